"""SQL that must give the same rows as the queries, run by another engine over the same tables.

The SQL states each result on its own terms: global row numbers for the split, joins for the language
model, windows for offsets and spans, long token tables for tags.
"""

from __future__ import annotations

from lisan import constants as C
from lisan.data import tables
from lisan.plans import queries as Q

SPACE = r"\s\p{Z}\x0B\x1C-\x1F\x{85}"
WORDPUNCT = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE}]+"
SIMPLE = rf"[\p{{L}}\p{{N}}\p{{M}}_]+|[^\p{{L}}\p{{N}}\p{{M}}_{SPACE}]"


def q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(q(c) for c in row) + ")" for row in rows) + ")"


WS = "concat(" + ", ".join(f"chr({ord(c)})" for c in C.WHITESPACE) + ")"
ARABISED = f"translate(lower(text), {q(Q.ARABISED_FROM)}, {q(Q.ARABISED_TO)})"
MARKS = (
    r"[\x{0617}-\x{061A}\x{064B}-\x{0652}\x{0670}\x{0653}-\x{065F}\x{06D6}-\x{06ED}]"
)


def sents(text: str = "text", name: str = "sents") -> str:
    """CTEs ending in ``sents(doc_id, sentence_index, sentence, start_char)``."""
    before, closers = r"(^|[^\p{L}\p{N}_])", C.CLOSERS.replace("'", "''")
    later = "|".join(C.OPEN_ABBREVIATIONS)
    masked = text
    for word in (r"(?:\p{L}\.){1,4}\p{L}", r"\p{Lu}", "|".join(C.ABBREVIATIONS)):
        masked = rf"regexp_replace({masked}, '{before}({word})\.', '\1\2' || chr(2), 'g')"
    for _ in range(2):  # a match takes the first letter of the next word along
        masked = rf"regexp_replace({masked}, '{before}({later})\.([{SPACE}]{{1,9}}[\p{{Ll}}\p{{N}}])', '\1\2' || chr(2) || '\3', 'g')"
    marked = rf"regexp_replace({masked}, '([.!?][{closers}]{{0,3}})([{SPACE}]+)', '\1' || chr(1) || '\2', 'g')"
    return located(f"string_split({marked}, chr(1))", name, fix=lambda x: f"replace({x}, chr(2), '.')")


def ar_sents(name: str = "sents") -> str:
    marked = rf"regexp_replace({ARABISED}, '([.!؟\n]+)', chr(1) || '\1' || chr(2), 'g')"
    return located(
        f"string_split({marked}, chr(1))",
        name,
        fix=lambda x: rf"regexp_replace({x}, '^[^\x{{02}}]*\x{{02}}', '')",
        lead=lambda x: f"instr({x}, chr(2))",
    )


def located(pieces: str, name: str, fix, lead=lambda x: "0") -> str:
    """Pieces in order; a piece's offset is the length of the pieces before it, less one per marker."""
    return rf"""{name}_pieces AS (
      SELECT doc_id, unnest(range(len(ps))) AS i, unnest(ps) AS raw
      FROM (SELECT doc_id, {pieces} AS ps FROM documents)),
    {name}_placed AS (
      SELECT doc_id, i, {fix('raw')} AS piece,
        coalesce(sum(length(raw) - CASE WHEN {lead('raw')} > 0 THEN 1 ELSE 0 END)
          OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + greatest({lead('raw')} - 1, 0) AS offs
      FROM {name}_pieces),
    {name} AS (
      SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS sentence_index,
        trim(piece, {WS}) AS sentence, (offs + length(piece) - length(ltrim(piece, {WS})))::INT AS start_char
      FROM {name}_placed WHERE trim(piece, {WS}) <> '')"""


def treebank(s: str) -> str:
    """The published word-token rules one by one."""
    rules = [
        ('^"', "`` "),
        (r'([ (\[{<])"', r"\1 `` "),
        (r"\.{2,}", r" \0 "),
        ("[«“‘„»”’]", r" \0 "),
        (r"[;@#$%&]", r" \0 "),
        (r"([:,])([^0-9])", r" \1 \2"),
        (r"([:,])$", r" \1 "),
        (r"""([^.])(\.)([\])}>"']*)\s*$""", r"\1 \2\3 "),
        (r"[?!]", r" \0 "),
        (r"[\]\[(){}<>]", r" \0 "),
        (r"--", " -- "),
        ('"', " '' "),
        (r"$", " "),
        (r"([^' ])('[sSmMdD]|') ", r"\1 \2 "),
        (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"\1 \2 "),
        (r"(?i)(^| )('t)(is|was)\b", r"\1\2 \3"),
        (r"(?i)\b(d)('ye)\b", r"\1 \2"),
        (r"(?i)\b(gim|lem)(me)\b", r"\1 \2"),
        (r"\b([Cc]an)(not)\b", r"\1 \2 "),
        (r"\b([Gg]on|[Gg]ot|[Ww]an)(na|ta)\b", r"\1 \2 "),
    ]
    for pattern, put in rules:
        s = f"regexp_replace({s}, {q(pattern)}, {q(put)}, 'g')"
    return f"regexp_split_to_array(trim({s}, {WS}), '[{SPACE}]+')"


def wordpunct(s: str) -> str:
    return f"regexp_extract_all({s}, '{WORDPUNCT}')"


def simple(s: str) -> str:
    return f"regexp_extract_all({s}, '{SIMPLE}')"


def toks(tokens: str, source: str = "sents", name: str = "toks") -> str:
    """Long form ``toks(doc_id, sentence_index, token_index, token)``."""
    return f"""{name} AS (
      SELECT doc_id, sentence_index, unnest(range(len(ts)))::INT AS token_index, unnest(ts) AS token
      FROM (SELECT doc_id, sentence_index, {tokens} AS ts FROM {source}))"""


TOKEN_ROWS = "SELECT doc_id, sentence_index, token_index, token FROM toks"


# Abbreviations and sentence starters by log-likelihood, stated token by token.
ENDS_CLOSERS = C.CLOSERS.replace("'", "''")


def xlogy(x: str, y: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 0 ELSE {x} * ln(CASE WHEN {x} = 0 THEN 1 ELSE {y} END) END)"


SHORTENED = rf"""raw AS (
      SELECT doc_id, coalesce(lang, '') AS lang, unnest(ts) AS token, unnest(range(len(ts))) AS i
      FROM (SELECT doc_id, lang, regexp_extract_all(text, '[^{SPACE}]+') AS ts FROM documents)),
    cores AS (
      SELECT *, regexp_replace(regexp_replace(token, '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}.]+$', '') AS core FROM raw),
    typed AS (
      SELECT doc_id, lang, i, token, usable AND regexp_matches(core, '[^.]\.$') AS stop,
        CASE WHEN usable THEN lower(CASE WHEN regexp_matches(core, '[^.]\.$') THEN left(core, length(core) - 1) ELSE core END) END AS type
      FROM (SELECT *, regexp_matches(core, '\p{{L}}') AND NOT regexp_matches(core, '\.\.$') AS usable FROM cores)),
    type_counts AS (
      SELECT lang, type, count(*) FILTER (stop) AS stopped, count(*) FILTER (NOT stop) AS plain,
        sum(count(*) FILTER (stop)) OVER l AS stops, sum(count(*)) OVER l AS tokens
      FROM typed WHERE type IS NOT NULL GROUP BY lang, type WINDOW l AS (PARTITION BY lang)),
    shortened AS (
      SELECT * FROM (
        SELECT lang, type, stopped, plain,
          -2 * ({xlogy('stopped', 'stops / tokens')} + {xlogy('plain', '1 - stops / tokens')}
            - (stopped * ln(0.99::DOUBLE) + plain * ln(1 - 0.99::DOUBLE)))
          * exp(-letters) * (length(type) - letters + 1) * pow(letters, -plain) AS score
        FROM (SELECT *, length(replace(type, '.', '')) AS letters FROM type_counts WHERE stopped > 0))
      WHERE score >= 0.3)"""

STARTERS = rf"""{SHORTENED},
    follows AS (
      SELECT t.lang, t.type, coalesce(regexp_matches(p.token, '[.!?][{ENDS_CLOSERS}]*$')
          AND NOT (p.stop AND (p.lang, p.type) IN (SELECT lang, type FROM shortened)), false) AS start
      FROM typed t LEFT JOIN typed p ON p.doc_id = t.doc_id AND p.i = t.i - 1 WHERE t.type IS NOT NULL),
    start_counts AS (
      SELECT lang, type, count(*) AS n, count(*) FILTER (start) AS starts, sum(count(*)) OVER l AS tokens,
        sum(count(*) FILTER (start)) OVER l AS ends
      FROM follows GROUP BY lang, type WINDOW l AS (PARTITION BY lang)),
    starters AS (
      SELECT lang, type, n, starts, score FROM (
        SELECT *, -2 * ({xlogy('starts', 'n / tokens')} + {xlogy('(ends - starts)', '1 - n / tokens')}
            + {xlogy('(n - starts)', 'n / tokens')} + {xlogy('(tokens - ends - n + starts)', '1 - n / tokens')}
            - {xlogy('starts', 'starts / ends')} - {xlogy('(ends - starts)', '1 - starts / ends')}
            - {xlogy('(n - starts)', '(n - starts) / (tokens - ends)')}
            - {xlogy('(tokens - ends - n + starts)', '1 - (n - starts) / (tokens - ends)')}) AS score
        FROM start_counts WHERE starts > 0)
      WHERE score >= 30 AND starts * tokens > n * ends)"""

# Pieces between all possible ends, joined again where the last word of one is shortened.
LEARNED_SENTENCES = rf"""{STARTERS},
    gap_pieces AS (
      SELECT doc_id, lang, unnest(range(len(ps))) AS i, unnest(ps) AS p
      FROM (SELECT doc_id, coalesce(lang, '') AS lang,
          string_split(regexp_replace(text, '([.!?][{ENDS_CLOSERS}]{{0,3}})([{SPACE}]+)', '\1' || chr(1) || '\2', 'g'), chr(1)) AS ps
        FROM documents)),
    ended AS (
      SELECT *, lag(p) OVER w AS before,
        regexp_extract(lag(p) OVER w, '([^{SPACE}]+)\.[{ENDS_CLOSERS}]{{0,3}}$', 1) AS last,
        regexp_extract(p, '^[{SPACE}]+[^\p{{L}}\p{{N}}{SPACE}]*(\p{{Lu}}[\p{{L}}\p{{N}}]*)', 1) AS next
      FROM gap_pieces WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    opens AS (
      SELECT e.doc_id, e.i, e.p, CASE WHEN before IS NULL OR
          NOT (EXISTS (SELECT 1 FROM shortened s WHERE s.lang = e.lang
              AND (lower(e.last) = s.type OR (ends_with(lower(e.last), s.type)
                AND NOT regexp_matches(left(lower(e.last), length(e.last) - length(s.type)), '[\p{{L}}\p{{N}}.]$'))))
            AND NOT EXISTS (SELECT 1 FROM starters t WHERE t.lang = e.lang AND e.next <> ''
              AND (lower(e.next) = t.type)))
        THEN 1 ELSE 0 END AS open
      FROM ended e),
    sentence_pieces AS (
      SELECT doc_id, string_agg(p, '' ORDER BY i) AS sentence, n
      FROM (SELECT *, sum(open) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM opens) GROUP BY doc_id, n),
    learned_sents AS (
      SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1)::INT AS sentence_index, trim(sentence, {WS}) AS sentence
      FROM sentence_pieces WHERE trim(sentence, {WS}) <> '')"""


# --- language model -----------------------------------------------------------------


def model(text: str, tokens: str, boundaries: bool) -> str:
    """CTEs: numbered sentences, padded train tokens, bigrams, vocabulary, test bigrams."""
    test = (
        "SELECT word, lead(word) OVER (PARTITION BY pos ORDER BY i) AS nxt FROM padded WHERE NOT train"
        if boundaries
        else "SELECT word, lead(word) OVER (PARTITION BY pos ORDER BY i) AS nxt FROM padded "
        "WHERE NOT train AND i > 0 AND i <= k"
    )
    return f"""{sents(text)},
    numbered AS (
      SELECT *, row_number() OVER (ORDER BY doc_id, sentence_index) - 1 AS pos, count(*) OVER () AS total
      FROM sents),
    parts AS (
      SELECT *, pos < floor(total * 0.8::DOUBLE) AS train, {tokens} AS ts FROM numbered),
    padded AS (
      SELECT pos, train, len(ts) AS k, unnest(range(len(ts) + 2)) AS i,
        unnest(list_concat(['<s>'], ts, ['</s>'])) AS word FROM parts),
    vocab AS (SELECT word, count(*) AS n FROM padded WHERE train GROUP BY word),
    size AS (SELECT count(*) + 1 AS v FROM vocab),
    bigrams AS (
      SELECT word AS context, nxt AS word, count(*) AS n
      FROM (SELECT word, lead(word) OVER (PARTITION BY pos ORDER BY i) AS nxt FROM padded WHERE train)
      WHERE nxt IS NOT NULL GROUP BY 1, 2),
    contexts AS (SELECT context, sum(n) AS n FROM bigrams GROUP BY context),
    tests AS (
      SELECT word AS context, nxt AS word, count(*) AS m FROM ({test}) WHERE nxt IS NOT NULL GROUP BY 1, 2),
    looked AS (
      SELECT t.context, t.word, m, coalesce(a.word, '<UNK>') AS context_lookup,
        coalesce(b.word, '<UNK>') AS word_lookup
      FROM tests t LEFT JOIN vocab a ON a.word = t.context LEFT JOIN vocab b ON b.word = t.word),
    scored AS (
      SELECT l.*, coalesce(g.n, 0) AS n, coalesce(c.n, 0) AS context_n,
        (coalesce(g.n, 0) + 1)::DOUBLE / (coalesce(c.n, 0) + v) AS score
      FROM looked l CROSS JOIN size
      LEFT JOIN bigrams g ON g.context = l.context_lookup AND g.word = l.word_lookup
      LEFT JOIN contexts c ON c.context = l.context_lookup),
    summary AS (
      SELECT (SELECT count(*) FROM parts)::BIGINT AS sentences,
        (SELECT count(*) FROM parts WHERE train)::BIGINT AS train_sentences,
        (SELECT count(*) FROM parts WHERE NOT train)::BIGINT AS test_sentences,
        (SELECT v FROM size)::BIGINT AS vocabulary, sum(m)::BIGINT AS test_bigrams,
        pow(2, -sum(m * log2(score)) / sum(m)) AS perplexity FROM scored)"""


ENGLISH_MODEL = model("text", treebank("lower(sentence)"), boundaries=False)
ARABIC_MODEL = model(ARABISED, wordpunct("sentence"), boundaries=True)


def greedy(seeds: list[str], steps: int, ctes: str) -> str:
    start = ", ".join(f"({i}, {q(s)})" for i, s in enumerate(seeds))
    return f"""{ctes},
    best AS (
      SELECT context, arg_min(word, (-n, word)) AS word FROM bigrams GROUP BY context),
    top AS (SELECT arg_min(word, (-n, word)) AS word FROM vocab),
    walk AS (
      SELECT seed_id::BIGINT AS seed_id, 0 AS step, seed AS last, NULL::VARCHAR AS generated, seed AS text
      FROM (VALUES {start}) s(seed_id, seed)
      UNION ALL
      SELECT seed_id, step + 1, coalesce(b.word, t.word), concat_ws(' ', generated, coalesce(b.word, t.word)),
        text || ' ' || coalesce(b.word, t.word)
      FROM walk CROSS JOIN top t LEFT JOIN best b ON b.context = walk.last WHERE step < {steps})"""


def sampled(seeds: list[str], steps: int, ctes: str) -> str:
    """One CTE per step: draw by the smallest waiting time among followers, else among all words."""
    start = ", ".join(f"({i}, {q(s)})" for i, s in enumerate(seeds))
    out = f"""{ctes},
    w0 AS (SELECT seed_id::BIGINT AS seed_id, seed AS last, seed AS text
      FROM (VALUES {start}) s(seed_id, seed))"""
    for i in range(1, steps + 1):
        wait = (
            f"-ln((('0x' || substr(md5(seed_id::VARCHAR || '|{i}|' || c.word || '|0'), 1, 13))::BIGINT + 0.5::DOUBLE)"
            " / 4503599627370496::DOUBLE) / (c.n + 1)"
        )
        out += f""",
    d{i} AS (
      SELECT seed_id, arg_min(c.word, {wait}) AS word FROM w{i - 1} JOIN bigrams c ON c.context = last GROUP BY seed_id),
    u{i} AS (
      SELECT seed_id, arg_min(c.word, {wait}) AS word FROM w{i - 1} CROSS JOIN vocab c GROUP BY seed_id),
    w{i} AS (
      SELECT seed_id, coalesce(d{i}.word, u{i}.word) AS last, text || ' ' || coalesce(d{i}.word, u{i}.word) AS text
      FROM w{i - 1} LEFT JOIN d{i} USING (seed_id) JOIN u{i} USING (seed_id))"""
    return out


def drawn(seeds: list[str], steps: int, ctes: str) -> str:
    """One CTE per step: a number below the context's total falls into a block, then onto a word."""
    start = ", ".join(f"({i}, {q(s)})" for i, s in enumerate(seeds))
    out = f"""{ctes},
    choices AS (SELECT context, word, n FROM bigrams UNION ALL SELECT '', word, n FROM vocab),
    dealt AS (
      SELECT *, ('0x' || substr(md5(word), 1, 8))::BIGINT % ceil(count(*) OVER (PARTITION BY context) / 1024)::BIGINT AS block
      FROM choices),
    ends AS MATERIALIZED (
      SELECT context, word, sum(n + 1) OVER (PARTITION BY context ORDER BY block, word) AS upto,
        sum(n + 1) OVER (PARTITION BY context) AS total, n + 1 AS w FROM dealt),
    known AS (SELECT DISTINCT context FROM bigrams),
    w0 AS (
      SELECT seed_id::BIGINT AS seed_id, CASE WHEN seed IN (SELECT context FROM known) THEN seed ELSE '' END AS last, seed AS text
      FROM (VALUES {start}) s(seed_id, seed))"""
    for i in range(1, steps + 1):
        number = (
            f"floor((('0x' || substr(md5(seed_id::VARCHAR || '|{i}||0'), 1, 13))::BIGINT + 0.5::DOUBLE)"
            " / 4503599627370496::DOUBLE * e.total)"
        )
        out += f""",
    w{i} AS MATERIALIZED (
      SELECT seed_id, CASE WHEN e.word = '</s>' THEN '' ELSE e.word END AS last, text || ' ' || e.word AS text
      FROM w{i - 1} JOIN ends e ON e.context = last AND {number} >= e.upto - e.w AND {number} < e.upto)"""
    return out


# Text that the model has not seen: the turns of conversations.
OTHER_SENTS = sents(name="other_sents").replace("FROM documents", "FROM (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations)")
OTHER = f"""{ENGLISH_MODEL}, {OTHER_SENTS},
    other_padded AS (
      SELECT doc_id, sentence_index, len(ts) AS k, unnest(range(len(ts) + 2)) AS i, unnest(list_concat(['<s>'], ts, ['</s>'])) AS word
      FROM (SELECT *, {treebank('lower(sentence)')} AS ts FROM other_sents)),
    other_pairs AS (
      SELECT word AS context, lead(word) OVER (PARTITION BY doc_id, sentence_index ORDER BY i) AS word, i, k FROM other_padded),
    others AS (
      SELECT context, word, count(*) AS m FROM other_pairs WHERE word IS NOT NULL AND i > 0 AND i < k GROUP BY 1, 2),
    other_scored AS (
      SELECT t.context, t.word, coalesce(a.word, '<UNK>') AS context_lookup, coalesce(b.word, '<UNK>') AS word_lookup, m,
        coalesce(g.n, 0) AS n, coalesce(c.n, 0)::BIGINT AS context_n, (coalesce(g.n, 0) + 1)::DOUBLE / (coalesce(c.n, 0) + v) AS score
      FROM others t CROSS JOIN size LEFT JOIN vocab a ON a.word = t.context LEFT JOIN vocab b ON b.word = t.word
      LEFT JOIN bigrams g ON g.context = t.context AND g.word = t.word LEFT JOIN contexts c ON c.context = t.context)"""


# --- tags ------------------------------------------------------------------------------


def shape_case(shapes, default: str, token: str = "token") -> str:
    tests = {
        "capital": "left({t}, 1) <> lower(left({t}, 1))",
        "prefix": "regexp_matches({t}, {p})",
        "suffix": "regexp_matches({t}, {p})",
        "pattern": "regexp_matches({t}, {p})",
    }
    anchored = {"prefix": "^{}", "suffix": "{}$"}
    whens = " ".join(
        f"WHEN {tests[kind].format(t=token, p=q(anchored.get(kind, '{}').replace('{}', value)))} THEN {q(tag)}"
        for kind, value, tag in shapes
    )
    return f"CASE {whens} ELSE {q(default)} END"


def tagged(tokens: str, lexicon, shapes, default: str, rules, source: str = "sents") -> str:
    """CTEs from tokens to ``tagged(..., base_tag, tag)``: lexicon join, shapes, one window per rule."""
    words = [(w, tag) for tag, ws in lexicon.items() for w in ws]
    out = f"""{toks(tokens, source)},
    lexicon(word, tag) AS {values(words)},
    r0 AS (
      SELECT doc_id, sentence_index, token_index, token, coalesce(l.tag, {shape_case(shapes, default)}) AS tag
      FROM toks LEFT JOIN lexicon l ON l.word = lower(token))"""
    if not rules:
        return out + """,
    tagged AS (SELECT *, tag AS base_tag FROM r0)"""
    return out + ruled(rules, "r0") + f""",
    tagged AS (SELECT r.*, r0.tag AS base_tag FROM r{len(rules)} r
      JOIN r0 USING (doc_id, sentence_index, token_index))"""


def ruled(rules, first: str, mark: str = "r") -> str:
    out = ""
    for i, (previous, old, following, new) in enumerate(rules, 1):
        test = f"tag = {q(old)}"
        if previous:
            test += f" AND lag(tag) OVER w = {q(previous)}"
        if following:
            test += f" AND lead(tag) OVER w = {q(following)}"
        source = first if i == 1 else f"{mark}{i - 1}"
        out += f""",
    {mark}{i} AS (
      SELECT doc_id, sentence_index, token_index, token, CASE WHEN {test} THEN {q(new)} ELSE tag END AS tag
      FROM {source} WINDOW w AS (PARTITION BY doc_id, sentence_index ORDER BY token_index))"""
    return out


ENGLISH_TAGS = f"""{sents()},
    {tagged(treebank("sentence"), tables.ENGLISH_LEXICON, tables.ENGLISH_SHAPES, tables.ENGLISH_DEFAULT, tables.ENGLISH_CONTEXT)}"""
ARABIC_TAGS = f"""{sents(ARABISED)},
    {tagged(simple("sentence"), tables.ARABIC_LEXICON, tables.ARABIC_SHAPES, tables.ARABIC_DEFAULT, [])}"""

TRAINED = """counted AS (
      SELECT lower(token) AS token, tag, count(*) AS n FROM tagged GROUP BY 1, 2),
    trained AS (
      SELECT token, tag, n FROM counted
      QUALIFY row_number() OVER (PARTITION BY token ORDER BY n DESC, tag) = 1)"""

# Phrases by marking matches in the string of tag letters; odd pieces are phrases.
CHUNKS = """codes AS (
      SELECT doc_id, sentence_index, list(token ORDER BY token_index) AS tokens,
        list(token || '/' || tag ORDER BY token_index) AS leaves,
        string_agg(CASE WHEN tag = 'DT' THEN 'D' WHEN tag LIKE 'JJ%' THEN 'J' WHEN tag LIKE 'NN%' THEN 'N'
          ELSE 'x' END, '' ORDER BY token_index) AS code
      FROM tagged GROUP BY ALL),
    marked AS (
      SELECT doc_id, sentence_index, tokens, leaves,
        string_split(regexp_replace(code, '(D?J*N+)', '|\\1|', 'g'), '|') AS ps FROM codes),
    pieces AS (
      SELECT doc_id, sentence_index, tokens, leaves, unnest(range(len(ps))) AS i, unnest(ps) AS p FROM marked),
    placed AS (
      SELECT *, (sum(length(p)) OVER (PARTITION BY doc_id, sentence_index ORDER BY i) - length(p))::INT AS start_token
      FROM pieces)"""


# Costs of a hidden Markov tagger in whole millionths, learned from the first 80 % of the sentences.
TAGGER = f"""{ENGLISH_TAGS},
    cut AS (
      SELECT doc_id, sentence_index, row_number() OVER (ORDER BY doc_id, sentence_index) - 1 < floor(count(*) OVER () * 0.8::DOUBLE) AS train
      FROM sents),
    learn AS (SELECT t.* FROM tagged t JOIN cut USING (doc_id, sentence_index) WHERE train),
    moves AS (
      SELECT coalesce(lag(tag) OVER w, '<s>') AS previous, tag FROM learn
      WINDOW w AS (PARTITION BY doc_id, sentence_index ORDER BY token_index)
      UNION ALL
      SELECT arg_max(tag, token_index), '</s>' FROM learn GROUP BY doc_id, sentence_index),
    transitions AS (
      SELECT previous, tag, n, round(1000000 * (ln(total + kinds) - ln(n + 1)))::BIGINT AS cost
      FROM (SELECT previous, tag, count(*) AS n, sum(count(*)) OVER (PARTITION BY previous) AS total,
          (SELECT count(DISTINCT tag) + 1 FROM learn) AS kinds FROM moves GROUP BY 1, 2)),
    emissions AS (
      SELECT token, tag, n, round(1000000 * (ln(total + words) - ln(n + 1)))::BIGINT AS cost
      FROM (SELECT lower(token) AS token, tag, count(*) AS n, sum(count(*)) OVER (PARTITION BY tag) AS total,
          (SELECT count(DISTINCT lower(token)) + 1 FROM learn) AS words FROM learn GROUP BY 1, 2))"""

# The cheapest path by a recursive query: every cheapest way to a tag of the next token.
VITERBI = f"""{TAGGER},
    kinds AS (
      SELECT tag, any_value(total) AS total, any_value(words) AS words, count(*) FILTER (all_n = 1) AS once
      FROM (SELECT tag, sum(n) OVER (PARTITION BY tag) AS total, sum(n) OVER (PARTITION BY token) AS all_n,
          (SELECT count(DISTINCT token) + 1 FROM emissions) AS words FROM emissions) GROUP BY tag),
    choices AS MATERIALIZED (
      SELECT k.doc_id, k.sentence_index, k.token_index, k.token, e.tag, e.cost FROM toks k JOIN emissions e ON e.token = lower(k.token)
      UNION ALL
      SELECT k.doc_id, k.sentence_index, k.token_index, k.token, a.tag, round(1000000 * (ln(a.total + a.words) - ln(a.once + 1)))::BIGINT
      FROM toks k, kinds a WHERE lower(k.token) NOT IN (SELECT token FROM emissions)),
    every AS MATERIALIZED (
      SELECT p.tag AS previous, q.tag, coalesce(t.cost, round(1000000 * ln(p.total + (SELECT count(*) + 1 FROM kinds)))::BIGINT) AS cost
      FROM (SELECT previous AS tag, sum(n) AS total FROM transitions GROUP BY 1) p,
        (SELECT tag FROM kinds UNION ALL SELECT '</s>') q
      LEFT JOIN transitions t ON t.previous = p.tag AND t.tag = q.tag),
    walk AS (
      SELECT doc_id, sentence_index, 0 AS token_index, c.tag, {{'cost': c.cost + t.cost, 'previous': '<s>', 'path': [c.tag]}} AS best
      FROM choices c JOIN every t ON t.previous = '<s>' AND t.tag = c.tag WHERE token_index = 0
      UNION ALL
      SELECT c.doc_id, c.sentence_index, c.token_index, c.tag,
        min({{'cost': w.best.cost + t.cost + c.cost, 'previous': w.tag, 'path': list_append(w.best.path, c.tag)}})
      FROM walk w JOIN choices c ON c.doc_id = w.doc_id AND c.sentence_index = w.sentence_index AND c.token_index = w.token_index + 1
      JOIN every t ON t.previous = w.tag AND t.tag = c.tag
      GROUP BY c.doc_id, c.sentence_index, c.token_index, c.tag),
    lengths AS (SELECT doc_id, sentence_index, max(token_index) AS token_index FROM toks GROUP BY 1, 2),
    paths AS (
      SELECT doc_id, sentence_index, min({{'cost': best.cost + t.cost, 'tag': w.tag, 'path': best.path}}).path AS path
      FROM walk w JOIN lengths USING (doc_id, sentence_index, token_index) JOIN every t ON t.previous = w.tag AND t.tag = '</s>'
      GROUP BY 1, 2),
    decoded AS (
      SELECT k.doc_id, k.sentence_index, k.token_index, k.token, path[k.token_index + 1] AS tag
      FROM toks k JOIN paths USING (doc_id, sentence_index))"""


def greedy_rules(rounds: int) -> str:
    """Round by round: every rule over a neighbour or both, the best by what it mends less what it breaks."""
    out = f"""{ENGLISH_TAGS}, g0 AS (SELECT doc_id, sentence_index, token_index, base_tag AS tag, tag AS gold FROM tagged)"""
    for i in range(1, rounds + 1):
        out += f""",
    a{i} AS MATERIALIZED (
      SELECT *, lag(tag) OVER w AS p, lead(tag) OVER w AS f FROM g{i - 1}
      WINDOW w AS (PARTITION BY doc_id, sentence_index ORDER BY token_index)),
    c{i} AS (
      SELECT p AS previous, tag AS old, NULL AS following, gold FROM a{i} WHERE p IS NOT NULL
      UNION ALL SELECT NULL, tag, f, gold FROM a{i} WHERE f IS NOT NULL
      UNION ALL SELECT p, tag, f, gold FROM a{i} WHERE p IS NOT NULL AND f IS NOT NULL),
    n{i} AS (SELECT previous, old, following, gold, count(*) AS n FROM c{i} GROUP BY ALL),
    b{i} AS MATERIALIZED (
      SELECT x.previous, x.old, x.following, x.gold AS new, x.n AS good, coalesce(y.n, 0) AS bad FROM n{i} x
      LEFT JOIN n{i} y ON y.gold = y.old AND y.old = x.old AND y.previous IS NOT DISTINCT FROM x.previous
        AND y.following IS NOT DISTINCT FROM x.following
      WHERE x.gold <> x.old AND x.n > coalesce(y.n, 0)
      ORDER BY good - bad DESC, previous NULLS FIRST, old, following NULLS FIRST, new LIMIT 1),
    g{i} AS (
      SELECT doc_id, sentence_index, token_index, gold, CASE WHEN tag = old AND (previous IS NULL OR coalesce(p = previous, false))
        AND (following IS NULL OR coalesce(f = following, false)) THEN new ELSE tag END AS tag FROM a{i} CROSS JOIN b{i})"""
    rows = " UNION ALL ".join(
        f"""SELECT {i} AS round, *, (SELECT count(*) FROM a{i} WHERE tag <> gold) AS errors_before,
          (SELECT count(*) FROM g{i} WHERE tag <> gold) AS errors_after FROM b{i}"""
        for i in range(1, rounds + 1)
    )
    return f"WITH {out} {rows}"


# --- entities --------------------------------------------------------------------------


OFFSETS = """gaps AS (
      SELECT doc_id, sentence_index, sentence, start_char,
        unnest(range(len(ps))) AS i, unnest(ps) AS p
      FROM (SELECT *, string_split(regexp_replace(sentence, '(%s)', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS ps
        FROM sents)),
    offsets AS (
      SELECT doc_id, sentence_index, sentence, start_char AS base, ((i - 1) // 2)::INT AS token_index, p AS token,
        (before - length(p))::INT AS s, before::INT AS e
      FROM (SELECT *, sum(length(p)) OVER (PARTITION BY doc_id, sentence_index ORDER BY i) AS before FROM gaps)
      WHERE i %% 2 = 1)""" % WORDPUNCT


def gazetteer(phrases: list[tuple[str, str]], mark: str = "") -> str:
    """CTEs to ``found``: longest-first alternation over tokens spelled as `` w1  w2 ``."""
    spelled = sorted(phrases, key=lambda p: (-len(p[0].split()), p[0]))
    either = "|".join(" " + "  ".join(p.split()) + " " for p, _ in spelled)
    labels = values([(" " + "  ".join(p.split()) + " ", label) for p, label in phrases])
    n = lambda x: f"(length({x}) - length(replace({x}, ' ', ''))) // 2"
    return f"""spelled{mark} AS (
      SELECT doc_id, sentence_index, string_agg(' ' || token || ' ', '' ORDER BY token_index) AS line
      FROM offsets GROUP BY ALL),
    split{mark} AS (
      SELECT doc_id, sentence_index, unnest(range(len(ps))) AS i, unnest(ps) AS p
      FROM (SELECT *, string_split(regexp_replace(line, '({either})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS ps
        FROM spelled{mark})),
    spans{mark} AS (
      SELECT doc_id, sentence_index, label, (upto - {n('p')})::INT AS start_token, upto::INT AS end_token
      FROM (SELECT *, sum({n('p')}) OVER (PARTITION BY doc_id, sentence_index ORDER BY i) AS upto FROM split{mark})
      JOIN {labels} l(phrase, label) ON phrase = p WHERE i % 2 = 1),
    found{mark} AS (
      SELECT s.doc_id, s.sentence_index, a.sentence, a.base, s.label, s.start_token, s.end_token, a.s, b.e,
        substr(a.sentence, a.s + 1, b.e - a.s) AS entity
      FROM spans{mark} s
      JOIN offsets a ON a.doc_id = s.doc_id AND a.sentence_index = s.sentence_index AND a.token_index = start_token
      JOIN offsets b ON b.doc_id = s.doc_id AND b.sentence_index = s.sentence_index AND b.token_index = end_token - 1)"""


def labels(mark: str = "") -> str:
    return f"""labels{mark} AS (
      SELECT o.doc_id, o.sentence_index, o.token_index, o.token, coalesce(s.label, 'O') AS label
      FROM offsets o LEFT JOIN spans{mark} s ON s.doc_id = o.doc_id AND s.sentence_index = o.sentence_index
        AND o.token_index >= s.start_token AND o.token_index < s.end_token)"""


ENGLISH_FOUND = f"{sents()}, {OFFSETS}, {gazetteer(tables.ENGLISH_GAZETTEER)}"
ARABIC_FOUND = f"""{ar_sents()}, {OFFSETS},
    {gazetteer([(Q.arabised_word(p), label) for p, label in Q.ARABISED_GAZETTEER])}"""

PATTERN_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, '{label}' AS label, p AS text, (upto - length(p))::INT AS start_char, upto::INT AS end_char
    FROM (SELECT doc_id, i, p, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS upto
      FROM (SELECT doc_id, unnest(range(len(ps))) AS i, unnest(ps) AS p
        FROM (SELECT doc_id, string_split(regexp_replace(text, '({pattern})', chr(1) || '\\1' || chr(1), 'g'),
          chr(1)) AS ps FROM documents)))
    WHERE i % 2 = 1"""
    for label, pattern in tables.ENTITY_PATTERNS
)

# Gaps and islands over BIO labels.
BIO = rf"""{sents()},
    {toks(wordpunct("sentence"))},
    labelled AS (
      SELECT *, CASE WHEN regexp_matches(token, '^\p{{Lu}}') THEN 'CAP' WHEN regexp_matches(token, '^\p{{N}}') THEN 'NUM' END AS kind,
        length(token) % 3 = 0 AS opener, 1.0::DOUBLE / length(token) AS score FROM toks),
    flagged AS (
      SELECT *, CASE WHEN kind IS NOT NULL AND (opener OR lag(kind) OVER w IS DISTINCT FROM kind) THEN 1 ELSE 0 END AS opens
      FROM labelled WINDOW w AS (PARTITION BY doc_id, sentence_index ORDER BY token_index)),
    islands AS (
      SELECT *, sum(opens) OVER (PARTITION BY doc_id, sentence_index ORDER BY token_index) AS island FROM flagged),
    spans AS (
      SELECT doc_id, sentence_index, min(token_index)::INT AS start, (max(token_index) + 1)::INT AS "end",
        kind AS label, round(avg(score), 6) AS score, string_agg(token, ' ' ORDER BY token_index) AS entity
      FROM islands WHERE kind IS NOT NULL GROUP BY doc_id, sentence_index, island, kind)"""


# --- evaluation ------------------------------------------------------------------------


def prf1(pairs: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""SELECT {key}tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall,
      round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1
    FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS p,
        CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS r
      FROM (SELECT {key}count(*) FILTER (gold <> 'O' AND gold = pred) AS tp,
          count(*) FILTER (gold = 'O' AND pred <> 'O') AS fp,
          count(*) FILTER (gold <> 'O' AND gold <> pred) AS fn FROM {pairs}{group}))"""


LEARNED = f"""{ENGLISH_TAGS}, {TRAINED},
    t0 AS (
      SELECT k.doc_id, k.sentence_index, k.token_index, k.token,
        coalesce(t.tag, {shape_case(tables.ENGLISH_SHAPES, tables.ENGLISH_DEFAULT, 'k.token')}) AS tag
      FROM toks k LEFT JOIN trained t ON t.token = lower(k.token))
    {ruled(tables.ENGLISH_CONTEXT, 't0', 't')},
    learned AS (SELECT * FROM t{len(tables.ENGLISH_CONTEXT)})"""

# Spans in order of preference, folded to those that begin after the last one kept.
MERGED = f"""{ENGLISH_FOUND},
    every AS (
      SELECT doc_id, entity AS text, label, base + s AS start_char, base + e AS end_char FROM found
      UNION ALL SELECT doc_id, text, label, start_char, end_char FROM ({PATTERN_FOUND})),
    lists AS (
      SELECT doc_id, list([struct_pack(s := start_char, e := end_char, label := label, text := text)]
        ORDER BY start_char, end_char DESC, label) AS xs FROM every GROUP BY doc_id),
    apart AS (
      SELECT doc_id, unnest(list_reduce(xs, lambda kept, x: CASE WHEN x[1].s >= kept[len(kept)].e
        THEN list_concat(kept, x) ELSE kept END)) AS x FROM lists),
    merged AS (
      SELECT doc_id AS article_index, x.text AS text, x.label AS label, x.s AS start_char, x.e AS end_char FROM apart)"""


def confusion(gold: str, pred: str, source: str) -> str:
    return f"""names AS (SELECT {gold} AS label FROM {source} UNION SELECT {pred} FROM {source}),
    ranked AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS code FROM names),
    matrix AS (
      SELECT g.label AS gold, p.label AS pred, count(t.doc_id) AS n
      FROM names g CROSS JOIN names p LEFT JOIN {source} t ON t.{gold} = g.label AND t.{pred} = p.label
      GROUP BY 1, 2)"""


def top(column: str, source: str, n: int | None = None) -> str:
    limit = f" ORDER BY n DESC, value LIMIT {n}" if n else ""
    return f"SELECT {column} AS value, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1{limit}"


def summary() -> str:
    english = f"WITH RECURSIVE {greedy(['the'], 5, ENGLISH_MODEL)}"
    arabic = f"WITH RECURSIVE {greedy([Q.arabised_word('the')], 10, ARABIC_MODEL)}"
    quoted = lambda x: (
        f"CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || replace({x}, '\\', '\\\\') || '\"' "
        f"ELSE '''' || replace(replace({x}, '\\', '\\\\'), '''', '\\''') || '''' END"
    )
    pos = f"""WITH {ENGLISH_TAGS}
      SELECT '[' || string_agg('(' || {quoted('token')} || ', ' || {quoted('tag')} || ')', ', ' ORDER BY token_index) || ']'
      FROM tagged WHERE doc_id = (SELECT min(doc_id) FROM documents) AND sentence_index = 0"""
    lines = [
        "SELECT 2, '=== DATA STATS ==='",
        "SELECT 3, 'Total English articles: ' || count(*) FROM documents",
        "SELECT 4, 'Total Arabic articles: ' || count(*) FROM documents",
        "SELECT 5, ''",
    ]
    for base, name, label, ctes, column in (
        (6, "ENGLISH", "English", english, "generated"),
        (11, "ARABIC", "Arabic", arabic, "text"),
    ):
        lines += [
            f"SELECT {base}, '=== {name} N-GRAM LM (BIGRAM) ==='",
            f"SELECT {base + 1}, '{label} vocab size: ' || vocabulary FROM ({ctes} SELECT vocabulary FROM summary)",
            f"SELECT {base + 2}, printf('{label} perplexity: %.6f', perplexity) FROM ({ctes} SELECT perplexity FROM summary)",
            f"SELECT {base + 3}, '{label} sample generation: ' || {column} FROM ({ctes} SELECT * FROM walk ORDER BY step DESC LIMIT 1)",
            f"SELECT {base + 4}, ''",
        ]
    lines += ["SELECT 16, '=== ENGLISH POS SAMPLE (FIRST SENTENCE) ==='", f"SELECT 17, ({pos})"]
    return "SELECT ord::INT AS ord, line FROM (" + " UNION ALL ".join(lines) + ") r(ord, line)"


MODEL_COLUMNS = "vocabulary, test_bigrams, round(perplexity, 6) AS perplexity"

ORACLES: dict[str, str] = {
    "corpus_counts": f"""WITH {sents()},
      n AS (SELECT doc_id, count(*) AS k FROM sents GROUP BY 1)
      SELECT lang, count(*) AS articles, sum(coalesce(k, 0))::BIGINT AS sentences,
        sum(len({wordpunct('text')}))::BIGINT AS tokens
      FROM documents LEFT JOIN n USING (doc_id) GROUP BY lang""",
    "article_preview": "SELECT doc_id, left(text, 150) || '...' AS preview FROM documents",
    "first_articles": "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 200",
    "en_sentences": f"WITH {sents()} SELECT * FROM sents",
    "ar_sentences": f"WITH {ar_sents()} SELECT * FROM sents",
    "abbreviations": f"WITH {SHORTENED} SELECT * EXCLUDE (score), round(score, 6) AS score FROM shortened",
    "sentence_starters": f"WITH {STARTERS} SELECT * EXCLUDE (score), round(score, 4) AS score FROM starters",
    "learned_sentences": f"WITH {LEARNED_SENTENCES} SELECT doc_id, sentence_index, sentence FROM learned_sents",
    "ar_first_pieces": rf"""SELECT doc_id, string_split(regexp_replace({ARABISED}, '[.!؟\n]+', chr(1), 'g'), chr(1))[1]
      AS piece FROM documents""",
    "sample_words": f"""WITH {sents()}, {toks(treebank('sentence'))},
      nth AS (SELECT doc_id FROM documents QUALIFY row_number() OVER (ORDER BY doc_id) = 6)
      {TOKEN_ROWS} JOIN nth USING (doc_id) WHERE sentence_index = 0""",
    "en_word_tokens": f"WITH {sents()}, {toks(treebank('sentence'))} {TOKEN_ROWS}",
    "wordpunct_tokens": f"WITH {sents(ARABISED)}, {toks(wordpunct('sentence'))} {TOKEN_ROWS}",
    "simple_word_tokens": f"WITH {sents(ARABISED)}, {toks(simple('sentence'))} {TOKEN_ROWS}",
    "token_offsets": f"""WITH {sents()}, {OFFSETS}
      SELECT doc_id, sentence_index, token_index, token, base + s AS start_char, base + e AS end_char FROM offsets""",
    "normalize_arabic": f"""SELECT doc_id, replace(replace(replace(replace(replace(regexp_replace(
        regexp_replace({ARABISED}, '{MARKS}', '', 'g'), '[إأآا]', 'ا', 'g'), 'ة', 'ه'), 'ى', 'ي'), 'ؤ', 'و'),
        'ئ', 'ي'), 'ـ', '') AS text FROM documents""",
    "top_tokens": f"""SELECT value, count(*) AS n FROM (SELECT unnest({wordpunct('text')}) AS value FROM documents)
      GROUP BY 1 ORDER BY n DESC, value LIMIT 20""",
    "positional_split": f"""WITH {sents()}
      SELECT doc_id, sentence_index, CASE WHEN pos < floor(total * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part
      FROM (SELECT *, row_number() OVER (ORDER BY doc_id, sentence_index) - 1 AS pos, count(*) OVER () AS total FROM sents)""",
    "everygrams": f"""WITH {sents()},
      padded AS (
        SELECT doc_id, sentence_index, unnest(range(len(ts) + 2)) AS i,
          unnest(list_concat(['<s>'], ts, ['</s>'])) AS word
        FROM (SELECT doc_id, sentence_index, {treebank('lower(sentence)')} AS ts FROM sents)),
      pairs AS (
        SELECT word AS context, lead(word) OVER (PARTITION BY doc_id, sentence_index ORDER BY i) AS word FROM padded)
      SELECT NULL AS context, word, count(*) AS n FROM padded GROUP BY word
      UNION ALL SELECT context, word, count(*) FROM pairs WHERE word IS NOT NULL GROUP BY 1, 2""",
    "lm_vocab": f"WITH {ENGLISH_MODEL} SELECT word, n FROM vocab",
    "lm_bigram_counts": f"WITH {ENGLISH_MODEL} SELECT context, word, n FROM bigrams",
    "lm_scores": f"""WITH {ENGLISH_MODEL}
      SELECT context, word, context_lookup, word_lookup, m, n, context_n::BIGINT AS context_n, round(score, 9) AS score
      FROM scored""",
    "en_perplexity": f"WITH {ENGLISH_MODEL} SELECT {MODEL_COLUMNS} FROM summary",
    "ar_perplexity": f"WITH {ARABIC_MODEL} SELECT {MODEL_COLUMNS} FROM summary",
    "lm_summary": f"WITH {ENGLISH_MODEL} SELECT sentences, train_sentences, test_sentences, {MODEL_COLUMNS} FROM summary",
    "generate_greedy": f"""WITH RECURSIVE {greedy(Q.GREEDY_SEEDS, 5, ENGLISH_MODEL)}
      SELECT seed_id, generated, text FROM walk WHERE step = 5""",
    "generate_sample": f"""WITH {sampled([Q.arabised_word(w) for w in Q.ARABISED_SEEDS], 10, ARABIC_MODEL)}
      SELECT seed_id, substr(w10.text, length(w0.text) + 2) AS generated, w10.text FROM w10 JOIN w0 USING (seed_id)""",
    "generate_drawn": f"""WITH {drawn(Q.DRAWN_SEEDS, 5, ENGLISH_MODEL)}
      SELECT seed_id, substr(w5.text, length(w0.text) + 2) AS generated, w5.text FROM w5 JOIN w0 USING (seed_id)""",
    "lm_save": f"""WITH {ENGLISH_MODEL}
      SELECT b.context, b.word, b.n, c.n::BIGINT AS context_n FROM bigrams b JOIN contexts c USING (context)""",
    "lm_score_other": f"WITH {OTHER} SELECT * EXCLUDE (score), round(score, 9) AS score FROM other_scored",
    "lm_perplexity_other": f"""WITH {OTHER}
      SELECT (SELECT v FROM size)::BIGINT AS vocabulary, sum(m)::BIGINT AS test_bigrams,
        round(pow(2, -sum(m * log2(score)) / sum(m)), 6) AS perplexity FROM other_scored""",
    "lm_merge": f"""WITH {OTHER}
      SELECT context, word, sum(n)::BIGINT AS n FROM (
        SELECT context, word, n FROM bigrams UNION ALL
        SELECT context, word, count(*) FROM other_pairs WHERE word IS NOT NULL GROUP BY 1, 2) GROUP BY 1, 2""",
    "en_pos_table": f"""WITH {ENGLISH_TAGS}
      SELECT doc_id AS article_index, sentence_index, token_index, token, tag AS pos FROM tagged""",
    "ar_pos_table": f"""WITH {ARABIC_TAGS}
      SELECT doc_id AS article_index, sentence_index, token_index, token, tag AS pos_tag FROM tagged""",
    "pipeline_pos_table": f"""WITH {ARABIC_TAGS}
      SELECT doc_id AS article_index, sentence_index, token_index, token, tag AS pos_tag FROM tagged""",
    "train_lexicon": f"WITH {ENGLISH_TAGS}, {TRAINED} SELECT token, tag, n FROM trained",
    "context_rules": f"WITH {LEARNED} SELECT * FROM learned",
    "train_tagger": f"""WITH {TAGGER}
      SELECT 'transition' AS kind, previous AS given, tag AS result, n, cost FROM transitions
      UNION ALL SELECT 'emission', tag, token, n, cost FROM emissions""",
    "viterbi_tags": f"WITH RECURSIVE {VITERBI} SELECT * FROM decoded",
    "viterbi_scores": f"""WITH RECURSIVE {VITERBI}
      {prf1("(SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, t.tag AS gold, d.tag AS pred FROM tagged t JOIN decoded d USING (doc_id, sentence_index, token_index) JOIN cut USING (doc_id, sentence_index))", "part")}""",
    "learned_rules": greedy_rules(Q.RULE_ROUNDS),
    "np_chunks": f"""WITH {ENGLISH_TAGS}, {CHUNKS}
      SELECT doc_id, sentence_index, start_token, (start_token + length(p))::INT AS end_token,
        array_to_string(tokens[start_token + 1:start_token + length(p)], ' ') AS phrase
      FROM placed WHERE i % 2 = 1""",
    "chunk_tree": f"""WITH {ENGLISH_TAGS}, {CHUNKS},
      shown AS (
        SELECT doc_id, sentence_index, i, array_to_string(leaves[start_token + 1:start_token + length(p)], ' ') AS words
        FROM placed WHERE p <> '')
      SELECT doc_id, sentence_index,
        '(S ' || string_agg(CASE WHEN i % 2 = 1 THEN '(NP ' || words || ')' ELSE words END, ' ' ORDER BY i) || ')' AS tree
      FROM shown GROUP BY ALL""",
    "grammar_noun_phrases": f"""WITH {ENGLISH_TAGS}, {CHUNKS}
      SELECT doc_id, sentence_index, start_token, (start_token + length(p))::INT AS end_token,
        array_to_string(tokens[start_token + 1:start_token + length(p)], ' ') AS phrase
      FROM placed WHERE i % 2 = 1""",
    "grammar_cascade": f"""WITH {ENGLISH_TAGS}, {CHUNKS},
      phrases AS (
        SELECT doc_id, sentence_index, tokens, i, 'NP' AS label, start_token, start_token + length(p) AS end_token
        FROM placed WHERE i % 2 = 1),
      preps AS (
        SELECT c.doc_id, c.sentence_index, c.tokens, c.i, 'PP' AS label, c.start_token - 1 AS start_token, c.end_token
        FROM phrases c JOIN tagged t ON t.doc_id = c.doc_id AND t.sentence_index = c.sentence_index
          AND t.token_index = c.start_token - 1 AND t.tag = 'IN')
      SELECT doc_id, sentence_index, label, start_token::INT AS start_token, end_token::INT AS end_token,
        array_to_string(tokens[start_token + 1:end_token], ' ') AS phrase
      FROM (SELECT * FROM phrases UNION ALL SELECT * FROM preps)""",
    "grammar_chinks": f"""WITH {ENGLISH_TAGS},
      runs AS (
        SELECT *, tag = 'IN' OR tag LIKE 'VB%' AS out,
          sum(CASE WHEN tag = 'IN' OR tag LIKE 'VB%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, sentence_index ORDER BY token_index) AS run
        FROM tagged)
      SELECT doc_id, sentence_index, 'NP' AS label, min(token_index)::INT AS start_token, (max(token_index) + 1)::INT AS end_token,
        string_agg(token, ' ' ORDER BY token_index) AS phrase
      FROM runs WHERE NOT out GROUP BY doc_id, sentence_index, run""",
    "gazetteer_entities": f"""WITH {ENGLISH_FOUND}
      SELECT doc_id AS article_index, entity AS text, label, base + s AS start_char, base + e AS end_char FROM found""",
    "pattern_entities": f"SELECT doc_id AS article_index, text, label, start_char, end_char FROM ({PATTERN_FOUND})",
    "sentence_entities": f"""WITH {ARABIC_FOUND}
      SELECT doc_id AS article_index, sentence_index, entity, label, s AS start, e AS "end", sentence FROM found""",
    "entity_head": f"""WITH {ARABIC_FOUND}
      SELECT doc_id AS article_index, sentence_index, entity, label, s AS start, e AS "end", sentence FROM found
      ORDER BY doc_id, sentence_index, s LIMIT 20""",
    "bio_spans": f'WITH {BIO} SELECT doc_id, sentence_index, start, "end", label, score FROM spans',
    "piece_spans": rf"""WITH {sents()}, {OFFSETS},
      cut AS (
        SELECT doc_id, sentence_index, token_index, s, unnest(range(len(ps))) AS k, unnest(ps) AS p
        FROM (SELECT *, regexp_extract_all(token, '(?s).{{1,3}}') AS ps FROM offsets)),
      shaped AS (
        SELECT *, s + 3 * k AS b, s + 3 * k + length(p) AS e,
          CASE WHEN regexp_matches(p, '^\p{{Lu}}') THEN 'CAP' WHEN regexp_matches(p, '[aeiou]$') THEN 'VOW' END AS kind FROM cut),
      opened AS (
        SELECT *, CASE WHEN kind IS NOT NULL AND (length(p) < 3 OR lag(kind) OVER w IS DISTINCT FROM kind) THEN 1 ELSE 0 END AS opens
        FROM shaped WINDOW w AS (PARTITION BY doc_id, sentence_index ORDER BY token_index, k)),
      numbered AS (
        SELECT *, sum(opens) OVER (PARTITION BY doc_id, sentence_index ORDER BY token_index, k) AS island FROM opened)
      SELECT doc_id, sentence_index, min(b)::INT AS start, max(e)::INT AS "end", kind AS label, round(avg(1.0::DOUBLE / length(p)), 6) AS score
      FROM numbered WHERE kind IS NOT NULL GROUP BY doc_id, sentence_index, island, kind""",
    "entity_lines": f"""WITH {BIO} SELECT doc_id, sentence_index, start, entity, label,
      printf('%s -> %s (score=%.4f)', entity, label, score) AS line FROM spans""",
    "model_entities": f"""SELECT doc_id AS article_index, text, label, start_char, end_char
      FROM ({PATTERN_FOUND}) WHERE label = 'EMAIL'""",
    "all_entities": f"WITH {MERGED} SELECT article_index, text, label, start_char, end_char FROM merged",
    "all_entity_type_counts": f"WITH {MERGED} {top('label', 'merged')}",
    "all_top_entities": f"WITH {MERGED} {top('text', 'merged', 20)}",
    "entity_type_counts": f"WITH {ENGLISH_FOUND} {top('label', 'found')}",
    "top_entities": f"WITH {ENGLISH_FOUND} {top('entity', 'found', 20)}",
    "ar_entity_type_counts": f"WITH {ARABIC_FOUND} {top('label', 'found')}",
    "ar_top_entities": f"WITH {ARABIC_FOUND} {top('entity', 'found', 20)}",
    "token_labels": f"WITH {ENGLISH_FOUND}, {labels()} SELECT * FROM labels",
    "token_labels_by_char": f"""WITH {sents()}, {OFFSETS}, ents AS ({PATTERN_FOUND})
      SELECT o.doc_id, o.sentence_index, o.token_index, o.token, o.base + o.s AS start_char, o.base + o.e AS end_char,
        coalesce(arg_max(x.label, (x.start_char, x.end_char, x.label)), 'O') AS label
      FROM offsets o LEFT JOIN ents x
        ON x.doc_id = o.doc_id AND o.base + o.s >= x.start_char AND o.base + o.e <= x.end_char
      GROUP BY ALL""",
    "prf1_pos": f"""WITH {ENGLISH_TAGS} {prf1('(SELECT tag AS gold, base_tag AS pred FROM tagged)')}""",
    "prf1_ner": f"""WITH {ENGLISH_FOUND}, {labels()}, {gazetteer(Q.OTHER_GAZETTEER, '2')}, {labels('2')}
      {prf1('(SELECT a.label AS gold, b.label AS pred FROM labels a JOIN labels2 b USING (doc_id, sentence_index, token_index))')}""",
    "prf1_documents": prf1(
        "(SELECT lang, CASE WHEN quality = 1 THEN 'FLAG' ELSE 'O' END AS gold, "
        "CASE WHEN toxic = 1 THEN 'FLAG' ELSE 'O' END AS pred FROM labels JOIN documents USING (doc_id))",
        "lang",
    ),
    "label_codes": f"WITH {ENGLISH_TAGS}, {confusion('tag', 'base_tag', 'tagged')} SELECT code, label FROM ranked",
    "confusion_pos": f"WITH {ENGLISH_TAGS}, {confusion('tag', 'base_tag', 'tagged')} SELECT gold, pred, n FROM matrix",
    "confusion_encoded": f"""WITH {ENGLISH_TAGS}, {confusion('tag', 'base_tag', 'tagged')}
      SELECT g.code AS gold_code, p.code AS pred_code, n FROM matrix
      JOIN ranked g ON g.label = gold JOIN ranked p ON p.label = pred WHERE n > 0""",
    "confusion_wide": f"""WITH {ENGLISH_TAGS}
      SELECT tag AS gold, {", ".join(f"count(*) FILTER (base_tag = {q(tag)}) AS {name}" for tag, name in Q.WIDE_COLUMNS.items())}
      FROM tagged GROUP BY tag""",
    "confusion_learned": f"""WITH {LEARNED},
      both_tags AS (SELECT l.doc_id, l.tag AS gold, t.tag AS pred
        FROM learned l JOIN tagged t USING (doc_id, sentence_index, token_index)),
      {confusion('gold', 'pred', 'both_tags')} SELECT gold, pred, n FROM matrix""",
    "confusion_self": f"WITH {ENGLISH_TAGS}, {confusion('tag', 'tag', 'tagged')} SELECT gold, pred, n FROM matrix",
    "ar_confusion_self": f"WITH {ARABIC_TAGS}, {confusion('tag', 'tag', 'tagged')} SELECT gold, pred, n FROM matrix",
    "summary_report": summary(),
    "jsonl_english": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, 'en' AS lang, text FROM documents",
    "jsonl_arabic": f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, 'ar' AS lang, {ARABISED} AS text
      FROM documents""",
    "doc_index": "SELECT row_number() OVER (ORDER BY doc_id DESC) - 1 AS doc_id, lang, text FROM documents",
    "csv_en_pos": f"""WITH {ENGLISH_TAGS}
      SELECT doc_id AS article_index, sentence_index, token, tag AS pos FROM tagged""",
    "csv_ar_pos": f"WITH {ARABIC_TAGS} SELECT token, tag AS pos_tag FROM tagged",
    "csv_en_pos_sample": f"""WITH {ENGLISH_TAGS}
      SELECT token, tag AS pos FROM tagged WHERE sentence_index = 0 AND doc_id = (SELECT min(doc_id) FROM documents)""",
    "csv_ar_pos_sample": f"""WITH {ARABIC_TAGS}
      SELECT token, tag AS pos_tag FROM tagged WHERE doc_id = (SELECT min(doc_id) FROM documents)""",
    "csv_en_entities": f"""WITH {ENGLISH_FOUND}
      SELECT doc_id AS article_index, entity AS text, label, base + s AS start_char, base + e AS end_char FROM found""",
    "csv_ar_entities": f"""WITH {ARABIC_FOUND}
      SELECT doc_id AS article_index, sentence_index, entity, label, s AS start, e AS "end", sentence FROM found""",
    "csv_top_entities": f"WITH {ENGLISH_FOUND} {top('entity', 'found', 20)}",
    "csv_entity_type_counts": f"WITH {ENGLISH_FOUND} {top('label', 'found')}",
    "csv_ar_entity_type_counts": f"WITH {ARABIC_FOUND} {top('label', 'found')}",
    "csv_ar_top_entities": f"WITH {ARABIC_FOUND} {top('entity', 'found', 20)}",
    "analysis_en_scores": f"""WITH {ENGLISH_TAGS}
      {prf1('(SELECT tag AS gold, base_tag AS pred FROM tagged)')}""",
    "analysis_ar_confusion": f"WITH {ARABIC_TAGS}, {confusion('tag', 'base_tag', 'tagged')} SELECT gold, pred, n FROM matrix",
}
