"""SQL (DuckDB) that must give the same rows as the queries that SQL can express."""

from __future__ import annotations

#: Normalised text: without ASCII white space; null is empty.
_BODY = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"

#: All turns in order, with the planted conversation; null text is empty.
_TURNS = r"""
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
"""

#: A text with one more backslash in each control string, and how much the template adds to a turn.
_ESCAPED = (
    r"regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|pad\|>|/?s>|/?INST\]|</?SYS>>|/?pad>|/?unk>)',"
    r" '\1\2\\\3', 'g')"
)
_MARKS = len("<|im_start|>") + len("\n") + len("<|im_end|>\n")

#: CRC-32 of the ASCII string s, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(range(length(s)), lambda i: ascii(s[i + 1])::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""

LLM_ORACLES: dict[str, str] = {
    "op1_chat": f"""
        WITH t AS ({_TURNS}), a AS (
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(length(role) + length({_ESCAPED}) + {_MARKS}) AS formatted_chars
            FROM t GROUP BY conv_id
        )
        SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               formatted_chars::BIGINT AS formatted_chars
        FROM a
    """,
    "op5_exact_dedup": f"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256({_BODY}) AS text_sha256 FROM documents)
        SELECT doc_id,
               first(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first(doc_id) OVER w AS kept,
               text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
    """,
    "op11_filter_audit": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), f AS (
            SELECT doc_id, part,
                   concat(CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
                          CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
                          CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
                          CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                          CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
            FROM d
        ), l AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), k AS (
            SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
            FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
        ), orders AS (
            SELECT '' AS o
            UNION ALL
            SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)
        ), steps AS (
            SELECT o AS filter_order, step::INT AS step, o[step] AS own, left(o, step - 1) AS before
            FROM orders, range(1, 6) AS r(step) WHERE length(o) = 5
        ), hits AS (
            SELECT part, filter_order, step, own, n, good, toxic,
                   contains(fails, own) AS fail, translate(fails, before, '') <> fails AS gone, fails = own AS alone
            FROM k, steps
        ), sums AS (
            SELECT part, filter_order, step, own,
                   coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (fail AND NOT gone), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (fail AND gone), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
                   coalesce(sum(n) FILTER (fail AND NOT gone AND good), 0)::BIGINT AS good_lost,
                   coalesce(sum(n) FILTER (fail AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
            FROM hits GROUP BY ALL
        )
        SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM sums
    """,
    "op12_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score, q.r
            FROM v AS q, v WHERE q.vec_id % 50 = 0 AND q.r <> v.r
        ), t AS (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank FROM p
        )
        SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 5
    """,
    "op13_repair": rf"""
        WITH RECURSIVE k AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s
            FROM conversations
        ), c AS (SELECT *, {_CRC} % 20 AS kind FROM k), d AS (
            SELECT conv_id, turn, r, t, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy,
                   CASE WHEN kind = 4 THEN 'user' ELSE r END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS text
            FROM c WHERE kind <> 0
        ), n AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, t, copy) AS seq FROM d
        ), f AS MATERIALIZED (
            SELECT conv_id, turn, seq, role, text, left(role, 1) AS i,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY seq) AS i_before,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY seq) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated'
                        ELSE '' END AS fault
            FROM n
        ), inserts(state, new, edits, said) AS (
            VALUES ('', '', '', []), ('', 'u', 'I', ['user:']), ('', 'a', 'II', ['user:', 'assistant:']),
                   ('s', 's', '', []), ('s', 'u', 'I', ['user:']), ('s', 'a', 'II', ['user:', 'assistant:']),
                   ('u', 'u', '', []), ('u', 'a', 'I', ['assistant:']), ('u', 'u', 'II', ['assistant:', 'user:']),
                   ('a', 'a', '', []), ('a', 'u', 'I', ['user:']), ('a', 'a', 'II', ['user:', 'assistant:'])
        ), allowed(state, i) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
        edits AS (
            SELECT 'D' AS e, 3 AS price, state, NULL AS i, state AS new FROM (VALUES (''), ('s'), ('u'), ('a')) AS s(state)
            UNION ALL SELECT 'K', 0, state, i, i FROM allowed
            UNION ALL SELECT 'R', 2, state, NULL, i FROM allowed WHERE i <> 's'
        ), walk AS (
            SELECT conv_id, 0::BIGINT AS seq, '' AS state, {{'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]}} AS best
            FROM f GROUP BY conv_id
            UNION ALL
            SELECT f.conv_id, f.seq, e.new,
                   min({{'cost': best.cost + 2 * length(x.edits) + e.price
                                 + CASE WHEN e.e <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END,
                        'audit': best.audit || x.edits || e.e,
                        'said': best.said || x.said || CASE e.e WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
                            ELSE [CASE e.new WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END}})
            FROM walk JOIN f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.seq = walk.seq + 1
            JOIN inserts x ON x.state = walk.state JOIN edits e ON e.state = x.new
            WHERE (e.i IS NULL OR e.i = f.i) AND (e.e = 'D' OR fault NOT IN ('blank', 'duplicate'))
            GROUP BY f.conv_id, f.seq, e.new
        ), ended AS (
            SELECT conv_id, min({{'cost': best.cost + 2 * length(x.edits), 'audit': best.audit || x.edits, 'said': best.said || x.said}}) AS best
            FROM walk JOIN inserts x USING (state) JOIN (SELECT conv_id, max(seq) AS seq FROM f GROUP BY conv_id) USING (conv_id, seq)
            WHERE x.new IN ('', 'a') GROUP BY conv_id
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i_before || i NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN ended USING (conv_id)
    """,
}
