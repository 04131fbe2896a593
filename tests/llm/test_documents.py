"""Document operators against brute force, on rows with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lisan.llm import common, exact_dedup, language, lines, mixing, packing, quality, simhash, tokens

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def union(n, links):
    """The smallest member of each one's group."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(x) for x in range(n)]


def test_exact_groups(edge_docs, edge_rows):
    got = exact_dedup.exact_groups(edge_docs, fan_in=2).collect()
    groups = {}
    for doc, text, *_ in edge_rows:
        groups.setdefault("".join(c for c in text or "" if c not in BLANKS), []).append((doc, text or ""))
    want = Counter()
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for doc, _ in members:
            want[doc, keep[0], len(members), hashlib.sha256(body.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_drop_keeps_columns(edge_docs):
    kept = exact_dedup.drop_exact(edge_docs)
    assert kept.dtypes == edge_docs.dtypes
    assert kept.where("text = 'Solo text here' AND __row = 'z'").count() == 1


def test_native_plans(edge_docs):
    for frame in (exact_dedup.digest_runs(edge_docs), lines.split_lines(edge_docs)):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_near_groups(edge_docs, edge_rows):
    got = simhash.near_groups(edge_docs).collect()
    fps = [brute_fingerprint(r[1]) for r in edge_rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    group = union(len(fps), pairs)
    first = {}
    for g, r in zip(group, edge_rows):
        if r[0] is not None:
            first[g] = min(first.get(g, r[0]), r[0])
    want = Counter((r[0], f"{fp:016x}", first.get(g)) for r, fp, g in zip(edge_rows, fps, group))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == len(set(group))


@pytest.mark.parametrize("distance", [2, 3, 4, 6])
def test_pigeonhole_search_is_whole(spark, distance):
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    centres[:20] &= np.uint64(0xFFFF)
    fps = {0}
    for c in centres.tolist():
        fps |= {c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(30)}
    fps = np.array(sorted(fps), np.uint64)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    for bucket in (16, 8192):
        links = simhash.near_links(common.written(table), distance, bucket).collect()
        at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
        near = [(at[r.a], at[r.b]) for r in links]
        assert union(len(fps), near) == union(
            len(fps), np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance).tolist()
        )


@pytest.mark.parametrize("n", [100, 200_000, 50_000_000])
def test_thresholds_keep_the_pigeonhole_sum(n):
    sample = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64)
    bits = np.array([[x >> b & 1 for b in range(64)] for x in sample.tolist()], float)
    parts, thresholds = simhash.plan_search(sample, bits.T @ bits * (n / 300), n, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert sum(thresholds) == 4 - len(parts) + 1 and min(thresholds) >= -1


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 100), (200, 201), (201, 200)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: i - i % 20 for i in range(60)}, 200: 200, 201: 200}


def normal_line(line):
    import regex

    return regex.sub(r"[^\p{L}\p{M}\p{N}]+", " ", line.lower()).strip(" ")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def line_features(norm):
    out = set()
    for w in norm.split(" "):
        out |= {w} if len(w) <= 16 else {w[i : i + 4] for i in range(len(w) - 3)}
    return out


def line_fingerprint(norm):
    hashes = [xxhash.xxh64_intdigest(f.encode(), 42) for f in line_features(norm)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_of_lines(spark):
    rng = np.random.default_rng(2)
    norms = [" ".join(f"word{x}" for x in rng.integers(0, 900, n)) for n in (1, 126, 127, 128, 300, 1000)]
    norms += ["a", "the cat", "wörter 😀 ganz ohne", "no blanks " * 300 + "end", "ab😀d" * 5, "x" * 16, "xyz" * 200 + " the end"]
    norms += ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in (17, 64, 65, 66, 67, 68, 130, 1000)]
    lines_of = spark.createDataFrame([(n, n) for n in norms + norms], "key string, norm string")
    whole = common.written(lines.folded(lines_of))
    assert whole.count() == len(set(norms))
    got = {r.id: (r.fp, r.size) for r in lines.fingerprints(whole).collect()}
    assert got == {r.id: (r.fp, r.size) for r in lines.fingerprints(whole, chunk=100).collect()}
    for r in whole.collect():
        assert (got[r.id][0] % (1 << 64), got[r.id][1]) == (line_fingerprint(r.norm), len(r.norm))


@pytest.mark.parametrize("similarity", [0.8, 0.9, 1.0])
def test_length_classes_of_similar_lines_are_neighbours(spark, similarity):
    level = [r[0] for r in spark.range(1, 3_001).select(lines.length_class(F.col("id"), similarity)).collect()]
    for longer in range(1, 3_001):
        shorter = longer - int(longer * round(1 - similarity, 6) + 1e-9)
        assert level[longer - 1] - level[shorter - 1] <= 1


def spots_of(rows):
    return [
        (r[0], k, normal_line(line))
        for r in rows
        if len(r[1] or "") < 10_000
        for k, line in enumerate((r[1] or "").split("\n"))
    ]


def similar(a, b):
    return edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9


def test_line_groups_are_those_of_edit_similarity_alone(edge_docs, edge_rows):
    docs = edge_docs.where(F.length(F.coalesce("text", F.lit(""))) < 10_000)
    norms = sorted({n for *_, n in spots_of(edge_rows) if n})
    group = union(len(norms), [(i, j) for i in range(len(norms)) for j in range(i) if similar(norms[i], norms[j])])
    of = dict(zip(norms, group))
    members = {}
    for doc, k, n in spots_of(edge_rows):
        if n:
            members.setdefault(of[n], []).append((doc is None, doc or 0, k, doc))
    want = Counter()
    for doc, k, n in spots_of(edge_rows):
        first = min(members[of[n]]) if n else (0, 0, k, doc)
        want[doc, k, first[3], first[2], len(members[of[n]]) if n else 1] += 1
    got = lines.line_groups(docs).collect()
    assert Counter((r.doc_id, r.line_no, r.group_doc, r.group_line, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(members) + sum(1 for *_, n in spots_of(edge_rows) if not n)


def test_line_groups_join_lines_of_changed_words(spark):
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 10))) for _ in range(2_000)]
    pairs = []
    for _ in range(60):
        body = [words[i] for i in rng.integers(0, 2_000, 50)]
        other = list(body)
        other[int(rng.integers(50))] = words[int(rng.integers(2_000))]
        pairs.append((" ".join(body), " ".join(other)))
    pairs += [(a.replace(" ", ""), a.replace(" ", "").replace("e", "o", 1)) for a, _ in pairs[:40]]
    assert all(similar(a, b) for a, b in pairs[::10])
    docs = spark.createDataFrame([(i, "\n".join(p)) for i, p in enumerate(pairs)], "doc_id long, text string")
    got = lines.line_groups(docs).where("group_doc = doc_id AND group_size > 1 AND line_no = 1").count()
    assert got >= 0.9 * len(pairs)


@pytest.mark.parametrize("blocks", [9, 11])
def test_line_search_over_fingerprints_is_whole(spark, blocks):
    rng = np.random.default_rng(blocks)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64).tolist()
    fps = {c ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 9), replace=False)) for c in centres for _ in "ab"}
    fps = sorted(fps | set(centres))
    rows = [(i, x, f"{i}", 95 + i % 11, f"{'same ' * 18}{i:05d}{'x' * (i % 11)}") for i, x in enumerate(fps)]
    table = common.written(spark.createDataFrame(rows, "id long, fp long, key string, size int, norm string"))
    links = lines.line_links(table.select("id", "fp", "size"), table, bits=((None, 8),), blocks={8: blocks}).collect()
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 8]
    assert union(len(fps), [(r.a, r.b) for r in links]) == union(len(fps), near)


def quick_edits(a, b):
    """The edit distance by bits of whole numbers, a column at a time."""
    where, top, full = {}, 1 << len(a) - 1, (1 << len(a)) - 1
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    up, down, far = full, 0, len(a)
    for y in b:
        same = where.get(y, 0)
        flat = (((same & up) + up) ^ up) | same | down
        right, left = down | (full & ~(flat | up)), up & flat
        far += bool(right & top) - bool(left & top)
        right = (right << 1 | 1) & full
        up, down = ((left << 1) & full) | (full & ~(same | down | right)), right & (same | down)
    return far


def test_recall_against_edit_similarity_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = lines.split_lines(docs).join(lines.line_groups(docs), [common.ROW, "line_no"])
    of = {r.norm: (r.group_doc, r.group_line) for r in found.where("length(norm) <= 2000").collect() if r.norm}
    norms = sorted(of, key=len)
    letters = sorted(set("".join(norms)))
    counts = np.array([[n.count(c) for c in letters] for n in norms])
    pairs = []
    for i, x in enumerate(norms):
        for j in range(i + 1, len(norms)):
            most = int(0.2 * len(norms[j]) + 1e-9)
            if len(norms[j]) - len(x) > most:
                break
            more = counts[j] - counts[i]
            if max(more[more > 0].sum(), -more[more < 0].sum()) <= most and quick_edits(x, norms[j]) <= most:
                pairs.append(of[x] == of[norms[j]])
    assert quick_edits("kitten", "sitting") == 3 and len(pairs) > 20
    assert sum(pairs) >= 0.9 * len(pairs)


def test_edit_similarity_is_that_of_the_whole_distance(spark):
    rng = np.random.default_rng(9)
    rows = []
    for n in (1, 4, 5, 9, 10, 200, 700):
        for share in (0.0, 0.1, 0.19, 0.21, 0.3):
            text = "".join(chr(97 + c) for c in rng.integers(0, 5, n))
            other = list(text)
            for at in rng.choice(n, int(share * n), replace=False):
                other[at] = rng.choice([other[at] + "z", "", "y"])
            rows.append((text, "".join(other)))
    frame = spark.createDataFrame(rows, "x string, y string").withColumn("z", lines.edit_similar("x", "y"))
    assert all(r.z == similar(r.x, r.y) for r in frame.collect())


def test_drop_lines(spark):
    docs = spark.createDataFrame([(1, "Same here\nmine", 7), (2, "same  HERE!\nyours\n", 8), (3, None, 9)], "doc_id long, text string, size int")
    got = {r.doc_id: (r.text, r.size) for r in lines.drop_lines(docs).collect()}
    assert got == {1: ("Same here\nmine", 7), 2: ("yours\n", 8), 3: ("", 9)}


def test_language(edge_docs, edge_rows):
    got = language.identify(edge_docs).collect()
    assert len(got) == len(edge_rows)
    texts = {(r[0], language.UNKNOWN if not any(c.isalpha() for c in r[1] or "") else "known") for r in edge_rows}
    assert {(r.doc_id, "und" if r.lang_pred == "und" else "known") for r in got} == texts
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    kept = language.keep_known(edge_docs)
    assert kept.dtypes == edge_docs.dtypes
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in edge_rows)


def out_of_place(text, profiles, top):
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        grams.update(word)
        grams.update(padded[i : i + 2] for i in range(len(padded) - 1))
        grams.update(padded[i : i + 3] for i in range(len(padded) - 2))

    def number(g):
        return sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))

    ranked = sorted(grams, key=lambda g: (-grams[g], number(g)))[:top]
    if not ranked:
        return "und", 0.0
    far = {}
    for lang, ranks in profiles.items():
        far[lang] = sum(abs(ranks[number(g)] - k) if number(g) in ranks else top for k, g in enumerate(ranked))
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (top * len(ranked))


def test_out_of_place_distance(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    training = docs.where(~common.held_out(F.col("doc_id")))
    profiles = {}
    for r in language.train_profiles(training, top=100).collect():
        profiles.setdefault(r.lang, {})[r.gram] = r.rank
    got = language.identify(docs, top=100).collect()
    for r in got[:60]:
        lang, score = out_of_place(texts[r.doc_id], profiles, 100)
        assert (r.lang_pred, round(r.score, 9)) == (lang, round(score, 9))
    langs = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def peak_of(work) -> int:
    """MB that Python and numpy hold at most while ``work`` runs."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] // 1_000_000
    finally:
        tracemalloc.stop()


def test_language_counts_hold_little_whatever_the_batch():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(300)]
    rows = [(f"l{i % 5}", " ".join(rng.choices(words, k=400))) for i in range(1_500)] + [("l0", None), ("l9", "1 2")]
    batch = pa.record_batch({"lang": [x for x, _ in rows], "text": [t for _, t in rows]})
    got, want = Counter(), Counter()

    def count() -> None:
        for part in language.gram_counts(iter([batch])):
            for lang, gram, n in zip(*(c.to_pylist() for c in part.columns)):
                got[lang, gram] += n

    assert peak_of(count) < 40  # all n-grams together take 84 MB
    for lang, text in rows:
        want.update((lang, g) for g in language.grams(text).tolist())
    assert got == want


def test_packing_encodes_few_megabytes_of_text_at_a_time():
    batch = pa.record_batch({"text": ["a" * 1_000] * 9_000 + ["b" * 5_000_000, None]})
    sizes = [sum(len(t or "") for t in part.column(0).to_pylist()) for part in packing.chunks(batch, 0)]
    assert sum(sizes) == 14_000_000
    assert [x for x in sizes if x > 2_000_000] == [5_000_000]


def test_packing_cuts_where_the_library_does():
    """Texts of white space, marks and foreign letters in any order have the library's ids, whatever is cut together."""
    draw = random.Random(3)
    bits = [" ", " ", " ", "\n", "\n", "  ", "\n\n", "\t", "\r\n", "\x85", "\xa0", "\u3000", "\x1c", "\x00", "a", "the", "The", "\u00e9t\u00e9",
            "\u65e5\u672c", "\U00010400", "\u02b0", "\u00b2", "\u0120", "\u010a", "\u2028", "\u200b", "1", "23", ".", ",", "!?", "...", "'s", "I'll",
            "-", "$", "_", "<|endoftext|", "<|endoftext|>"]
    texts = ["".join(draw.choices(bits, k=draw.randrange(30))) for _ in range(4_000)] + [None, "", " ", "\n", "a " * 3_000, "\n" * 3_000]
    draw.shuffle(texts)
    encoder, tokenizer = packing.Encoder(BYTES), Tokenizer.from_file(BYTES)
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    for size in (10**9, 700):
        got = []
        for part in packing.chunks(batch, 0, size):
            ids, ends = encoder.encode(part.column(0))
            got += [x.tolist() for x in np.split(ids, ends)[:-1]]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert [len(x) for x in packing.chunks(batch.slice(0, 0), 0)] == []


def test_packing_encodes_a_word_once(monkeypatch):
    """Words that more than a few hundred texts share go to the library once, also without a memory of them."""
    monkeypatch.setattr(packing, "MEMORY", 0)
    encoder, seen = packing.Encoder(BYTES), Counter()

    class Watched:
        def encode_batch_fast(self, texts, **options):
            for text in texts:
                seen.update(text.split())
            return encoder_library.encode_batch_fast(texts, **options)

    encoder_library, encoder.tokenizer = encoder.tokenizer, Watched()
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(300)]
    texts = pa.array(["x " + " ".join(words[i % 7 :: 7]) + ".\nEnd, x" for i in range(5_000)])
    for part in packing.chunks(pa.record_batch({"text": texts}), 0):
        encoder.encode(part.column(0))
    assert max(seen[w] for w in words) == 1 and min(seen[w] for w in words) == 1 and seen["End"] == 1


def test_packing(edge_docs, edge_rows):
    got = packing.pack(edge_docs, BYTES, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    want = Counter()
    total = 0
    for r in edge_rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        first = len(ids) - (-(-len(ids) // 2048) - 1) * 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            body = np.array(ids[a:b], "<u4").tobytes()
            want[r[0], k, a, b - a, zlib.crc32(body), body] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(by) == list(range(len(by)))
    assert len(by) == -(-total // 2048)


def test_best_two_fit_replaces_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]  # greedy takes 6 + 3; 2 + 2 fill the gap left by 3 better
    assert packing.best_two_fit(counts, 10) == [(1, [6, 2, 2]), (1, [3])]


@pytest.mark.parametrize("seed", range(5))
def test_best_two_fit_packs_all(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.minimum(rng.geometric(0.02, 5_000), 128), minlength=129)
    counts[0] = 0
    plan = packing.best_two_fit(counts, 128)
    packed = sum(times * np.bincount(x, minlength=129) for times, x in plan)
    assert (packed == counts).all() and all(sum(x) <= 128 for _, x in plan)
    assert sum(t for t, _ in plan) <= 1.01 * -(-(counts * np.arange(129)).sum() // 128) + 1


def test_mixing(edge_docs, edge_rows):
    got = mixing.mix(edge_docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], size(r[1])) for r in edge_rows)
    sources = Counter()
    for r in edge_rows:
        sources[r[3]] += size(r[1])
    want = mixing.targets(dict(sources))
    assert list(sorted(sources, key=lambda s: (s is None, s or ""))) == ["", "s0", "s1", "s2", None]
    assert abs(sum(want.values()) - sum(sources.values())) < 1e-6
    assert {round(r.target, 6) for r in got} <= {round(t, 6) for t in want.values()}
    assert all(r.taken == r.size * r.copies and r.copies <= 3 for r in got)
    again = mixing.mix(edge_docs).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_targets_stop_at_the_most():
    got = mixing.targets({"a": 1000, "b": 10, "c": 1000, None: 0})
    assert got["b"] == 30 and got[None] == 0
    assert abs(got["a"] * 3 - got["c"]) < 1e-9 and abs(sum(got.values()) - 2010) < 1e-9


def test_flight_keeps_totals():
    rng = np.random.default_rng(3)
    size = sorted(rng.geometric(0.01, 3_000).tolist(), reverse=True)
    p = rng.uniform(0.05, 0.95, 3_000).tolist()
    out = mixing.flight(p, size, rng.uniform(size=3_000).tolist())
    open_ = [i for i, x in enumerate(out) if 0 < x < 1]
    assert len(open_) <= 2
    assert abs(sum(out) - sum(p)) < 1e-5
    assert abs(np.dot(out, size) - np.dot(p, size)) < 1e-2
    landed = mixing.settle(p, size, rng.uniform(size=3_000).tolist())
    assert set(landed) <= {0.0, 1.0} and abs(np.dot(landed, size) - np.dot(p, size)) < 20


def test_flight_is_unbiased():
    rng = np.random.default_rng(4)
    size, p = rng.integers(1, 50, 12).tolist(), rng.uniform(0.2, 0.8, 12).tolist()
    mean = np.mean([mixing.flight(p, size, rng.uniform(size=12).tolist()) for _ in range(4_000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def test_mixing_flies_again_over_blocks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 12)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.lit("one")).where("doc_id % 2 < 2")
    rest = docs.where("doc_id < 40").withColumn("source", F.lit("two"))
    got = mixing.mix(docs.where("doc_id >= 40").unionByName(rest)).collect()
    assert len(got) == docs.count()
    for target in {r.target for r in got}:
        assert abs(sum(r.taken for r in got if r.target == target) - target) < 0.02 * target


def test_mixing_lands_a_small_source_beside_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 200)
    rng = np.random.default_rng(6)
    rows = [
        (k, source, "w " * int(n))
        for source, many in [("big", 1_000), *((f"small{i}", 50) for i in range(6))]
        for k, n in enumerate(rng.lognormal(4, 1, many).astype(int) + 1)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs, weights=(30.0, *[0.5] * 6)).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        taken[r.source_size, r.target] += r.taken
    assert len(taken) == 7
    off = [abs(words - target) / target for (_, target), words in taken.items()]
    assert max(off) < 0.005, off


def test_token_counts(edge_docs, edge_rows):
    tokenizer = Tokenizer.from_file(WORDS)
    got = tokens.token_counts(edge_docs, WORDS, limit=100).collect()
    want = Counter()
    for r in edge_rows:
        text = r[1] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        want[r[0], len(text.encode()), n, n > 100] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_token_counts_over_many_blocks(edge_docs, edge_rows, spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 500)
    monkeypatch.setattr(tokens, "FREQUENT", 0)
    texts = spark.createDataFrame([(1, "big " * 70_000 + "<|endoftext|>")], "doc_id long, text string")
    assert tokens.token_counts(texts, WORDS).first().n_tokens == 70_001
    total = sum(r.n_tokens for r in tokens.token_counts(edge_docs, WORDS).collect())
    tokenizer = Tokenizer.from_file(WORDS)
    assert total == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in edge_rows)


def test_token_counts_refuse_other_vocabularies(edge_docs):
    with pytest.raises(ValueError):
        tokens.token_counts(edge_docs, BYTES)


def test_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert len(got) == docs.count()
    marked = {r.doc_id: r.quality for r in labels.collect()}
    held = [(marked[k], r) for k, r in got.items() if r.held_out and k in marked]
    assert sum((r.score >= 0.5) == q for q, r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_quality_of_odd_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame(
        [(3, 1), (3, 0), (3, 1), (8, 0), (None, 1), (10, None)], "doc_id long, quality int"
    )
    got = quality.score(edge_docs, labels)
    assert got.count() == len(edge_rows)
    assert quality.score(edge_docs, labels.limit(0)).select("score").distinct().collect()[0].score == 0.5
    assert quality.score(no_docs, labels).count() == 0


def test_training_draws_one_row_of_an_id_within_its_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality.AttentionModel, "fit", lambda self, bags, labels: seen.append((bags, labels)))
    rows = [(1, f"copy {i} of one id") for i in range(300)] + [(i, "some words " * 700) for i in (3, 4, 5, 7, 8)]
    rows += [(9, None), (10, "many words " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    trained = {i for i in (1, 3, 4, 5, 7, 8, 9, 10) if zlib.crc32(str(i).encode()) % 4 != 2}
    quality.train(docs, labels)
    assert len(seen[-1][0]) == len(trained)
    assert max(map(len, seen[-1][0])) == (625 if 10 in trained else 22)
    quality.train(docs, labels, train_bytes=8 * 7_700)
    assert len(seen[-1][0]) == len(trained - {10})
    quality.train(docs, labels, train_docs=2)
    assert len(seen[-1][0]) == 2
    parts = list(quality.batches_of(np.arange(6), [5, 5, 30, 1, 1, 1], docs=2, passages=10))
    assert parts == [[0, 1], [2], [3, 4], [5]]


def test_scores_are_those_of_a_plain_forward_pass():
    rng = np.random.default_rng(4)
    model = quality.AttentionModel()
    n = np.array([3, 1, 4])
    x = rng.normal(size=(8, quality.FEATURES)) * 3
    p, at = model.p, 0
    for bag, score in zip(n, model.score(x, n)):
        hidden, weight = [], []
        for row in x[at : at + bag]:
            scaled = [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(row, np.broadcast_to(model.mean, row.shape), np.broadcast_to(model.scale, row.shape))]
            h = [np.tanh(sum(v * w for v, w in zip(scaled, p["w"][:, k])) + p["b"][k]) for k in range(len(p["b"]))]
            gate = [
                np.tanh(sum(a * b for a, b in zip(h, p["v"][:, k]))) / (1 + np.exp(-sum(a * b for a, b in zip(h, p["u"][:, k]))))
                for k in range(p["v"].shape[1])
            ]
            hidden.append(h)
            weight.append(np.exp(sum(a * b for a, b in zip(gate, p["q"]))))
        share = [w / sum(weight) for w in weight]
        whole = [sum(a * h[k] for a, h in zip(share, hidden)) for k in range(len(p["c"]))]
        assert abs(score - 1 / (1 + np.exp(-(sum(a * b for a, b in zip(whole, p["c"])) + float(p["d"][0]))))) < 1e-9
        at += bag


def test_passages_do_not_depend_on_neighbours():
    texts = ["one two two three", None, " \n ", "x " * 200 + "end", "Ünder 12 | 34!!"]
    x, n = quality.encode(texts)
    assert n.tolist() == [1, 1, 1, 4, 1]
    for k, text in enumerate(texts):
        alone, _ = quality.encode([text])
        assert np.array_equal(x[n[:k].sum() : n[: k + 1].sum()], alone)


def test_gradient():
    rng = np.random.default_rng(0)
    model = quality.AttentionModel()
    x, n, y = rng.normal(size=(7, quality.FEATURES)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])
    model.p["q"] *= 20
    loss = lambda: -np.mean(np.log(np.where(y > 0, s := model.score(x, n), 1 - s)))
    for name, grad in model.gradient(x, n, y).items():
        at = tuple(int(rng.integers(0, k)) for k in grad.shape)
        was = model.p[name][at]
        model.p[name][at] = was + 1e-5
        up = loss()
        model.p[name][at] = was - 1e-5
        down = loss()
        model.p[name][at] = was
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_empty_tables(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert simhash.near_groups(no_docs).count() == 0
    assert lines.line_groups(no_docs).count() == 0
    assert language.identify(no_docs).count() == 0
    assert packing.pack(no_docs, BYTES).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert tokens.token_counts(no_docs, WORDS).count() == 0


def test_pipeline_stages(spark, edge_docs, edge_rows, tmp_path):
    import corpus_pipeline

    docs, seen = edge_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "unused")
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == edge_docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language id", "exact dedup", "near dedup", "mixing", "packing"]

    texts = [r[1] for r in edge_rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(r.text for r in seen["language id"]) == sorted(texts)

    bare = lambda t: "".join(c for c in t if c not in BLANKS)
    longest = {}
    for t in texts:
        longest[bare(t)] = max(longest.get(bare(t), ""), t, key=len)
    assert sorted(len(r.text) for r in seen["exact dedup"]) == sorted(map(len, longest.values()))
    assert {bare(r.text) for r in seen["exact dedup"]} == set(longest)

    left = seen["exact dedup"]
    fps = [brute_fingerprint(r.text) for r in left]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    group, best = union(len(fps), near), {}
    for g, r in zip(group, left):
        own = (r.doc_id is None, r.doc_id or 0)
        best[g] = min(best.get(g, own), own)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in seen["near dedup"]) == sorted(best.values())

    kept = spark.read.parquet(str(tmp_path / "near dedup"))
    copies = Counter()
    for r in mixing.mix(kept).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in seen["mixing"]) == Counter({k: n for k, n in copies.items() if n})

    tokenizer = Tokenizer.from_file(BYTES)
    want = Counter()
    for r in seen["mixing"]:
        want[r.doc_id] += len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in seen["packing"]:
        got[r.doc_id] += r.length
    assert got == want


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    folder = tmp_path / "none"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(folder / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).count() == 0
