"""The filter audit against a plain count over every order."""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from lisan.llm import audit

SPACES = "\t\n\x0b\x0c\r "


def words(text: str) -> list[str]:
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    """Every row of the audit, from (doc_id, text, part) and (doc_id, quality, toxic)."""
    parts = defaultdict(list)
    for doc_id, text, part in docs:
        text, w = text or "", words(text or "")
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs),
        }
        good = any(d == doc_id is not None and q == 1 for d, q, _ in labels)
        toxic = any(d == doc_id is not None and t == 1 for d, _, t in labels)
        parts[part or ""].append(({f for f in fails if fails[f]}, good, toxic))
    out, shares = [], Counter()
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                gone = [bool(f & set(order[: step - 1])) for f, _, _ in rows]
                cut = [own in f and not g for (f, _, _), g in zip(rows, gone)]
                shares[part, own] += sum(cut)
                out.append(
                    (part, own, "".join(order), step, sum(not c and not g for c, g in zip(cut, gone)), sum(cut),
                     sum(own in f and g for (f, _, _), g in zip(rows, gone)), sum(f == {own} for f, _, _ in rows),
                     sum(c and r[1] for c, r in zip(cut, rows)), sum(c and r[2] for c, r in zip(cut, rows)))
                )
    return {(part, *rest, shares[part, own]) for part, own, *rest in out}


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(3, 1, 0), (3, 0, 1), (8, 1, None), (101, 1, 1), (102, None, 1), (None, 1, 1), (999, 1, 1)]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, quality int, toxic int, lang string, n int")


@pytest.mark.parametrize("rows", [8_192, 3])
def test_audit(edge_docs, edge_rows, marks, monkeypatch, rows):
    monkeypatch.setattr(audit, "SHARD_ROWS", rows)
    got = audit.filter_audit(edge_docs, marks[1]).select(*COLUMNS).collect()
    want = plain([r[:3] for r in edge_rows], marks[0])
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


@pytest.mark.parametrize("words_a_bucket", [1, 2_000_000])
def test_matrix_is_that_of_the_words(edge_docs, edge_rows, monkeypatch, words_a_bucket):
    """Every count of every word of every document, read from shards of four rows."""
    monkeypatch.setattr(audit, "SHARD_ROWS", 4)
    monkeypatch.setattr(audit, "LEAST_BUCKETS", 3)
    monkeypatch.setattr(audit, "BUCKET_WORDS", 500 * words_a_bucket)
    words_of, shards = audit.document_term_matrix(edge_docs)
    rows = words_of.collect()
    names = {r["id"]: bytes(r["word"]).decode() for r in rows}
    assert len(rows) == len(names) == len(set(names.values()))
    got = Counter()
    for r in shards.collect():
        indptr, columns, counts = audit.shard_rows(r["ids"] or [], r["sizes"], r["steps"], r["counts"])
        assert len(r["docs"]) <= 4 and len(indptr) == len(r["docs"]) + 1
        for k, doc in enumerate(r["docs"]):
            part = slice(indptr[k], indptr[k + 1])
            row = {names[c]: n for c, n in zip(columns[part].tolist(), counts[part].tolist())}
            got[doc["doc_id"], tuple(sorted(row.items()))] += 1
    want = Counter((r[0], tuple(sorted(Counter(words(r[1] or "")).items()))) for r in edge_rows)
    assert got == want


def test_a_long_document_is_a_shard_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 1_000)
    docs = spark.createDataFrame([(i, "word " * (5_000 if i == 2 else 1), "en") for i in range(5)], "doc_id long, text string, lang string")
    shards = audit.local_shards(docs.coalesce(1)).collect()
    assert sorted(len(r["docs"]) for r in shards) == [2, 3]
    sums = {r["doc_id"]: (r["n_words"], r["n_distinct"]) for r in audit.row_sums(audit.document_term_matrix(docs)[1]).collect()}
    assert sums == {i: (5_000 if i == 2 else 1, 1) for i in range(5)}


def test_packed_numbers():
    numbers = np.array([0, 1, 255, 256, 70_000, 2**32 - 1])
    assert audit.unpack(audit.pack(numbers)).tolist() == numbers.tolist()
    assert audit.unpack(audit.pack(numbers[:0])).tolist() == []


def test_no_documents(spark, no_docs, marks, edge_docs, edge_rows):
    assert audit.filter_audit(no_docs, marks[1]).count() == 0
    none = marks[1].limit(0)
    got = audit.filter_audit(edge_docs, none).select(*COLUMNS).collect()
    assert {tuple(r) for r in got} == plain([r[:3] for r in edge_rows], [])
