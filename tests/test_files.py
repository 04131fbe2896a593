from __future__ import annotations

import csv
import io
import json
import re

import pytest
from pyspark.sql import functions as F

from lisan import session
from lisan.data import tables
from lisan.operators import entities
from lisan.plans import queries as Q
from lisan.plans.report import analyse_corpus
from lisan.sources.files import FILE_ROWS, write_csv, write_lines
from lisan.sources.jsonl import from_texts, gold_labels, read_jsonl, with_doc_index

ARABIC = "قال العالم مرحبا. زار محمد بن سلمان الرياض! ما هذا؟ قال العالم نعم. ثم زار المدينة."


def read_back(folder, encoding="utf-8") -> list[list[str]]:
    rows = []
    for part in sorted(folder.glob("part-*.csv")):
        header, *body = csv.reader(io.StringIO(part.read_text(encoding=encoding)))
        rows = rows or [header]
        rows += body
    return rows


def test_csv_round_trip(spark, tmp_path):
    tricky = ['say "hi"', "a,b", " padded ", "two\nlines", "", "back\\slash", "سلام", "#x"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(tricky)], "n int, token string").coalesce(1)
    write_csv(frame, str(tmp_path / "out"))
    header, *rows = read_back(tmp_path / "out")
    assert header == ["n", "token"]
    assert [token for _, token in rows] == tricky


def test_csv_with_byte_order_mark(spark, tmp_path):
    frame = spark.createDataFrame([("سلام", "NOUN")], "token string, pos_tag string")
    write_csv(frame, str(tmp_path / "out"), bom=True)
    parts = [p.read_bytes() for p in (tmp_path / "out").glob("part-*.csv")]
    assert parts and all(p.startswith(b"\xef\xbb\xbftoken,pos_tag") for p in parts if p)
    assert read_back(tmp_path / "out", "utf-8-sig")[1] == ["سلام", "NOUN"]


def test_csv_files_do_not_grow_with_a_task(spark, tmp_path):
    write_csv(spark.range(2 * FILE_ROWS + 1).coalesce(1), str(tmp_path / "out"), bom=True)
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    assert [len(p.read_text(encoding="utf-8-sig").splitlines()) - 1 for p in parts] == [FILE_ROWS, FILE_ROWS, 1]
    found = spark.read.schema("id bigint").option("header", True).option("multiLine", True).csv(str(tmp_path / "out"))
    assert sorted(r[0] for r in found.collect()) == list(range(2 * FILE_ROWS + 1))


def test_csv_compression(spark, tmp_path):
    write_csv(spark.range(3), str(tmp_path / "out"), compression="gzip")
    assert list((tmp_path / "out").glob("part-*.csv.gz"))


def test_lines_keep_their_order(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b"), (1, "a"), (10, "")], "ord int, line string").repartition(3)
    write_lines(lines, str(tmp_path / "out"))
    assert "".join(p.read_text() for p in (tmp_path / "out").glob("part-*.txt")) == "a\nb\n\n"


def test_jsonl_keeps_line_positions_over_splits(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = [f"نص {i} " + "x" * (i % 50) for i in range(400)]
    for name, part in (("a", texts[:10]), ("b", texts[10:390]), ("c", texts[390:])):
        lines = "".join(json.dumps({"id": 1, "text": t}, ensure_ascii=False) + "\n" for t in part)
        (tmp_path / "in" / f"{name}.jsonl").write_text(lines, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        docs = read_jsonl(spark, str(tmp_path / "in"), "ar")
        assert docs.columns == ["doc_id", "lang", "text"]
        rows = docs.orderBy("doc_id").collect()
        assert docs.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.doc_id, r.lang, r.text) for r in rows] == [(i, "ar", t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("line", ["{bad", '{"other": 1}', "", '{"text": null}'])
def test_jsonl_fails_on_bad_lines(spark, tmp_path, line):
    path = tmp_path / "in.jsonl"
    path.write_text('{"text": "ok"}\n' + line + '\n{"text": "ok"}\n', encoding="utf-8")
    with pytest.raises(Exception):
        read_jsonl(spark, str(path), "en").collect()


def test_rows_are_numbered_in_order(spark):
    frame = spark.range(1000, numPartitions=7).select((F.col("id") * 3).alias("x")).where("x % 2 = 0")
    rows = with_doc_index(frame).orderBy("doc_id").collect()
    assert [(r.doc_id, r.x) for r in rows] == [(i, 6 * i) for i in range(500)]
    assert with_doc_index(frame.withColumnRenamed("x", "doc_id")).columns == ["doc_id"]


def test_gold_labels(spark):
    rows = gold_labels(spark, [["DT", "NN"], ["O"]]).collect()
    assert [tuple(r) for r in rows] == [(0, 0, "DT"), (0, 1, "NN"), (1, 0, "O")]


def test_written_tables_go_to_the_shared_folder(spark):
    frame = session.written(spark.range(5))
    folder = session.scratch_folder(spark).removeprefix("file:").lstrip("/")
    assert all(folder in path for path in frame.inputFiles())
    assert frame.count() == 5


def test_models_are_built_once_per_task(spark):
    docs = from_texts(spark, ["mail a@b.example", "none", "c@d.example e@f.example"], "en").coalesce(1)
    model = Q.pattern_model("EMAIL", dict(tables.ENTITY_PATTERNS)["EMAIL"])
    found = entities.predict_partitions(docs, model, Q.MODEL_RECORD).collect()
    assert [(r.article_index, r.text) for r in found] == [
        (0, "a@b.example"), (2, "c@d.example"), (2, "e@f.example"),
    ]


def test_whole_analysis(spark, tmp_path):
    english = from_texts(
        spark, ["The quick fox met Fox News. It's fine. The fox ran.", "The fox slept. The dog barked at 3."], "en"
    )
    arabic = from_texts(spark, [ARABIC, ARABIC], "ar")
    out = tmp_path / "out"
    results = analyse_corpus(english, arabic, output=str(out), stamp="2024-01-01 00:00:00")
    lines = "".join(p.read_text(encoding="utf-8") for p in (out / "summary").glob("part-*")).splitlines()
    assert lines[:2] == ["Run timestamp: 2024-01-01 00:00:00", ""]
    assert "Total English articles: 2" in lines and "Total Arabic articles: 2" in lines
    assert [line for line in lines if line.startswith("[('The', 'DT'), ('quick', 'JJ')")]
    assert any(re.fullmatch(r"Arabic sample generation: العالم( \S+){10}", line) for line in lines)
    assert read_back(out / "EN_POS_ALL")[0] == ["article_index", "sentence_index", "token", "pos"]
    assert read_back(out / "AR_POS_ALL", "utf-8-sig")[0] == ["token", "pos_tag"]
    assert read_back(out / "EN_NER_ALL")[1:] == [["0", "Fox News", "ORG", "18", "26"]]
    assert read_back(out / "NER_AR_entity_type_counts") == [["value", "n"], ["LOC", "2"], ["PER", "2"]]
    assert results["normalized_arabic"].where(F.col("text").contains("ة")).count() == 0


def test_bad_lines_fail_when_counted(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"text": "a"}\n{"text": "b"\n\n{"id": 3}\n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "bad.jsonl"), "en").count()
    (tmp_path / "good.jsonl").write_text('{"text": "a"}\n{"text": ""}\n')
    assert read_jsonl(spark, str(tmp_path / "good.jsonl"), "en").count() == 2
