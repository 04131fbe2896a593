"""Run queries and their SQL side by side: ``python tests/compare.py [sf] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _key(row: tuple) -> tuple:
    return tuple((v is not None, v) for v in row)


def difference(got: DataFrame, db, sql: str) -> str:
    """Empty if both sides hold the same rows, else a short description."""
    columns = sorted(got.columns)
    mine = sorted((tuple(r) for r in got.select(*columns).collect()), key=_key)
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    if len(mine) != len(theirs):
        extra = set(mine) ^ set(theirs)
        return f"{len(mine)} rows != {len(theirs)}; e.g. {sorted(extra, key=_key)[:4]}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(y) for y in b]:
            return f"{columns}: {a} != {b}"
    return "" if mine else "no rows"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    import __spark_entry__ as e

    spark, db = session(), database(sf_dir)
    names = sys.argv[2:] or list(e.queries())
    for name in names:
        start = time.time()
        try:
            got = e.queries()[name](spark, sf_dir)
            note = difference(got, db, e.oracle_sql()[name]) if name in e.oracle_sql() else f"{got.count()} rows"
            note = note or "ok"
        except Exception as error:  # report and go on with the next query
            note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.time() - start:6.1f}s {note}", flush=True)


if __name__ == "__main__":
    main()
