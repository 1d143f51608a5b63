"""Queries and pipeline stages on the smallest tables, on odd rows and on empty tables."""

import duckdb
import pytest

import corpus_pipeline
from skein.llm.queries import ORACLE_SQL, QUERIES

ODD = [(1, "The of the and this is of", "en", "s", 9), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "The of the and this is that", "en", "s", 1), (1, "The of the and this is of", "en", "s", 9), (4, "!!! 12", "de", "s", 3)]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, lang_pred int, keep int, ids string, fp string"


def test_query_names():
    numbers = [int(q[2:].split("_")[0]) for q in QUERIES]
    assert numbers == list(range(1, 11))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    want = c.sql(ORACLE_SQL[name])
    order = [want.columns.index(x) for x in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())


@pytest.mark.parametrize("stage", range(5))
def test_stage_on_odd_rows(spark, sf, stage):
    name, f = corpus_pipeline.STAGES[stage]
    docs = spark.createDataFrame([(*r, "a", 1, 2, "i", "f") for r in ODD], SCHEMA)
    for df, n in ((docs, 6), (docs.limit(0), 0)):
        out = f(spark, df, sf)
        rows = out.collect()
        assert len(rows) <= n
        if stage < 4:
            assert out.columns == docs.columns and all(r["score"] == "a" and r["lang_pred"] == 1 for r in rows)
        if n and name == "language ID":
            assert sorted(r["doc_id"] or 0 for r in rows) in ([0, 1, 1], [])
        if n and name == "exact dedup":
            assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 2, 4]
        if n and name == "byte-level BPE":
            assert len(rows) == 6


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < spark.read.parquet(f"{sf}/documents.parquet").count()
