"""The registered queries over the smallest tables: against their SQL, or against plain versions."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from tickloom.llm.queries import QUERIES, SQL
from tests.test_registry import table_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return c


@pytest.fixture(scope="module")
def rows(con):
    return con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    twin = con.sql(SQL[name])
    assert table_of([tuple(r) for r in df.collect()], df.columns) == table_of(twin.fetchall(), twin.columns)


def test_near_duplicates(spark, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op3_near_duplicates"](spark, SF).collect()}
    assert got == brute.components_of(rows)


def test_secrets(spark, rows):
    found = QUERIES["op10_secret_scan"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in found} == {d: brute.secrets(t)[:4] for d, t in rows}


def test_pipeline(spark):
    """Each stage on its predecessor's whole result, against plain versions of the decisions."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = pipeline.written(stage(spark, docs, SF), f"test-{name}")
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns[:len(names)] == names and docs.count() == len(after)
        if name == "quality":
            assert set(after) < set(before) and not any(brute.quality(t)[-1] for t in after.values())
        elif name == "lines":
            want = {d: t for d, t in brute.line_dedup(sorted(before.items())) if t == before[d] or brute.WORD.search(t)}
            assert after == want
        elif name == "near_dedup":
            assert after == {d: before[d] for d, (_, c) in brute.components_of(sorted(before.items())).items() if d == c}
        else:
            assert after == before
    assert docs.filter("not exact").count() == 0
    if os.environ.get("FULL_PIPELINE"):
        assert pipeline.run(spark, SF).count() == docs.count()


def test_the_mix_reaches_the_last_table(spark, monkeypatch):
    """Over many files and sources: places are those of the mix's slots, and the files of the last stage stand in that order."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 3 = 0").select("doc_id", F.substring("text", 1, 3000).alias("text"), "lang", "source", "n_chars")
    monkeypatch.setattr(pipeline, "BLOCK_BYTES", 2000)
    want = [r["id"] for r in pipeline.mix_sources(docs, block_bytes=2000).orderBy("slot", "mixed", "id", "text_hash").collect()]
    for name in ("mixing", "pieces"):
        docs = pipeline.written(dict(pipeline.STAGES)[name](spark, docs, SF), f"test-{name}")
    rows = docs.select("doc_id", "place", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part"), "_metadata.row_index").collect()
    assert len({r["part"] for r in rows}) > 1 and sorted(r["place"] for r in rows) == list(range(len(want)))
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["place"])] == want
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: (r["part"], r["row_index"]))] == want


def test_pipeline_links_from_80_percent(spark):
    import corpus_pipeline as pipeline

    from tests.llm.test_operators import between_80_and_85

    rows = between_80_and_85(random.Random(9), 20)
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in pipeline.near_dedup(spark, docs, SF).collect()) == list(range(0, 40, 2))


def test_the_lines_stage_cuts_each_text_once(spark):
    """Its filter stays above the cut: pushed below, it would repeat the whole expression."""
    import corpus_pipeline

    plan = corpus_pipeline.lines(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(transform(") == 1
