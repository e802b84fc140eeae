"""The pipeline and the registered queries on small tables."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tributary.llm import mixing, quality
from tributary.llm.common import small_table

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        if name != "mixing sources":
            assert 0 < docs.count() <= before
            before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DIR)
    assert last.count() == docs.count() and "doc_id" in last.columns


def test_stages_on_nothing(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DIR).count() == 0


def test_stages_give_back_heap(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    whole = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:]:
        before = whole()
        stage(spark, docs, DIR)
        assert whole() > before, name


def test_small_tables_need_no_workers(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    plan, copies = mixing.planned(docs)
    numbered = mixing._numbered(mixing.sizes(docs, "doc_id"), plan.ids)
    assert "ExistingRDD" not in plan.applied(numbered)._jdf.queryExecution().toString()
    judge = quality.Judge(docs, spark.read.parquet(f"{DIR}/labels.parquet"), keep=False)
    assert "ExistingRDD" not in judge.verdict()._jdf.queryExecution().toString()
    rows = [(None, 1.5, 2**60), ("é", float("inf"), None), ("", -1e300, -1)]
    assert [tuple(r) for r in small_table(spark, rows, "s string, x double, n long").collect()] == rows
    assert small_table(spark, [], "s string, n long").collect() == []


def test_odd_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, " ".join(rng.choice(words, 50)), ["en", None][i % 2], [None, "s"][i % 2], 1, 2, 3, 4, 5, 6) for i in range(30)]
    rows += [(None, None, None, None, *[None] * 6), (40, "", "en", "s", *[None] * 6), (1, rows[1][1], "en", "s", *[1] * 6), (41, "word " * 20000, "en", "s", *[1] * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, `whole` int, guess int, gone int, `copies` int")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, DIR).toPandas().astype(object).where(lambda x: x.notna(), None), docs.schema)
        assert docs.columns == columns and docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DIR).count() == docs.count()


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if k.startswith("op")))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("conversations", "embeddings", "documents", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    columns = [c[0] for c in db.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()]
    got = entry.queries()[name](spark, DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=str) == sorted((tuple(r) for r in db.execute(entry.oracle_sql()[name]).fetchall()), key=str)
