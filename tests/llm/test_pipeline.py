"""The stages of the corpus pipeline on the given tables, and the SQL twin of op6."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_registered():
    names = list(driver.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "pack"]


def test_windows_equal_sql(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.sql(driver.oracle_sql()["op6_difference_cover"]).df().sort_values("doc_id").reset_index(drop=True)
    got = driver.queries()["op6_difference_cover"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert (got == want[got.columns]).all().all()


def test_stages(spark):
    from wattloom.llm.common import staged, table

    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SF))
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0.8 * docs.count() <= after.count() <= docs.count()
        docs = after
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert placed.select("doc_id").distinct().count() == docs.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
