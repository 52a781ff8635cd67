"""Tables landed as files: their number grows with the table, so that no task writes it alone."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from feedlens.plans import catalog
from feedlens.plans import testtables as tt


@pytest.fixture
def landed_in(spark, tmp_path, monkeypatch):
    """A folder with ``documents`` in twelve files, three of which make up what one landed file may hold."""
    rows = spark.range(240).select(
        F.col("id").alias("doc_id"), F.concat(F.lit('a "text"\nof '), F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"),
    )
    rows.repartition(12, "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    size = tt.table(spark, str(tmp_path), "documents")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    monkeypatch.setattr(tt, "LANDED_BYTES", int(str(size)) // 6, raising=False)
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, purpose: str(tmp_path / purpose))
    return tmp_path


def test_csv_in_ranges_is_landed_by_more_than_one_task(spark, landed_in):
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")  # no two files in one task's share of the scan
    try:
        got = catalog.QUERIES["csv_in_ranges"](spark, str(landed_in)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(glob.glob(f"{landed_in}/csv/messages.csv/*.csv")) in (6, 7)
    assert sorted((int(r.id_), r.text) for r in got) == [(i, f'a "text"\nof {i}') for i in range(240)]


def test_stream_ingest_lands_files_of_bounded_size(spark, landed_in):
    got = catalog.QUERIES["stream_ingest"](spark, str(landed_in)).collect()
    assert len(glob.glob(f"{landed_in}/landed/*.json")) in (6, 7)
    assert len(glob.glob(f"{landed_in}/ingested-progress/commits/[0-9]*")) >= 3  # two files a batch
    assert sorted((int(r.id_), r.text) for r in got) == [(i, f'a "text"\nof {i}') for i in range(240)]
