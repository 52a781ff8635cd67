"""Intermediate tables of a job are gone when it has ended, or failed; what it saved is not."""

import os

import pytest

from feedlens.session import cut_lineage, job_scratch, scratch_dir, shared_dir
from feedlens.sources.store import MessageStore


def held(spark):
    return {name for name in os.listdir(shared_dir(spark))}


def test_job_leaves_nothing(spark):
    before = held(spark)
    with job_scratch(spark):
        assert cut_lineage(spark.range(5)).count() == 5
        with job_scratch(spark):
            inner = cut_lineage(spark.range(3))
            assert inner.count() == 3
        assert len(held(spark)) == len(before) + 1
    assert held(spark) == before


def test_failed_job_leaves_nothing(spark):
    before = held(spark)
    with pytest.raises(ValueError), job_scratch(spark):
        cut_lineage(spark.range(5))
        raise ValueError
    assert held(spark) == before
    assert os.path.dirname(scratch_dir(spark, "x")) == shared_dir(spark)


def test_upsert_leaves_only_the_store(spark, make, tmp_path):
    before = held(spark)
    store = MessageStore(spark, str(tmp_path / "store"))
    store.upsert(make({"id_": "1"}, {"id_": "2"}))
    store.upsert(make({"id_": "2", "text": "newer", "datetime_scraped_": "2024-01-01 00:00:00"}))
    assert held(spark) == before
    assert {(r.id_, r.text) for r in store.all().collect()} == {("1", "text"), ("2", "newer")}
