"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

WHOLE_RUNS = {
    "end_to_end_counts",
    "end_to_end_performance",
    "late_members",
    "metrics_by_delta",
    "replayed_batches",
    "rerun_after_drop",
    "stream_ad_spend",
    "stream_by_name",
    "stream_sales",
    "stream_sales_performance",
}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_flagship(spark):
    assert entry_module.entry(spark).columns[:2] == ["perf_key", "date_key"]


@pytest.fixture(scope="module")
def engine():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WHOLE_RUNS])
def test_query_equals_sql(spark, sf_dir, engine, name):
    assert difference(QUERIES[name](spark, sf_dir), engine, ORACLE[name]) is None


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(WHOLE_RUNS))
def test_whole_run_equals_sql(spark, sf_dir, engine, name):
    assert difference(QUERIES[name](spark, sf_dir), engine, ORACLE[name]) is None
