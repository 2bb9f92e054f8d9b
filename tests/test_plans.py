"""Plan assertions: the physical plans we want at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from farespark.operators import materialize as M
from farespark.params import DEFAULT
from farespark.plans import flows, models
from farespark.plans.registry import REGISTRY
from farespark.session import scratch_path
from tests.conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_dm_scans_ods_once_with_grouping_sets(spark):
    p = plan(models.dm(flows.fx1_ods(spark, SF_SMALL)))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, flags=re.M)) == 1
    assert "Expand" in p
    assert "BroadcastNestedLoopJoin" not in p and "SortMergeJoin" not in p


def test_best_segment_by_rank_uses_window_group_limit(spark):
    stats = models.lead_time_stats(models.dm_base(flows.fx1_ods(spark, SF_SMALL)))
    p = plan(models.rank_segments(stats, "avg_price_for_days_before_departure", ["days_before_departure"]).filter("rn = 1"))
    assert "WindowGroupLimit" in p


@pytest.fixture(scope="module")
def stored_ods(spark):
    path = scratch_path(spark, "test-ods")
    ods = flows.fx1_ods(spark, SF_SMALL).withColumn("captured_date", F.to_date("captured_at"))
    M.create_partitioned(ods, path, "captured_date")
    return path


def test_horizon_filter_reaches_parquet_scan(spark, stored_ods):
    ods = spark.read.parquet(stored_ods)
    p = plan(models.dm_base(ods))
    assert "PushedFilters" in p and "GreaterThanOrEqual(days_before_departure,0)" in p
    assert "LessThanOrEqual(days_before_departure,120)" in p


def test_dwh_reopen_pushes_implied_departure_predicate(spark, stored_ods):
    ods = spark.read.parquet(stored_ods)
    p = plan(models.dwh(ods, DEFAULT, since="2024-01-20"))
    assert "GreaterThanOrEqual(departure_at" in p and "GreaterThanOrEqual(captured_at" in p


def test_dwh_refresh_prunes_old_capture_partitions(spark, stored_ods):
    ods = spark.read.parquet(stored_ods).filter(F.col("captured_date") >= F.date_sub(F.lit("2024-01-20"), 45))
    p = plan(models.dwh(ods, DEFAULT, since="2024-01-20"))
    assert "PartitionFilters: [isnotnull(captured_date" in p and "captured_date" in p


def test_column_pruning_on_stored_ods(spark, stored_ods):
    ods = spark.read.parquet(stored_ods)
    p = plan(models.dm(ods))
    read_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    for unused in ("record_hash", "ticket_class", "departure_day_of_week", "currency"):
        assert unused not in read_schema


def test_partition_pruning_for_watermark_day(spark, stored_ods):
    ods = spark.read.parquet(stored_ods)
    p = plan(ods.filter(F.col("captured_date") >= F.lit("2024-01-20").cast("date")))
    assert "PartitionFilters: [isnotnull(captured_date" in p


READ_ONLY = [n for n in REGISTRY if not n.startswith(("stream_", "pipeline", "ods_append", "dm_full", "dm_read",
                                                       "late_rows", "stg_upsert", "raw_append", "schema_sync",
                                                       "batch_counters", "dq_report", "dq_severity"))]


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_python_in_registered_plans(spark, name):
    p = plan(REGISTRY[name][0](spark, SF_SMALL))
    assert not any(node in p for node in PY_NODES)


def test_lineitem_is_never_broadcast(spark):
    from farespark.sources.fixtures import fx2_raw

    p = plan(fx2_raw(spark, SF_SMALL))
    # the scan feeding each BroadcastExchange must not be lineitem
    ids = {m.group(1): m.group(2) for m in re.finditer(r"^\((\d+)\) Scan parquet.*?\nLocation: .*?/(\w+)\.parquet", p, flags=re.M | re.S)}
    tree = p.split("\n\n")[0]
    lines = tree.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
                m = re.search(r"Scan parquet\s+\((\d+)\)", below)
                if m:
                    assert ids.get(m.group(1)) != "lineitem", below
    assert "SortMergeJoin" in p
