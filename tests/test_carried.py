"""Carried window state: re-opened days without the quotes of the horizon before them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farespark.operators import materialize as M
from farespark.operators import quality as Qy
from farespark.operators import versions as V
from farespark.params import DEFAULT
from farespark.plans import flows, models
from farespark.plans import pipeline as PL
from farespark.schemas import DWH_COLUMNS, RAW
from farespark.session import scratch_path
from farespark.sources.fixtures import fx1_raw
from tests.conftest import SF_SMALL, quote, raw_df

COLS = RAW.fieldNames()


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def dense(spark):
    """Three routes, three departures, two captures on most of the days before each."""
    data = [
        quote(o, "LED", dep=dep, cap=cap, price=100.0 + (7 * i + 13 * j + 29 * k) % 83, ingested_at=cap)
        for i, o in enumerate(("SVO", "DME", "VKO"))
        for j, dep in enumerate(dt.datetime(2024, 1, d, 8) for d in (12, 20, 31))
        for k, cap in enumerate(dt.datetime(2024, 1, 1, 6) + dt.timedelta(hours=12 * h) for h in range(60))
        if cap < dep and (k // 2 + i) % 5
    ]
    return raw_df(spark, data)


def slices(spark, cuts, raw=None):
    raw = fx1_raw(spark, SF_SMALL).select(*COLS) if raw is None else raw
    edges = [dt.datetime(2000, 1, 1), *cuts, dt.datetime(2100, 1, 1)]
    return [raw.where((F.col("captured_at") >= F.lit(a)) & (F.col("captured_at") < F.lit(b))) for a, b in zip(edges, edges[1:])]


CUTS = [dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 10, 18), dt.datetime(2024, 1, 13), dt.datetime(2024, 1, 25, 3)]


@pytest.mark.parametrize("versioned", [False, True])
def test_every_run_equals_the_full_one_without_older_quotes(spark, versioned):
    params = DEFAULT.with_(versioned_tables=versioned)
    layout, seen = PL.Layout(scratch_path(spark, "carried")), None
    for i, batch in enumerate(slices(spark, CUTS, dense(spark))):
        seen = batch if seen is None else seen.unionByName(batch)
        PL.load_stg(spark, batch, layout, flows.RUN_TS, params)
        PL.append_ods(spark, layout, params)
        if i and not versioned:  # what the state stands for is not there to be read
            since = M.max_value(spark, layout.dwh, "captured_date")
            wm = spark.read.parquet(layout.ods).agg(F.max("captured_at")).first()[0]
            kept = spark.read.parquet(layout.ods).where((F.col("captured_date") >= F.lit(since)) | (F.col("captured_at") == F.lit(wm))).checkpoint()
            M.create_partitioned(kept, layout.ods, "captured_date")
        PL.refresh_dwh(spark, layout, params)
        assert rows(PL.read_dwh(spark, layout)) == rows(models.dwh(flows.ods_of(seen)).select(*DWH_COLUMNS)), i
    last = (V if versioned else M).max_value(spark, layout.dwh, "captured_date", "captured_date")
    state = PL.read_trend_state(spark, layout, params, last)
    assert state.groupBy("route_key", "departure_date").count().agg(F.max("count")).first()[0] == models.TREND_ROWS
    assert state.where((F.col("departure_date") < F.lit(last)) | (F.col("captured_date") >= F.lit(last))).isEmpty()


@pytest.mark.parametrize("lost", ["commit", "state"])
def test_a_run_that_died_before_the_state_falls_back(spark, monkeypatch, lost):
    layout = PL.Layout(scratch_path(spark, "carried-died"))
    first, second, *_ = slices(spark, [dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 20)])
    PL.run_batch(spark, first, layout, flows.RUN_TS)
    with monkeypatch.context() as m:
        if lost == "state":
            m.setattr(models, "trend_state", lambda *a: 1 / 0)
        else:
            append = M.append
            m.setattr(M, "append", lambda df, path, *a, **k: 1 / 0 if path == layout.dwh_trend_commits else append(df, path, *a, **k))
        with pytest.raises(ZeroDivisionError):
            PL.run_batch(spark, second, layout, flows.RUN_TS)
    last = M.max_value(spark, layout.dwh, "captured_date")
    assert PL.read_trend_state(spark, layout, DEFAULT, last) is None
    PL.refresh_dwh(spark, layout)
    assert PL.read_trend_state(spark, layout, DEFAULT, last) is not None
    assert rows(PL.read_dwh(spark, layout)) == rows(models.dwh(flows.ods_of(first.unionByName(second))).select(*DWH_COLUMNS))


def test_other_parameters_do_not_use_the_state(spark):
    layout = PL.Layout(scratch_path(spark, "carried-params"))
    first, _ = slices(spark, [dt.datetime(2024, 1, 10, 12)])
    PL.run_batch(spark, first, layout, flows.RUN_TS)
    last = M.max_value(spark, layout.dwh, "captured_date")
    assert PL.read_trend_state(spark, layout, DEFAULT, last) is not None
    for change in ({"horizon_days": 10}, {"currency": "USD"}):
        assert PL.read_trend_state(spark, layout, DEFAULT.with_(**change), last) is None


def test_spine_of_many_series_needs_no_single_task(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-03"), (None, "2024-01-02")], "k string, day string").withColumn("day", F.col("day").cast("date"))
    out = Qy.day_spine(df, "day", ["k"])
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert rows(out) == sorted(
        [("a", f"2024-01-0{i}") for i in (1, 2, 3)] + [("b", "2024-01-03")] + [("None", f"2024-01-0{i}") for i in (2, 3)]
    )
    assert Qy.day_spine(df.limit(0), "day", ["k"]).count() == 0 == Qy.day_spine(df.limit(0), "day").count()
