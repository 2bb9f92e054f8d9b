"""Checks from stored moments: equal to those on the whole model, whatever the runs the rows came in."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farespark.operators import metric_store as S
from farespark.operators import quality as Qy
from farespark.operators import versions as V
from farespark.params import DEFAULT
from farespark.plans import flows, models
from farespark.schemas import DWH_COLUMNS
from farespark.session import scratch_path
from tests.conftest import SF_SMALL

COLUMNS = ["price", "currency", "departure_at", "days_before_departure", "ticket_class"]


def rows(df):
    return sorted(tuple(f"{v:.5f}" if isinstance(v, float) else str(v) for v in r) for r in df.collect())


def ods(spark):
    o = flows.fx1_ods(spark, SF_SMALL).where(F.dayofyear("captured_at") % 7 != 0)
    holes = F.crc32("record_hash") % 5 == 0
    return o.withColumn("price", F.when(holes, None).otherwise(F.col("price"))).withColumn("ticket_class", F.when(holes, "").otherwise(F.col("ticket_class")))


def fold(spark, path, df, **more):
    return S.fold(spark, path, df, "captured_at", COLUMNS, ["route_origin", "route_destination"], "departure_at", **more)


def same(spark, path, df, since=None):
    got = {
        "volume": (S.volume(spark, path, since=since), Qy.dq_volume(df, "captured_at", since=since)),
        "freshness": (S.event_freshness(spark, path, since=since), Qy.dq_event_freshness(df, "departure_at", "captured_at", since=since)),
        "columns": (S.column_metrics(spark, path, since=since), Qy.dq_column_metrics(df, "captured_at", COLUMNS, since=since)),
        "dimension": (S.dimension(spark, path, ["route_origin", "route_destination"], since=since), Qy.dq_dimension(df, "captured_at", ["route_origin", "route_destination"], since=since)),
    }
    for name, (a, b) in got.items():
        assert rows(a.select(*b.columns)) == rows(b), name


def test_runs_that_part_days_equal_the_whole(spark):
    path, df = scratch_path(spark, "moments"), ods(spark).checkpoint()
    for cut in (dt.datetime(2024, 1, 9, 13), dt.datetime(2024, 1, 9, 19), dt.datetime(2024, 1, 24)):
        fold(spark, path, df.where(F.col("captured_at") < F.lit(cut)))
    assert fold(spark, path, df) > 0
    assert fold(spark, path, df) == 0  # repeated: nothing is folded twice
    same(spark, path, df)
    same(spark, path, df, since="2024-01-25")


def test_a_run_reads_rows_above_the_mark_only(spark):
    path, df = scratch_path(spark, "moments-new"), ods(spark).checkpoint()
    cut = F.col("captured_at") < F.lit(dt.datetime(2024, 1, 20, 12))
    fold(spark, path, df.where(cut))
    through = df.where(cut).agg(F.max("captured_at")).first()[0]
    fold(spark, path, df.where(F.col("captured_at") > F.lit(through)))  # older rows are not there to be read
    same(spark, path, df)


def test_reopened_days_are_replaced(spark):
    path = scratch_path(spark, "moments-reopened")
    dwh = models.dwh(flows.fx1_ods(spark, SF_SMALL)).select(*DWH_COLUMNS).checkpoint()
    day = dt.date(2024, 1, 15)
    first = dwh.where(F.col("captured_date") <= F.lit(day)).withColumn("avg_price", F.when(F.col("captured_date") == F.lit(day), 1.0).otherwise(F.col("avg_price")))
    S.fold(spark, path, first, "captured_date", DWH_COLUMNS)
    S.fold(spark, path, dwh, "captured_date", DWH_COLUMNS, reopened=day)
    want = Qy.dq_column_metrics(dwh, "captured_date", DWH_COLUMNS)
    assert rows(S.column_metrics(spark, path).select(*want.columns)) == rows(want)


def test_a_fold_that_dies_is_repeated(spark, monkeypatch):
    path, df = scratch_path(spark, "moments-died"), ods(spark).checkpoint()
    fold(spark, path, df.where(F.col("captured_at") < F.lit(dt.datetime(2024, 1, 20, 12))))
    with monkeypatch.context() as m:
        m.setattr(V, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fold(spark, path, df)
    fold(spark, path, df)
    same(spark, path, df)


def test_empty_models_and_null_days(spark):
    path, df = scratch_path(spark, "moments-empty"), ods(spark)
    assert fold(spark, path, df.limit(0)) == 0 and V.version(spark, path) is None
    with pytest.raises(ValueError):
        S.volume(spark, path)
    undated = df.limit(5).withColumn("captured_at", F.lit(None).cast("timestamp_ntz"))
    assert fold(spark, path, undated) == 0
    fold(spark, path, df.limit(50).unionByName(undated).checkpoint())
    assert S.volume(spark, path, DEFAULT).agg(F.sum("metric_value")).first()[0] == 50
