"""Property tests against plain-Python definitions (one Spark job per example)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from farespark.functions.keys import ts_text
from farespark.params import DEFAULT
from farespark.plans import models

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

stamps = st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2099, 12, 31))


@SETTINGS
@given(st.lists(stamps, min_size=1, max_size=40))
def test_ts_text_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("t", T.TimestampNTZType())]))
    got = [r.x for r in df.select(ts_text("t").alias("x")).collect()]
    assert got == [v.strftime("%Y-%m-%dT%H:%M:%S.%f") for v in values]


def disc(sorted_vals: list, p: float):
    """SQL percentile_disc: the first value whose cumulative share reaches p."""
    n = len(sorted_vals)
    return sorted_vals[max(math.ceil(p * n), 1) - 1]


prices = st.decimals(min_value=Decimal("0.00"), max_value=Decimal("999.99"), places=2)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), prices), min_size=1, max_size=60))
def test_daily_percentiles_match_definition(spark, rows):
    schema = "g int, price decimal(12,2)"
    df = spark.createDataFrame(rows, schema)
    base = df.selectExpr(
        "cast(g as string) as route_key", "'A' as route_origin", "'B' as route_destination",
        "date'2024-01-02' as departure_date", "date'2024-01-01' as captured_date", "price",
    )
    for skew_safe in (False, True):
        out = models._daily_agg(base, DEFAULT.with_(skew_safe_percentiles=skew_safe)).collect()
        for r in out:
            vals = sorted(p for g, p in rows if str(g) == r.route_key)
            assert (r.p25_price, r.p50_price) == (disc(vals, 0.25), disc(vals, 0.5))
            assert r.min_price == vals[0] and r.max_price == vals[-1]
            assert abs(r.avg_price - float(sum(vals)) / len(vals)) < 1e-9
