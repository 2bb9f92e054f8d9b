"""Hand-written micro fixtures, one per trap."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from farespark.functions.keys import record_hash, route_key
from farespark.operators.ingest import (
    above_watermark,
    dedupe_latest,
    json_price,
    normalize,
    rejected,
    source_fallback,
    to_stg_base,
)
from farespark.params import DEFAULT
from farespark.plans import models
from tests.conftest import T, quote, raw_df

RUN = dt.datetime(2024, 3, 2)


def ods_of(spark, rows, params=DEFAULT):
    return models.ods(models.stg(to_stg_base(raw_df(spark, rows), RUN, params)), params)


def test_lower_case_codes_are_upper_cased_and_keyed(spark):
    o = ods_of(spark, [quote(o="svo", d="led")]).first()
    assert (o.route_origin, o.route_destination) == ("SVO", "LED")
    assert o.route_key == hashlib.md5(b"SVO-LED").hexdigest()


def test_route_key_null_in_null_out(spark):
    df = spark.createDataFrame([("SVO", None)], "o string, d string")
    assert df.select(route_key("o", "d").alias("k")).first().k is None


def test_missing_origin_becomes_empty_code(spark):
    r = normalize(raw_df(spark, [quote(o=None)]), RUN).first()
    assert r.route_origin == ""


def test_null_price_quarantined_or_zero(spark):
    raw = raw_df(spark, [quote(price=None), quote(cap="2024-03-01 09:00:01")])
    assert normalize(raw, RUN).count() == 1
    assert rejected(raw).first().reject_reason == "null price"
    zero = normalize(raw, RUN, DEFAULT.with_(null_price="zero"))
    assert sorted(float(r.price) for r in zero.collect()) == [0.0, 100.0]


def test_incomplete_rows_skipped(spark):
    raw = raw_df(spark, [quote(dep=None), quote(cap=None), quote()])
    assert normalize(raw, RUN).count() == 1
    reasons = sorted(r.reject_reason for r in rejected(raw).collect())
    assert reasons == ["missing captured_at", "missing departure_at"]


def test_missing_defaults_filled(spark):
    r = normalize(raw_df(spark, [quote(provider=None, ticket_class=None, currency=None, ingested_at=None)]), RUN).first()
    assert (r.provider, r.ticket_class, r.currency, r.ingested_at) == ("aviasales", "economy", "RUB", RUN)


def test_same_instant_business_and_economy_collide(spark):
    rows = [
        quote(ticket_class="economy", price=100.0, ingested_at=T("2024-03-01 10:00:00")),
        quote(ticket_class="business", price=300.0, ingested_at=T("2024-03-01 11:00:00")),
    ]
    base = to_stg_base(raw_df(spark, rows), RUN).collect()
    assert len(base) == 1 and base[0].ticket_class == "business" and float(base[0].price) == 300.0


def test_dedupe_is_deterministic_on_ties(spark):
    rows = [quote(price=100.0), quote(price=120.0)]  # same key, same ingested_at
    base = to_stg_base(raw_df(spark, rows), RUN).collect()
    assert len(base) == 1 and float(base[0].price) == 120.0


def test_hash_text_keeps_zero_fraction(spark):
    df = spark.createDataFrame([("SVO", "LED", T("2024-03-10 10:00:00"), T("2024-03-01 09:00:00"))],
                               "o string, d string, dep timestamp_ntz, cap timestamp_ntz")
    h = df.select(record_hash("o", "d", "dep", "cap").alias("h")).first().h
    text = "SVO|LED|2024-03-10T10:00:00.000000|2024-03-01T09:00:00.000000"
    assert h == hashlib.sha256(text.encode()).hexdigest()


def test_strict_watermark_excludes_equal_timestamp(spark):
    raw = raw_df(spark, [quote(cap="2024-03-01 09:00:00"), quote(cap="2024-03-01 09:00:01")])
    kept = above_watermark(raw, "captured_at", T("2024-03-01 09:00:00")).collect()
    assert [r.captured_at for r in kept] == [T("2024-03-01 09:00:01")]
    assert above_watermark(raw, "captured_at", None).count() == 2  # empty target: epoch


def test_sunday_and_saturday_numbering(spark):
    # 2024-03-10 is a Sunday, 2024-03-16 a Saturday
    o = ods_of(spark, [quote(dep="2024-03-10 08:00:00"), quote(dep="2024-03-16 08:00:00")])
    got = sorted((r.departure_at.day, r.departure_day_of_week) for r in o.collect())
    assert got == [(10, 0), (16, 6)]


def test_capture_at_2359_departure_next_day_is_one_day(spark):
    o = ods_of(spark, [quote(cap="2024-03-01 23:59:00", dep="2024-03-02 00:30:00")]).first()
    assert o.days_before_departure == 1


def _dm(spark, rows, params=DEFAULT):
    ods = ods_of(spark, rows, params)
    a = models.dm(ods, params).orderBy("route_key").collect()
    b = models.dm_from_segments(models.segment_stats(ods, params), params).orderBy("route_key").collect()
    assert a == b  # from the rows == from the additive state
    return a


def test_single_sample_route_has_null_stddev_and_cv(spark):
    (r,) = _dm(spark, [quote()])
    assert r.samples_total == 1 and r.route_price_stddev is None and r.route_price_cv is None
    assert r.best_days_before_departure == 9


def test_zero_mean_price_gives_null_cv(spark):
    rows = [quote(price=0.0), quote(price=0.0, cap="2024-03-01 09:00:01")]
    (r,) = _dm(spark, rows)
    assert float(r.route_avg_price) == 0.0 and r.route_price_cv is None


def test_only_thin_segments_still_ranked(spark):
    rows = [quote(dep="2024-03-05 10:00:00", price=50.0), quote(dep="2024-03-08 10:00:00", price=40.0, cap="2024-03-01 10:00:00")]
    (r,) = _dm(spark, rows)
    assert r.best_days_before_departure == 7  # cheapest thin segment wins


def test_thin_cheaper_segment_loses_to_full_one(spark):
    full = [quote(dep="2024-03-05 10:00:00", cap=f"2024-03-01 0{i}:00:00", price=90.0) for i in range(3)]
    thin = [quote(dep="2024-03-08 10:00:00", cap="2024-03-01 05:00:00", price=10.0)]
    (r,) = _dm(spark, full + thin)
    assert r.best_days_before_departure == 4


def test_tie_on_avg_and_samples_picks_smaller_lead_time(spark):
    rows = [
        quote(dep="2024-03-08 10:00:00", cap="2024-03-01 01:00:00", price=70.0),
        quote(dep="2024-03-05 10:00:00", cap="2024-03-01 02:00:00", price=70.0),
    ]
    (r,) = _dm(spark, rows)
    assert r.best_days_before_departure == 4
    assert r.best_search_weekday == "Friday" and r.best_search_hour == 1  # 2024-03-01 is a Friday


def test_rolling_mean_is_seven_rows_not_seven_days(spark):
    # 8 observed capture days with a hole: 7 rows span 8 calendar days
    days = [1, 2, 3, 5, 6, 7, 8, 9]
    rows = [quote(dep="2024-03-20 10:00:00", cap=f"2024-03-{d:02d} 09:00:00", price=float(d * 10)) for d in days]
    out = models.dwh(ods_of(spark, rows)).orderBy("captured_date").collect()
    last = out[-1]
    assert last.avg_price_7d == sum(d * 10 for d in days[-7:]) / 7
    assert last.prev_avg_price == 80.0  # previous *observed* day (the 8th)
    assert out[3].prev_avg_price == 30.0  # day 5 follows day 3 across the hole


def test_dwh_horizon_and_percentiles(spark):
    rows = [quote(dep="2024-03-10 10:00:00", cap=f"2024-03-01 0{i}:00:00", price=p) for i, p in enumerate([10.0, 20.0, 30.0, 40.0])]
    rows.append(quote(dep="2024-05-10 10:00:00", price=5.0))  # 70 days out: beyond 45
    (r,) = models.dwh(ods_of(spark, rows)).collect()
    assert (float(r.p25_price), float(r.p50_price), float(r.min_price), float(r.max_price)) == (10.0, 20.0, 10.0, 40.0)


def test_currency_filter_in_ods(spark):
    o = ods_of(spark, [quote(currency="usd"), quote(currency="rub", cap="2024-03-01 09:00:01")]).collect()
    assert [r.currency for r in o] == ["RUB"]


def test_json_price_payload_shapes(spark):
    payloads = [
        ('{"data": [{"price": 10.5}]}', 10.5),
        ('{"data": {"value": 7}}', 7.0),
        ('{"data": [{"price": null, "value": null, "min_price": 3}]}', 3.0),
        ('{"data": []}', None),
        ('{"data": {"price": null}}', None),
        ('{"data": [{"price": 0}]}', 0.0),
        ("garbage", None),
    ]
    df = spark.createDataFrame([(p,) for p, _ in payloads], "p string")
    got = [r.x for r in df.select(json_price("p").alias("x")).collect()]
    assert got == [e for _, e in payloads]


def test_source_fallback_used_only_when_primary_empty(spark):
    fb = raw_df(spark, [quote(provider="mock")])
    empty = raw_df(spark, [])
    prim = raw_df(spark, [quote(provider="api")])
    assert [r.provider for r in source_fallback(empty, fb).collect()] == ["mock"]
    assert [r.provider for r in source_fallback(prim, fb).collect()] == ["api"]


def test_dedupe_latest_generic(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "key string, ingested_at int, price string")
    got = sorted((r.key, r.price) for r in dedupe_latest(df, "key").collect())
    assert got == [("j", "c"), ("k", "b")]


def test_weekday_name_out_of_range_is_null(spark):
    from farespark.functions.dates import weekday_name

    df = spark.createDataFrame([(0,), (6,), (7,), (None,)], "d int")
    assert [r.n for r in df.select(weekday_name("d").alias("n")).collect()] == ["Sunday", "Saturday", None, None]


def test_calendar_grid_and_coefficients(spark):
    from farespark.operators import calendar as C

    req = spark.createDataFrame([(1, " SVO, DME ,,", "LED,SVO")], "id int, origins string, destinations string")
    grid = sorted((r.route_origin, r.route_destination) for r in C.route_grid(req).collect())
    assert grid == [("DME", "LED"), ("DME", "SVO"), ("SVO", "LED")]
    routes = spark.createDataFrame([("SVO", dt.date(2024, 3, 1))], "o string, cap date")
    cal = C.route_calendar(routes, "cap", 3).select(
        "day_ahead", "departure_date", C.demand_coef("departure_date").alias("dc"), C.lead_coef(F.col("day_ahead") - 1).alias("lc")
    ).collect()
    # 2024-03-02 Sat, 03 Sun, 04 Mon
    assert [(r.day_ahead, r.dc) for r in cal] == [(1, 1.25), (2, 1.25), (3, 1.0)]
    assert cal[0].lc == 1.25 and abs(cal[2].lc - (1.25 - 2 / 120)) < 1e-12
    floor = spark.range(1).select(C.lead_coef(F.lit(200)).alias("x")).first().x
    assert floor == 0.8


def test_runner_raises_on_error_not_on_warn(spark):
    import pytest

    from farespark.operators import quality as Qy

    warn = spark.createDataFrame([("volume_anomalies", "ods", None, 2)], "check_name string, model string, column_name string, failures long")
    ok = Qy.raise_on_error(Qy.with_status(warn, "warn"))
    assert ok.first().status == "warn"
    with pytest.raises(Qy.DataTestFailure):
        Qy.raise_on_error(Qy.with_status(warn, "error"))


def test_wall_clock_literals_ignore_process_zone(spark):
    import os
    import time

    from farespark.functions.dates import wall_lit

    old = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Tokyo"
    time.tzset()
    try:
        raw = raw_df(spark, [quote(cap="2024-03-01 09:00:00"), quote(cap="2024-03-01 09:00:01")])
        kept = above_watermark(raw, "captured_at", T("2024-03-01 09:00:00")).collect()
        assert [r.captured_at for r in kept] == [T("2024-03-01 09:00:01")]
        v = spark.range(1).select(wall_lit(T("2024-01-20 12:00:00")).alias("x")).first().x
        assert v == T("2024-01-20 12:00:00")
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_hash_text_is_zone_free_in_a_dst_gap(spark):
    from farespark.functions.keys import ts_text

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.5' AS t")  # no such local time in New York
        assert df.select(ts_text("t").alias("x")).first().x == "2024-03-10T02:30:00.500000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
