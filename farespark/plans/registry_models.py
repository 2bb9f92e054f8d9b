"""Registered queries: whole models and their parts.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or
None)``. Inputs are the driver's test tables through the FX1/FX2 mappings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.functions import dates, keys
from farespark.functions.dates import wall_lit
from farespark.functions.numeric import exact_avg, round_num, safe_ratio
from farespark.operators.ingest import above_watermark, json_price, normalize, read_documents, reject_reason, skip_incomplete
from farespark.operators.selection import percentiles_by_selection
from farespark.params import DEFAULT
from farespark.plans import duckdb_sql as D
from farespark.plans import flows, models
from farespark.schemas import DM_COLUMNS, DWH_COLUMNS, ODS_COLUMNS, RAW, STG_BASE, STG_COLUMNS
from farespark.session import scratch_path
from farespark.sources import variants as V
from farespark.sources.fixtures import fx1_raw, fx2_raw

Q = {}


def register(name: str, sql: str | None, columns: list[str] | None = None):
    def deco(fn):
        Q[name] = (fn, D.portable(sql, columns) if (sql and columns) else sql)
        return fn

    return deco


P = DEFAULT
FX1 = D.fx1_ods(P)  # raw_all, raw, stg_base_norm, stg_base, stg, ods
FX1_DWH = FX1 + D.dwh("ods", P)
FX1_DM = FX1 + D.dm("ods", P)
RAW_COLS = RAW.fieldNames()


def _ods(spark, sf):
    return flows.fx1_ods(spark, sf)


def _dwh(spark, sf):
    return models.dwh(_ods(spark, sf))


def _dm(spark, sf):
    return models.dm(_ods(spark, sf))


# ---------------------------------------------------------------- L1-L4


@register("model_stg", D.query(FX1, "SELECT * FROM stg"), STG_COLUMNS)
def model_stg(spark: SparkSession, sf: str) -> DataFrame:
    return flows.fx1_stg(spark, sf)


@register("stg_view", D.query(FX1, "SELECT * FROM stg"), STG_COLUMNS)
def stg_view(spark: SparkSession, sf: str) -> DataFrame:
    """The STG model materialized as a (lazy) temp view."""
    flows.fx1_stg(spark, sf).createOrReplaceTempView("stg_raw_flight_prices")
    return spark.table("stg_raw_flight_prices")


@register("model_ods", D.query(FX1, "SELECT * FROM ods"), ODS_COLUMNS)
def model_ods(spark, sf):
    return _ods(spark, sf)


@register("model_dwh", D.query(FX1_DWH, "SELECT * FROM dwh"), DWH_COLUMNS)
def model_dwh(spark, sf):
    return _dwh(spark, sf)


@register("model_dm", D.query(FX1_DM, "SELECT * FROM dm"), DM_COLUMNS)
def model_dm(spark, sf):
    return _dm(spark, sf)


@register("model_dm_fx2", D.query(D.fx2_ods(P) + D.dm("ods", P), "SELECT * FROM dm"), DM_COLUMNS)
def model_dm_fx2(spark, sf):
    return models.dm(flows.fx2_ods(spark, sf))


@register("model_dwh_fx2", D.query(D.fx2_ods(P) + D.dwh("ods", P), "SELECT * FROM dwh"), DWH_COLUMNS)
def model_dwh_fx2(spark, sf):
    return models.dwh(flows.fx2_ods(spark, sf))


# ---------------------------------------------------------------- 2.B


DIRTY = D.raw_fx1() + [("dirty", V.sql_dirty("raw_all"))]


@register(
    "normalize_doc",
    D.query(DIRTY + D.normalized("dirty", P), "SELECT * FROM normalized"),
    STG_BASE.fieldNames(),
)
def normalize_doc(spark, sf):
    return normalize(V.dirty(spark, sf).select(*RAW_COLS), flows.RUN_TS, P)


@register(
    "skip_incomplete",
    D.query(DIRTY, "SELECT * FROM dirty WHERE departure_at IS NOT NULL AND captured_at IS NOT NULL"),
    [*RAW_COLS, "event_id"],
)
def q_skip_incomplete(spark, sf):
    return skip_incomplete(V.dirty(spark, sf))


@register("filter_currency", D.query(FX1, f"SELECT * FROM stg WHERE currency = '{P.currency}'"), STG_COLUMNS)
def filter_currency(spark, sf):
    return flows.fx1_stg(spark, sf).filter(F.col("currency") == F.lit(P.currency))


@register(
    "filter_horizon",
    D.query(FX1, f"SELECT * FROM ods WHERE days_before_departure BETWEEN 0 AND {P.horizon_days}"),
    ODS_COLUMNS,
)
def filter_horizon(spark, sf):
    return _ods(spark, sf).filter(F.col("days_before_departure").between(0, P.horizon_days))


@register(
    "filter_self_route",
    D.query(D.raw_fx2(), "SELECT * FROM raw WHERE route_origin <> route_destination"),
    RAW_COLS,
)
def filter_self_route(spark, sf):
    return fx2_raw(spark, sf).filter(F.col("route_origin") != F.col("route_destination"))


@register(
    "filter_watermark",
    D.query(
        FX1,
        f"SELECT * FROM stg WHERE captured_at > (SELECT coalesce(max(captured_at), TIMESTAMP '1970-01-01') "
        f"FROM stg WHERE captured_at < {V.CUT_SQL})",
    ),
    STG_COLUMNS,
)
def filter_watermark(spark, sf):
    """Strict filter above the max capture of the rows before the cut."""
    stg = flows.fx1_stg(spark, sf)
    wm = stg.filter(F.col("captured_at") < wall_lit(V.CUT)).agg(F.max("captured_at")).first()[0]
    return above_watermark(stg, "captured_at", wm)


@register(
    "scan_raw",
    D.query(D.raw_fx1(), f"SELECT * FROM raw WHERE captured_at > {V.CUT_SQL}"),
    RAW_COLS,
)
def scan_raw(spark, sf):
    """A1: raw quotes newer than a watermark; the predicate reaches the scan."""
    return above_watermark(fx1_raw(spark, sf), "captured_at", V.CUT)


# Each event as a document, with a field that no one asks for; some lines are cut off.
def _document_lines(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    line = F.to_json(F.struct(*[F.col(c) for c in RAW_COLS], F.col("event_id").alias("event")), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return e.select("event_id", line.alias("line")).select(F.expr("if(event_id % 77 = 0, left(line, length(line) div 2), line)").alias("value"))


@register(
    "json_documents",
    D.query(
        D.raw_fx1(),
        "SELECT " + ", ".join(f"CASE WHEN event_id % 77 <> 0 THEN {c} END AS {c}" for c in RAW_COLS)
        + ", CASE WHEN event_id % 77 = 0 THEN 'not a document' WHEN departure_at IS NULL THEN 'missing departure_at' "
        "WHEN captured_at IS NULL THEN 'missing captured_at' WHEN price IS NULL THEN 'null price' "
        "WHEN TRY_CAST(price AS DECIMAL(12,2)) IS NULL THEN 'price out of range' END AS reject_reason FROM raw_all",
    ),
    [*RAW_COLS, "reject_reason"],
)
def json_documents(spark, sf):
    """A1 from JSON lines: every line as read, and why it is not loaded if it is not."""
    path = scratch_path(spark, "json-documents")
    _document_lines(spark, sf).write.text(path)
    rows = read_documents(spark, path)
    return rows.select(*RAW_COLS, reject_reason(rows, P).alias("reject_reason"))


# Payload text derived from each event (list form, object form, empty list,
# no candidate, unparsable), then parsed back.
def _payload(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    v = F.col("price").cast("string")
    eid = F.col("event_id")
    text = (
        F.when(eid % 50 == 0, F.lit('{"data": []}'))
        .when(eid % 77 == 0, F.lit("not json"))
        .when(eid % 31 == 0, F.lit('{"data": {"other": 1}}'))
        .when(eid % 3 == 0, F.concat(F.lit('{"data": [{"price": null, "value": '), v, F.lit("}]}")))
        .when(eid % 3 == 1, F.concat(F.lit('{"data": {"min_price": '), v, F.lit("}}")))
        .otherwise(F.concat(F.lit('{"data": [{"price": '), v, F.lit('}, {"price": 1}]}')))
    )
    return e.select("event_id", text.alias("payload"))


PAYLOAD_SQL = """SELECT event_id, CASE
    WHEN event_id % 50 = 0 THEN '{"data": []}'
    WHEN event_id % 77 = 0 THEN 'not json'
    WHEN event_id % 31 = 0 THEN '{"data": {"other": 1}}'
    WHEN event_id % 3 = 0 THEN '{"data": [{"price": null, "value": ' || CAST(price AS VARCHAR) || '}]}'
    WHEN event_id % 3 = 1 THEN '{"data": {"min_price": ' || CAST(price AS VARCHAR) || '}}'
    ELSE '{"data": [{"price": ' || CAST(price AS VARCHAR) || '}, {"price": 1}]}' END AS payload
FROM raw_all"""

JSON_PRICE_SQL = """SELECT event_id, price FROM (
  SELECT event_id, TRY_CAST(CASE WHEN NOT json_valid(payload) THEN NULL
        WHEN json_type(payload, '$.data') = 'ARRAY'
        THEN coalesce(json_extract_string(payload, '$.data[0].price'), json_extract_string(payload, '$.data[0].value'),
                      json_extract_string(payload, '$.data[0].min_price'))
        WHEN json_type(payload, '$.data') = 'OBJECT'
        THEN coalesce(json_extract_string(payload, '$.data.price'), json_extract_string(payload, '$.data.value'),
                      json_extract_string(payload, '$.data.min_price'))
        END AS DOUBLE) AS price
  FROM payloads) AS p
WHERE price IS NOT NULL"""


@register("json_price", D.query(D.raw_fx1() + [("payloads", PAYLOAD_SQL)], JSON_PRICE_SQL), ["event_id", "price"])
def q_json_price(spark, sf):
    p = _payload(spark, sf)
    return p.select("event_id", json_price("payload").alias("price")).filter(F.col("price").isNotNull())


# ---------------------------------------------------------------- 2.D aggregates

BASE_DM = FX1 + D.mart_rows("ods", P)


@register("agg_count", D.query(BASE_DM, "SELECT route_key, COUNT(*) AS n FROM mart_rows GROUP BY route_key"), ["route_key", "n"])
def agg_count(spark, sf):
    return models.dm_base(_ods(spark, sf)).groupBy("route_key").agg(F.count(F.lit(1)).alias("n"))


@register(
    "agg_avg",
    D.query(BASE_DM, "SELECT route_key, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price FROM mart_rows GROUP BY route_key"),
    ["route_key", "avg_price"],
)
def agg_avg(spark, sf):
    return models.dm_base(_ods(spark, sf)).groupBy("route_key").agg(exact_avg("price").alias("avg_price"))


@register(
    "agg_stddev",
    D.query(
        BASE_DM,
        "SELECT route_key, CAST(round(CAST(stddev_samp(CAST(price AS DOUBLE)) AS DECIMAL(38,10)), 4) AS DOUBLE) AS price_stddev "
        "FROM mart_rows GROUP BY route_key",
    ),
    ["route_key", "price_stddev"],
)
def agg_stddev(spark, sf):
    return (
        models.dm_base(_ods(spark, sf))
        .groupBy("route_key")
        .agg(round_num(F.stddev_samp(F.col("price").cast("double")), 4).cast("double").alias("price_stddev"))
    )


@register(
    "agg_minmax",
    D.query(BASE_DM, "SELECT route_key, MIN(price) AS min_price, MAX(price) AS max_price FROM mart_rows GROUP BY route_key"),
    ["route_key", "min_price", "max_price"],
)
def agg_minmax(spark, sf):
    return models.dm_base(_ods(spark, sf)).groupBy("route_key").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )


@register(
    "agg_percentile_disc",
    D.query(
        BASE_DM,
        "SELECT route_key, CAST(percentile_disc(0.25) WITHIN GROUP (ORDER BY price) AS DECIMAL(12,2)) AS p25_price, "
        "CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY price) AS DECIMAL(12,2)) AS p50_price FROM mart_rows GROUP BY route_key",
    ),
    ["route_key", "p25_price", "p50_price"],
)
def agg_percentile_disc(spark, sf):
    return models.dm_base(_ods(spark, sf)).groupBy("route_key").agg(
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY price)").cast("decimal(12,2)").alias("p25_price"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY price)").cast("decimal(12,2)").alias("p50_price"),
    )


@register(
    "agg_percentile_select",
    "SELECT l_returnflag, l_linestatus, quantile_disc(l_quantity, 0.05)::BIGINT AS q05_quantity, "
    "quantile_disc(CAST(round(l_extendedprice * 100) AS BIGINT), 0.25) AS p25_cents, "
    "quantile_disc(CAST(round(l_extendedprice * 100) AS BIGINT), 0.5) AS p50_cents, "
    "quantile_disc(CAST(round(l_extendedprice * 100) AS BIGINT), 0.99) AS p99_cents "
    "FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def agg_percentile_select(spark, sf):
    """D5 by distributed selection, on groups that each hold a large share of all rows."""
    groups = ["l_returnflag", "l_linestatus"]
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    prices = li.groupBy(*groups, cents.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    sizes = li.groupBy(*groups, F.col("l_quantity").cast("long").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    p = percentiles_by_selection(prices, groups, "v", "n", [0.25, 0.5, 0.99]).toDF(*groups, "p25_cents", "p50_cents", "p99_cents")
    q = percentiles_by_selection(sizes, groups, "v", "n", [0.05]).toDF(*groups, "q05_quantity")
    return q.join(p, groups)


ROUTE_STATS_COLS = [
    "route_key",
    "route_origin",
    "route_destination",
    "samples_total",
    "route_avg_price",
    "route_price_stddev",
    "route_min_price",
    "route_max_price",
]


@register(
    "route_stats",
    D.query(
        FX1 + D.mart_groups("ods", P),
        "SELECT route.key AS route_key, route.origin AS route_origin, route.destination AS route_destination, n AS samples_total, "
        f"mean AS route_avg_price, {D.r2('sd', 4)}::DOUBLE AS route_price_stddev, low AS route_min_price, high AS route_max_price "
        f"FROM mart_groups WHERE part = {D.BY_ROUTE}",
    ),
    ROUTE_STATS_COLS,
)
def q_route_stats(spark, sf):
    rs = models.route_stats(models.dm_base(_ods(spark, sf)))
    return rs.withColumn("route_price_stddev", round_num("route_price_stddev", 4).cast("double"))


LEAD_SQL = "route.key AS route_key, lead AS days_before_departure, n AS segment_samples, mean AS avg_price_for_days_before_departure"
SLOT_SQL = (
    "route.key AS route_key, CAST(slot // 24 AS INTEGER) AS search_weekday_num, CAST(slot % 24 AS INTEGER) AS search_hour, "
    "n AS segment_samples, mean AS avg_price_for_search_slot"
)


@register(
    "lead_time_stats",
    D.query(FX1 + D.mart_groups("ods", P), f"SELECT {LEAD_SQL} FROM mart_groups WHERE part = {D.BY_LEAD}"),
    ["route_key", "days_before_departure", "segment_samples", "avg_price_for_days_before_departure"],
)
def q_lead_time_stats(spark, sf):
    return models.lead_time_stats(models.dm_base(_ods(spark, sf)))


@register(
    "search_time_stats",
    D.query(FX1 + D.mart_groups("ods", P), f"SELECT {SLOT_SQL} FROM mart_groups WHERE part = {D.BY_SLOT}"),
    ["route_key", "search_weekday_num", "search_hour", "segment_samples", "avg_price_for_search_slot"],
)
def q_search_time_stats(spark, sf):
    return models.search_time_stats(models.dm_base(_ods(spark, sf)))


DAILY_COLS = ["route_key", "route_origin", "route_destination", "departure_date", "captured_date",
              "avg_price", "min_price", "max_price", "p25_price", "p50_price"]


@register("daily_agg", D.query(FX1 + D.dwh_daily("ods", P), "SELECT * FROM dwh_daily"), DAILY_COLS)
def q_daily_agg(spark, sf):
    return models.dwh_daily(_ods(spark, sf))


@register(
    "route_cv",
    D.query(
        FX1 + D.mart_groups("ods", P),
        f"SELECT route.key AS route_key, {D.r2('sd / nullif(mean, 0)', 4)}::DOUBLE AS route_price_cv FROM mart_groups WHERE part = {D.BY_ROUTE}",
    ),
    ["route_key", "route_price_cv"],
)
def q_route_cv(spark, sf):
    rs = models.route_stats(models.dm_base(_ods(spark, sf)))
    return rs.select("route_key", round_num(safe_ratio("route_price_stddev", "route_avg_price"), 4).cast("double").alias("route_price_cv"))


# ---------------------------------------------------------------- 2.E windows


@register("win_lag", D.query(FX1_DWH, "SELECT feature_key, prev_avg_price FROM dwh"), ["feature_key", "prev_avg_price"])
def win_lag(spark, sf):
    return _dwh(spark, sf).select("feature_key", "prev_avg_price")


@register("win_rolling7", D.query(FX1_DWH, "SELECT feature_key, avg_price_7d FROM dwh"), ["feature_key", "avg_price_7d"])
def win_rolling7(spark, sf):
    return _dwh(spark, sf).select("feature_key", "avg_price_7d")


@register(
    "rank_lead_time",
    D.query(
        FX1 + D.mart_groups("ods", P),
        f"SELECT {LEAD_SQL}, (rank() OVER (PARTITION BY route ORDER BY key))::INTEGER AS rn FROM mart_groups WHERE part = {D.BY_LEAD}",
    ),
    ["route_key", "days_before_departure", "segment_samples", "avg_price_for_days_before_departure", "rn"],
)
def rank_lead_time(spark, sf):
    stats = models.lead_time_stats(models.dm_base(_ods(spark, sf)))
    return models.rank_segments(stats, "avg_price_for_days_before_departure", ["days_before_departure"], P)


@register(
    "rank_search_slot",
    D.query(
        FX1 + D.mart_groups("ods", P),
        f"SELECT {SLOT_SQL}, (rank() OVER (PARTITION BY route ORDER BY key))::INTEGER AS rn FROM mart_groups WHERE part = {D.BY_SLOT}",
    ),
    ["route_key", "search_weekday_num", "search_hour", "segment_samples", "avg_price_for_search_slot", "rn"],
)
def rank_search_slot(spark, sf):
    stats = models.search_time_stats(models.dm_base(_ods(spark, sf)))
    return models.rank_segments(stats, "avg_price_for_search_slot", ["search_weekday_num", "search_hour"], P)


# ---------------------------------------------------------------- 2.C joins


@register(
    "join_best_lead",
    D.query(
        FX1 + D.mart_best("ods", P),
        "SELECT route.key AS route_key, whole.n AS samples_total, days.lead::INTEGER AS best_days_before_departure, "
        "days.mean AS avg_price_for_days_before_departure FROM mart_best",
    ),
    ["route_key", "samples_total", "best_days_before_departure", "avg_price_for_days_before_departure"],
)
def join_best_lead(spark, sf):
    base = models.dm_base(_ods(spark, sf))
    best = (
        models.rank_segments(models.lead_time_stats(base), "avg_price_for_days_before_departure", ["days_before_departure"], P)
        .filter("rn = 1")
        .select("route_key", F.col("days_before_departure").alias("best_days_before_departure"), "avg_price_for_days_before_departure")
    )
    return models.route_stats(base).select("route_key", "samples_total").join(best, "route_key", "left")


@register(
    "join_best_slot",
    D.query(
        FX1 + D.mart_best("ods", P),
        "SELECT route.key AS route_key, whole.n AS samples_total, (hours.slot // 24)::INTEGER AS search_weekday_num, "
        "(hours.slot % 24)::INTEGER AS best_search_hour, hours.mean AS avg_price_for_search_slot FROM mart_best",
    ),
    ["route_key", "samples_total", "search_weekday_num", "best_search_hour", "avg_price_for_search_slot"],
)
def join_best_slot(spark, sf):
    base = models.dm_base(_ods(spark, sf))
    best = (
        models.rank_segments(models.search_time_stats(base), "avg_price_for_search_slot", ["search_weekday_num", "search_hour"], P)
        .filter("rn = 1")
        .select("route_key", "search_weekday_num", F.col("search_hour").alias("best_search_hour"), "avg_price_for_search_slot")
    )
    return models.route_stats(base).select("route_key", "samples_total").join(best, "route_key", "left")


# ---------------------------------------------------------------- 2.H scalar functions


@register(
    "route_key",
    D.query(FX1, f"SELECT DISTINCT route_origin, route_destination, {D.route_key_sql('route_origin', 'route_destination')} AS route_key FROM stg"),
    ["route_origin", "route_destination", "route_key"],
)
def q_route_key(spark, sf):
    stg = flows.fx1_stg(spark, sf)
    return stg.select("route_origin", "route_destination").distinct().withColumn(
        "route_key", keys.route_key("route_origin", "route_destination")
    )


@register(
    "record_hash",
    D.query(
        D.raw_fx1(),
        "SELECT event_id, "
        + D.record_hash_sql("upper(route_origin)", "upper(route_destination)", "departure_at", "captured_at")
        + " AS record_hash FROM raw_all",
    ),
    ["event_id", "record_hash"],
)
def q_record_hash(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    return e.select(
        "event_id",
        keys.record_hash(F.upper("route_origin"), F.upper("route_destination"), "departure_at", "captured_at").alias("record_hash"),
    )


@register(
    "feature_key",
    D.query(FX1_DWH, "SELECT route_key, departure_date, captured_date, feature_key FROM dwh"),
    ["route_key", "departure_date", "captured_date", "feature_key"],
)
def q_feature_key(spark, sf):
    daily = models.dwh_daily(_ods(spark, sf))
    return daily.select(
        "route_key", "departure_date", "captured_date",
        keys.feature_key("route_key", "departure_date", "captured_date").alias("feature_key"),
    )


@register(
    "to_date_parts",
    D.query(D.raw_fx1(), "SELECT event_id, CAST(departure_at AS DATE) AS departure_date, CAST(captured_at AS DATE) AS captured_date FROM raw_all"),
    ["event_id", "departure_date", "captured_date"],
)
def to_date_parts(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    return e.select("event_id", dates.to_date_part("departure_at").alias("departure_date"), dates.to_date_part("captured_at").alias("captured_date"))


@register(
    "days_before",
    D.query(D.raw_fx1(), "SELECT event_id, CAST(date_diff('day', CAST(captured_at AS DATE), CAST(departure_at AS DATE)) AS INTEGER) AS days_before_departure FROM raw_all"),
    ["event_id", "days_before_departure"],
)
def days_before(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    return e.select("event_id", dates.days_before("departure_at", "captured_at").alias("days_before_departure"))


@register(
    "dow_hour",
    D.query(
        D.raw_fx1(),
        "SELECT event_id, CAST(extract(dow FROM departure_at) AS INTEGER) AS departure_day_of_week, "
        "CAST(extract(dow FROM captured_at) AS INTEGER) AS search_weekday_num, CAST(extract(hour FROM captured_at) AS INTEGER) AS search_hour FROM raw_all",
    ),
    ["event_id", "departure_day_of_week", "search_weekday_num", "search_hour"],
)
def dow_hour(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    return e.select(
        "event_id",
        dates.dow_sunday0("departure_at").alias("departure_day_of_week"),
        dates.dow_sunday0("captured_at").alias("search_weekday_num"),
        dates.hour_of("captured_at").alias("search_hour"),
    )


@register(
    "weekday_name",
    D.query(
        D.raw_fx1(),
        "SELECT event_id, dayname(departure_at) AS departure_weekday FROM raw_all",
    ),
    ["event_id", "departure_weekday"],
)
def q_weekday_name(spark, sf):
    e = fx1_raw(spark, sf, keep_event_id=True)
    return e.select("event_id", dates.weekday_name(dates.dow_sunday0("departure_at")).alias("departure_weekday"))


@register(
    "round_out",
    D.query(
        FX1_DWH,
        "SELECT feature_key, round(CAST(avg_price AS DECIMAL(38,10)), 2) AS price_rounded, "
        "CAST(round(CAST(avg_price / 1000 AS DECIMAL(38,10)), 4) AS DOUBLE) AS ratio_rounded FROM dwh",
    ),
    ["feature_key", "price_rounded", "ratio_rounded"],
)
def round_out(spark, sf):
    d = models.dwh_daily(_ods(spark, sf)).withColumn(
        "feature_key", keys.feature_key("route_key", "departure_date", "captured_date")
    )
    return d.select(
        "feature_key",
        round_num("avg_price", 2).alias("price_rounded"),
        round_num(F.col("avg_price") / 1000, 4).cast("double").alias("ratio_rounded"),
    )
