"""Registered calendar queries (C3, C4, H11-H14) over data-derived requests.

The request log is derived from ODS: one request per capture day listing
the origins and destinations quoted that day (as the text a caller would
send), so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.functions.dates import iso_date
from farespark.functions.numeric import exact_avg
from farespark.operators import calendar as C
from farespark.params import DEFAULT
from farespark.plans import duckdb_sql as D
from farespark.plans import flows

Q = {}
P = DEFAULT
DAYS_AHEAD = 60  # fixed value: days per scheduled request


def register(name: str, sql: str | None, columns: list[str] | None = None):
    def deco(fn):
        Q[name] = (fn, D.portable(sql, columns) if (sql and columns) else sql)
        return fn

    return deco


def requests(spark: SparkSession, sf: str) -> DataFrame:
    ods = flows.fx1_ods(spark, sf, P)
    return ods.groupBy(F.to_date("captured_at").alias("captured_date")).agg(
        F.concat(F.array_join(F.sort_array(F.collect_set("route_origin")), " , "), F.lit(",,")).alias("origins"),
        F.array_join(F.sort_array(F.collect_set("route_destination")), ",").alias("destinations"),
    )


REQ_SQL = D.fx1_ods(P) + [
    (
        "requests",
        """SELECT CAST(captured_at AS DATE) AS captured_date,
       array_to_string(list_sort(list_distinct(list(route_origin))), ' , ') || ',,' AS origins,
       array_to_string(list_sort(list_distinct(list(route_destination))), ',') AS destinations
FROM ods GROUP BY 1""",
    )
]


@register(
    "split_codes",
    D.query(
        REQ_SQL,
        "SELECT captured_date, code FROM (SELECT captured_date, unnest(list_filter(list_transform(string_split(origins, ','), lambda x: trim(x)), lambda x: x <> '')) AS code FROM requests) AS s",
    ),
    ["captured_date", "code"],
)
def q_split_codes(spark, sf):
    r = requests(spark, sf)
    return r.select("captured_date", F.explode(C.split_codes("origins")).alias("code"))


@register(
    "route_grid",
    D.query(
        REQ_SQL
        + [
            (
                "o",
                "SELECT captured_date, destinations, unnest(list_filter(list_transform(string_split(origins, ','), lambda x: trim(x)), lambda x: x <> '')) AS route_origin FROM requests",
            ),
            (
                "od",
                "SELECT captured_date, route_origin, unnest(list_filter(list_transform(string_split(destinations, ','), lambda x: trim(x)), lambda x: x <> '')) AS route_destination FROM o",
            ),
        ],
        "SELECT captured_date, route_origin, route_destination FROM od WHERE route_origin <> route_destination",
    ),
    ["captured_date", "route_origin", "route_destination"],
)
def q_route_grid(spark, sf):
    return C.route_grid(requests(spark, sf))


CAL_COLS = ["route_key", "captured_date", "day_ahead", "departure_date", "departure_iso", "demand_coef", "lead_coef", "expected_price"]


@register(
    "route_calendar",
    D.query(
        D.fx1_ods(P)
        + [
            ("base", "SELECT route_key, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS base_price FROM ods GROUP BY 1"),
            ("caps", "SELECT DISTINCT route_key, CAST(captured_at AS DATE) AS captured_date FROM ods"),
            (
                "cal",
                f"""SELECT c.route_key, c.captured_date, CAST(g.day_ahead AS INTEGER) AS day_ahead,
       CAST(c.captured_date + CAST(g.day_ahead AS INTEGER) AS DATE) AS departure_date, b.base_price
FROM caps c JOIN base b ON c.route_key = b.route_key, (SELECT unnest(generate_series(1, {DAYS_AHEAD})) AS day_ahead) g""",
            ),
            (
                "coef",
                f"""SELECT *, CASE WHEN isodow(departure_date) >= 5 THEN CAST({C.WEEKEND_DEMAND} AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS demand_coef,
       greatest(CAST({C.LEAD_FLOOR} AS DOUBLE), CAST({C.LEAD_START} AS DOUBLE) - CAST(day_ahead - 1 AS DOUBLE) / {C.LEAD_SLOPE_DAYS}) AS lead_coef
FROM cal""",
            ),
        ],
        "SELECT route_key, captured_date, day_ahead, departure_date, strftime(departure_date, '%Y-%m-%d') AS departure_iso, demand_coef, lead_coef, "
        "round(CAST(base_price * demand_coef * lead_coef AS DECIMAL(38,10)), 2) AS expected_price FROM coef",
    ),
    CAL_COLS,
)
def q_route_calendar(spark, sf):
    """C4 + H12-H14: each (route, capture day) expanded to 60 departure days
    with the demand and lead-time factors and the expected price index,
    based on the route's mean price."""
    ods = flows.fx1_ods(spark, sf, P)
    base = ods.groupBy("route_key").agg(exact_avg("price").alias("base_price"))
    caps = ods.select("route_key", F.to_date("captured_at").alias("captured_date")).distinct()
    cal = C.route_calendar(caps.join(base, "route_key"), "captured_date", DAYS_AHEAD)
    day_idx = F.col("day_ahead") - 1
    return cal.select(
        "route_key",
        "captured_date",
        F.col("day_ahead").cast("int").alias("day_ahead"),
        "departure_date",
        iso_date("departure_date").alias("departure_iso"),
        C.demand_coef("departure_date").alias("demand_coef"),
        C.lead_coef(day_idx).alias("lead_coef"),
        C.expected_price("base_price", "departure_date", day_idx).alias("expected_price"),
    )


# Per-quote factors over ODS: the lead index is the 0-based day number
# (days before departure - 1), the base is the route's mean price.
ODS_BASE_SQL = D.fx1_ods(P) + [
    ("base", "SELECT route_key, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS base_price FROM ods GROUP BY 1"),
    (
        "q",
        f"""SELECT o.record_hash, o.departure_at, b.base_price,
       CASE WHEN isodow(o.departure_at) >= 5 THEN CAST({C.WEEKEND_DEMAND} AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS demand_coef,
       greatest(CAST({C.LEAD_FLOOR} AS DOUBLE), CAST({C.LEAD_START} AS DOUBLE) - CAST(o.days_before_departure - 1 AS DOUBLE) / {C.LEAD_SLOPE_DAYS}) AS lead_coef
FROM ods o JOIN base b ON o.route_key = b.route_key
WHERE o.days_before_departure >= 1""",
    ),
]


def _quotes(spark, sf):
    ods = flows.fx1_ods(spark, sf, P)
    base = ods.groupBy("route_key").agg(exact_avg("price").alias("base_price"))
    return ods.filter(F.col("days_before_departure") >= 1).join(base, "route_key")


@register("demand_coef", D.query(ODS_BASE_SQL, "SELECT record_hash, demand_coef FROM q"), ["record_hash", "demand_coef"])
def q_demand_coef(spark, sf):
    """H12 on every quote's departure."""
    return _quotes(spark, sf).select("record_hash", C.demand_coef("departure_at").alias("demand_coef"))


@register("lead_coef", D.query(ODS_BASE_SQL, "SELECT record_hash, lead_coef FROM q"), ["record_hash", "lead_coef"])
def q_lead_coef(spark, sf):
    """H13 on every quote's lead time."""
    return _quotes(spark, sf).select("record_hash", C.lead_coef(F.col("days_before_departure") - 1).alias("lead_coef"))


@register(
    "expected_price",
    D.query(
        ODS_BASE_SQL,
        "SELECT record_hash, round(CAST(base_price * demand_coef * lead_coef AS DECIMAL(38,10)), 2) AS expected_price FROM q",
    ),
    ["record_hash", "expected_price"],
)
def q_expected_price(spark, sf):
    """The route's seasonal price index at each quote."""
    q = _quotes(spark, sf)
    return q.select(
        "record_hash",
        C.expected_price("base_price", "departure_at", F.col("days_before_departure") - 1).alias("expected_price"),
    )
