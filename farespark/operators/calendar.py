"""Route grid, departure calendar and the seasonal price index.

The reference builds these in a Python loop per request; here they are
column expressions and generators on a DataFrame of requests, so each
request row expands on its own executor (no cross join, no driver loop).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the price index: Friday-Sunday departures cost 1.25x;
# the lead-time factor falls from 1.25 by 1/120 per day to a floor of 0.8.
WEEKEND_DEMAND = 1.25
LEAD_START, LEAD_SLOPE_DAYS, LEAD_FLOOR = 1.25, 120, 0.8


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_codes(text: str | Column) -> Column:
    """'SVO, DME,,VKO' -> ['SVO', 'DME', 'VKO']: split on ',', trim, drop empties."""
    parts = F.transform(F.split(_c(text), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def route_grid(requests: DataFrame, origins: str = "origins", destinations: str = "destinations") -> DataFrame:
    """One row per (origin, destination) of each request, origin != destination.

    Both lists come from the same request row; the pairs are generated by
    nested ``transform`` + ``explode`` inside that row, so the output is
    bounded by the request's own list sizes.
    """
    o, d = split_codes(origins), split_codes(destinations)
    pairs = F.flatten(F.transform(o, lambda x: F.transform(d, lambda y: F.struct(x.alias("route_origin"), y.alias("route_destination")))))
    keep = [c for c in requests.columns if c not in (origins, destinations)]
    out = requests.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.route_origin", "p.route_destination")
    return out.filter(F.col("route_origin") != F.col("route_destination"))


def route_calendar(routes: DataFrame, capture_col: str, days_ahead: int | str | Column) -> DataFrame:
    """Per route row, one row per departure day 1..N after capture."""
    n = F.lit(days_ahead) if isinstance(days_ahead, int) else _c(days_ahead)
    return routes.select(
        "*",
        F.explode(F.sequence(F.lit(1), n)).alias("day_ahead"),
    ).withColumn("departure_date", F.date_add(F.to_date(capture_col), F.col("day_ahead")))


def demand_coef(departure: str | Column) -> Column:
    """1.25 for Friday, Saturday, Sunday departures, else 1.0.
    Spark ``weekday`` is 0 = Monday, so Fri..Sun are 4..6."""
    return F.when(F.weekday(_c(departure)) >= 4, F.lit(WEEKEND_DEMAND)).otherwise(F.lit(1.0))


def lead_coef(day_idx: str | Column) -> Column:
    """max(0.8, 1.25 - idx / 120) with a 0-based day index."""
    return F.greatest(F.lit(LEAD_FLOOR), F.lit(LEAD_START) - _c(day_idx).cast("double") / LEAD_SLOPE_DAYS)


def expected_price(base: str | Column, departure: str | Column, day_idx: str | Column) -> Column:
    """round(base x demand x lead, 2): the price index without noise."""
    raw = _c(base).cast("double") * demand_coef(departure) * lead_coef(day_idx)
    return F.round(raw.cast("decimal(38,10)"), 2)
