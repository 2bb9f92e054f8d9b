"""Report series over the mart (F1-F5): stay on Spark until the final limit.

The mart has one row per route, so these sorts are small; they are still
expressed as Spark sorts / ``TakeOrderedAndProject`` so that only the rows a
report shows ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY_COLUMNS = [
    "route_origin",
    "route_destination",
    "best_days_before_departure",
    "best_search_weekday",
    "best_search_hour",
    "route_avg_price",
    "route_price_stddev",
    "route_price_cv",
]

# Series behind the three charts: price level by route, best lead time by
# route, price level versus volatility.
CHART_COLUMNS = [
    "route_origin",
    "route_destination",
    "route_avg_price",
    "best_days_before_departure",
    "route_price_stddev",
    "route_price_cv",
    "best_search_weekday",
    "best_search_hour",
]


def sort_by_avg_price(dm: DataFrame) -> DataFrame:
    """F1; route_key breaks ties so the order is total."""
    return dm.orderBy(F.col("route_avg_price").asc_nulls_last(), "route_key")


def sort_by_best_days(dm: DataFrame) -> DataFrame:
    """F2."""
    return dm.orderBy(F.col("best_days_before_departure").asc_nulls_last(), "route_key")


def head_routes(dm: DataFrame, n: int = 30) -> DataFrame:
    """first n rows of the summary; ordered by key for determinism."""
    return dm.orderBy("route_key").select(*SUMMARY_COLUMNS).limit(n)


def top_cheapest(dm: DataFrame, n: int = 20) -> DataFrame:
    """the n cheapest routes (TakeOrderedAndProject: a top-k, no full sort)."""
    return dm.orderBy(F.col("route_avg_price").asc_nulls_last(), "route_key").select(*SUMMARY_COLUMNS).limit(n)


def chart_series(dm: DataFrame) -> DataFrame:
    """columns behind the charts (drawing itself is out of scope)."""
    return dm.select(*CHART_COLUMNS)
