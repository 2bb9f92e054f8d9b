"""Explicit schemas of every layer (never inferred).

Timestamps are ``TIMESTAMP_NTZ`` holding the UTC wall clock; the session
time zone is pinned to UTC as well. Column descriptions travel as
``StructField.metadata['comment']`` so that they land in the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TS = T.TimestampNTZType()
PRICE = T.DecimalType(12, 2)


def _f(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata={"comment": comment})


RAW = T.StructType(
    [
        _f("provider", T.StringType(), "price source"),
        _f("route_origin", T.StringType(), "origin airport code, any case"),
        _f("route_destination", T.StringType(), "destination airport code, any case"),
        _f("departure_at", TS, "departure time, UTC"),
        _f("captured_at", TS, "time the quote was captured, UTC; one per batch"),
        _f("ticket_class", T.StringType(), "economy or business"),
        _f("currency", T.StringType(), "currency code"),
        _f("price", T.DoubleType(), "quoted price"),
        _f("ingested_at", TS, "time the quote reached raw storage"),
    ]
)

STG_BASE = T.StructType(
    [
        _f("record_hash", T.StringType(), "sha256 of origin|destination|departure|captured", False),
        _f("provider", T.StringType(), "price source", False),
        _f("route_origin", T.StringType(), "origin code, upper case", False),
        _f("route_destination", T.StringType(), "destination code, upper case", False),
        _f("departure_at", TS, "departure time, UTC", False),
        _f("captured_at", TS, "capture time, UTC", False),
        _f("ticket_class", T.StringType(), "ticket class", False),
        _f("currency", T.StringType(), "currency code", False),
        _f("price", PRICE, "price", False),
        _f("ingested_at", TS, "last load time of this key", False),
    ]
)

STG_COLUMNS = [
    "record_hash",
    "route_origin",
    "route_destination",
    "departure_at",
    "captured_at",
    "ticket_class",
    "currency",
    "price",
    "ingested_at",
    "days_before_departure",
    "departure_day_of_week",
]

ODS_COLUMNS = [
    "record_hash",
    "route_key",
    "route_origin",
    "route_destination",
    "departure_at",
    "captured_at",
    "days_before_departure",
    "departure_day_of_week",
    "ticket_class",
    "currency",
    "price",
]

DWH_COLUMNS = [
    "feature_key",
    "route_key",
    "route_origin",
    "route_destination",
    "departure_date",
    "captured_date",
    "avg_price",
    "min_price",
    "max_price",
    "p25_price",
    "p50_price",
    "prev_avg_price",
    "avg_price_7d",
]

DM_COLUMNS = [
    "route_key",
    "route_origin",
    "route_destination",
    "samples_total",
    "best_days_before_departure",
    "avg_price_for_best_days_before_departure",
    "best_search_weekday",
    "best_search_hour",
    "avg_price_for_best_search_slot",
    "route_avg_price",
    "route_price_stddev",
    "route_price_cv",
    "route_min_price",
    "route_max_price",
]

_TYPES = {
    "departure_at": TS,
    "captured_at": TS,
    "departure_date": T.DateType(),
    "captured_date": T.DateType(),
    "days_before_departure": T.IntegerType(),
    "departure_day_of_week": T.IntegerType(),
    "price": PRICE,
    "min_price": PRICE,
    "max_price": PRICE,
    "p25_price": PRICE,
    "p50_price": PRICE,
    "avg_price": T.DoubleType(),
    "prev_avg_price": T.DoubleType(),
    "avg_price_7d": T.DoubleType(),
}
# What the stored tables hold now; files written before a column was added lack it.
ODS = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in [*ODS_COLUMNS, "captured_date"]])
DWH = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in DWH_COLUMNS])

# Columns the reports read from the mart.
DM_READ_COLUMNS = [
    "route_origin",
    "route_destination",
    "best_days_before_departure",
    "best_search_weekday",
    "best_search_hour",
    "route_avg_price",
    "route_price_stddev",
    "route_price_cv",
    "route_min_price",
    "route_max_price",
]

COLUMN_DOCS = {
    "record_hash": "deterministic hash of the quote, de-duplication key",
    "route_key": "md5 of ORIGIN-DESTINATION",
    "feature_key": "md5 of route_key-departure_date-captured_date",
    "days_before_departure": "departure date minus capture date, days",
    "departure_day_of_week": "0 = Sunday .. 6 = Saturday",
    "avg_price": "mean price per route, departure date and capture date",
    "prev_avg_price": "avg_price of the previous observed capture date",
    "avg_price_7d": "mean of avg_price over the last 7 observed rows",
    "best_days_before_departure": "lead time with the lowest mean price",
    "best_search_weekday": "capture weekday with the lowest mean price",
    "best_search_hour": "capture hour with the lowest mean price",
    "route_price_cv": "stddev / mean of the route price",
}


def with_column_docs(df: DataFrame, docs: dict[str, str] | None = None) -> DataFrame:
    """Attach column descriptions as metadata (persisted by saveAsTable)."""
    docs = docs or COLUMN_DOCS
    cols = []
    for f in df.schema.fields:
        if f.name in docs:
            cols.append(df[f.name].alias(f.name, metadata={"comment": docs[f.name]}))
        else:
            cols.append(df[f.name])
    return df.select(*cols)
