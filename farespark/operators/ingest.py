"""Loader operators: raw quotes -> typed, hashed, de-duplicated STG base rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.functions.dates import wall_lit
from farespark.functions.keys import record_hash
from farespark.params import DEFAULT, Params
from farespark.schemas import PRICE, RAW, STG_BASE

EPOCH = dt.datetime(1970, 1, 1)


#: Text of a line that is no document, beside the columns of RAW.
CORRUPT = "corrupt_line"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Raw quotes from files with one JSON document a line (A1), as RAW and ``CORRUPT``.

    Documents have no schema of their own: fields that RAW lacks are left
    out, absent ones are null, and every value is read as text and then
    cast, so a number in quotes or a time with an offset is understood and a
    value that is not costs its field only. A line that is no document costs
    itself only: its other columns are null, the loader skips it and
    :func:`rejected` reports it. Empty lines are nothing.
    """
    fields = [T.StructField(f.name, T.StringType()) for f in RAW.fields]
    as_text = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    document = F.from_json("value", as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # A line such as [] is JSON and no document.
    told = F.coalesce(F.col(f"d.{CORRUPT}"), F.when(~F.col("value").rlike(r"^\s*\{"), F.col("value")))
    rows = spark.read.text(path).where(F.trim("value") != "").select("value", document.alias("d")).withColumn(CORRUPT, told)

    def typed(f: T.StructField) -> Column:
        c = F.when(F.col(CORRUPT).isNull(), F.col(f"d.{f.name}"))
        if isinstance(f.dataType, T.TimestampNTZType):
            c = c.try_cast("timestamp")  # with an offset or in the session's zone, UTC
        return c.cast(f.dataType) if isinstance(f.dataType, (T.TimestampNTZType, T.StringType)) else c.try_cast(f.dataType)

    return rows.select(*[typed(f).alias(f.name) for f in RAW.fields], CORRUPT)


def stamped(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """RAW rows with the time of their arrival where they carry none (A3)."""
    at = F.coalesce(F.col("ingested_at").cast("timestamp_ntz"), wall_lit(run_ts))
    return raw.select(*[at.alias(c) if c == "ingested_at" else F.col(c) for c in RAW.fieldNames()])


def skip_incomplete(raw: DataFrame) -> DataFrame:
    """Drop quotes lacking a departure or capture time (B2)."""
    return raw.dropna(subset=["departure_at", "captured_at"])


def _price_col(params: Params) -> Column:
    p = F.col("price")
    if params.null_price == "zero":
        p = F.coalesce(p, F.lit(0.0))
    return p.try_cast(PRICE)


def normalize(raw: DataFrame, run_ts: dt.datetime, params: Params = DEFAULT) -> DataFrame:
    """Raw quote -> STG base row (B1, B3 for codes, H2, H17).

    Defaults: provider, ticket_class and currency from ``params``; missing
    origin/destination -> ''; missing ingested_at -> the run timestamp
    (a literal, so reruns agree). Codes are upper-cased before hashing.
    Rows with no usable price (null under the quarantine policy, or a value
    that does not fit decimal(12,2)) are dropped here and reported by
    :func:`rejected`.
    """
    origin = F.upper(F.coalesce(F.col("route_origin"), F.lit("")))
    dest = F.upper(F.coalesce(F.col("route_destination"), F.lit("")))
    df = skip_incomplete(raw).select(
        record_hash(origin, dest, "departure_at", "captured_at").alias("record_hash"),
        F.coalesce(F.col("provider"), F.lit(params.default_provider)).alias("provider"),
        origin.alias("route_origin"),
        dest.alias("route_destination"),
        F.col("departure_at").cast("timestamp_ntz").alias("departure_at"),
        F.col("captured_at").cast("timestamp_ntz").alias("captured_at"),
        F.coalesce(F.col("ticket_class"), F.lit(params.default_ticket_class)).alias("ticket_class"),
        F.coalesce(F.col("currency"), F.lit(params.default_currency)).alias("currency"),
        _price_col(params).alias("price"),
        F.coalesce(F.col("ingested_at").cast("timestamp_ntz"), wall_lit(run_ts)).alias(
            "ingested_at"
        ),
    )
    return df.filter(F.col("price").isNotNull())


def reject_reason(raw: DataFrame, params: Params = DEFAULT) -> Column:
    """Why the loader does not load a quote; null if it does."""
    price = _price_col(params)
    return (
        F.when(F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False), "not a document")
        .when(F.col("departure_at").isNull(), "missing departure_at")
        .when(F.col("captured_at").isNull(), "missing captured_at")
        .when(F.col("price").isNull(), "null price")
        .when(price.isNull(), "price out of range")
    )


def rejected(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Quotes the loader does not load, with a reason (quarantine view)."""
    return raw.withColumn("reject_reason", reject_reason(raw, params)).filter(F.col("reject_reason").isNotNull())


def dedupe_latest(df: DataFrame, key: str = "record_hash", order: tuple[str, ...] = ("ingested_at", "price")) -> DataFrame:
    """One row per key: the latest ``ingested_at`` wins, ties by price, then
    by the remaining columns (a total order, so reruns agree).

    Written as ``max(struct(...))`` per key: an aggregate with a map-side
    partial merge, so a hot key is collapsed before the shuffle instead of
    being sorted whole inside one window partition.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in (*order, *rest)])
    return df.groupBy(key).agg(F.max(packed).alias("_w")).select(key, *[F.col(f"_w.{c}").alias(c) for c in df.columns if c != key]).select(*df.columns)


def to_stg_base(raw: DataFrame, run_ts: dt.datetime, params: Params = DEFAULT) -> DataFrame:
    """normalize -> de-duplicate: the rows an upsert of this batch applies."""
    # The hash goes through the shuffle as its 32 bytes instead of their text.
    rows = normalize(raw, run_ts, params).withColumn("record_hash", F.unhex("record_hash"))
    return dedupe_latest(rows).withColumn("record_hash", F.lower(F.hex("record_hash"))).select(*STG_BASE.fieldNames())


def above_watermark(df: DataFrame, column: str, watermark) -> DataFrame:
    """Strict ``column > watermark`` (B8); NULL watermark means epoch."""
    wm = watermark if watermark is not None else EPOCH
    return df.filter(F.col(column) > wall_lit(wm).cast(df.schema[column].dataType))


def upsert_rows(target: DataFrame, batch: DataFrame, key: str, update_cols: list[str]) -> DataFrame:
    """Keyed upsert as a relation.

    New keys are inserted; for existing keys only ``update_cols`` take the
    batch value, every other column keeps the stored one. ``batch`` must be
    unique on ``key`` (see :func:`dedupe_latest`). One full-outer join on the
    key: both sides are shuffled on ``key`` once; callers restrict ``target``
    to the partitions the batch can touch before calling this.
    """
    t = target.alias("t")
    b = batch.alias("b")
    j = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    in_target = F.col(f"t.{key}").isNotNull()
    in_batch = F.col(f"b.{key}").isNotNull()
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"b.{c}")).alias(c))
        elif c in update_cols:
            cols.append(F.when(in_batch, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
    return j.select(*cols)


def delete_insert_rows(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Delete target rows whose key is in ``new``, then insert ``new``."""
    kept = target.join(new.select(key), on=key, how="left_anti")
    return kept.unionByName(new)


def json_price(payload: str | Column) -> Column:
    """Price out of an API payload (A2).

    ``data`` is a list (first element used) or an object; the first
    non-null of price, value, min_price wins. Unparsable text, an empty
    list or no candidate gives NULL, so only that row drops out.
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    # Candidate field order price, value, min_price.
    candidates = ("price", "value", "min_price")
    from_list = [F.get_json_object(p, f"$.data[0].{c}") for c in candidates]
    from_obj = [F.get_json_object(p, f"$.data.{c}") for c in candidates]
    is_list = F.get_json_object(p, "$.data[0]").isNotNull()
    chosen = F.when(is_list, F.coalesce(*from_list)).otherwise(F.coalesce(*from_obj))
    return chosen.try_cast("double")


def source_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Primary rows if there are any, else the fallback rows.

    Declarative: the fallback side is anti-joined with a one-row probe of
    the primary, so no driver round trip and no full scan of ``primary``
    for the decision (``limit(1)`` stops early).
    """
    probe = primary.limit(1).select(F.lit(1).alias("_has_primary"))
    fb = fallback.join(F.broadcast(probe), on=F.lit(True), how="left_anti")
    return primary.unionByName(fb)
