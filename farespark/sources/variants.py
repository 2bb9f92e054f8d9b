"""FX1 variants (FIXTURES.md section 2): batches, corrections, late and dirty rows.

All are narrow transformations of the events-derived quotes, so they scale
with the input and never leave the executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.functions.dates import wall_lit
from farespark.schemas import RAW
from farespark.sources.fixtures import fx1_raw

# Fixed scenario values: batch cut 2024-01-20 12:00 (mid-day, so the last
# day of batch 1 must be re-opened); corrections on event_id % 97 = 0
# (price x 1.1, ingested one day later); late rows event_id % 101 = 0;
# dirty rows: null departure % 113, currency XXX % 127, doubled % 131.
CUT = dt.datetime(2024, 1, 20, 12, 0, 0)
CUT_SQL = "TIMESTAMP '2024-01-20 12:00:00'"
CORRECTION_MOD, LATE_MOD = 97, 101
NULL_DEP_MOD, BAD_CCY_MOD, DOUBLE_MOD = 113, 127, 131


def _raw(df: DataFrame) -> DataFrame:
    return df.select(*RAW.fieldNames())


def fx1_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx1_raw(spark, sf_dir, keep_event_id=True)


def is_late(df: DataFrame):
    return (F.col("event_id") % LATE_MOD == 0) & (F.col("captured_at") < wall_lit(CUT))


def batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures before the cut, minus the rows held back as late."""
    e = fx1_events(spark, sf_dir)
    return e.filter((F.col("captured_at") < wall_lit(CUT)) & ~is_late(e))


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-quotes of batch-1 rows: price x 1.1 (decimal arithmetic), one day later."""
    b1 = batch1(spark, sf_dir)
    fixed = F.round(F.col("price").cast("decimal(12,2)") * F.lit(1.1).cast("decimal(2,1)"), 2)
    return b1.filter(F.col("event_id") % CORRECTION_MOD == 0).withColumns(
        {
            "price": fixed.cast("double"),
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
        }
    )


def batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures from the cut on, plus the late rows and the corrections.

    One scan: every event maps to at most one batch-2 row (a new capture,
    a late one, or the corrected copy of a batch-1 row).
    """
    e = fx1_events(spark, sf_dir)
    new = F.col("captured_at") >= wall_lit(CUT)
    late = is_late(e)
    fix = (F.col("captured_at") < wall_lit(CUT)) & ~late & (F.col("event_id") % CORRECTION_MOD == 0)
    fixed_price = F.round(F.col("price").cast("decimal(12,2)") * F.lit(1.1).cast("decimal(2,1)"), 2).cast("double")
    return e.filter(new | late | fix).withColumns(
        {
            "price": F.when(fix, fixed_price).otherwise(F.col("price")),
            "ingested_at": F.when(fix, F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ingested_at")),
        }
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx1_events(spark, sf_dir)
    d = e.withColumns(
        {
            "departure_at": F.when(F.col("event_id") % NULL_DEP_MOD == 0, F.lit(None)).otherwise(F.col("departure_at")),
            "currency": F.when(F.col("event_id") % BAD_CCY_MOD == 0, F.lit("XXX")).otherwise(F.col("currency")),
        }
    )
    return d.unionByName(d.filter(F.col("event_id") % DOUBLE_MOD == 0))


# DuckDB twins, over the CTE ``raw_all`` (FX1 with event_id).
def sql_batch1(src: str = "raw_all") -> str:
    return f"SELECT * FROM {src} WHERE captured_at < {CUT_SQL} AND NOT (event_id % {LATE_MOD} = 0)"


def sql_late(src: str = "raw_all") -> str:
    return f"SELECT * FROM {src} WHERE captured_at < {CUT_SQL} AND event_id % {LATE_MOD} = 0"


def sql_corrections(src: str = "raw_all") -> str:
    return f"""SELECT * REPLACE (
    CAST(round(CAST(price AS DECIMAL(12,2)) * CAST(1.1 AS DECIMAL(2,1)), 2) AS DOUBLE) AS price,
    ingested_at + INTERVAL 1 DAY AS ingested_at)
FROM ({sql_batch1(src)}) AS b WHERE event_id % {CORRECTION_MOD} = 0"""


def sql_batch2(src: str = "raw_all") -> str:
    return (
        f"SELECT * FROM {src} WHERE captured_at >= {CUT_SQL}\n"
        f"UNION ALL {sql_late(src)}\nUNION ALL {sql_corrections(src)}"
    )


def sql_dirty(src: str = "raw_all") -> str:
    d = f"""SELECT * REPLACE (
    CASE WHEN event_id % {NULL_DEP_MOD} = 0 THEN NULL ELSE departure_at END AS departure_at,
    CASE WHEN event_id % {BAD_CCY_MOD} = 0 THEN 'XXX' ELSE currency END AS currency)
FROM {src}"""
    return f"SELECT * FROM ({d}) AS d UNION ALL SELECT * FROM ({d}) AS d2 WHERE event_id % {DOUBLE_MOD} = 0"


# FX1-gap (fixed values): the capture day 2024-01-15 is dropped, the day
# 2024-01-25 is sent three times (the copies captured 1 and 2 microseconds
# later, so they are distinct quotes that survive de-duplication).
GAP_DROP_DAY = dt.date(2024, 1, 15)
GAP_TRIPLE_DAY = dt.date(2024, 1, 25)


def gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx1_events(spark, sf_dir)
    day = F.to_date("captured_at")
    kept = e.filter(day != wall_lit(GAP_DROP_DAY))
    triple = e.filter(day == wall_lit(GAP_TRIPLE_DAY))

    def shifted(us: int) -> DataFrame:
        return triple.withColumn("captured_at", F.col("captured_at") + F.make_dt_interval(secs=F.lit(us / 1e6)))

    return kept.unionByName(shifted(1)).unionByName(shifted(2))


def sql_gap(src: str = "raw_all") -> str:
    kept = f"SELECT * FROM {src} WHERE CAST(captured_at AS DATE) <> DATE '{GAP_DROP_DAY}'"
    triple = f"FROM {src} WHERE CAST(captured_at AS DATE) = DATE '{GAP_TRIPLE_DAY}'"
    shift = "SELECT * REPLACE (captured_at + INTERVAL {n} MICROSECOND AS captured_at) "
    return f"{kept}\nUNION ALL {shift.format(n=1)}{triple}\nUNION ALL {shift.format(n=2)}{triple}"
