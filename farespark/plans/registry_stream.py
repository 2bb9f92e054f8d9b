"""Registered streaming queries (2.I): drained results read back."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from farespark.params import DEFAULT
from farespark.plans import duckdb_sql as D
from farespark.plans import flows
from farespark.plans.registry_io import SCEN, UPSERT_SQL
from farespark.schemas import RAW, STG_BASE
from farespark.session import scratch_path
from farespark.sources import variants as V
from farespark.sources.fixtures import fx1_raw
from farespark.streaming import ingest as S

Q = {}
P = DEFAULT
RAW_COLS = RAW.fieldNames()
_STATE: dict = {}
_LOCK = threading.Lock()


def register(name: str, sql: str | None, columns: list[str] | None = None):
    def deco(fn):
        Q[name] = (fn, D.portable(sql, columns) if (sql and columns) else sql)
        return fn

    return deco


def _land(spark: SparkSession, parts, name: str) -> str:
    """Write raw slices one after another into a landing folder (the way a
    producer would drop files), in the shared checkpoint folder."""
    landing = scratch_path(spark, name)
    for df in parts:
        df.select(*RAW_COLS).write.mode("append").parquet(landing)
    return landing


@register("stream_ingest", D.query(UPSERT_SQL, "SELECT * FROM merged"), STG_BASE.fieldNames())
def stream_ingest(spark, sf):
    """Batch 1 and batch 2 (late rows, corrections) land as files; the
    drained stream's STG equals the batch upsert's final state."""
    k = (spark.sparkContext.applicationId, sf, "stream_ingest")
    with _LOCK:
        if k not in _STATE:
            landing = _land(spark, [V.batch1(spark, sf), V.batch2(spark, sf)], "landing")
            stg = scratch_path(spark, "stream-stg")
            S.stream_ingest(spark, landing, stg, scratch_path(spark, "stream-ckpt"), flows.RUN_TS, P, max_files=4)
            _STATE[k] = stg
    return spark.read.parquet(_STATE[k]).select(*STG_BASE.fieldNames())


@register(
    "stream_late_rows",
    D.query(
        SCEN + [("late_cand", "SELECT * FROM b2 WHERE captured_at <= (SELECT wm FROM wm1)")]
        + D.normalized("late_cand", P, name="late_norm") + D.stg_base("b1", P, name="stored"),
        "SELECT * FROM late_norm WHERE record_hash NOT IN (SELECT record_hash FROM stored)",
    ),
    STG_BASE.fieldNames(),
)
def stream_late_rows(spark, sf):
    """I3 in the stream: batch 1 is drained, then batch 2; the late rows kept
    beside STG are those that a strict watermark never loads."""
    k = (spark.sparkContext.applicationId, sf, "stream_late_rows")
    with _LOCK:
        if k not in _STATE:
            landing, stg, ckpt, late = (scratch_path(spark, n) for n in ("landing-late", "stg-late", "ckpt-late", "late"))
            for b in (V.batch1(spark, sf), V.batch2(spark, sf)):
                b.select(*RAW_COLS).write.mode("append").parquet(landing)
                S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, P, late_path=late)
            _STATE[k] = late
    return S.read_late(spark, _STATE[k]).select(*STG_BASE.fieldNames())


VERSIONS_SQL = D.query(
    SCEN + D.normalized("b1", P, name="v1") + D.normalized("b2", P, name="v2")
    + [("versions", "SELECT * FROM v1 UNION SELECT * FROM v2")],
    "SELECT * FROM versions",
)


@register("stream_versions", VERSIONS_SQL, STG_BASE.fieldNames())
def stream_versions(spark, sf):
    """Batch 1, batch 2 and batch 1 again, over many micro-batches and two
    runs: each version of a quote is appended once."""
    k = (spark.sparkContext.applicationId, sf, "stream_versions")
    with _LOCK:
        if k not in _STATE:
            first, again = V.batch1(spark, sf), V.batch2(spark, sf)
            landing = _land(spark, [first], "landing-versions")
            out, ckpt = scratch_path(spark, "stream-versions"), scratch_path(spark, "stream-versions-ckpt")
            S.stream_versions(spark, landing, out, ckpt, flows.RUN_TS, P, max_files=2)
            for df in (again, first):
                df.select(*RAW_COLS).write.mode("append").parquet(landing)
            S.stream_versions(spark, landing, out, ckpt, flows.RUN_TS, P, max_files=2)
            _STATE[k] = out
    return spark.read.parquet(_STATE[k]).select(*STG_BASE.fieldNames())


DAILY_SQL = D.query(
    D.fx1_ods(P)
    + [
        (
            "daily",
            f"""SELECT {D.route_key_sql('route_origin', 'route_destination')} AS route_key, route_origin, route_destination,
       CAST(captured_at AS DATE) AS captured_date, COUNT(*) AS n,
       CAST(SUM(price) AS DOUBLE) / COUNT(*) AS avg_price, MIN(price) AS min_price, MAX(price) AS max_price
FROM ods WHERE days_before_departure BETWEEN 0 AND {P.horizon_days}
GROUP BY ALL""",
        )
    ],
    "SELECT * FROM daily WHERE CAST(captured_date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(captured_at) FROM ods) - INTERVAL 1 DAY",
)


@register(
    "stream_daily",
    DAILY_SQL,
    ["route_key", "route_origin", "route_destination", "captured_date", "n", "avg_price", "min_price", "max_price"],
)
def stream_daily(spark, sf):
    """Closed 1-day windows of the drained stream (watermark 1 day)."""
    k = (spark.sparkContext.applicationId, sf, "stream_daily")
    with _LOCK:
        if k not in _STATE:
            raw = fx1_raw(spark, sf)
            landing = _land(spark, [raw], "landing-daily")
            out = scratch_path(spark, "stream-daily")
            S.stream_daily(spark, landing, out, scratch_path(spark, "stream-daily-ckpt"), flows.RUN_TS, P)
            _STATE[k] = out
    return spark.read.parquet(_STATE[k])
