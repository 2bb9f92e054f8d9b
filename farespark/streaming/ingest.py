"""Structured Streaming re-aim of the scheduled loader (I1) and of the daily
feature aggregate (I2).

The reference polls every six hours and reads above a stored maximum; here
a file stream's checkpoint records what was read, ``foreachBatch`` applies
the idempotent partition-scoped upsert, and ``Trigger.AvailableNow`` drains
what has landed and stops (one scheduled run). A failed micro-batch is
re-run from the checkpoint and the upsert gives the same state again.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from farespark.functions.dates import wall_lit
from farespark.functions.keys import route_key
from farespark.operators import materialize as M
from farespark.operators import versions as V
from farespark.operators.ingest import dedupe_latest, normalize
from farespark.params import DEFAULT, Params
from farespark.plans import models
from farespark.schemas import PRICE, RAW, STG_BASE
from farespark.session import scratch_path


class _Totals(StreamingQueryListener):
    """Sums over every micro-batch; a query's own progress list keeps only the last ones."""

    def __init__(self):
        self.batches: dict[str, dict[int, tuple[int, int, int]]] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        again = sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in p.stateOperators)
        rows, dropped, twice = self.batches.setdefault(str(p.runId), {}).get(p.batchId, (0, 0, 0))
        self.batches[str(p.runId)][p.batchId] = (rows + p.numInputRows, dropped + late, twice + again)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.setdefault(str(event.runId), threading.Event()).set()


_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb."
#: The state in RocksDB, in bounded memory, its changes uploaded. Spark's default holds all keys on the
#: heap and copies the map in every micro-batch, so that a drain costs keys times micro-batches.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}changelogCheckpointing.enabled": "true",
    f"{_ROCKSDB}boundedMemoryUsage": "true",
    f"{_ROCKSDB}trackTotalNumberOfRows": "false",
}


@contextlib.contextmanager
def _state_conf(spark: SparkSession):
    """Settings of the state store for a query that starts inside; what the session sets itself stays, and so does what a checkpoint was begun with."""
    given = spark.conf.getAll
    ours = {k: v for k, v in STATE_CONF.items() if k not in given}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def _drain(spark: SparkSession, start) -> tuple[int, int, int, int]:
    """Runs a query to its end: micro-batches, input rows, rows dropped by the watermark, duplicates dropped by the state."""
    totals = _Totals()
    spark.streams.addListener(totals)
    try:
        with _state_conf(spark):
            q = start()
        q.awaitTermination()
        # The listener hears of a query's end after all its progress.
        if not totals.ended.setdefault(str(q.runId), threading.Event()).wait(60):
            raise RuntimeError("the stream ended, but its progress did not arrive")
    finally:
        spark.streams.removeListener(totals)
    of = totals.batches.get(str(q.runId), {})
    rows, late, again = (sum(counts[i] for counts in of.values()) for i in range(3))
    return len(of), rows, late, again


def raw_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """File stream of raw quotes with the explicit RAW schema (never inferred)."""
    r = spark.readStream.schema(RAW)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(landing)


def upsert_newer(spark: SparkSession, batch: DataFrame, path: str, partition_col: str = "captured_date") -> None:
    """Upsert where a stored row is only replaced by a *newer* version
    (``ingested_at``), so the result does not depend on how files are
    grouped into micro-batches or on replays."""
    change = V.upsert if V.exists(spark, path) else M.upsert_partitioned
    change(spark, batch, path, "record_hash", ["price", "ingested_at"], partition_col, only_newer="ingested_at")


#: What makes two deliveries the same version of a quote.
VERSION_KEY = STG_BASE.fieldNames()


def drop_redelivered(rows: DataFrame, keep: str = "7 days") -> DataFrame:
    """Each version of a quote once: deliveries that repeat one seen within ``keep`` are dropped, over all micro-batches.

    The state holds a version's key from its first arrival for ``keep`` (state
    store, ``dropDuplicatesWithinWatermark``). The watermark runs on the
    arrival, the micro-batch's own time, which the offset log keeps for
    replays: a quote that arrives weeks after its capture is not late and is
    never lost, and a repeat that comes after ``keep`` goes on to the upsert,
    which it leaves as it is. Versions differ in any stored column, so a
    correction passes. Null values are equal to each other.
    """
    arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep)
    return arrived.dropDuplicatesWithinWatermark(VERSION_KEY).drop("_arrived")


def keep_late(spark: SparkSession, batch: DataFrame, stg_path: str, late_path: str, epoch_id: int) -> None:
    """Writes the rows of a micro-batch that a loader with a strict watermark would
    lose: not above the newest capture that STG holds, and of a key it lacks.

    Called before the upsert, which makes them no longer late. So the folder of
    a micro-batch that is complete is not written again when the batch is
    replayed; one that is not complete is, as its upsert has not begun.
    """
    folder = f"{late_path}/epoch={epoch_id}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return
    store = V if V.exists(spark, stg_path) else M
    if store is M:
        M.finish_swap(spark, stg_path, "captured_date")
    newest = store.max_value(spark, stg_path, "captured_at", "captured_date")
    cols = STG_BASE.fieldNames()
    late = batch.select(*cols).filter(F.col("captured_at") <= wall_lit(newest) if newest is not None else F.lit(False))
    stored = V.read(spark, stg_path) if store is V else M.read_table(spark, stg_path)
    if stored is not None:
        # a key holds its capture day, so only the days that late rows are of are looked at
        days = [r[0] for r in late.select(F.to_date("captured_at")).distinct().collect()]
        stored = stored.filter(F.col("captured_date").isin(days))
        late = late.join(stored.select("record_hash"), "record_hash", "left_anti").select(*cols)
    M.overwrite(late, folder)


def read_late(spark: SparkSession, late_path: str) -> DataFrame:
    """All late rows that the stream has kept, with the micro-batch they came in."""
    return spark.read.schema(T.StructType([*STG_BASE.fields, T.StructField("epoch", T.LongType())])).parquet(late_path)


def stream_ingest(
    spark: SparkSession,
    landing: str,
    stg_path: str,
    checkpoint: str,
    run_ts: dt.datetime,
    params: Params = DEFAULT,
    max_files: int | None = None,
    keep: str = "7 days",
    late_path: str | None = None,
) -> dict:
    """Landing files -> normalize -> repeats dropped by state -> per-micro-batch de-dup + upsert into STG.

    ``duplicates`` counts the repeats that the state dropped. With ``late_path``
    the late rows of each micro-batch (I3) are kept there as well, see :func:`keep_late`.
    """
    rows = drop_redelivered(normalize(raw_stream(spark, landing, max_files), run_ts, params), keep)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if late_path:
            # held, as a second action on the micro-batch would run its state again
            held = scratch_path(spark, "micro-batch")
            M.overwrite(batch, held)
            batch = spark.read.schema(batch.schema).parquet(held)
            keep_late(spark, batch, stg_path, late_path, epoch_id)
        b = dedupe_latest(batch).select(*STG_BASE.fieldNames()).withColumn("captured_date", F.to_date("captured_at"))
        upsert_newer(spark, b, stg_path)

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    batches, n, _, twice = _drain(spark, writer.start)
    return {"batches": batches, "rows": n, "duplicates": twice}


def stream_versions(
    spark: SparkSession,
    landing: str,
    out_path: str,
    checkpoint: str,
    run_ts: dt.datetime,
    params: Params = DEFAULT,
    max_files: int | None = None,
    keep: str = "7 days",
) -> dict:
    """Every version of every quote once, appended to ``out_path`` (no upsert): the history of corrections."""
    rows = drop_redelivered(normalize(raw_stream(spark, landing, max_files), run_ts, params), keep)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    batches, n, _, twice = _drain(spark, writer.start)
    return {"batches": batches, "rows": n, "duplicates": twice}


def stream_daily(
    spark: SparkSession,
    landing: str,
    out_path: str,
    checkpoint: str,
    run_ts: dt.datetime,
    params: Params = DEFAULT,
    delay: str = "1 day",
    max_files: int | None = None,
) -> dict:
    """Per route and capture day, count / mean / min / max of ODS-grade
    quotes within the DWH horizon; tumbling 1-day event-time windows with a
    watermark, append mode: a day is written once, when it is closed.

    Percentiles are left out on purpose: their state keeps every value.
    ``withWatermark`` rejects TIMESTAMP_NTZ, so the event time is cast to
    TIMESTAMP (session zone UTC keeps the wall clock).
    """
    rows = normalize(raw_stream(spark, landing, max_files), run_ts, params)
    ods = models.ods(models.stg(rows), params).filter(F.col("days_before_departure").between(0, params.horizon_days))
    ev = ods.withColumn("event_ts", F.col("captured_at").cast("timestamp")).withWatermark("event_ts", delay)
    agg = ev.groupBy(F.window("event_ts", "1 day"), "route_origin", "route_destination").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("sum_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )
    out = agg.select(
        route_key("route_origin", "route_destination").alias("route_key"),
        "route_origin",
        "route_destination",
        F.to_date(F.col("window.start").cast("timestamp_ntz")).alias("captured_date"),
        "n",
        (F.col("sum_price").cast("double") / F.col("n")).alias("avg_price"),
        F.col("min_price").cast(PRICE).alias("min_price"),
        F.col("max_price").cast(PRICE).alias("max_price"),
    )
    writer = (
        out.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    batches, _, dropped, _ = _drain(spark, writer.start)
    return {"batches": batches, "rows_dropped_by_watermark": dropped}
