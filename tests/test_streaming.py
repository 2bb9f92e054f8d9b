"""Streaming: restart from the checkpoint, late rows behind the watermark."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farespark.operators import materialize as M
from farespark.operators.ingest import normalize
from farespark.plans import flows
from farespark.schemas import RAW, STG_BASE
from farespark.session import scratch_path
from farespark.sources.fixtures import fx1_raw
from farespark.streaming import ingest as S
from tests.conftest import SF_SMALL


def test_restart_from_checkpoint_drops_late_rows(spark):
    raw = fx1_raw(spark, SF_SMALL).select(*RAW.fieldNames())
    recent = raw.filter(F.col("captured_at") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    old = raw.filter(F.col("captured_at") < F.lit("2024-01-05").cast("timestamp_ntz"))
    landing, out, ckpt = (scratch_path(spark, n) for n in ("land", "daily", "ckpt"))

    recent.write.parquet(landing)
    first = S.stream_daily(spark, landing, out, ckpt, flows.RUN_TS)
    days_before = {r.captured_date for r in spark.read.parquet(out).select("captured_date").distinct().collect()}

    old.write.mode("append").parquet(landing)  # arrives after the watermark passed those days
    second = S.stream_daily(spark, landing, out, ckpt, flows.RUN_TS)
    days_after = {r.captured_date for r in spark.read.parquet(out).select("captured_date").distinct().collect()}

    assert first["rows_dropped_by_watermark"] == 0
    assert second["rows_dropped_by_watermark"] > 0
    assert days_after == days_before  # late days are not re-opened
    assert min(days_before).isoformat() >= "2024-01-10"


def test_stream_ingest_is_idempotent_on_restart(spark):
    raw = fx1_raw(spark, SF_SMALL).select(*RAW.fieldNames())
    landing, stg, ckpt = (scratch_path(spark, n) for n in ("land2", "stg2", "ckpt2"))
    raw.write.parquet(landing)
    S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS)
    once = sorted(tuple(r) for r in spark.read.parquet(stg).collect())
    info = S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS)  # nothing new since the checkpoint
    assert info["rows"] == 0
    assert sorted(tuple(r) for r in spark.read.parquet(stg).collect()) == once


def test_redelivered_rows_never_reach_the_upsert(spark, monkeypatch):
    """Over micro-batches and a restart; corrections and late captures pass."""
    raw = fx1_raw(spark, SF_SMALL).select(*RAW.fieldNames())
    landing, stg, ckpt = (scratch_path(spark, n) for n in ("land3", "stg3", "ckpt3"))
    seen = []
    upsert = S.upsert_newer

    def counted(sp, batch, path):
        # Written once, as a second action on the micro-batch would run its state again.
        held = scratch_path(spark, "micro-batch")
        batch.write.parquet(held)
        batch = spark.read.schema(batch.schema).parquet(held)
        seen.append(batch.count())
        upsert(sp, batch, path)

    monkeypatch.setattr(S, "upsert_newer", counted)
    raw.repartition(3).write.parquet(landing)
    n = raw.count()
    first = S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, max_files=1)
    loaded = spark.read.parquet(stg).count()
    assert first["rows"] == n and sum(seen) == loaded == n - first["duplicates"]
    raw.repartition(2).write.mode("append").parquet(landing)  # everything once more, in other files
    second = S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, max_files=1)
    assert second["rows"] == n and second["duplicates"] == n and sum(seen) == loaded
    old = raw.orderBy("captured_at").limit(5)
    old.withColumn("price", F.col("price") + 1).withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).write.mode("append").parquet(landing)
    third = S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS)
    assert third["duplicates"] == 0 and sum(seen) == loaded + 5
    assert spark.read.parquet(stg).count() == loaded


def test_late_rows_are_kept_once_over_a_crash(spark, monkeypatch):
    """Died in the upsert, or while the late rows were written: the replay keeps the same rows."""
    raw = fx1_raw(spark, SF_SMALL).select(*RAW.fieldNames())
    cut = F.col("captured_at") < F.lit("2024-01-20").cast("timestamp_ntz")
    held_back = F.crc32(F.concat_ws("|", "captured_at", "route_origin")) % 20 == 0
    first, second = raw.where(cut & ~held_back), raw.where(~cut | held_back)
    stg, ckpt, landing, late = (scratch_path(spark, n) for n in ("stg4", "ckpt4", "land4", "late4"))
    first.write.parquet(landing)
    S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, late_path=late)
    assert S.read_late(spark, late).isEmpty()  # nothing was stored before it
    before = spark.read.parquet(stg)
    newest = before.agg(F.max("captured_at")).first()[0]
    want = normalize(second, flows.RUN_TS).where(F.col("captured_at") <= F.lit(newest)).join(before.select("record_hash"), "record_hash", "left_anti").distinct()
    want = sorted(tuple(r) for r in want.select(*STG_BASE.fieldNames()).collect())
    assert want
    second.write.mode("append").parquet(landing)
    for broken in ("write", "upsert", "after"):
        with monkeypatch.context() as m:
            if broken == "write":
                m.setattr(M, "max_value", lambda *a: 1 / 0)
            elif broken == "upsert":
                m.setattr(S, "upsert_newer", lambda *a: 1 / 0)
            else:
                upsert = S.upsert_newer
                m.setattr(S, "upsert_newer", lambda *a: (upsert(*a), 1 / 0))
            with pytest.raises(Exception, match="division by zero"):
                S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, late_path=late)
    S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, late_path=late)
    got = S.read_late(spark, late)
    assert sorted(tuple(r) for r in got.select(*STG_BASE.fieldNames()).collect()) == want
    assert got.select("epoch").distinct().count() == 1
    assert spark.read.parquet(stg).select("record_hash").distinct().count() == spark.read.parquet(stg).count()


def test_state_is_on_disk_and_the_session_keeps_its_settings(spark):
    """The keys of the stream are in RocksDB, not in maps that each micro-batch copies; what a session sets itself stays."""
    raw = fx1_raw(spark, SF_SMALL).select(*RAW.fieldNames())
    landing, out, ckpt = (scratch_path(spark, n) for n in ("land5", "versions5", "ckpt5"))
    raw.repartition(2).write.parquet(landing)
    before = spark.conf.getAll
    info = S.stream_versions(spark, landing, out, ckpt, flows.RUN_TS, max_files=1)
    assert spark.conf.getAll == before
    assert info["rows"] == raw.count() == spark.read.parquet(out).count() + info["duplicates"]
    kinds = {p.suffix for p in Path(ckpt.removeprefix("file:")).glob("state/**/*") if p.is_file()}
    assert kinds & {".changelog", ".zip"} and ".delta" not in kinds
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", HDFS := "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        S.stream_versions(spark, landing, scratch_path(spark, "versions6"), ckpt := scratch_path(spark, "ckpt6"), flows.RUN_TS)
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == HDFS
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert ".delta" in {p.suffix for p in Path(ckpt.removeprefix("file:")).glob("state/**/*")}
