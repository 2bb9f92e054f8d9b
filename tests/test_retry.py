"""Runs that start empty, are interrupted, meet other parameters or older files."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from farespark.operators import materialize as M
from farespark.operators import quality as Qy
from farespark.params import DEFAULT
from farespark.plans import flows, models
from farespark.plans import pipeline as PL
from farespark.schemas import RAW
from farespark.session import scratch_path
from farespark.sources import variants as V
from farespark.sources.fixtures import fx1_raw
from farespark.streaming import ingest as S
from tests.conftest import SF_SMALL, quote, raw_df

COLS = RAW.fieldNames()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batches(spark):
    return [b(spark, SF_SMALL).select(*COLS) for b in (V.batch1, V.batch2)]


def run(spark, name, params=DEFAULT, which=(0, 1)):
    layout, got = PL.Layout(scratch_path(spark, name)), batches(spark)
    for i in which:
        PL.run_batch(spark, got[i], layout, flows.RUN_TS, params)
    return layout


def full_mart(spark, layout, params=DEFAULT):
    return rows(models.dm(PL.read_ods(spark, layout), params))


def test_empty_first_batch_leaves_no_tables_and_the_next_one_loads(spark):
    layout = PL.Layout(scratch_path(spark, "empty-first"))
    first, _ = batches(spark)
    info = PL.run_batch(spark, first.limit(0), layout, flows.RUN_TS)
    assert info == {"stg_watermark": None, "ods_watermark": None, "dwh_since": None, "inserted": None, "transferred": 0}
    assert PL.read_stg_base(spark, layout) is None and PL.read_ods(spark, layout) is None and PL.read_dm(spark, layout) is None
    PL.run_batch(spark, first, layout, flows.RUN_TS)
    assert rows(PL.read_dm(spark, layout)) == full_mart(spark, layout)


def test_version_left_by_a_failed_write_does_not_block(spark):
    layout = run(spark, "left-over", which=(0,))
    # half a state: written, never committed
    spark.range(3).write.parquet(f"{layout.dm_segments}/v=2")
    PL.run_batch(spark, batches(spark)[1], layout, flows.RUN_TS)
    assert rows(PL.read_dm(spark, layout)) == full_mart(spark, layout)


@pytest.mark.parametrize("change", [{"mart_horizon_days": 10}, {"currency": "USD"}])
def test_changed_parameters_rebuild_the_state(spark, change):
    layout = run(spark, "changed")
    params = DEFAULT.with_(**change)
    PL.refresh_dm(spark, layout, params)
    assert rows(PL.read_dm(spark, layout)) == full_mart(spark, layout, params)


def test_stddev_of_large_prices_keeps_its_digits(spark):
    prices = [98765432.00, 98765432.01, 98765432.02] * 2000
    raw = raw_df(spark, [quote(price=p, dep=dt.datetime(2024, 3, 10) + dt.timedelta(seconds=i)) for i, p in enumerate(prices)])
    layout = PL.Layout(scratch_path(spark, "large"))
    PL.run_batch(spark, raw, layout, flows.RUN_TS)
    assert [float(r.route_price_stddev) for r in PL.read_dm(spark, layout).collect()] == [0.01]


def test_interrupted_swap_is_finished(spark):
    layout = run(spark, "swap")
    want = rows(PL.read_dwh(spark, layout))
    day = max(r[0] for r in PL.read_dwh(spark, layout).select("captured_date").distinct().collect())
    # staged whole, then the partition was removed and the run died
    last = spark.read.parquet(layout.dwh).where(F.col("captured_date") == F.lit(day))
    last.write.partitionBy("captured_date").parquet(f"{layout.dwh}/{M.SWAP}/rows")
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{layout.dwh}/captured_date={day}")
    part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(part, True)
    assert rows(PL.read_dwh(spark, layout)) != want
    PL.refresh_dwh(spark, layout)
    assert rows(PL.read_dwh(spark, layout)) == want
    M.finish_swap(spark, layout.dwh, "captured_date")  # nothing left to do


def test_added_and_dropped_columns(spark):
    layout, (first, second) = PL.Layout(scratch_path(spark, "drift")), batches(spark)
    PL.run_batch(spark, first, layout, flows.RUN_TS)
    for path, lost in ((layout.ods, "ticket_class"), (layout.dwh, "p25_price")):
        old = spark.read.parquet(path).drop(lost).withColumn("legacy_note", F.lit("v1")).checkpoint()
        M.create_partitioned(old, path, "captured_date")
    PL.run_batch(spark, second, layout, flows.RUN_TS)
    ods, dwh = PL.read_ods(spark, layout), PL.read_dwh(spark, layout)
    wm = first.agg(F.max("captured_at")).first()[0]
    older = F.col("captured_at") <= F.lit(wm)
    assert ods.where(older & F.col("ticket_class").isNotNull()).count() == 0 < ods.where(older).count()
    assert ods.where(~older & F.col("ticket_class").isNull()).count() == 0 < ods.where(~older).count()
    assert dwh.where("p25_price is not null").count() > 0 and dwh.where("p25_price is null").count() > 0


def test_since_equals_full_history_where_days_are_missing(spark):
    ods = flows.fx1_ods(spark, SF_SMALL).where(F.dayofyear("captured_at") % 3 != 0)
    since = "2024-01-25"
    for check in (
        lambda s: Qy.dq_volume(ods, "captured_at", since=s),
        lambda s: Qy.dq_event_freshness(ods, "departure_at", "captured_at", since=s),
        lambda s: Qy.dq_column_metrics(ods, "captured_at", ["price", "currency"], since=s),
        lambda s: Qy.dq_freshness(ods, "captured_at", since=s),
    ):
        assert rows(check(since)) == rows(check(None).where(F.col("bucket_date") >= F.lit(since).cast("date")))


def test_few_files_a_day(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout = run(spark, "files", which=(0,))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for path in (layout.stg, layout.ods, layout.dwh):
        days = glob.glob(f"{path.removeprefix('file:')}/captured_date=*")
        files = glob.glob(f"{path.removeprefix('file:')}/captured_date=*/*.parquet")
        assert days and len(files) <= 2 * len(days)


def test_stream_counts_cover_more_batches_than_the_progress_list(spark):
    raw = fx1_raw(spark, SF_SMALL).select(*COLS)
    landing, stg, ckpt = (scratch_path(spark, n) for n in ("land3", "stg3", "ckpt3"))
    raw.limit(50).repartition(5).write.parquet(landing)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        info = S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert info["rows"] == 50 and info["batches"] >= 5


def test_upsert_writes_new_days_once(spark, monkeypatch):
    """Days that the table lacks are moved in as staged; a run that dies before all are there leaves none, and its replay all."""
    def day(d, price, n=3):
        return [(f"{d}-{i}", price, dt.datetime(2024, 3, d), dt.date(2024, 3, d)) for i in range(n)]

    def upsert(rows):
        df = spark.createDataFrame(rows, "k string, price double, ingested_at timestamp_ntz, day date")
        return M.upsert_partitioned(spark, df, path, "k", ["price", "ingested_at"], "day")

    path, written = scratch_path(spark, "moved"), []
    write = M.write
    monkeypatch.setattr(M, "write", lambda df, *a, **kw: (written.append(a[0].rsplit("/", 1)[1]), write(df, *a, **kw))[1])
    assert upsert(day(1, 1.0) + day(2, 1.0)) == 6
    written.clear()
    assert upsert(day(3, 2.0) + day(4, 2.0)) == 6 and written == ["batch"]  # neither joined nor written again
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    before = rows(spark.read.parquet(path))
    with monkeypatch.context() as m:
        m.setattr(M, "finish_swap", lambda *a: None if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{M.SWAP}")) else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(day(4, 3.0) + day(5, 3.0))
    assert rows(spark.read.parquet(path)) == before
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{M.SWAP}/rows/_SUCCESS"), False)  # as if it had died a step before
    M.finish_swap(spark, path, "day")
    assert rows(spark.read.parquet(path)) == before
    assert upsert(day(4, 3.0, 1) + day(5, 3.0)) == 4
    got = {(r.k, r.price) for r in spark.read.parquet(path).collect()}
    want = day(1, 1.0) + day(2, 1.0) + day(3, 2.0) + day(4, 3.0, 1) + day(4, 2.0)[1:] + day(5, 3.0)
    assert got == {w[:2] for w in want} and spark.read.parquet(path).count() == len(want)


def test_ods_is_appended_without_a_shuffle(spark, monkeypatch):
    plans, write = [], M.write
    monkeypatch.setattr(M, "write", lambda df, path, *a, **kw: (plans.append((path, a[2] if len(a) > 2 else kw.get("placed", False))), write(df, path, *a, **kw))[1])
    layout = run(spark, "placed")
    ods = [placed for path, placed in plans if path == layout.ods]
    assert ods and all(ods)
    days = [len({p.split("captured_date=")[1].split("/")[0] for p in spark.read.parquet(layout.ods).inputFiles()}), len(spark.read.parquet(layout.ods).inputFiles())]
    assert days[1] <= 3 * days[0]
