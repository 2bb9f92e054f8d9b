"""Versioned tables: equal to plain ones, whole at every step of a change, one write of a touched partition."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from farespark.operators import materialize as M
from farespark.operators import versions as V
from farespark.params import DEFAULT
from farespark.plans import flows, models
from farespark.plans import pipeline as PL
from farespark.schemas import DWH_COLUMNS, RAW
from farespark.session import scratch_path
from farespark.sources import variants
from farespark.streaming import ingest as S
from tests.conftest import SF_SMALL

COLS = RAW.fieldNames()
VERSIONED = DEFAULT.with_(versioned_tables=True)
T = "day date, k string, x int"


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def frame(spark, *data, schema=T):
    return spark.createDataFrame([(d, *rest) for d, *rest in data], schema.replace("day date", "day string")).withColumn("day", F.col("day").cast("date"))


def table(spark, *data):
    path = scratch_path(spark, "versions")
    V.append(spark, frame(spark, *data), path, "day")
    return path


def files(path):
    return set(glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True))


START = [("2024-01-01", "a", 1), ("2024-01-02", "b", 2), ("2024-01-03", "c", 3)]


def upsert(spark, path, *data, **more):
    return V.upsert(spark, frame(spark, *data), path, "k", ["x"], "day", **more)


def test_upsert_writes_touched_partitions_once_and_leaves_files_alone(spark):
    path = table(spark, *START)
    before = files(path)
    assert upsert(spark, path, ("2024-01-02", "b", 20), ("2024-01-02", "d", 4), ("2024-01-04", "e", 5)) == 3
    new = files(path) - before
    assert before < files(path) and {f.split("day=")[1].split("/")[0] for f in new} == {"2024-01-02", "2024-01-04"}
    assert rows(V.read(spark, path)) == rows(
        frame(spark, START[0], ("2024-01-02", "b", 20), ("2024-01-02", "d", 4), START[2], ("2024-01-04", "e", 5))
    )
    assert rows(V.read(spark, path, number=1)) == rows(frame(spark, *START))


def test_readers_keep_the_version_they_opened(spark):
    path = table(spark, *START)
    opened = V.read(spark, path)
    upsert(spark, path, ("2024-01-01", "a", 10))
    assert rows(opened) == rows(frame(spark, *START))


def test_empty_batches_publish_nothing(spark):
    path = table(spark, *START)
    assert upsert(spark, path) == 0 and V.numbers(spark, path) == [1]
    V.append(spark, frame(spark), path, "day")
    assert V.numbers(spark, path) == [1]
    fresh = scratch_path(spark, "none")
    assert upsert(spark, fresh) == 0 and V.version(spark, fresh) is None and V.read(spark, fresh) is None
    assert V.max_value(spark, fresh, "day", "day") is None and V.vacuum(spark, fresh) == []


def test_null_days_older_versions_and_new_columns(spark):
    path = table(spark, *START, (None, "n", 0))
    wide = frame(spark, ("2024-01-03", "c", 2**40, "new"), (None, "n", 9, "new"), schema="day date, k string, x long, note string")
    with pytest.raises(Exception, match="OVERFLOW"):  # the stored type wins; nothing is published
        V.upsert(spark, wide, path, "k", ["x", "note"], "day")
    assert V.numbers(spark, path) == [1]
    V.upsert(spark, wide.withColumn("x", F.lit(7)), path, "k", ["x", "note"], "day")
    assert rows(V.read(spark, path)) == sorted(
        [("2024-01-01", "a", "1", "None"), ("2024-01-02", "b", "2", "None"), ("2024-01-03", "c", "7", "new"), ("None", "n", "7", "new")]
    )
    assert str(V.max_value(spark, path, "day", "day")) == "2024-01-03"


def test_wider_columns_widen_without_a_rewrite(spark):
    path = scratch_path(spark, "widen")
    old = "day date, k string, i int, s short, d decimal(6,2), f float, t string"
    new = "day date, k string, i long, s int, d decimal(12,4), f double, t long"
    V.append(spark, frame(spark, ("2024-01-01", "a", 1, 2, None, 0.5, "x"), ("2024-01-02", "b", 3, 4, None, 0.25, "y"), schema=old).withColumn("d", F.lit("12.34").cast("decimal(6,2)")), path, "day")
    before = files(path)
    batch = frame(spark, ("2024-01-02", "b", 2**40, 70000, None, 1e300, 7), schema=new).withColumn("d", F.lit("12345678.9876").cast("decimal(12,4)"))
    V.upsert(spark, batch, path, "k", ["i", "s", "d", "f", "t"], "day", widen=True)
    df = V.read(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["date", "string", "bigint", "int", "decimal(12,4)", "double", "string"]
    assert rows(df) == [
        ("2024-01-01", "a", "1", "2", "12.3400", "0.5", "x"), ("2024-01-02", "b", str(2**40), "70000", "12345678.9876", "1e+300", "7")
    ]
    assert not any("day=2024-01-01" in f for f in files(path) - before)
    assert V.version(spark, path, 1).schema["i"].dataType.simpleString() == "int"  # the log of types
    V.append(spark, frame(spark, ("2024-01-03", "c", 5, 6, None, 0.5, "z"), schema=old), path, "day", widen=True)  # narrow rows narrow nothing
    assert V.read(spark, path).schema == df.schema and V.read(spark, path).count() == 3


def test_pipeline_passes_a_change_of_type(spark):
    b1, b2 = (b(spark, SF_SMALL).select(*COLS) for b in (variants.batch1, variants.batch2))
    params, got = VERSIONED.with_(widen_types=True), []
    for narrow in (False, True):
        layout = PL.Layout(scratch_path(spark, "pipeline-widen"))
        PL.run_batch(spark, b1, layout, flows.RUN_TS, params)
        if narrow:  # as an older model has left it
            for path, types in ((layout.ods, {"days_before_departure": "short", "price": "decimal(9,2)"}), (layout.stg, {"price": "decimal(9,2)"})):
                held = V.read(spark, path).withColumns({c: F.col(c).cast(t) for c, t in types.items()}).checkpoint()
                M.create_partitioned(held, path, "captured_date")
        PL.run_batch(spark, b2, layout, flows.RUN_TS, params)
        got.append([rows(r(spark, layout)) for r in (PL.read_stg_base, PL.read_ods, PL.read_dwh, PL.read_dm)])
    assert got[0] == got[1]
    assert dict(PL.read_ods(spark, layout).dtypes)["days_before_departure"] == "int"
    assert {dict(r(spark, layout).dtypes)["price"] for r in (PL.read_stg_base, PL.read_ods)} == {"decimal(12,2)"}


def test_only_newer_versions_replace(spark):
    path = table(spark, ("2024-01-01", "a", 5), ("2024-01-01", "b", 5))
    upsert(spark, path, ("2024-01-01", "a", 4), ("2024-01-01", "b", 6), only_newer="x")
    assert rows(V.read(spark, path)) == [("2024-01-01", "a", "5"), ("2024-01-01", "b", "6")]


def test_delete_insert_reads_and_writes_reopened_days_only(spark):
    path = table(spark, *START)
    before = files(path)
    V.delete_insert(spark, frame(spark, ("2024-01-03", "c", 30), ("2024-01-04", "d", 4)), path, "k", "day", "2024-01-03")
    assert rows(V.read(spark, path)) == rows(frame(spark, *START[:2], ("2024-01-03", "c", 30), ("2024-01-04", "d", 4)))
    assert all("day=2024-01-03" in f or "day=2024-01-04" in f for f in files(path) - before)


@pytest.mark.parametrize("step", ["write", "list", "draft", "rename"])
def test_a_crash_at_any_step_leaves_the_old_version_and_a_rerun_ends_right(spark, monkeypatch, step):
    path = table(spark, *START)
    change = [("2024-01-01", "a", 10), ("2024-01-02", "b", 20)]

    def die(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "write":  # some of the files are there
            whole = M.write
            m.setattr(M, "write", lambda df, p, *a, **k: (whole(df.limit(1), p, *a, **k), die()) if V.DATA in p else whole(df, p, *a, **k))
        elif step == "list":
            names = V._names
            m.setattr(V, "_names", lambda s, p: die() if V.COMMIT in p else names(s, p))
        else:  # before the draft of the version is written, or between that and its rename
            m.setattr(V, "_publish" if step == "draft" else "_rename_new", die)
        with pytest.raises(RuntimeError, match="lost"):
            upsert(spark, path, *change)
    assert rows(V.read(spark, path)) == rows(frame(spark, *START))
    upsert(spark, path, *change)
    assert rows(V.read(spark, path)) == rows(frame(spark, *change, START[2]))
    V.vacuum(spark, path, keep=1)
    assert rows(V.read(spark, path)) == rows(frame(spark, *change, START[2]))
    live = {c for commits in V.version(spark, path).partitions.values() for c in commits}
    assert set(V._names(spark, f"{path}/{V.DATA}")) == live


def test_a_first_commit_that_dies_is_no_table(spark, monkeypatch):
    path = scratch_path(spark, "first")
    with monkeypatch.context() as m:
        m.setattr(V, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            V.append(spark, frame(spark, *START), path, "day")
    assert files(path) and V.read(spark, path) is None
    assert V.read_synced(spark, path, frame(spark).schema) is None
    V.append(spark, frame(spark, *START), path, "day")
    assert rows(V.read(spark, path)) == rows(frame(spark, *START))


def test_second_writer_from_the_same_version_gets_a_conflict(spark):
    path = table(spark, *START)
    base = V.version(spark, path)
    V.commit(spark, frame(spark, ("2024-01-05", "f", 6)), path, "day", base)
    with pytest.raises(V.Conflict):
        V.commit(spark, frame(spark, ("2024-01-06", "g", 7)), path, "day", base)
    assert rows(V.read(spark, path)) == rows(frame(spark, *START, ("2024-01-05", "f", 6)))
    assert not [n for n in V._names(spark, f"{path}/{V.VERSIONS}") if n.endswith(".draft")]


def test_plain_folder_is_taken_over(spark):
    path = scratch_path(spark, "plain")
    M.create_partitioned(frame(spark, *START), path, "day")
    assert V.version(spark, path).number == 0 and not V.exists(spark, path)
    before = files(path)
    upsert(spark, path, ("2024-01-02", "b", 20))
    want = rows(frame(spark, START[0], ("2024-01-02", "b", 20), START[2]))
    got = ("day", "k", "x")  # a plain folder has its partition column last
    assert rows(V.read(spark, path).select(*got)) == want and before < files(path)
    assert V.vacuum(spark, path, keep=2) == []
    assert V.vacuum(spark, path, keep=1) == ["day=2024-01-02"]
    assert rows(V.read(spark, path).select(*got)) == want


def test_vacuum_keeps_what_kept_versions_name(spark):
    path = table(spark, *START)
    for x in (10, 11, 12):
        upsert(spark, path, ("2024-01-01", "a", x))
    kept = rows(V.read(spark, path, number=3))
    assert V.vacuum(spark, path, keep=2) and V.numbers(spark, path) == [3, 4]
    assert rows(V.read(spark, path, number=3)) == kept
    assert rows(V.read(spark, path)) == rows(frame(spark, ("2024-01-01", "a", 12), *START[1:]))
    assert len([f for f in files(path) if "day=2024-01-01" in f]) == 2
    assert V.vacuum(spark, path, keep=2) == []
    with pytest.raises(ValueError):
        V.vacuum(spark, path, keep=0)


def test_filter_on_the_partition_column_prunes_folders(spark):
    path = table(spark, *START)
    df = V.read(spark, path).where(F.col("day") == F.lit("2024-01-02").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert rows(df) == rows(frame(spark, START[1]))


def test_pipeline_on_versions_equals_plain_tables(spark):
    b1, b2 = (b(spark, SF_SMALL).select(*COLS) for b in (variants.batch1, variants.batch2))
    got = {}
    for name, params in (("plain", DEFAULT), ("versions", VERSIONED)):
        layout = PL.Layout(scratch_path(spark, name))
        infos = [PL.run_batch(spark, b, layout, flows.RUN_TS, params) for b in (b1, b2, b2.limit(0))]
        got[name] = infos, [rows(r(spark, layout)) for r in (PL.read_stg_base, PL.read_ods, PL.read_dwh, PL.read_dm)]
    assert got["plain"] == got["versions"]
    for path in (layout.stg, layout.ods, layout.dwh):
        assert 1 <= len(V.numbers(spark, path)) <= VERSIONED.keep_versions
    assert got["versions"][1][2] == rows(models.dwh(PL.read_ods(spark, layout)).select(*DWH_COLUMNS))


def test_stream_upserts_into_a_versioned_table(spark):
    landing, stg, ckpt = (scratch_path(spark, n) for n in ("land-v", "stg-v", "ckpt-v"))
    raw = variants.batch1(spark, SF_SMALL).select(*COLS)
    layout_rows = PL._with_cap_date(PL.to_stg_base(raw.limit(20), flows.RUN_TS))
    V.append(spark, layout_rows, stg, "captured_date")
    raw.repartition(3).write.parquet(landing)
    S.stream_ingest(spark, landing, stg, ckpt, flows.RUN_TS, max_files=2)
    want = PL.to_stg_base(raw, flows.RUN_TS)
    assert rows(V.read(spark, stg).drop("captured_date")) == rows(want) and not V._plain_parts(spark, stg)
