"""Properties: idempotent upsert, incremental == full, ranking uniqueness."""

from __future__ import annotations

from pyspark.sql import functions as F

from farespark.functions.dates import wall_lit
from farespark.operators import materialize as M
from farespark.operators.ingest import delete_insert_rows, to_stg_base
from farespark.params import DEFAULT
from farespark.plans import flows, models
from farespark.plans import pipeline as PL
from farespark.schemas import DWH_COLUMNS, RAW, STG_BASE
from farespark.session import scratch_path
from farespark.sources import variants as V
from tests.conftest import SF_SMALL

COLS = RAW.fieldNames()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_is_idempotent(spark):
    path = scratch_path(spark, "idem")
    batch = to_stg_base(V.batch1(spark, SF_SMALL).select(*COLS), flows.RUN_TS).withColumn(
        "captured_date", F.to_date("captured_at")
    )
    M.upsert_partitioned(spark, batch, path, "record_hash", ["price", "ingested_at"], "captured_date")
    once = rows(spark.read.parquet(path).select(*STG_BASE.fieldNames()))
    M.upsert_partitioned(spark, batch, path, "record_hash", ["price", "ingested_at"], "captured_date")
    twice = rows(spark.read.parquet(path).select(*STG_BASE.fieldNames()))
    assert once == twice and len(once) == batch.count()


def test_upsert_changes_only_price_and_ingested_at(spark):
    path = scratch_path(spark, "upd")
    b1 = to_stg_base(V.batch1(spark, SF_SMALL).select(*COLS), flows.RUN_TS)
    changed = b1.orderBy("record_hash").limit(5).withColumns(
        {"price": F.col("price") + 1, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"), "provider": F.lit("other")}
    )
    for b in (b1, changed):
        M.upsert_partitioned(spark, b.withColumn("captured_date", F.to_date("captured_at")), path, "record_hash",
                             ["price", "ingested_at"], "captured_date")
    out = spark.read.parquet(path)
    assert out.count() == b1.count()
    assert out.filter(F.col("provider") == "other").count() == 0
    keys = [r.record_hash for r in changed.select("record_hash").collect()]
    joined = out.filter(F.col("record_hash").isin(keys)).join(
        b1.select("record_hash", F.col("price").alias("old")), "record_hash"
    )
    assert joined.filter(F.col("price") != F.col("old") + 1).count() == 0


def test_incremental_pipeline_equals_full_run(spark):
    layout = PL.Layout(scratch_path(spark, "inc"))
    b1 = V.batch1(spark, SF_SMALL).select(*COLS)
    b2 = V.batch2(spark, SF_SMALL).select(*COLS)
    PL.run_batch(spark, b1, layout, flows.RUN_TS)
    info = PL.run_batch(spark, b2, layout, flows.RUN_TS)
    wm = info["stg_watermark"]
    full_ods = flows.ods_of(b1.unionByName(b2.filter(F.col("captured_at") > wall_lit(wm))))
    assert rows(PL.read_ods(spark, layout)) == rows(full_ods)
    assert rows(PL.read_dwh(spark, layout)) == rows(models.dwh(full_ods).select(*DWH_COLUMNS))
    assert rows(PL.read_dm(spark, layout)) == rows(models.dm(full_ods))


def test_partition_delete_insert_equals_relational_form(spark):
    path = scratch_path(spark, "di")
    ods1 = flows.ods_of(V.batch1(spark, SF_SMALL).select(*COLS))
    old = models.dwh(ods1)
    M.create_partitioned(old, path, "captured_date")
    since = old.agg(F.max("captured_date")).first()[0]
    ods_all = flows.fx1_ods(spark, SF_SMALL)
    new = models.dwh(ods_all, DEFAULT, since=since)
    M.delete_insert_partitioned(spark, new, path, "feature_key", "captured_date", since)
    fast = rows(spark.read.parquet(path).select(*DWH_COLUMNS))
    assert fast == rows(delete_insert_rows(old, new, "feature_key").select(*DWH_COLUMNS))


def test_rank_one_is_unique_per_route(spark):
    base = models.dm_base(flows.fx1_ods(spark, SF_SMALL))
    ranked = models.rank_segments(models.lead_time_stats(base), "avg_price_for_days_before_departure", ["days_before_departure"])
    firsts = ranked.filter("rn = 1").groupBy("route_key").count()
    assert firsts.filter("count > 1").count() == 0
    assert firsts.count() == base.select("route_key").distinct().count()


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "route_key"


def test_empty_batch_writes_nothing_and_docs_persist(spark):
    layout = PL.Layout(scratch_path(spark, "empty"))
    b1 = V.batch1(spark, SF_SMALL).select(*COLS)
    PL.run_batch(spark, b1, layout, flows.RUN_TS)
    before = rows(PL.read_stg_base(spark, layout))
    info = PL.run_batch(spark, b1.limit(0), layout, flows.RUN_TS)  # D13
    assert rows(PL.read_stg_base(spark, layout)) == before
    assert info["stg_watermark"] is not None
    meta = {f.name: f.metadata for f in spark.read.parquet(layout.dm).schema.fields}
    assert "comment" in meta["best_search_weekday"]  # A13: descriptions stored with the data


def test_create_table_over_partitioned_path(spark):
    from farespark.schemas import STG_BASE as SB

    layout = PL.Layout(scratch_path(spark, "ddl"))
    PL.run_batch(spark, V.batch1(spark, SF_SMALL).select(*COLS), layout, flows.RUN_TS)
    from pyspark.sql import types as T

    schema = T.StructType([*SB.fields, T.StructField("captured_date", T.DateType())])  # StructType.add mutates
    M.create_table(spark, "stg_raw_flight_prices_t", layout.stg, schema, ["captured_date"])
    n = spark.table("stg_raw_flight_prices_t").count()
    assert n == PL.read_stg_base(spark, layout).count() > 0
    cols = {c.name: c.description for c in spark.catalog.listColumns("stg_raw_flight_prices_t")}
    assert cols["record_hash"].startswith("sha256")
    M.create_table(spark, "stg_raw_flight_prices_t", layout.stg, schema, ["captured_date"])  # idempotent


def test_segment_state_merge_equals_full_mart(spark):
    ods = flows.fx1_ods(spark, SF_SMALL)
    parts = [ods.filter(f"hour(captured_at) % 3 = {i}") for i in range(3)]
    state = models.merge_segments(*[models.segment_stats(p) for p in parts])
    assert rows(models.dm_from_segments(state)) == rows(models.dm(ods))


def test_full_and_incremental_mart_agree_in_pipeline(spark):
    out = {}
    for inc in (True, False):
        layout = PL.Layout(scratch_path(spark, f"mart-{inc}"))
        params = DEFAULT.with_(incremental_mart=inc)
        for b in (V.batch1(spark, SF_SMALL), V.batch2(spark, SF_SMALL)):
            PL.run_batch(spark, b.select(*COLS), layout, flows.RUN_TS, params)
        out[inc] = rows(PL.read_dm(spark, layout))
    assert out[True] == out[False] and out[True]


def test_anomaly_checks_since_equal_full_history_rows(spark):
    from farespark.operators import quality as Qy

    ods = flows.fx1_ods(spark, SF_SMALL)
    dwh = models.dwh(ods)
    since = "2024-01-24"
    cases = [
        (Qy.dq_volume(ods, "captured_at"), Qy.dq_volume(ods, "captured_at", since=since)),
        (Qy.dq_event_freshness(ods, "departure_at", "captured_at"), Qy.dq_event_freshness(ods, "departure_at", "captured_at", since=since)),
        (Qy.dq_column_metrics(ods, "captured_at", ["price"]), Qy.dq_column_metrics(ods, "captured_at", ["price"], since=since)),
        (Qy.dq_freshness(dwh, "captured_date"), Qy.dq_freshness(dwh, "captured_date", since=since)),
    ]
    for full, recent in cases:
        want = rows(full.filter(F.col("bucket_date") >= F.lit(since).cast("date")))
        assert rows(recent) == want and want


def test_skew_safe_percentiles_equal_percentile_disc(spark):
    ods = flows.fx2_ods(spark, SF_SMALL)
    a = rows(models.dwh(ods))
    b = rows(models.dwh(ods, DEFAULT.with_(skew_safe_percentiles=True)))
    assert a == b and a
    hot = ods.withColumns(
        {"route_key": F.lit("k"), "route_origin": F.lit("A"), "route_destination": F.lit("B"), "departure_at": F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"),
         "captured_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "days_before_departure": F.lit(1)}
    )
    assert rows(models.dwh(hot)) == rows(models.dwh(hot, DEFAULT.with_(skew_safe_percentiles=True)))


def test_report_since_reads_recent_days_only(spark):
    from farespark.operators import quality as Qy
    from farespark.plans import registry_dq as R

    ods = flows.fx1_ods(spark, SF_SMALL)
    stg = models.stg(flows.fx1_stg_base(spark, SF_SMALL))
    m = {"stg": stg, "ods": ods, "dwh": models.dwh(ods), "dm": models.dm(ods)}
    since = "2024-01-24"
    got = {(r.check_name, r.model, r.column_name): r.failures for r in R.build_report(m, since=since).collect()}
    recent = R.recent_models(m, since)
    assert recent["ods"].count() < ods.count()
    for (check, model, col), n in got.items():
        if check == "not_null":
            assert n == recent[model].filter(F.col(col).isNull()).count()
        if check == "unique":
            assert n == Qy.dq_unique(recent[model], col).count()
    vol = Qy.dq_volume(ods, "captured_at").filter(F.col("bucket_date") >= F.lit(since).cast("date"))
    assert got[("volume_anomalies", "ods", None)] == vol.filter("is_anomaly").count()
