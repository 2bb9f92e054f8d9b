"""Registered queries that write and read back tables (2.A, D12, L5, I3)
and the report series over the mart (2.F).

Write scenarios run in a fresh folder below the shared checkpoint folder
(``spark.checkpoint.dir``) and return the table read back, so the result
is the *final state* a user would see; the oracle SQL states that state.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.functions.dates import wall_lit
from farespark.operators import materialize as M
from farespark.operators import versions
from farespark.operators.ingest import delete_insert_rows, source_fallback, to_stg_base
from farespark.operators import report
from farespark.params import DEFAULT
from farespark.plans import duckdb_sql as D
from farespark.plans import flows, models
from farespark.plans import pipeline as PL
from farespark.schemas import DM_COLUMNS, DM_READ_COLUMNS, DWH_COLUMNS, ODS_COLUMNS, RAW, STG_BASE
from farespark.session import scratch_path
from farespark.sources import variants as V
from farespark.sources.fixtures import FX2_RAW_SQL, fx2_raw

Q = {}
P = DEFAULT
RAW_COLS = RAW.fieldNames()
STG_BASE_COLS = STG_BASE.fieldNames()


def register(name: str, sql: str | None, columns: list[str] | None = None):
    def deco(fn):
        Q[name] = (fn, D.portable(sql, columns) if (sql and columns) else sql)
        return fn

    return deco


# ------------------------------------------------------------ scenario SQL

SCEN = D.raw_fx1() + [
    ("b1", f"SELECT * EXCLUDE (event_id) FROM ({V.sql_batch1('raw_all')}) AS x"),
    ("b2", f"SELECT * EXCLUDE (event_id) FROM ({V.sql_batch2('raw_all')}) AS x"),
    ("wm1", "SELECT max(captured_at) AS wm FROM b1"),
    ("b2v", "SELECT * FROM b2 WHERE captured_at > (SELECT wm FROM wm1)"),
    ("b12", "SELECT * FROM b1 UNION ALL SELECT * FROM b2v"),
]
PIPE = SCEN + D.stg_base("b12", P, name="stg_base") + D.stg("stg_base") + D.ods("stg", P)
PIPE_DWH = PIPE + D.dwh("ods", P)
PIPE_DM = PIPE + D.dm("ods", P)

UPSERT_SQL = (
    SCEN
    + D.stg_base("b1", P, name="t")
    + D.stg_base("b2", P, name="b")
    + [
        (
            "merged",
            """SELECT coalesce(t.record_hash, b.record_hash) AS record_hash,
       CASE WHEN t.record_hash IS NOT NULL THEN t.provider ELSE b.provider END AS provider,
       CASE WHEN t.record_hash IS NOT NULL THEN t.route_origin ELSE b.route_origin END AS route_origin,
       CASE WHEN t.record_hash IS NOT NULL THEN t.route_destination ELSE b.route_destination END AS route_destination,
       CASE WHEN t.record_hash IS NOT NULL THEN t.departure_at ELSE b.departure_at END AS departure_at,
       CASE WHEN t.record_hash IS NOT NULL THEN t.captured_at ELSE b.captured_at END AS captured_at,
       CASE WHEN t.record_hash IS NOT NULL THEN t.ticket_class ELSE b.ticket_class END AS ticket_class,
       CASE WHEN t.record_hash IS NOT NULL THEN t.currency ELSE b.currency END AS currency,
       CASE WHEN b.record_hash IS NOT NULL THEN b.price ELSE t.price END AS price,
       CASE WHEN b.record_hash IS NOT NULL THEN b.ingested_at ELSE t.ingested_at END AS ingested_at
FROM t FULL OUTER JOIN b ON t.record_hash = b.record_hash""",
        )
    ]
)


# ------------------------------------------------------------ scenario runs

_STATE: dict = {}
_LOCK = threading.Lock()


def _key(spark: SparkSession, sf: str, what: str):
    return (spark.sparkContext.applicationId, sf, what)


def pipeline_state(spark: SparkSession, sf: str) -> dict:
    """Run the two-batch pipeline once per (application, scale) and keep the
    table locations; every query below reads the persisted tables."""
    k = _key(spark, sf, "pipeline")
    with _LOCK:
        if k not in _STATE:
            layout = PL.Layout(scratch_path(spark, "pipeline"))
            b1 = V.batch1(spark, sf).select(*RAW_COLS)
            b2 = V.batch2(spark, sf).select(*RAW_COLS)
            info1 = PL.run_batch(spark, b1, layout, flows.RUN_TS, P, batch="b1")
            info2 = PL.run_batch(spark, b2, layout, flows.RUN_TS, P, batch="b2")
            _STATE[k] = {"layout": layout, "batch1": info1, "batch2": info2}
        return _STATE[k]


@register("pipeline_incremental", D.query(PIPE_DWH, "SELECT * FROM dwh"), DWH_COLUMNS)
def pipeline_incremental(spark, sf):
    """Two batches through EL -> ODS -> DWH (delete+insert) -> DM; the
    DWH read back equals one full run over the rows the watermark admits."""
    return PL.read_dwh(spark, pipeline_state(spark, sf)["layout"])


@register(
    "raw_layer",
    D.query(
        SCEN,
        f"SELECT * REPLACE (coalesce(ingested_at, {D.RUN_TS}) AS ingested_at), 'b1' AS batch FROM b1 "
        f"UNION ALL BY NAME SELECT * REPLACE (coalesce(ingested_at, {D.RUN_TS}) AS ingested_at), 'b2' AS batch FROM b2",
    ),
    [*RAW_COLS, "batch"],
)
def raw_layer(spark, sf):
    """A3: both batches as the pipeline stored them, stamped; the first one is stored twice, as by a repeated run."""
    layout = pipeline_state(spark, sf)["layout"]
    PL.store_raw(spark, V.batch1(spark, sf).select(*RAW_COLS), layout, "b1", flows.RUN_TS)
    return PL.read_raw(spark, layout).select(*RAW_COLS, "batch")


@register("ods_append", D.query(PIPE, "SELECT * FROM ods"), ODS_COLUMNS)
def ods_append(spark, sf):
    return PL.read_ods(spark, pipeline_state(spark, sf)["layout"])


@register("dm_full_refresh", D.query(PIPE_DM, "SELECT * FROM dm"), DM_COLUMNS)
def dm_full_refresh(spark, sf):
    return PL.read_dm(spark, pipeline_state(spark, sf)["layout"])


@register("dm_read", D.query(PIPE_DM, f"SELECT {', '.join(DM_READ_COLUMNS)} FROM dm"), DM_READ_COLUMNS)
def dm_read(spark, sf):
    """Read the mart's report columns, first existing location wins."""
    layout = pipeline_state(spark, sf)["layout"]
    df = M.read_first(spark, [f"{layout.root}/dm/dm_route_purchase_recommendations", layout.dm])
    return df.select(*DM_READ_COLUMNS)


@register(
    "late_rows",
    D.query(
        PIPE
        + [("late_cand", "SELECT * FROM b2 WHERE captured_at <= (SELECT wm FROM wm1)")]
        + D.normalized("late_cand", P, name="late_norm"),
        "SELECT * FROM late_norm WHERE record_hash NOT IN (SELECT record_hash FROM stg_base)",
    ),
    STG_BASE_COLS,
)
def late_rows(spark, sf):
    """Batch-2 quotes the strict watermark never loads."""
    st = pipeline_state(spark, sf)
    wm = st["batch2"]["stg_watermark"]
    b2 = V.batch2(spark, sf).select(*RAW_COLS)
    return PL.skipped_by_watermark(b2, PL.read_stg_base(spark, st["layout"]), wm, flows.RUN_TS, P)


@register("stg_upsert", D.query(UPSERT_SQL, "SELECT * FROM merged"), STG_BASE_COLS)
def stg_upsert(spark, sf):
    """A4: batch 1 then batch 2 (with corrections) upserted into STG; only
    price and ingested_at change for keys already stored."""
    k = _key(spark, sf, "upsert")
    with _LOCK:
        if k not in _STATE:
            path = scratch_path(spark, "stg-upsert")
            for b in (V.batch1(spark, sf), V.batch2(spark, sf)):
                rows = to_stg_base(b.select(*RAW_COLS), flows.RUN_TS, P).withColumn("captured_date", F.to_date("captured_at"))
                M.upsert_partitioned(spark, rows, path, "record_hash", ["price", "ingested_at"], "captured_date")
            _STATE[k] = path
    return spark.read.parquet(_STATE[k]).select(*STG_BASE_COLS)


@register("stg_upsert_versions", D.query(UPSERT_SQL, "SELECT * FROM merged"), STG_BASE_COLS)
def stg_upsert_versions(spark, sf):
    """A4 on a versioned table: the same two batches, each touched partition
    written once and the change published as a version; the newest is read."""
    k = _key(spark, sf, "upsert-versions")
    with _LOCK:
        if k not in _STATE:
            path = scratch_path(spark, "stg-upsert-versions")
            for b in (V.batch1(spark, sf), V.batch2(spark, sf)):
                rows = to_stg_base(b.select(*RAW_COLS), flows.RUN_TS, P).withColumn("captured_date", F.to_date("captured_at"))
                versions.upsert(spark, rows, path, "record_hash", ["price", "ingested_at"], "captured_date")
            _STATE[k] = path
    return versions.read(spark, _STATE[k]).select(*STG_BASE_COLS)


@register("pipeline_versions", D.query(PIPE_DWH, "SELECT * FROM dwh"), DWH_COLUMNS)
def pipeline_versions(spark, sf):
    """L5 with versioned STG, ODS and DWH (A4, A9, A10): the DWH's newest
    version equals one full run over the rows the watermark admits."""
    k = _key(spark, sf, "pipeline-versions")
    with _LOCK:
        if k not in _STATE:
            layout = PL.Layout(scratch_path(spark, "pipeline-versions"))
            for b in (V.batch1(spark, sf), V.batch2(spark, sf)):
                PL.run_batch(spark, b.select(*RAW_COLS), layout, flows.RUN_TS, P.with_(versioned_tables=True))
            _STATE[k] = layout
    return PL.read_dwh(spark, _STATE[k])


@register(
    "raw_append",
    D.query(SCEN, "SELECT * FROM b1 UNION ALL SELECT * FROM b2"),
    RAW_COLS,
)
def raw_append(spark, sf):
    """Both raw batches appended, laid out by capture date and the
    compound lookup key (origin, destination, departure, capture)."""
    k = _key(spark, sf, "raw")
    with _LOCK:
        if k not in _STATE:
            path = scratch_path(spark, "raw")
            for b in (V.batch1(spark, sf), V.batch2(spark, sf)):
                rows = b.select(*RAW_COLS).withColumn("captured_date", F.to_date("captured_at"))
                M.append(rows, path, "captured_date", order=("route_origin", "route_destination", "departure_at", "captured_at"))
            _STATE[k] = path
    return spark.read.parquet(_STATE[k]).select(*RAW_COLS)


@register(
    "dwh_delete_insert",
    D.query(PIPE_DWH, "SELECT * FROM dwh"),
    DWH_COLUMNS,
)
def dwh_delete_insert(spark, sf):
    """A10/C6 in relational form: DWH of batch 1, then rows re-computed from
    its last capture date deleted by feature_key and inserted."""
    ods1 = flows.ods_of(V.batch1(spark, sf).select(*RAW_COLS), P)
    old = models.dwh(ods1, P)
    since = old.agg(F.max("captured_date")).first()[0]
    b12 = V.batch1(spark, sf).select(*RAW_COLS)
    wm1 = b12.agg(F.max("captured_at")).first()[0]
    b2v = V.batch2(spark, sf).select(*RAW_COLS).filter(F.col("captured_at") > wall_lit(wm1))
    ods_all = flows.ods_of(b12.unionByName(b2v), P)
    new = models.dwh(ods_all, P, since=since)
    return delete_insert_rows(old, new, "feature_key")


SYNC_SCHEMA = T.StructType(
    [T.StructField(c, t, True) for c, t in [
        ("record_hash", T.StringType()), ("route_key", T.StringType()), ("route_origin", T.StringType()),
        ("route_destination", T.StringType()), ("departure_at", T.TimestampNTZType()), ("captured_at", T.TimestampNTZType()),
        ("days_before_departure", T.IntegerType()), ("departure_day_of_week", T.IntegerType()),
        ("ticket_class", T.StringType()), ("currency", T.StringType()), ("price", T.DecimalType(12, 2)),
        ("captured_date", T.DateType()),
    ]]
)


@register(
    "schema_sync",
    D.query(
        SCEN
        + D.stg_base("b1", P, name="s1") + D.stg("s1", name="stg1") + D.ods("stg1", P, name="ods1")
        + D.stg_base("b2v", P, name="s2") + D.stg("s2", name="stg2") + D.ods("stg2", P, name="ods2"),
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS ticket_class) FROM ods1 UNION ALL SELECT * FROM ods2",
    ),
    ODS_COLUMNS,
)
def schema_sync(spark, sf):
    """Old files lack ticket_class and carry an extra column;
    new files have the current schema; reading through the current schema
    adds the missing column as NULL and drops the removed one."""
    k = _key(spark, sf, "sync")
    with _LOCK:
        if k not in _STATE:
            path = scratch_path(spark, "schema-sync")
            b1 = V.batch1(spark, sf).select(*RAW_COLS)
            wm1 = b1.agg(F.max("captured_at")).first()[0]
            b2v = V.batch2(spark, sf).select(*RAW_COLS).filter(F.col("captured_at") > wall_lit(wm1))
            old = flows.ods_of(b1, P).drop("ticket_class").withColumn("legacy_note", F.lit("v1"))
            M.append(old.withColumn("captured_date", F.to_date("captured_at")), path, "captured_date")
            new = flows.ods_of(b2v, P)
            M.append(new.withColumn("captured_date", F.to_date("captured_at")), path, "captured_date")
            _STATE[k] = path
    return M.read_table(spark, _STATE[k], SYNC_SCHEMA).select(*ODS_COLUMNS)


@register(
    "source_fallback",
    D.query(
        SCEN + [("fb", FX2_RAW_SQL)],
        "SELECT * FROM b2",
    ),
    RAW_COLS,
)
def q_source_fallback(spark, sf):
    """Primary quotes when there are any, else the fallback source."""
    primary = V.batch2(spark, sf).select(*RAW_COLS)
    return source_fallback(primary, fx2_raw(spark, sf))


@register(
    "batch_counters",
    D.query(
        PIPE
        + D.stg_base("b1", P, name="l1")
        + D.stg_base("b2v", P, name="l2")
        + D.dwh("ods", P)
        + D.dm("ods", P),
        """SELECT 1 AS batch, 'generated' AS counter, COUNT(*) AS n FROM b1
UNION ALL SELECT 2, 'generated', COUNT(*) FROM b2
UNION ALL SELECT 1, 'transferred', COUNT(*) FROM l1
UNION ALL SELECT 2, 'transferred', COUNT(*) FROM l2
UNION ALL SELECT 2, 'stg_rows', COUNT(*) FROM stg_base
UNION ALL SELECT 2, 'ods_rows', COUNT(*) FROM ods
UNION ALL SELECT 2, 'dwh_rows', COUNT(*) FROM dwh
UNION ALL SELECT 2, 'dm_rows', COUNT(*) FROM dm""",
    ),
    ["batch", "counter", "n"],
)
def batch_counters(spark, sf):
    """Rows generated and transferred (distinct keys loaded), as the runs
    observed them while writing, and rows stored per layer, counted."""
    st = pipeline_state(spark, sf)
    layout = st["layout"]
    told = [(i, name, st[f"batch{i}"][key]) for name, key in (("generated", "inserted"), ("transferred", "transferred")) for i in (1, 2)]

    def cnt(df: DataFrame, batch: int, counter: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(batch).alias("batch"), F.lit(counter).alias("counter"), "n"
        )

    parts = [
        spark.createDataFrame(told, "batch int, counter string, n long"),
        cnt(PL.read_stg_base(spark, layout), 2, "stg_rows"),
        cnt(PL.read_ods(spark, layout), 2, "ods_rows"),
        cnt(PL.read_dwh(spark, layout), 2, "dwh_rows"),
        cnt(PL.read_dm(spark, layout), 2, "dm_rows"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ 2.F reports

FX1_DM = D.fx1_ods(P) + D.dm("ods", P)


def _dm(spark, sf):
    return models.dm(flows.fx1_ods(spark, sf), P)


@register("sort_avg_price", D.query(FX1_DM, "SELECT * FROM dm ORDER BY route_avg_price, route_key"), DM_COLUMNS)
def sort_avg_price(spark, sf):
    return report.sort_by_avg_price(_dm(spark, sf))


@register(
    "sort_best_days",
    D.query(FX1_DM, "SELECT * FROM dm ORDER BY best_days_before_departure NULLS LAST, route_key"),
    DM_COLUMNS,
)
def sort_best_days(spark, sf):
    return report.sort_by_best_days(_dm(spark, sf))


@register(
    "head_routes",
    D.query(FX1_DM, f"SELECT {', '.join(report.SUMMARY_COLUMNS)} FROM dm ORDER BY route_key LIMIT 30"),
    report.SUMMARY_COLUMNS,
)
def head_routes(spark, sf):
    return report.head_routes(_dm(spark, sf), 30)


@register(
    "top_cheapest",
    D.query(
        FX1_DM,
        f"SELECT {', '.join(report.SUMMARY_COLUMNS)} FROM dm ORDER BY route_avg_price NULLS LAST, route_key LIMIT 20",
    ),
    report.SUMMARY_COLUMNS,
)
def top_cheapest(spark, sf):
    return report.top_cheapest(_dm(spark, sf), 20)


@register(
    "chart_price_level",
    D.query(FX1_DM, f"SELECT {', '.join(report.CHART_COLUMNS)} FROM dm"),
    report.CHART_COLUMNS,
)
def chart_price_level(spark, sf):
    return report.chart_series(_dm(spark, sf))
