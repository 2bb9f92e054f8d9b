"""The incremental pipeline: one call per raw batch.

Order per batch (the reference's schedule, as a plain function order):
  0. Raw: the batch, stamped, into its own folder of the raw layer (if it is named).
  1. EL: raw quotes strictly above the STG watermark -> normalize -> de-dup
     -> upsert into STG base (partitioned by capture date).
  2. ODS: STG model rows in the pipeline currency strictly above the ODS
     watermark -> append.
  3. DWH: recompute from the last stored capture date on (re-opened day),
     delete+insert on feature_key.
  4. DM: full refresh from ODS.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.functions.dates import wall_lit
from farespark.operators import materialize as M
from farespark.operators import versions as V
from farespark.operators.ingest import CORRUPT, above_watermark, normalize, stamped, to_stg_base
from farespark.params import DEFAULT, Params
from farespark.plans import models
from farespark.schemas import DM_COLUMNS, DWH, DWH_COLUMNS, ODS, ODS_COLUMNS, RAW, STG_BASE, with_column_docs


@dataclass(frozen=True)
class Layout:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_flight_prices"

    @property
    def stg(self) -> str:
        return f"{self.root}/stg_raw_flight_prices"

    @property
    def ods(self) -> str:
        return f"{self.root}/ods_flight_price_snapshots"

    @property
    def dwh(self) -> str:
        return f"{self.root}/dwh_route_price_features"

    @property
    def dwh_trend(self) -> str:
        return f"{self.root}/dwh_trend_state"

    @property
    def dwh_trend_commits(self) -> str:
        return f"{self.root}/dwh_trend_commits"

    @property
    def dm(self) -> str:
        return f"{self.root}/dm_route_purchase_recommendations"

    @property
    def dm_segments(self) -> str:
        return f"{self.root}/dm_segment_state"

    @property
    def dm_segment_commits(self) -> str:
        return f"{self.root}/dm_segment_commits"


def _with_cap_date(df: DataFrame) -> DataFrame:
    return df.withColumn("captured_date", F.to_date("captured_at"))


def store_raw(spark: SparkSession, raw_batch: DataFrame, layout: Layout, batch: str, run_ts: dt.datetime) -> tuple[DataFrame, int]:
    """Step 0 (A3): the stamped batch as stored, and how many rows were inserted.

    A batch has a folder of its own, so a run that is repeated writes it
    again and inserts nothing twice. Lines that are no documents are not quotes
    and stay out of it.
    """
    path = f"{layout.raw}/batch={batch}"
    n = M.write_counted(stamped(raw_batch if CORRUPT not in raw_batch.columns else raw_batch.filter(F.col(CORRUPT).isNull()), run_ts), path)
    return spark.read.schema(RAW).parquet(path), n


def read_raw(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Every stored batch of the raw layer, with the column ``batch``."""
    return M.read_table(spark, layout.raw, T.StructType([*RAW.fields, T.StructField("batch", T.StringType())]))


def read_stg_base(spark: SparkSession, layout: Layout) -> DataFrame | None:
    df = V.read(spark, layout.stg) if V.exists(spark, layout.stg) else M.read_table(spark, layout.stg)
    return None if df is None else df.select(*STG_BASE.fieldNames())


def read_ods(spark: SparkSession, layout: Layout) -> DataFrame | None:
    df = V.read_synced(spark, layout.ods, ODS)
    return None if df is None else df.select(*ODS_COLUMNS)


def read_dwh(spark: SparkSession, layout: Layout) -> DataFrame | None:
    df = V.read_synced(spark, layout.dwh, DWH)
    return None if df is None else df.select(*DWH_COLUMNS)


def read_dm(spark: SparkSession, layout: Layout) -> DataFrame | None:
    df = M.read_table(spark, layout.dm)
    return None if df is None else df.select(*DM_COLUMNS)


def _versioned(spark: SparkSession, path: str, params: Params) -> bool:
    return params.versioned_tables or V.exists(spark, path)


def load_stg(spark: SparkSession, raw_batch: DataFrame, layout: Layout, run_ts: dt.datetime, params: Params = DEFAULT):
    """Step 1. Returns the STG watermark used (None on the first load) and the rows transferred."""
    versioned = _versioned(spark, layout.stg, params)
    if not V.exists(spark, layout.stg):
        M.finish_swap(spark, layout.stg, "captured_date")
    wm = (V if versioned else M).max_value(spark, layout.stg, "captured_at", "captured_date")
    visible = above_watermark(raw_batch, "captured_at", wm)
    # An empty batch stages nothing and leaves the table untouched
    rows = _with_cap_date(to_stg_base(visible, run_ts, params))
    how = (layout.stg, "record_hash", ["price", "ingested_at"], "captured_date")
    return wm, V.upsert(spark, rows, *how, widen=params.widen_types) if versioned else M.upsert_partitioned(spark, rows, *how)


def append_ods(spark: SparkSession, layout: Layout, params: Params = DEFAULT):
    """Step 2 (A9): strict ``captured_at > max(ODS.captured_at)`` append."""
    store = V if _versioned(spark, layout.ods, params) else M
    wm = store.max_value(spark, layout.ods, "captured_at", "captured_date")
    stg = V.read(spark, layout.stg) if V.exists(spark, layout.stg) else M.read_table(spark, layout.stg)
    if stg is None:  # nothing has been loaded yet (D13)
        return None
    if wm is not None:
        # partition pruning: only capture dates from the watermark's day on
        stg = stg.filter(F.col("captured_date") >= wall_lit(wm).cast("date"))
    new = models.ods(models.stg(stg.select(*STG_BASE.fieldNames())), params)
    new = with_column_docs(above_watermark(new, "captured_at", wm))
    order = ("route_key", "departure_at", "captured_at")
    # ODS has the partitions of STG, and no step between them moves rows: files of a day are read and written as such.
    if store is V:
        V.append(spark, _with_cap_date(new), layout.ods, "captured_date", order=order, widen=params.widen_types, placed=True)
    else:
        M.append(_with_cap_date(new), layout.ods, "captured_date", order=order, placed=True)
    return wm


def refresh_dwh(spark: SparkSession, layout: Layout, params: Params = DEFAULT):
    """Step 3 (A10): re-open ``captured_date >= max(DWH.captured_date)``.

    The re-opened days are computed from their own quotes and the window
    state that the last run carried over. Without a state of just that day
    and these parameters (first run, a run that died before it was
    committed) they are computed from the whole horizon.
    """
    store = V if _versioned(spark, layout.dwh, params) else M
    if not V.exists(spark, layout.dwh):
        M.finish_swap(spark, layout.dwh, "captured_date")
    since = store.max_value(spark, layout.dwh, "captured_date", "captured_date")
    ods = V.read_synced(spark, layout.ods, ODS)
    if ods is None:
        return None
    state = None
    if since is not None and params.carried_windows:
        state = read_trend_state(spark, layout, params, since)
    if state is not None:
        ods = ods.filter(F.col("captured_date") >= wall_lit(since).cast("date"))
        new = models.dwh_carried(ods.select(*ODS_COLUMNS), state, params, since)
    else:
        if since is not None:
            # partition pruning: rows within the horizon of a re-opened departure
            # day were captured at most `horizon_days` before it
            ods = ods.filter(F.col("captured_date") >= F.date_sub(wall_lit(since), params.horizon_days))
        new = models.dwh(ods.select(*ODS_COLUMNS), params, since=since)
    new = with_column_docs(new)
    if store is V:
        V.delete_insert(spark, new, layout.dwh, "feature_key", "captured_date", since, widen=params.widen_types)
    elif since is None:
        M.create_partitioned(new, layout.dwh, "captured_date")
    else:
        M.delete_insert_partitioned(spark, new, layout.dwh, "feature_key", "captured_date", since)
    if params.carried_windows:
        _carry_trend(spark, layout, params, since, state)
    return since


def _trend_built_with(params: Params) -> str:
    """The parameters that the mean prices in the window state depend on."""
    return f"currency={params.currency} horizon_days={params.horizon_days}"


def _trend_commit(spark: SparkSession, layout: Layout):
    commits = M.read_table(spark, layout.dwh_trend_commits)
    return None if commits is None else commits.agg(F.max(F.struct("v", "before", "built_with")).alias("h")).first()["h"]


def read_trend_state(spark: SparkSession, layout: Layout, params: Params, before) -> DataFrame | None:
    """The committed window state of the day ``before``; None if the newest one is of another day or other parameters."""
    head = _trend_commit(spark, layout)
    if head is None or head["before"] != before or head["built_with"] != _trend_built_with(params):
        return None
    return spark.read.parquet(f"{layout.dwh_trend}/v={head['v']}")


def _carry_trend(spark: SparkSession, layout: Layout, params: Params, since, state: DataFrame | None) -> None:
    """Folds the days that are closed now into the state, for the day the next run re-opens.

    The rows come from the DWH as stored, not from quotes. A state counts once
    its commit row is written.
    """
    store = V if V.exists(spark, layout.dwh) else M
    last = store.max_value(spark, layout.dwh, "captured_date", "captured_date")
    if last is None or (state is not None and last == since):
        return
    day = wall_lit(last).cast("date")
    first = F.date_sub(day, params.horizon_days) if state is None else wall_lit(since).cast("date")
    daily = V.read_synced(spark, layout.dwh, DWH).filter(F.col("captured_date").between(first, F.date_sub(day, 1))).select(*models.TREND_STATE)
    if state is not None:
        daily = daily.unionByName(state.select(*models.TREND_STATE))
    head = _trend_commit(spark, layout)
    v = 1 if head is None else head["v"] + 1
    M.overwrite(models.trend_state(daily, last), f"{layout.dwh_trend}/v={v}")
    commit = spark.range(1).select(F.lit(v).cast("long").alias("v"), day.alias("before"), F.lit(_trend_built_with(params)).alias("built_with"))
    M.append(commit, layout.dwh_trend_commits)


def refresh_dm(spark: SparkSession, layout: Layout, params: Params = DEFAULT) -> None:
    """Step 4 (A11): rebuild the mart table (one row per route: small).

    Full form: from all of ODS. Incremental form: ODS rows past the segment
    state's own watermark are folded into the additive state (bounded size)
    and the mart is rebuilt from it, so a batch scans only new partitions.
    The state is written as a new version folder and counts once its commit
    row is written, which names its watermark and parameters. So a run that
    failed half-way is caught up by the next one, which writes over what it
    left, and other parameters build the state anew.
    """
    ods = V.read_synced(spark, layout.ods, ODS)
    if ods is None:
        return
    if not params.incremental_mart:
        M.overwrite(with_column_docs(models.dm(ods.select(*ODS_COLUMNS), params)), layout.dm)
        return
    state, version, wm = read_segment_state(spark, layout, params)
    if wm is not None:
        ods = ods.filter(F.col("captured_date") >= wall_lit(wm).cast("date"))
        ods = above_watermark(ods, "captured_at", wm)
    through = ods.agg(F.max("captured_at")).first()[0]
    if through is not None:
        new = models.segment_stats(ods.select(*ODS_COLUMNS), params)
        merged = new if state is None else models.merge_segments(state, new)
        version += 1
        M.overwrite(merged, f"{layout.dm_segments}/v={version}")
        commit = spark.range(1).select(
            F.lit(version).cast("long").alias("v"), wall_lit(through).alias("through_captured_at"), F.lit(_built_with(params)).alias("built_with")
        )
        M.append(commit, layout.dm_segment_commits)
    elif state is None:
        return
    seg = spark.read.parquet(f"{layout.dm_segments}/v={version}")
    M.overwrite(with_column_docs(models.dm_from_segments(seg, params)), layout.dm)


def _built_with(params: Params) -> str:
    """The parameters that the segment state depends on."""
    return f"currency={params.currency} mart_horizon_days={params.mart_horizon_days}"


def read_segment_state(spark: SparkSession, layout: Layout, params: Params = DEFAULT):
    """(state, version, watermark) of the newest committed version.

    The state and the watermark are None if there is no version or it was
    built with other parameters. Only that version's folder is read.
    """
    commits = M.read_table(spark, layout.dm_segment_commits)
    head = None if commits is None else commits.agg(F.max(F.struct("v", "through_captured_at", "built_with")).alias("h")).first()["h"]
    if head is None:
        return None, 0, None
    if head["built_with"] != _built_with(params):
        return None, head["v"], None
    return spark.read.parquet(f"{layout.dm_segments}/v={head['v']}"), head["v"], head["through_captured_at"]


def run_batch(spark: SparkSession, raw_batch: DataFrame, layout: Layout, run_ts: dt.datetime, params: Params = DEFAULT, batch: str | None = None) -> dict:
    """One scheduled run. With a name of the ``batch`` it is kept in the raw layer,
    and loaded from there. The counters (D12) are observed by the writes: no job is run for them. DWH and DM both read only ODS, so they are
    submitted as concurrent Spark jobs (the reference runs its models on
    several threads too); the session's scheduler shares the cluster."""
    inserted = None
    if batch is not None:
        raw_batch, inserted = store_raw(spark, raw_batch, layout, batch, run_ts)
    stg_wm, transferred = load_stg(spark, raw_batch, layout, run_ts, params)
    ods_wm = append_ods(spark, layout, params)
    if params.model_threads > 1:
        with ThreadPoolExecutor(max_workers=min(2, params.model_threads)) as pool:
            dwh_job = pool.submit(refresh_dwh, spark, layout, params)
            dm_job = pool.submit(refresh_dm, spark, layout, params)
            dwh_since = dwh_job.result()
            dm_job.result()
    else:
        dwh_since = refresh_dwh(spark, layout, params)
        refresh_dm(spark, layout, params)
    for path in (layout.stg, layout.ods, layout.dwh):
        V.vacuum(spark, path, params.keep_versions)
    return {"stg_watermark": stg_wm, "ods_watermark": ods_wm, "dwh_since": dwh_since, "inserted": inserted, "transferred": transferred}


def skipped_by_watermark(raw_batch: DataFrame, stg_base: DataFrame, watermark, run_ts: dt.datetime, params: Params = DEFAULT) -> DataFrame:
    """Quotes of a batch the strict watermark never loads.

    Rows at or below the watermark whose key is absent from STG: late
    arrivals (rows of keys already stored are re-quotes, not losses).
    """
    if watermark is None:
        return normalize(raw_batch.limit(0), run_ts, params)
    at_or_below = raw_batch.filter(F.col("captured_at") <= wall_lit(watermark))
    rows = normalize(at_or_below, run_ts, params)
    return rows.join(stg_base.select("record_hash"), "record_hash", "left_anti")
