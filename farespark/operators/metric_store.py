"""Stored daily moments for the anomaly checks (K5-K9).

A row of the store holds what a day's rows say of one column in a form that
merges: counts, mean, sum of squared deviations, least and largest value. A
scheduled run folds in new rows only and the checks read the store, not the
model. The results are those of :mod:`farespark.operators.quality` on the whole
model.

``fold`` takes rows above the newest ones it has seen (append-only models), or
days that were opened again, whose stored rows it replaces. Rows and the mark of
what has been seen are one version of a versioned table (one folder a month
of days), so a run that is repeated folds nothing twice.

Rows without a day are not counted. An empty model leaves no store.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.functions.dates import wall_lit
from farespark.functions.numeric import round_num
from farespark.operators import materialize as M
from farespark.operators import quality as Qy
from farespark.operators import versions as V
from farespark.params import DEFAULT, Params

#: Names of the rows that are of no single column: all rows of a day, and the lag of its events.
ROWS, LAG = "*", "*lag"
KEY = ["name", "kind", "series", "bucket_date"]


def _of_column(name: str, kind: str, x: Column, given: Column) -> Column:
    """Moments of ``x``, the value of a column (a text's length), and counts of ``given``, the column itself."""
    k = F.count(x)
    return F.struct(
        F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.count_if(given.isNull()).alias("nulls"), k.alias("k"),
        F.avg(x).alias("mean"), (F.var_pop(x) * k).alias("m2"), F.min(x).alias("least"), F.max(x).alias("most"),
        F.count_if(x == 0).alias("zeros"), F.count_if(given.isNull() | (x == 0)).alias("missing"),
    )


def moments(df: DataFrame, day_col: str, columns: Iterable[str], dims: Iterable[str] = (), event_col: str | None = None) -> DataFrame:
    """The store's rows for ``df``: one aggregate by day for all columns, one by day and dimension values."""
    nothing = F.lit(None).cast("double")
    got = [_of_column(ROWS, "rows", nothing, F.lit(1))]
    if event_col:
        lag = F.timestamp_diff("MICROSECOND", F.col(event_col), F.col(day_col)) / F.lit(1_000_000.0)
        got.append(_of_column(LAG, "lag", lag, lag))
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.NumericType):
            got.append(_of_column(c, "number", F.col(c).cast("double"), F.col(c)))
        elif isinstance(kind, T.StringType):
            got.append(_of_column(c, "text", F.length(c).cast("double"), F.col(c)))
        else:
            got.append(_of_column(c, "other", nothing, F.col(c)))
    day = F.to_date(F.col(day_col))
    common = [F.count(F.lit(1)).alias("n"), F.max(F.col(day_col).cast("timestamp_ntz")).alias("seen_to")]
    rows = df.filter(F.col(day_col).isNotNull())
    out = rows.groupBy(day.alias("bucket_date")).agg(*common, F.array(*got).alias("_m"))
    out = out.select("bucket_date", "n", "seen_to", F.inline("_m")).withColumn("series", F.array().cast("array<string>"))
    dims = list(dims)
    if dims:
        counts = rows.groupBy(day.alias("bucket_date"), F.array(*[F.col(d).cast("string") for d in dims]).alias("series")).agg(*common)
        out = out.unionByName(counts.withColumns({"name": F.lit(",".join(dims)), "kind": F.lit("dimension")}), allowMissingColumns=True)
    return out.withColumn("month", F.trunc("bucket_date", "month"))


def merged(parts: DataFrame) -> DataFrame:
    """One row a key from at most two, the stored one and the new one."""
    k = F.coalesce("k", F.lit(0))
    mean = F.when(k > 0, F.col("mean"))
    both = F.count(mean) == 2
    # two means lie k1*k2/(k1+k2) * (difference)^2 of squares apart
    apart = F.when(both, F.max(k).cast("double") * F.min(k) / F.sum(k) * F.pow(F.max(mean) - F.min(mean), F.lit(2.0))).otherwise(0.0)
    exact = F.when(both, F.sum(mean * k) / F.sum(k)).otherwise(F.max(mean))
    sums = [F.sum(c).alias(c) for c in ("n", "nulls", "k", "zeros", "missing")]
    return parts.groupBy(*KEY, "month").agg(
        *sums, exact.alias("mean"), (F.sum("m2") + apart).alias("m2"), F.min("least").alias("least"), F.max("most").alias("most"), F.max("seen_to").alias("seen_to")
    )


def fold(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    day_col: str,
    columns: Iterable[str],
    dims: Iterable[str] = (),
    event_col: str | None = None,
    reopened: dt.date | None = None,
) -> int:
    """Brings the store at ``path`` up to ``df``; returns the rows of the store that were computed.

    Without ``reopened`` only rows of ``df`` above the newest ``day_col`` seen are read, and merged with those of their day;
    with it the rows of that day and later ones, which take the place of the stored ones.
    """
    base = V.version(spark, path)
    if reopened is not None:
        df = df.filter(F.col(day_col) >= wall_lit(reopened))
    else:
        seen_to = V.max_value(spark, path, "seen_to", "month")
        df = df if seen_to is None else df.filter(F.col(day_col).cast("timestamp_ntz") > wall_lit(seen_to))
    seen = Observation()
    new = M.stage_rows(spark, moments(df, day_col, columns, dims, event_col), "month", "moments", seen)
    touched = {f"month={m}" for m in M.staged_partitions(new, "month")}
    if reopened is not None and base is not None:
        touched |= {p for p in base.partitions if p >= f"month={reopened.replace(day=1)}"}
    if not touched:
        return 0
    stored = None if base is None else V.read(spark, path, touched, of=base)
    if stored is not None:
        if reopened is not None:
            stored = stored.filter(F.col("bucket_date") < wall_lit(reopened).cast("date"))
        new = new.unionByName(stored)
    V.commit(spark, merged(new), path, "month", base, replaced=touched)
    return M.rows_seen(seen)


def _stored(spark: SparkSession, path: str, kinds: list[str], params: Params, since) -> DataFrame:
    got = V.read(spark, path)
    if got is None:
        raise ValueError(f"nothing has been folded into {path} yet")
    return Qy._recent(got.filter(F.col("kind").isin(kinds)), "bucket_date", since, params)


def volume(spark: SparkSession, path: str, params: Params = DEFAULT, since=None) -> DataFrame:
    """K5 from the store: as ``quality.dq_volume``."""
    daily = _stored(spark, path, ["rows"], params, since).select("bucket_date", F.col("n").alias("metric_value"))
    return Qy._report_from(Qy.zscored_counts(daily, [], params), since)


def event_freshness(spark: SparkSession, path: str, params: Params = DEFAULT, since=None) -> DataFrame:
    """K6 from the store: as ``quality.dq_event_freshness``."""
    rows = _stored(spark, path, ["lag"], params, since)
    long = _long(rows, [("max_lag_seconds", "most"), ("avg_lag_seconds", "mean")]).select(
        "bucket_date", "metric", round_num("metric_value", 3).cast("double").alias("metric_value")
    )
    return Qy._report_from(Qy.zscore(long, ["metric"], "bucket_date", params=params), since)


def column_metrics(spark: SparkSession, path: str, params: Params = DEFAULT, since=None) -> DataFrame:
    """K7/K8 from the store: as ``quality.dq_column_metrics`` on the columns that were folded."""
    rows = _stored(spark, path, ["number", "text", "other"], params, since).withColumns(
        {
            "null_percent": F.col("nulls") * 100.0 / F.col("n"),
            "sd": F.when(F.col("k") > 1, F.sqrt(F.greatest("m2", F.lit(0.0)) / (F.col("k") - 1))),
        }
    )
    nulls = [("null_count", "nulls"), ("null_percent", "null_percent")]
    by_kind = {
        "number": [*nulls, ("min", "least"), ("max", "most"), ("average", "mean"), ("standard_deviation", "sd"), ("zero_count", "zeros")],
        "text": [*nulls, ("min_length", "least"), ("max_length", "most"), ("average_length", "mean"), ("missing_count", "missing")],
        "other": nulls,
    }
    long = Qy.union_all([_long(rows.filter(F.col("kind") == k), metrics) for k, metrics in by_kind.items()])
    long = long.withColumn("metric_value", round_num("metric_value", 6).cast("double")).withColumnRenamed("name", "column_name")
    return Qy._report_from(Qy.zscore(long, ["column_name", "metric"], "bucket_date", params=params), since)


def dimension(spark: SparkSession, path: str, dims: list[str], params: Params = DEFAULT, since=None) -> DataFrame:
    """K9 from the store: as ``quality.dq_dimension`` on the dimensions that were folded, whose values come as text."""
    rows = _stored(spark, path, ["dimension"], params, since).filter(F.col("name") == ",".join(dims))
    daily = rows.select(*[F.col("series")[i].alias(d) for i, d in enumerate(dims)], "bucket_date", F.col("n").alias("metric_value"))
    return Qy._report_from(Qy.zscored_counts(daily, dims, params), since)


def _long(rows: DataFrame, metrics: list[tuple[str, str]]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("metric_value")) for m, c in metrics])
    return rows.select("bucket_date", "name", F.inline(pairs))
