"""Data-quality operators (K1-K12). Every check returns a plain DataFrame.

Generic tests return the failing rows (or failing groups); anomaly tests
return one row per (series, day) with the z-score against the previous
``anomaly_window`` days. All checks are aggregates or anti-joins that
partial-aggregate before the shuffle; the anomaly windows run over daily
aggregates (one row per day and series), never over raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.functions.dates import wall_lit
from farespark.functions.numeric import round_num
from farespark.params import DEFAULT, Params

# ------------------------------------------------------------------ generic


def dq_unique(df: DataFrame, key: str | list[str]) -> DataFrame:
    """K1: key values that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dq_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """K2: null count per column, all columns in one pass (one row each)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot([], columns, "column_name", "failures").select(
        "column_name", F.col("failures").cast("long").alias("failures")
    )


def dq_accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """K3: values outside the accepted set (NULL is not judged), with counts."""
    c = F.col(column)
    bad = df.filter(c.isNotNull() & ~c.isin(values))
    return bad.groupBy(c.alias("bad_value")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(column).alias("column_name"), "bad_value", "n"
    )


def dq_relationships(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """K4: child keys missing from the parent (left anti join)."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias(key))
    return child.filter(F.col(key).isNotNull()).select(key).join(p, key, "left_anti")


# ------------------------------------------------------------------ anomalies


def day_spine(df: DataFrame, day_col: str, by: list[str] | None = None) -> DataFrame:
    """Every calendar day from the first to the last observed one.

    With ``by`` each series runs from its own first day to the *global*
    last day (so a series that stops shows zeros), generated per series by
    ``sequence`` + ``explode``: no cross join. The series count is the
    number of dimension values (routes), the length the number of days.
    """
    by = by or []
    firsts = df.groupBy(*by).agg(F.min(day_col).alias("_first"), F.max(day_col).alias("_last"))
    if by:
        # the last day of all is one row: it goes to the series, the series do not go to one task
        firsts = firsts.join(F.broadcast(firsts.agg(F.max("_last").alias("_end"))), F.col("_last") <= F.col("_end"))
    else:
        firsts = firsts.withColumnRenamed("_last", "_end")
    return firsts.select(*by, F.explode(F.sequence("_first", "_end", F.expr("INTERVAL 1 DAY"))).alias(day_col))


def zscore(series: DataFrame, by: list[str], day_col: str, value_col: str = "metric_value", params: Params = DEFAULT) -> DataFrame:
    """Control chart: z of each day's value against the previous N days.

    Needs ``anomaly_min_history`` non-null previous values and a positive
    stddev; flagged when |z| > ``anomaly_z``. Window partitions are series
    (a column, a metric, a route), each at most one row per day.
    """
    w = Window.partitionBy(*by).orderBy(day_col).rowsBetween(-params.anomaly_window, -1)
    v = F.col(value_col).cast("double")
    hist_n = F.count(v).over(w)
    mean = F.avg(v).over(w)
    sd = F.stddev_samp(v).over(w)
    out = series.select(
        "*",
        hist_n.alias("hist_n"),
        mean.alias("_mean"),
        sd.alias("_sd"),
    )
    z = F.when(
        (F.col("hist_n") >= params.anomaly_min_history) & (F.col("_sd") > 0),
        (F.col(value_col).cast("double") - F.col("_mean")) / F.col("_sd"),
    )
    return out.select(
        *series.columns,
        F.col("hist_n").cast("long").alias("hist_n"),
        round_num("_mean", 6).cast("double").alias("hist_mean"),
        round_num("_sd", 6).cast("double").alias("hist_stddev"),
        round_num(z, 6).cast("double").alias("z_score"),
        F.coalesce(F.abs(z) > params.anomaly_z, F.lit(False)).alias("is_anomaly"),
    )


def _day(ts_col: str) -> Column:
    return F.to_date(F.col(ts_col))


def _recent(df: DataFrame, ts_col: str, since, params: Params) -> DataFrame:
    """Rows a run that reports days >= ``since`` needs: those days plus as many
    observed days before them as the history window counts and one for the
    lag, however far back they lie. The days come from one aggregate of the
    date column; the predicate is a literal then. ``since=None`` keeps everything."""
    if since is None:
        return df
    before = df.select(_day(ts_col).alias("d")).filter(F.col("d") < wall_lit(since).cast("date")).distinct()
    first = before.orderBy(F.desc("d")).limit(params.anomaly_window + 1).agg(F.min("d")).first()[0]
    return df.filter(_day(ts_col) >= (wall_lit(since) if first is None else wall_lit(first)).cast("date"))


def _report_from(out: DataFrame, since) -> DataFrame:
    return out if since is None else out.filter(F.col("bucket_date") >= wall_lit(since).cast("date"))


def dq_volume(df: DataFrame, ts_col: str, params: Params = DEFAULT, since=None) -> DataFrame:
    """K5: rows per day (zero days included) as a z-scored series."""
    df = _recent(df, ts_col, since, params)
    daily = df.groupBy(_day(ts_col).alias("bucket_date")).agg(F.count(F.lit(1)).alias("metric_value"))
    return _report_from(zscored_counts(daily, [], params), since)


def zscored_counts(daily: DataFrame, by: list[str], params: Params = DEFAULT) -> DataFrame:
    """Counts by day (``bucket_date``, ``metric_value``) and series with their zero days, z-scored."""
    spine = day_spine(daily, "bucket_date", by)
    series = spine.join(daily, [*by, "bucket_date"], "left").select(
        *by, "bucket_date", F.coalesce("metric_value", F.lit(0)).cast("double").alias("metric_value")
    )
    return zscore(series, by, "bucket_date", params=params)


def dq_event_freshness(df: DataFrame, event_col: str, update_col: str, params: Params = DEFAULT, since=None) -> DataFrame:
    """K6: per update day, max and mean of (update - event) in seconds."""
    df = _recent(df, update_col, since, params)
    # zone-free difference of two wall clocks
    lag_s = F.timestamp_diff("MICROSECOND", F.col(event_col), F.col(update_col)) / F.lit(1_000_000.0)
    daily = df.groupBy(_day(update_col).alias("bucket_date")).agg(
        F.max(lag_s).alias("max_lag_seconds"), F.avg(lag_s).alias("avg_lag_seconds")
    )
    long = daily.unpivot(["bucket_date"], ["max_lag_seconds", "avg_lag_seconds"], "metric", "metric_value")
    long = long.withColumn("metric_value", round_num("metric_value", 3).cast("double"))
    return _report_from(zscore(long, ["metric"], "bucket_date", params=params), since)


def _column_metrics(f: T.StructField) -> list[tuple[str, Column]]:
    """Per-day metrics of one column, chosen by type (all single-pass aggregates)."""
    c = F.col(f.name)
    out = [("null_count", F.count_if(c.isNull()).cast("double")),
           ("null_percent", (F.count_if(c.isNull()) * 100.0 / F.count(F.lit(1))).cast("double"))]
    if isinstance(f.dataType, T.NumericType):
        d = c.cast("double")
        out += [
            ("min", F.min(d)),
            ("max", F.max(d)),
            ("average", F.sum(c).cast("double") / F.count(c) if isinstance(f.dataType, T.DecimalType) else F.avg(d)),
            ("standard_deviation", F.stddev_samp(d)),
            ("zero_count", F.count_if(d == 0).cast("double")),
        ]
    elif isinstance(f.dataType, T.StringType):
        ln = F.length(c)
        out += [
            ("min_length", F.min(ln).cast("double")),
            ("max_length", F.max(ln).cast("double")),
            ("average_length", F.avg(ln).cast("double")),
            ("missing_count", F.count_if(c.isNull() | (c == "")).cast("double")),
        ]
    return out


def dq_column_metrics(df: DataFrame, day_col: str, columns: list[str], params: Params = DEFAULT, since=None) -> DataFrame:
    """K7/K8: many metrics of many columns in ONE aggregate pass per day,
    unpivoted to (day, column, metric, value), then one z-score window
    partitioned by (column, metric). No query per column."""
    df = _recent(df, day_col, since, params)
    fields = {f.name: f for f in df.schema.fields}
    aggs, names = [], []
    for col in columns:
        for metric, expr in _column_metrics(fields[col]):
            alias = f"{col}__{metric}"
            aggs.append(expr.alias(alias))
            names.append((alias, col, metric))
    daily = df.groupBy(_day(day_col).alias("bucket_date")).agg(*aggs)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(col).alias("column_name"), F.lit(m).alias("metric"), F.col(a).cast("double").alias("metric_value"))
                  for a, col, m in names])
    )
    long = daily.select("bucket_date", pairs.alias("p")).select("bucket_date", "p.column_name", "p.metric", "p.metric_value")
    long = long.withColumn("metric_value", round_num("metric_value", 6).cast("double"))
    return _report_from(zscore(long, ["column_name", "metric"], "bucket_date", params=params), since)


def dq_dimension(df: DataFrame, day_col: str, dims: list[str], params: Params = DEFAULT, since=None) -> DataFrame:
    """K9: rows per dimension value and day (zeros included), z per value."""
    df = _recent(df, day_col, since, params)
    daily = df.groupBy(*dims, _day(day_col).alias("bucket_date")).agg(F.count(F.lit(1)).alias("metric_value"))
    return _report_from(zscored_counts(daily, dims, params), since)


def dq_freshness(df: DataFrame, day_col: str, params: Params = DEFAULT, since=None) -> DataFrame:
    """Days since the previous update, per observed update day."""
    df = _recent(df, day_col, since, params)
    days = df.groupBy(_day(day_col).alias("bucket_date")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy().orderBy("bucket_date")
    gaps = days.select(
        "bucket_date",
        F.datediff("bucket_date", F.lag("bucket_date").over(w)).cast("double").alias("metric_value"),
    )
    return _report_from(zscore(gaps, [], "bucket_date", params=params), since)


# ------------------------------------------------------------------ report


def summary(check: str, model: str, column: str | None, failing: DataFrame, severity: str = "error",
            count_col: str | None = None) -> DataFrame:
    """One report row for a check: failures = failing rows (or the sum of
    ``count_col``), status from severity (K11)."""
    n = F.count(F.lit(1)) if count_col is None else F.coalesce(F.sum(count_col), F.lit(0))
    return failing.agg(n.cast("long").alias("failures")).select(
        F.lit(check).alias("check_name"),
        F.lit(model).alias("model"),
        F.lit(column).cast("string").alias("column_name"),
        "failures",
        F.lit(severity).alias("severity"),
        F.when(F.col("failures") == 0, "pass").when(F.lit(severity) == "warn", "warn").otherwise("fail").alias("status"),
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_status(counts: DataFrame, severity: str = "error") -> DataFrame:
    """Add severity and status to (check_name, model, column_name, failures)."""
    return counts.select(
        "check_name",
        "model",
        F.col("column_name").cast("string").alias("column_name"),
        F.col("failures").cast("long").alias("failures"),
        F.lit(severity).alias("severity"),
        F.when(F.col("failures") == 0, "pass").when(F.lit(severity) == "warn", "warn").otherwise("fail").alias("status"),
    )


def model_column_checks(df: DataFrame, model: str, not_null: list[str], accepted: dict[str, list[str]]) -> DataFrame:
    """All not_null and accepted_values tests of one model in ONE scan:
    a single aggregate of ``count_if`` columns, unpivoted to report rows."""
    aggs, names = [], []
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"not_null__{c}"))
        names.append(f"not_null__{c}")
    for c, values in accepted.items():
        aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(values)).alias(f"accepted_values__{c}"))
        names.append(f"accepted_values__{c}")
    if not aggs:
        return None
    long = df.agg(*aggs).unpivot([], names, "test", "failures")
    parts = F.split("test", "__")
    return with_status(
        long.select(
            parts.getItem(0).alias("check_name"),
            F.lit(model).alias("model"),
            parts.getItem(1).alias("column_name"),
            "failures",
        )
    )


class DataTestFailure(RuntimeError):
    pass


def raise_on_error(report: DataFrame) -> DataFrame:
    """Runner behaviour: error-severity failures abort, warnings do not."""
    bad = report.filter(F.col("status") == "fail").collect()  # one row a declared test
    if bad:
        names = ", ".join(f"{r['check_name']}({r['model']}.{r['column_name']})={r['failures']}" for r in bad)
        raise DataTestFailure(names)
    return report
