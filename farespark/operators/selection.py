"""Discrete percentiles of large groups by distributed selection.

``percentile_disc`` collects a group's values in one task. Here the value of a
rank is found digit by digit: a histogram of the leading ``BITS`` bits is a
partial aggregate, the digit that holds the rank is chosen from it, and only
values with that digit go on to the next histogram. A task sees at most
``2 ** BITS`` histogram rows of a group and percentile, never its values; the
chosen digits reach the values by a join on (group, digit, salt), so the
values of a hot group are spread over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a digit; three digits cover the values.
BITS, LEVELS = 14, 3
#: Smallest and largest value that fits (decimal(12,2) in hundredths does).
LOW, HIGH = -(1 << (BITS * LEVELS - 1)), (1 << (BITS * LEVELS - 1)) - 1
#: Parts that the values of one digit are joined in.
SALTS = 16


def _all_same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _chosen(hist: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """keys, _digit, _before: the first digit of each group whose running count reaches ``rank`` (a column of ``hist``)."""
    running = Window.partitionBy(*keys).orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_cum", F.sum("_c").over(running)).withColumn("_rank", rank)
    least = F.min(F.when(F.col("_cum") >= F.col("_rank"), F.struct("_digit", (F.col("_rank") - F.col("_cum") + F.col("_c")).alias("_left"))))
    return cum.groupBy(*keys).agg(least.alias("_p")).select(*keys, F.col("_p._digit").alias("_digit"), F.col("_p._left").alias("_left"))


def percentiles_by_selection(counts: DataFrame, keys: list[str], value: str, count: str, probs: list[float]) -> DataFrame:
    """keys, q0, q1, ... (long): for each probability p the smallest value whose cumulative count is at least p * n.

    ``counts`` has one or several rows a (group, value): value a long between
    ``LOW`` and ``HIGH`` (rows with a null value do not count, larger ones
    raise), count a positive long. Null keys are a group. Groups without a
    value have no row.
    """
    fits = F.col(value).between(LOW, HIGH)
    shifted = F.when(fits, F.col(value) - LOW).otherwise(F.raise_error(F.lit("value out of range"))).cast("long")
    rows = counts.where(F.col(value).isNotNull()).select(*keys, shifted.alias("_v"), F.col(count).alias("_c"), F.pmod(F.xxhash64(value), F.lit(SALTS)).alias("_salt"))
    top = F.shiftright("_v", BITS * (LEVELS - 1))
    hist = rows.groupBy(*keys, top.alias("_digit")).agg(F.sum("_c").alias("_c"))
    n = F.sum("_c").over(Window.partitionBy(*[k for k in keys if k != "_q"]))
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    first = hist.withColumn("_n", n).withColumn("_a", asked).withColumn("_q", F.col("_a.q"))
    rank = F.greatest(F.ceil(F.col("_a.p") * F.col("_n")).cast("long"), F.lit(1).cast("long"))
    by = [*keys, "_q"]
    picks = _chosen(first, by, rank)
    for level in range(1, LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        spread = picks.withColumnRenamed("_digit", "_prefix").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        r = rows.withColumn("_prefix", F.shiftright("_v", shift + BITS)).alias("r")
        on = _all_same("r", "s", [*keys]) & (F.col("r._prefix") == F.col("s._prefix")) & (F.col("r._salt") == F.col("s._salt"))
        hit = r.join(spread.alias("s"), on).select(*[F.col(f"r.{k}") for k in keys], "s._q", "s._left", F.shiftright("r._v", shift).alias("_digit"), "r._c")
        hist = hit.groupBy(*by, "_left", "_digit").agg(F.sum("_c").alias("_c"))
        picks = _chosen(hist, by, F.col("_left"))
    found = picks.withColumn("_value", F.col("_digit") + LOW)
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == i, F.col("_value"))).alias(f"q{i}") for i in range(len(probs))])
