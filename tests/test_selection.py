"""Discrete percentiles by distributed selection, against sorting each group."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from farespark.operators.selection import HIGH, LOW, percentiles_by_selection

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def plain(rows) -> list[tuple]:
    groups: dict = {}
    for k, v, n in rows:
        if v is not None:
            groups.setdefault(k, []).extend([v] * n)
    return [(k, *(sorted(vs)[max(math.ceil(p * len(vs)), 1) - 1] for p in PROBS)) for k, vs in groups.items()]


@pytest.mark.parametrize("seed", range(3))
def test_against_sorted_groups(spark, seed):
    rng = np.random.default_rng(seed)
    spans = [(0, 3), (-50, 50), (LOW, HIGH), (10**9, 10**9 + 100_000)]
    rows = [("hot", int(rng.integers(*spans[seed])), int(rng.integers(1, 4))) for _ in range(400)]
    rows += [(str(i % 7) if i % 7 else None, int(rng.integers(*spans[3])), 1) for i in range(60)]
    rows += [("ends", LOW, 1), ("ends", HIGH, 1), ("one", 5, 1), ("none", None, 1), ("hot", None, 2)]
    df = spark.createDataFrame(rows, "k string, v long, n long")
    got = [tuple(r) for r in percentiles_by_selection(df, ["k"], "v", "n", PROBS).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_empty_and_out_of_range(spark):
    df = spark.createDataFrame([("a", HIGH + 1, 1)], "k string, v long, n long")
    assert percentiles_by_selection(df.where("false"), ["k"], "v", "n", [0.5]).collect() == []
    with pytest.raises(PySparkException):
        percentiles_by_selection(df, ["k"], "v", "n", [0.5]).collect()


def test_no_task_takes_a_hot_group(spark):
    """The values of one group reach the histograms by group, digit and salt, not by group alone."""
    df = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("v"), F.lit(1).cast("long").alias("n"))
    plan = percentiles_by_selection(df, ["k"], "v", "n", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and all("_prefix" in j and "_salt" in j for j in joins)
