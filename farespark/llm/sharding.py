"""Resharding by minimum-cost flow: the block transfers that move the fewest bytes.

Old shards supply the bytes they hold, new shards demand their capacity, and
a byte costs nothing where it stays and one where it moves (or a given cost).
The flow says how many bytes go from which shard to which. It has one node a
shard, so the driver solves it; sizes cover all rows.

A shard's rows are ordered by a hash of the text, and the flow cuts that order
into blocks, one for each receiver. The place of a cut is found from sums by
range of the hash, and only the range with the cut is ordered row by row.
Equal texts have equal hashes and stay together. Large groups (over LARGE of a
shard) come first in the order, where a shard's own block lies, so that cuts fall
between small ones. Only a group of which the copies alone fill over
WHOLE of a shard is ordered by (text, id) and may part. Only shards that
give or take a block are rewritten; the others stay as they are in the old layout.

Law: bytes. Sizes are near equal: each cut is off by at most half a group, a large
one only where an old shard has more of them than its own block holds. On a table of
few documents one text may be a good part of a shard, so sizes differ by that much.

Defined results: a null text has no bytes and size 1; null ids are a value
like others; rows that repeat each have a slot. An empty table has empty
shards. Other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespark.llm.common import table
from farespark.session import scratch_path

N_OLD, N_NEW = 6, 8
#: A group of equal texts that fills this part of a shard is large: it comes first in its shard's order.
LARGE = 0.01
#: A group that fills more than this part of a shard cannot stay whole beside near equal sizes.
WHOLE = 0.5
_RANGES = 12  # bits: ranges of the hash in which sizes are summed


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """flow[i][j] that ships all supply to the demand at the least cost, by successive shortest paths."""
    m, n = len(supply), len(demand)
    flow = [[0] * n for _ in range(m)]
    left, want = list(supply), list(demand)
    while any(left) and any(want):
        # Shortest path from any row with something left to any column that wants more; columns lead back along flow.
        far = [0 if x else None for x in left] + [None] * n
        came: list[int | None] = [None] * (m + n)
        for _ in range(m + n):
            changed = False
            for i in range(m):
                for j in range(n):
                    if far[i] is not None and (far[m + j] is None or far[i] + cost[i][j] < far[m + j]):
                        far[m + j], came[m + j], changed = far[i] + cost[i][j], i, True
                    if flow[i][j] and far[m + j] is not None and (far[i] is None or far[m + j] - cost[i][j] < far[i]):
                        far[i], came[i], changed = far[m + j] - cost[i][j], m + j, True
            if not changed:
                break
        j = min((j for j in range(n) if want[j]), key=lambda j: far[m + j])
        path, at = [], m + j
        while came[at] is not None:
            path.append((came[at], at))
            at = came[at]
        amount = min([left[at], want[j], *(flow[b][a - m] for a, b in path if a >= m)])
        left[at] -= amount
        want[j] -= amount
        for a, b in path:
            if a < m:
                flow[a][b - m] += amount
            else:
                flow[b][a - m] -= amount
    return flow


def capacities(total: int, n: int) -> list[int]:
    return [total // n + (j < total % n) for j in range(n)]


@dataclass(frozen=True)
class Transfer:
    """Rows of shard ``old`` with start <= order < stop go to shard ``new``."""

    old: int
    new: int
    start: int
    stop: int
    n_bytes: int


def _order(rows: DataFrame, n_shards: int, whole: float = WHOLE) -> Column:
    """63-bit order of the rows: large groups first, then by the hash of the text, with the id for groups over ``whole``."""
    th = F.xxhash64("text")
    total = rows.agg(F.sum("size")).first()[0] or 0
    sums = rows.groupBy(th.alias("th")).agg(F.sum("size").alias("n"))
    frequent = sums.where(F.col("n") > F.lit(total * min(LARGE, whole) / n_shards)).collect()  # under n_shards / LARGE rows
    parted = [r["th"] for r in frequent if r["n"] > total * whole / n_shards]
    large = sorted({r["th"] for r in frequent} - set(parted))
    low = F.shiftrightunsigned(F.when(th.isin(parted), F.xxhash64("text", "doc_id")).otherwise(th), 2)
    return F.when(th.isin(large), low).otherwise(low.bitwiseOR(F.lit(1 << 62)))


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)


def plan(rows: DataFrame, n_old: int, capacity: list[int], cost: list[list[int]] | None = None) -> list[Transfer]:
    """Blocks of the flow. ``rows``: old (0 to n_old - 1), ord, size."""
    n_new = len(capacity)
    span = F.shiftright("ord", 63 - _RANGES)
    up_to = Window.partitionBy("old").orderBy("span")
    ranges = rows.groupBy("old", span.alias("span")).agg(F.sum("size").alias("n"))
    held = {r["old"]: r["n"] for r in ranges.groupBy("old").agg(F.sum("n").alias("n")).collect()}
    supply = [held.get(i, 0) for i in range(n_old)]
    cost = cost or [[int(i != j) for j in range(n_new)] for i in range(n_old)]
    flow = min_cost_flow(supply, capacity, cost)
    cuts = []  # (old, bytes before the cut) between the receivers of a shard
    for i, row in enumerate(flow):
        at = 0
        for j in [j for j in range(n_new) if row[j]][:-1]:
            at += row[j]
            cuts.append((i, at))
    where: dict[tuple[int, int], int] = {}
    if cuts:
        wanted = rows.sparkSession.createDataFrame(cuts, "old int, cut long")
        ends = ranges.withColumn("end", F.sum("n").over(up_to))
        at = (
            ends.join(F.broadcast(wanted), "old")  # fewer rows than shards on either side together
            .where("end - n < cut and cut <= end")
            .select("old", "cut", "span", (F.col("end") - F.col("n")).alias("before"))
        )
        places = [tuple(r) for r in at.collect()]
        inside = rows.withColumn("span", span).join(F.broadcast(rows.sparkSession.createDataFrame(places, "old int, cut long, span long, before long")), ["old", "span"])
        order = Window.partitionBy("old", "cut").orderBy("ord").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        groups = inside.groupBy("old", "cut", "before", "ord").agg(F.sum("size").alias("n")).withColumn("end", F.col("before") + F.sum("n").over(order))
        # A group that straddles the cut goes to the side that holds more of it.
        below = groups.where("end - n / 2 <= cut").groupBy("old", "cut").agg(F.max("ord").alias("last")).collect()
        low = {(r["old"], r["cut"]): r["last"] + 1 for r in below}
        where = {(o, c): low.get((o, c), s << (63 - _RANGES)) for o, c, s, _ in places}
    out = []
    for i, row in enumerate(flow):
        at, start = 0, 0
        receivers = [j for j in range(n_new) if row[j]]
        for j in receivers:
            at += row[j]
            stop = where[(i, at)] if j != receivers[-1] else 1 << 63
            out.append(Transfer(i, j, start, stop, row[j]))
            start = stop
    return out


def assigned(blocks: list[Transfer]) -> Column:
    """The new shard of a row by its old one and its place in the order."""
    c = F.lit(None).cast("int")
    for t in blocks:
        upper = F.lit(True) if t.stop >= 1 << 63 else F.col("ord") < F.lit(t.stop)
        c = F.when((F.col("old") == t.old) & (F.col("ord") >= F.lit(t.start)) & upper, F.lit(t.new)).otherwise(c)
    return c


def affected(blocks: list[Transfer], n_old: int, n_new: int) -> list[int]:
    """New shards of which the files change: those that take rows from elsewhere or have given some away."""
    gives = {t.old for t in blocks if t.old != t.new}
    takes = {t.new for t in blocks if t.old != t.new}
    return sorted(j for j in range(n_new) if j in gives | takes or j >= n_old)


def write_shards(rows: DataFrame, path: str, only: list[int]) -> None:
    """Rewrites the shards of ``only``, one folder each; large ones in several files."""
    rows.where(F.col("shard").isin(only)).hint("rebalance", "shard").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def slots(rows: DataFrame) -> Column:
    """Number of a row within its shard, from 0 without gaps, given ``before``: rows of the shard in earlier ranges."""
    return F.col("before") + F.row_number().over(Window.partitionBy("shard", "span").orderBy("ord", "doc_id")) - 1


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grows a layout of N_OLD shards, dealt by the hash of the text, to N_NEW of near equal bytes."""
    docs = sized(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.withColumn("ord", _order(docs, N_NEW)).withColumn("old", F.pmod(F.col("ord"), F.lit(N_OLD)).cast("int"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    blocks = plan(rows.select("old", "ord", "size"), N_OLD, capacities(total, N_NEW))
    path = scratch_path(spark, "sharding")
    dealt = rows.withColumn("shard", assigned(blocks))
    written = affected(blocks, N_OLD, N_NEW) if blocks else []
    write_shards(dealt, path, written)
    files = spark.read.schema("doc_id long, text string, size long, ord long, old int, shard int").parquet(path)
    # A shard that already holds its capacity and keeps all its rows has no new files.
    stay = sorted({t.new for t in blocks} - set(written))
    if stay:
        files = files.unionByName(dealt.where(F.col("shard").isin(stay)).select(*files.columns))
    kept = files.select(
        "doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), "shard", "ord", F.shiftrightunsigned(F.xxhash64("doc_id", "ord"), 64 - _RANGES).alias("span")  # a large group is in all of them
    )
    ranges = kept.groupBy("shard", "span").agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("span")) - F.col("n"))
    return kept.join(ranges.drop("n"), ["shard", "span"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        slots(kept).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
