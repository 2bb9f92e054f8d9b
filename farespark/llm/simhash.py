"""SimHash near-dedup with pigeonring filtering.

A text is lower-cased (A-Z), cut into words at ASCII white space and into
shingles of ``shingle`` words. Its 64-bit fingerprint has a bit set where more
than half of the shingles' XXH64 values (seed 42) have it set. Fingerprints at
``max_bits`` or fewer differing bits are linked; groups are the components.

Candidates by the pigeonring principle: the 64 bits are a ring of 16 segments.
If two fingerprints differ in at most d bits, then from some segment on every
chain of l consecutive segments differs in at most l*d/16 bits. For d = 4
that leaves no difference in the first three segments and at most one bit in
the four after them. So both sides are dealt out by (start, first segments,
the chain with one segment left out): the segment left out is the one that may
differ. The whole chain of growing budgets is checked before a pair counts;
its last step is the Hamming distance.

Equal fingerprints are one node, so exact copies and repeated rows cost one
row after a partial aggregation. Large buckets are compared in pieces
(``buckets.links``).

Defined results: null and empty texts, and texts with white space only, have
no words and fingerprint 0, linked like any other; a text with fewer words
than a shingle is one shingle. A null id gets a fingerprint, but is no name
for a component. Repeated rows come back as often as they went in. An empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm import buckets
from farespark.llm.common import land, table, text_of
from farespark.llm.components import components

SEGMENTS = 16
_BITS = 64 // SEGMENTS
SEED = 42
_SOME = 200_000


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit fingerprint of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SOME):
        h = [xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts[at : at + _SOME], ends[at : at + _SOME])]
        bits = np.unpackbits(np.array(h, np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _chain(max_bits: int) -> tuple[int, int]:
    """(segments at the start of a chain that may not differ, segments of the chain with budget one)."""
    budget = [length * max_bits // SEGMENTS for length in range(1, SEGMENTS + 1)]
    exact = budget.count(0)
    return exact, sum(b <= 1 for b in budget)


def _keys(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Bucket keys of fingerprints, one row each: (start, segment left out) and the other bits of the chain."""
    exact, chain = _chain(max_bits)
    chain = min(chain, SEGMENTS)
    out, bits = [], fps.astype("<i8").view(np.uint64)
    for s in range(SEGMENTS):
        turn = np.uint64(s * _BITS)
        ring = (bits >> turn) | (bits << np.uint64((64 - s * _BITS) % 64)) if s else bits
        ring = ring & np.uint64((1 << (chain * _BITS)) - 1 if chain < SEGMENTS else 0xFFFFFFFFFFFFFFFF)
        for left in range(exact, chain):
            rest = ring & ~np.uint64(((1 << _BITS) - 1) << (left * _BITS))
            key = (rest ^ np.uint64((s * SEGMENTS + left) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
            out.append(key ^ (key >> np.uint64(32)))
    return np.stack(out, axis=1).view(np.int64) if out else np.zeros((len(fps), 1), np.int64)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """True where a chain of segments keeps to its budgets all round the ring."""
    x = (a ^ b).view(np.uint64)
    # At most max_bits of 64 differ in nearly no pair: the last step of the chain comes first where it is cheapest.
    per = np.stack([np.bitwise_count((x >> np.uint64(i * _BITS)) & np.uint64((1 << _BITS) - 1)) for i in range(SEGMENTS)], axis=1).astype(np.int16)
    budget = np.arange(1, SEGMENTS + 1) * max_bits // SEGMENTS
    found = np.zeros(len(x), bool)
    for s in range(SEGMENTS):
        todo = np.flatnonzero(~found)
        for length in range(1, SEGMENTS + 1):
            if not len(todo):
                break
            cols = [(s + i) % SEGMENTS for i in range(length)]
            todo = todo[per[todo][:, cols].sum(axis=1) <= budget[length - 1]]
        found[todo] = True
    return found


def _compare(max_bits: int):
    budget_one = _chain(max_bits)[1]

    def chains(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (a ^ b).view(np.uint64)
        ok = np.bitwise_count(x) <= max_bits if budget_one >= SEGMENTS else _near_some(x)
        return ok

    def _near_some(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for at in range(0, len(x), 1 << 20):
            part = x[at : at + (1 << 20)].view(np.int64)
            out[at : at + (1 << 20)] = _near(part, np.zeros_like(part), max_bits)
        return out

    def compare(rows: pd.DataFrame, other: pd.DataFrame | None):
        none = np.empty(0, np.int64)
        key, fp = rows["key"].to_numpy(), rows["id"].to_numpy()
        a, b = [], []
        if other is not None:
            far = other["id"].to_numpy()
            for x in fp:
                hit = chains(np.full(len(far), x), far)
                a.append(np.full(int(hit.sum()), x))
                b.append(far[hit])
        else:
            # Rows are sorted by key: rows d apart share a bucket or none further apart do.
            i = np.arange(len(key))
            d = 1
            while True:
                i = i[i + d < len(key)]
                i = i[key[i] == key[i + d]]
                if not len(i):
                    break
                hit = i[chains(fp[i], fp[i + d])]
                a.append(fp[hit])
                b.append(fp[hit + d])
                d += 1
        return np.concatenate(a or [none]), np.concatenate(b or [none]), none, none

    return compare


def near_fingerprints(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fp, root): for every distinct fingerprint with a near one, the smallest fingerprint of its component."""
    distinct = fps.select("fp").where("fp is not null").distinct()

    def dealt(frames):
        for f in frames:
            for at in range(0, len(f), 20_000):
                fp = f["fp"].to_numpy()[at : at + 20_000]
                keys = _keys(fp, max_bits)
                yield pd.DataFrame({"key": keys.ravel(), "id": np.repeat(fp, keys.shape[1])})

    rows = distinct.mapInPandas(dealt, "key long, id long").selectExpr("key", "id", "0L as w", "cast(null as binary) as body")
    found = buckets.links(rows, _compare(max_bits), "simhash")
    edges = found.where(F.col("kind") == buckets.EDGE).select(F.col("x").alias("u"), F.col("y").alias("v"))
    return components(edges).select(F.col("node").alias("fp"), F.col("component").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: (id, fp long, component = smallest id of its group)."""
    return _grouped(docs, id_col, text_col, shingle, max_bits).select("id", "fp", "component")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """id, fp, text_hash, root (names the group) and component of every document."""
    text = text_of(docs, text_col)
    fps = land(
        docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint(text, shingle).alias("fp"), F.xxhash64(text).alias("text_hash")),
        "simhash-fp",
    )
    named = fps.groupBy("fp").agg(F.min("id").alias("least"))
    roots = named.join(near_fingerprints(fps, max_bits), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = land(roots, "simhash-roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component"))
    return fps.join(roots.join(least, "root").select("fp", "root", "component"), "fp")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = near_groups(table(spark, sf_dir, "documents"))
    return g.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each group: the one with the smallest id (a null id only if there is no other).

    Rows that repeat an id and its text count as one document.
    """
    g = _grouped(docs, "doc_id", "text", shingle, max_bits)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    first = land(
        g.groupBy("root", "id", "text_hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root")
        .agg(F.min_by(F.struct("id", "text_hash", "n"), order).alias("k"))
        .select("k.*"),
        "simhash-first",
    )

    def those(keys: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(keys["id"]) & (F.xxhash64(text_of(docs)) == keys["text_hash"])
        return docs.join(keys, same, "left_semi")

    return those(first.where("n = 1")).unionByName(those(first.where("n > 1")).dropDuplicates(["doc_id", "text"]))
