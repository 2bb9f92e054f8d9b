"""Comparing rows that share a bucket key, without emitting the pairs.

Rows are dealt out by the key and sorted, and each task streams through its
buckets. A bucket of up to ``piece`` rows is compared on the spot. A larger
one is cut into pieces: each piece is compared with itself, and the pieces
are written out and compared with one another in a second job, two at a
time. A task never holds more than two pieces, whatever the size of a bucket.

A comparison returns links as a spanning forest (enough for components) and
the number of links of each row, so the number of rows out is bounded by the
number of rows in, not by the number of pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespark.llm.common import land

EDGE, COUNT, PIECE = 0, 1, 2
_OUT = "kind int, x long, y long, piece long, w long, body binary"
_COLS = ["kind", "x", "y", "piece", "w", "body"]


def pieces(frames: Iterable[pd.DataFrame], piece: int) -> Iterator[tuple[pd.DataFrame, int]]:
    """(rows, number) from rows sorted by key: whole small buckets with number -1, or one piece of a large bucket."""
    rest, number = None, 0  # the bucket that may go on, and the number of its next piece
    for f in frames:
        cur = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if cur.empty:
            continue
        key = cur["key"].to_numpy()
        last = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])
        yield from _closed(cur.iloc[:last], piece, number)
        number = 0 if last else number
        rest = cur.iloc[last:]
        while len(rest) > piece:
            yield rest.iloc[:piece], number
            rest, number = rest.iloc[piece:], number + 1
    if rest is not None:
        yield from _closed(rest, piece, number)


def _closed(rows: pd.DataFrame, piece: int, number: int) -> Iterator[tuple[pd.DataFrame, int]]:
    """Whole buckets; ``number`` pieces of the first one have gone before."""
    if rows.empty:
        return
    key = rows["key"].to_numpy()
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
    large = ends - starts > piece
    large[0] |= number > 0
    if not large.all():
        yield rows[np.repeat(~large, ends - starts)], -1
    for i in np.flatnonzero(large):
        n = 0 if i else number
        for s in range(starts[i], ends[i], piece):
            yield rows.iloc[s : min(s + piece, ends[i])], n
            n += 1


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links a-b: each node with the smallest node it reaches."""
    if not len(a):
        return a, b
    ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    m = root != np.arange(len(ids))
    return ids[m], ids[root[m]]


def _frame(kind, x, y, piece=0, w=0, body=None) -> pd.DataFrame:
    out = pd.DataFrame({"kind": np.full(len(x), kind, "i4"), "x": x, "y": y})
    out["piece"] = piece
    out["w"] = w
    out["body"] = body
    return out[_COLS]


def _told(found) -> Iterator[pd.DataFrame]:
    """found: a, b (ids linked), and ids, counts (links of each row, or empty)."""
    a, b, ids, n = found
    u, v = forest(a, b)
    if len(u):
        yield _frame(EDGE, u, v)
    if len(ids):
        ids, inv = np.unique(ids, return_inverse=True)
        yield _frame(COUNT, ids, np.bincount(inv, weights=n).astype("i8"))


#: compare(rows, other): links inside each bucket of ``rows`` (other is None), or between the pieces ``rows`` and ``other``.
Compare = Callable[[pd.DataFrame, pd.DataFrame | None], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def links(rows: DataFrame, compare: Compare, name: str, piece: int = 2048) -> DataFrame:
    """(kind, x, y): EDGE x-y of a spanning forest of each task's links; COUNT y links of row x.

    ``rows``: key (long), id (long), w (long), body (binary). The result is landed.
    """

    def within(frames):
        for part, number in pieces(frames, piece):
            yield from _told(compare(part, None))
            if number >= 0:
                yield _frame(PIECE, part["key"], part["id"], number, part["w"], part["body"])

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        i = pdf["piece"].min()
        told = _told(compare(pdf[pdf["piece"] == i], pdf[pdf["piece"] != i]))
        return pd.concat([_frame(EDGE, np.empty(0, "i8"), np.empty(0, "i8")), *told], ignore_index=True)

    first = land(
        rows.select("key", "id", "w", "body").repartition("key").sortWithinPartitions("key", "id").mapInPandas(within, _OUT),
        f"{name}-links",
    )
    hot = first.where(F.col("kind") == PIECE).select(F.col("x").alias("key"), F.col("y").alias("id"), "piece", "w", "body")
    last = hot.groupBy("key").agg(F.max("piece").alias("last"))
    dealt = (
        hot.join(last, "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .where("other != piece")
        .withColumn("i", F.least("piece", "other"))
        .withColumn("j", F.greatest("piece", "other"))
    )
    second = dealt.groupBy("key", "i", "j").applyInPandas(between, _OUT)
    return first.where(F.col("kind") != PIECE).select("kind", "x", "y").unionByName(second.select("kind", "x", "y"))

