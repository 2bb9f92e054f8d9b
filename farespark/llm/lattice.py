"""Embedding near-dedup by lattice hashing.

Vectors are scaled to length 1. Each of ``TABLES`` tables projects them to eight
dimensions by a random matrix and decodes the point to the E8 lattice: the
nearer of the nearest points of D8 and of D8 shifted by one half. A vector's
cells in a table are its own and the ``PROBES`` neighbouring cells (of 240)
that it is nearest to. Vectors of one label that share a cell are compared by
cosine in double precision.

Equal vectors are one node with a weight. Cells with many vectors are compared
in pieces (``buckets.links``), and only link counts and a spanning forest come
out. A pair is counted in the first cell that it shares, so it counts once.

Defined results: vectors that are null, zero or hold null or non-finite
components, and rows with a null label, link with nothing and are kept. Null
ids come back with a null component. Vectors of other lengths are compared with their own kind
only. Rows that repeat a vector count each other as links. An empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm import buckets
from farespark.llm.common import land, table
from farespark.llm.components import components

COSINE = 0.93
TABLES = 6
PROBES = 6
#: Lattice cells for one unit of length.
SCALE = 0.9
SEED = 42


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    out.append(v)
    for m in range(256):
        if m.bit_count() % 2 == 0:
            out.append([-1 if m >> i & 1 else 1 for i in range(8)])
    return np.array(out, np.int64)


_NEAR = _shortest()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(odd))
    near[odd, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of each row, doubled (integers)."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    return np.rint(np.where(closer[:, None], b, a) * 2).astype(np.int64)


def _hash(points: np.ndarray, seed: int) -> np.ndarray:
    h = np.full(points.shape[:-1], seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(points.shape[-1]):
        h = (h ^ points[..., i].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Numbers of the cells of each unit vector, (vectors, tables, 1 + probes)."""
    n, dim = unit.shape
    out = np.empty((n, tables, 1 + probes), np.int64)
    rng = np.random.default_rng(SEED)
    for t in range(tables):
        x = unit @ (rng.standard_normal((dim, 8)) * scale)
        home = decode_e8(x)
        pull = (x * 2 - home) @ _NEAR.T  # the nearer a neighbour, the larger
        best = np.argpartition(-pull, probes, axis=1)[:, :probes]
        out[:, t, 0] = _hash(home, t + 1)
        out[:, t, 1:] = _hash(home[:, None, :] + _NEAR[best], t + 1)
    return out


def _unit(bodies, kind: str) -> np.ndarray:
    v = np.stack([np.frombuffer(b, kind) for b in bodies]).astype("f8")
    return v / np.linalg.norm(v, axis=1)[:, None]


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first cell, by table and number, that rows of a and b share (tables, then least number)."""
    out, found = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
    for t in range(a.shape[1]):
        same = (a[:, t, :, None] == b[:, t, None, :]).any(axis=2)
        hit = same.any(axis=1) & ~found
        least = np.where(same, a[:, t], np.iinfo(np.int64).max).min(axis=1)
        out[hit] = least[hit]
        found |= hit
    return out


def _compare(cosine: float, tables: int, probes: int, scale: float, kind: str):
    """Links of rows that share a cell. The body holds the cell's number before the label is mixed in, and the vector."""
    none = np.empty(0, np.int64)

    def opened(rows: pd.DataFrame):
        width = len(rows["body"].iloc[0])
        raw = np.frombuffer(b"".join(rows["body"]), np.uint8).reshape(len(rows), width)
        unit = np.ascontiguousarray(raw[:, 8:]).view(kind).astype("f8")
        return raw[:, :8].copy().view("<i8")[:, 0], unit / np.linalg.norm(unit, axis=1)[:, None]

    def small(key: np.ndarray, unit: np.ndarray):
        """Pairs of places in one bucket: rows d apart share one, or none further apart do."""
        i, d = np.arange(len(key)), 1
        while True:
            i = i[i + d < len(key)]
            i = i[key[i] == key[i + d]]
            if not len(i):
                return
            for at in range(0, len(i), 100_000):
                p = i[at : at + 100_000]
                hit = p[np.einsum("ij,ij->i", unit[p], unit[p + d]) >= cosine]
                yield hit, hit + d
            d += 1

    def large(u: np.ndarray, v: np.ndarray, same: bool):
        for at in range(0, len(u), 1024):
            i, j = np.nonzero(u[at : at + 1024] @ v.T >= cosine - 1e-9)
            i += at
            keep = (i < j) if same else np.ones(len(i), bool)
            i, j = i[keep], j[keep]
            exact = np.einsum("ij,ij->i", u[i], v[j]) >= cosine
            yield i[exact], j[exact]

    def told(pairs, cell, x: pd.DataFrame, u, y: pd.DataFrame, v):
        """ids and weights of the pairs that first meet in this cell."""
        pairs = [p for p in pairs if len(p[0])]
        if not pairs:
            return none, none, none, none
        i, j = (np.concatenate(p) for p in zip(*pairs))
        used_i, used_j = np.unique(i), np.unique(j)
        ci, cj = (cells(w[used], tables, probes, scale) for w, used in ((u, used_i), (v, used_j)))
        mine = np.zeros(len(i), bool)
        for at in range(0, len(i), 50_000):
            s = slice(at, at + 50_000)
            mine[s] = _first_shared(ci[np.searchsorted(used_i, i[s])], cj[np.searchsorted(used_j, j[s])]) == cell[i[s]]
        i, j = i[mine], j[mine]
        a, b = x["id"].to_numpy()[i], y["id"].to_numpy()[j]
        return a, b, np.concatenate([a, b]), np.concatenate([y["w"].to_numpy()[j], x["w"].to_numpy()[i]])

    def compare(rows: pd.DataFrame, other: pd.DataFrame | None):
        out = []
        # Buckets of vectors of other lengths differ in their keys; a chance meeting of hashes links nothing.
        for width, x in rows.groupby(rows["body"].map(len), sort=False):
            cell, u = opened(x)
            if other is not None:
                y = other[other["body"].map(len) == width]
                if len(y):
                    out.append(told(large(u, (v := opened(y)[1]), False), cell, x, u, y, v))
                continue
            key = x["key"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
            size = ends - starts
            some = np.repeat((size > 1) & (size <= 64), size)
            out.append(told(small(key[some], u[some]), cell[some], x[some], u[some], x[some], u[some]))
            for s, e in zip(starts[size > 64], ends[size > 64]):
                out.append(told(large(u[s:e], u[s:e], True), cell[s:e], x.iloc[s:e], u[s:e], x.iloc[s:e], u[s:e]))
        return tuple(np.concatenate([o[k] for o in out] or [none]) for k in range(4))

    return compare


def near_vectors(rows: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, kind: str = "<f8") -> tuple[DataFrame, DataFrame]:
    """(counts: id, n), (groups: node, component). ``rows``: id, label, w, v (array<double>), distinct by label and v.

    ``kind``: numpy type in which components travel, "<f4" if they are single-precision values.
    """

    def dealt(frames):
        for f in frames:
            for at in range(0, len(f), 2000):
                part = f.iloc[at : at + 2000]
                for dim, same in part.groupby(part["v"].map(len)):
                    raw = [np.asarray(v, "f8").astype(kind) for v in same["v"]]
                    c = cells(_unit([r.tobytes() for r in raw], kind), tables, probes, scale).reshape(len(same), -1)
                    label = _hash(np.stack([same["label_hash"].to_numpy(), np.full(len(same), dim)], axis=1), 7)
                    k = c.shape[1]
                    yield pd.DataFrame(
                        {
                            "key": (c ^ label[:, None]).ravel(),
                            "id": np.repeat(same["id"].to_numpy(), k),
                            "w": np.repeat(same["w"].to_numpy(), k),
                            "body": [x.tobytes() + r.tobytes() for r, cs in zip(raw, c.astype("<i8")) for x in cs],
                        }
                    )

    keyed = rows.select("id", "w", "v", F.xxhash64("label").alias("label_hash")).mapInPandas(dealt, "key long, id long, w long, body binary")
    found = buckets.links(keyed, _compare(cosine, tables, probes, scale, kind), "lattice", piece=1024)
    counts = found.where(F.col("kind") == buckets.COUNT).groupBy(F.col("x").alias("id")).agg(F.sum("y").alias("n"))
    edges = found.where(F.col("kind") == buckets.EDGE).select(F.col("x").alias("u"), F.col("y").alias("v"))
    return counts, components(edges)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row. ``vectors``: vec_id, embedding, label."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0)
    # A key of the vector's own: equal arrays are equal values, whatever the sign of a zero.
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))))
    classes = land(rows.where("v is not null").groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w")), "lattice-classes")
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    counts, groups = near_vectors(classes, cosine, kind="<f4" if single else "<f8")
    told = (
        classes.join(counts, "id", "left")
        .join(groups, classes["id"] == groups["node"], "left")
        .select(
            F.col("label").alias("_label"),
            F.col("v").alias("_v"),
            (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("_n"),
            F.coalesce("component", "id").alias("_component"),
        )
    )
    same = (rows["label"] == told["_label"]) & (rows["v"] == told["_v"])
    return rows.join(told, same, "left").select(
        "vec_id",
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_component", "vec_id").cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("_component", "vec_id"), F.lit(True)).alias("kept"),
    )


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
