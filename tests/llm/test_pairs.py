"""Near-duplicate operators against brute force over all pairs."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from farespark.llm import buckets, lattice, simhash
from farespark.llm.components import components
from tests.llm.conftest import bag, rows_of, texts_of


def least_of_groups(n: int, pairs) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def naive_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op9(spark, request, where):
    d = request.getfixturevalue(where)
    docs = texts_of(spark, d)
    fps = [naive_fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    group = least_of_groups(len(fps), pairs)
    least = {}
    for (i, _), g in zip(docs, group):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = [(i, f"{f:016x}", least[g]) for (i, _), f, g in zip(docs, fps, group)]
    got = simhash.op9_simhash(spark, d).collect()
    assert bag((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == bag(want)


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 6])
def test_near_fingerprints(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    base = rng.integers(-(1 << 62), 1 << 62, 60)
    flips = [sum(1 << int(b) for b in rng.choice(63, n, replace=False)) for n in rng.integers(0, 8, 240)]
    fps = np.unique(np.concatenate([base, np.repeat(base, 4) ^ np.array(flips)]))
    near = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64)) <= max_bits
    group = least_of_groups(len(fps), [p for p in np.argwhere(near).tolist() if p[0] != p[1]])
    want = {}
    for f, g in zip(fps.tolist(), group):
        want.setdefault(g, []).append(f)
    want = {f: min(v) for v in want.values() if len(v) > 1 for f in v}
    got = simhash.near_fingerprints(spark.createDataFrame([(int(f),) for f in fps], "fp long"), max_bits).collect()
    assert {r["fp"]: r["root"] for r in got} == want


def test_keep_first(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in simhash.op9_simhash(spark, edge).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(groups) and set(ids) == groups


def naive_links(rows) -> list[tuple]:
    usable = []
    for r in rows:
        v = r["embedding"]
        ok = r["vec_id"] is not None and r["label"] is not None and v and None not in v and np.isfinite(v).all() and any(v)
        usable.append(np.array(v, "f8") / np.linalg.norm(np.array(v, "f8")) if ok else None)
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if usable[i] is not None and usable[j] is not None and rows[i]["label"] == rows[j]["label"] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= 0.93
    ]
    n = np.bincount(np.array(pairs, int).ravel(), minlength=len(rows))
    group = least_of_groups(len(rows), pairs)
    out = []
    for i, r in enumerate(rows):
        c = min((rows[j]["vec_id"] for j in range(len(rows)) if group[j] == group[i] and rows[j]["vec_id"] is not None), default=None)
        out.append((r["vec_id"], int(n[i]), c, c is None or c == r["vec_id"]))
    return out


@pytest.mark.parametrize("where", ["edge", "empty"])
def test_op3_edges(spark, request, where):
    d = request.getfixturevalue(where)
    got = lattice.op3_lattice(spark, d).select("vec_id", "n_links", "component_id", "kept").collect()
    assert bag(got) == bag(naive_links(rows_of(spark, d, "embeddings")))


def test_op3_recall(spark, small):
    want = {r[0]: r for r in naive_links(rows_of(spark, small, "embeddings"))}
    got = {r["vec_id"]: r for r in lattice.op3_lattice(spark, small).collect()}
    assert got.keys() == want.keys()
    assert all(got[i]["n_links"] <= want[i][1] for i in want)  # no link below the bound
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(r[1] for r in want.values())


@pytest.mark.parametrize("dim", [64, 256])
def test_op3_recall_of_planted_pairs(spark, tmp_path, dim):
    """Pairs planted just above the bound are found, pairs just below it are not."""
    rng = np.random.default_rng(dim)
    rows, above = [], set()
    for i, cosine in enumerate(np.tile([0.931, 0.94, 0.96, 0.929], 100)):
        a, b = rng.standard_normal((2, dim))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), i % 3), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist(), i % 3)]
        if cosine >= 0.93:
            above |= {2 * i, 2 * i + 1}
    # Doubles, as vectors of floats may fall below the bound.
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").write.parquet(str(tmp_path / "embeddings.parquet"))
    linked = {r["vec_id"] for r in lattice.op3_lattice(spark, str(tmp_path)).where("n_links > 0").collect()}
    assert linked <= above and len(linked) >= 0.9 * len(above)


def test_e8_points_are_nearest():
    x = np.random.default_rng(1).standard_normal((300, 8)) * 2
    got = lattice.decode_e8(x)
    ints, halves = (got % 2 == 0).all(axis=1), (got % 2 == 1).all(axis=1)
    assert (ints | halves).all() and ((got.sum(axis=1) % 4) == 0).all()
    away = ((x * 2 - got) ** 2).sum(axis=1)
    for step in lattice._NEAR:
        assert (away <= ((x * 2 - got - step) ** 2).sum(axis=1) + 1e-9).all()


@pytest.mark.parametrize("piece", [2, 5, 100])
def test_large_buckets_lose_no_link(spark, piece):
    """All rows of a bucket linked: counts are whole, whatever the size of the pieces."""
    rows = [(k, k * 100 + i, 1, None) for k, n in ((1, 23), (2, 1), (3, 5)) for i in range(n)]

    def compare(x: pd.DataFrame, other):
        a, b = [], []
        for _, part in x.groupby("key"):
            ids = part["id"].tolist()
            if other is not None:
                far = other[other["key"] == part["key"].iloc[0]]["id"].tolist()
                new = [(i, j) for i in ids for j in far]
            else:
                new = [(i, j) for i in ids for j in ids if i < j]
            a += [i for i, _ in new]
            b += [j for _, j in new]
        a, b = np.array(a, "i8"), np.array(b, "i8")
        return a, b, np.concatenate([a, b]), np.ones(2 * len(a), "i8")

    found = buckets.links(spark.createDataFrame(rows, "key long, id long, w long, body binary"), compare, "test-links", piece)
    n = {}
    for r in found.where("kind = 1").collect():
        n[r["x"]] = n.get(r["x"], 0) + r["y"]
    assert n == {k * 100 + i: m - 1 for k, m in ((1, 23), (3, 5)) for i in range(m)}
    got = components(found.where("kind = 0").selectExpr("x as u", "y as v")).collect()
    assert {r["node"]: r["component"] for r in got} == {k * 100 + i: k * 100 for k, m in ((1, 23), (3, 5)) for i in range(m)}


def test_components_of_a_long_chain(spark):
    e = [(i, i + 1) for i in range(200)] + [(500, 500), (None, 3), (700, 600), (600, 700)]
    got = components(spark.createDataFrame(e, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(201)} | {600: 600, 700: 600}
