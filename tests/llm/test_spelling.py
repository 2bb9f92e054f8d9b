"""Spelling variants against a plain search of all edits."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from farespark.llm import spelling
from tests.llm.conftest import bag, texts_of


def plain_words(docs) -> dict[str, int]:
    n: Counter[str] = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words: dict[str, int]) -> list[tuple]:
    by_size: dict[int, list[str]] = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, []) if apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others and words[b := min(others, key=lambda x: (-words[x], x))] >= 5 * words[w]:
            form[w] = b

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()]


COLS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op13(spark, request, where):
    d = request.getfixturevalue(where)
    got = spelling.op13_spelling(spark, d).select(*COLS).collect()
    assert bag(got) == bag(plain(plain_words(texts_of(spark, d))))


@pytest.mark.parametrize("seed", range(3))
def test_variants(spark, seed):
    """Few letters make many near words, runs of one letter, long chains and shared prefixes over several parts."""
    rng = np.random.default_rng(seed)
    made = {"".join(rng.choice(list("abé"), rng.integers(6, 9))) for _ in range(400)} | {"a" * k for k in range(6, 40)} | {"ab" * 900, "ab" * 900 + "a", "ab" * 450 + "b" * 901}
    words = {w: int(6 ** rng.integers(1, 7)) for w in sorted(made)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.variants(df).select(*COLS).collect()
    assert bag(got) == bag(plain(words))


def test_nodes_are_distinct_prefixes(spark):
    """Numbers of the parts together: one for each distinct prefix, whatever the parts."""
    words = sorted({"".join(c) for c in np.random.default_rng(5).choice(list("abc"), (300, 7)).tolist()})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long").withColumn("part", F.lit(0))
    old = spelling.in_order
    for cut in (1, 2, 7, 150):
        try:
            spelling.in_order = lambda d, key, cut=cut: d.drop("part").join(spark.createDataFrame([(w, i // cut) for i, w in enumerate(words)], f"{key} string, part int"), key)
            got = spelling.numbered(df.select("word", "n"), "word", spelling._forward, "id long, word string, n long, nodes array<long>").collect()
        finally:
            spelling.in_order = old
        node = {}
        for r in got:
            for j, x in enumerate(r["nodes"]):
                assert node.setdefault(r["word"][: j + 1], x) == x
        assert len(set(node.values())) == len(node)
        assert len({r["id"] for r in got}) == len(words)
