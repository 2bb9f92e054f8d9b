"""Suffix-array dedup against all windows in a dictionary."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from farespark.llm import passages
from farespark.llm.suffix_arrays import common_prefixes, repeated_windows, suffix_array
from tests.llm.conftest import bag, texts_of


def naive(docs, length: int) -> list[tuple]:
    data = [t.encode() for _, t in docs]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(docs, data):
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(d) else 0
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op5(spark, request, where):
    d = request.getfixturevalue(where)
    got = passages.op5_suffix_array(spark, d).collect()
    assert bag(got) == bag(naive(texts_of(spark, d), passages.LENGTH))


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_gram_over_many_shards(spark, piece):
    """One k-gram in many different snippets: shards are merged by ranges."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcde"), 12)) for _ in range(12)]
    middle = "the very same words in the middle of all of them " * 2
    docs = [(i, " ".join(rng.choice(words, 6)) + middle + " ".join(rng.choice(words, 6))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = passages.without_repeats(df, 100, piece).selectExpr("doc_id", "_cut.n_removed", "_cut.n_spans", "sha2(_cut.kept, 256)").collect()
    assert bag(got) == bag((r[0], *r[2:]) for r in naive(docs, 100))


def test_stage_keeps_columns(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    cut = passages.cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert text[9] is not None and len(text[9]) < 60 and text[3] == "short" and text[0] is None


def test_runs_and_periods(spark):
    """Runs of one character and of short periods have few anchors, and their windows are cut as any others."""
    assert len(list(passages.anchors(b"z" * 500_000))) <= 3
    assert len(list(passages.anchors(b"ab, " * 100_000))) <= 6
    docs = [(0, "z" * 3000), (1, "start " + "z" * 700 + " end"), (2, "xyz" * 400), (3, "q" + "zxy" * 300), (4, "ab, " * 150 + "once"), (5, "b, a" * 90), (6, "z" * 400), (7, "y" * 400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = passages.without_repeats(df).selectExpr("doc_id", "_cut.n_removed", "_cut.n_spans", "sha2(_cut.kept, 256)").collect()
    assert bag(got) == bag((r[0], *r[2:]) for r in naive(docs, passages.LENGTH))


def words_and_bytes(texts: list[str], words: int, length: int) -> list[bytes]:
    """What is left after cutting windows of ``length`` bytes found anywhere else and of ``words`` words found in other rows."""
    data = [t.encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    window = lambda d, p, i: b" ".join(d[a:b] for a, b in p[i : i + words])
    rows = Counter(w for d, p in zip(data, places) for w in {window(d, p, i) for i in range(len(p) - words + 1)})
    out = []
    for d, p in zip(data, places):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        for i in range(len(p) - words + 1):
            if rows[window(d, p, i)] > 1:
                gone[p[i][0] : p[i + words - 1][1]] = True
        out.append(bytes(np.frombuffer(d, np.uint8)[~gone]).decode("utf-8", "ignore").encode())
    return out


def test_stage_cuts_short_passages_of_many_words(spark):
    """Over 50 words in fewer than 400 bytes: not a repeat by bytes, but one by words, in two documents or more."""
    passage = " ".join(f"w{i}" for i in range(53))
    assert len(passage) < passages.LENGTH
    alone = " ".join(f"x{i}" for i in range(53))
    docs = [(0, f"one {passage} end"), (1, "two\n" + passage.replace(" ", "\n") + " fin"), (2, f"{alone} and again {alone}"), (3, " ".join(passage.split()[:49])), (4, None), (None, f"no id {passage}")]
    got = {r["doc_id"]: r["text"] for r in passages.cut_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {0: "one  end", 1: "two\n fin", 2: docs[2][1], 3: docs[3][1], 4: None, None: "no id "}


def test_op5_goes_by_bytes_only(spark, tmp_path):
    """The contract's 400 bytes decide, not the stage's words: a passage of 60 words and 399 bytes stays, one of 400 goes."""
    passage = " ".join(f"w{i:04d}" for i in range(60)) + "x" * 41
    assert len(passage) == 400 == passages.LENGTH and len(passage.split()) > passages.WORDS
    docs = [(0, f"<{passage[:-1]}>"), (1, f"({passage[:-1]})"), (2, f"[{passage[::-1]}]"), (3, f"{{{passage[::-1]}}}")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = passages.op5_suffix_array(spark, str(tmp_path)).collect()
    assert bag(got) == bag(naive(docs, passages.LENGTH))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in got} == {0: (401, 0), 1: (401, 0), 2: (402, 400), 3: (402, 400)}


@pytest.mark.parametrize("seed", range(3))
def test_words_against_all_windows(spark, seed):
    """Passages over one another, in copies, in rows that come twice, in runs of one word and of short periods."""
    rng = np.random.default_rng(seed)
    say = lambda n, of=60: " ".join(rng.choice([f"é{i}" if i % 7 == 0 else f"w{i}" for i in range(of)], n))
    base = [say(90).split() for _ in range(5)]
    texts = ["a " * 300, "x " + "a " * 70 + "y", "a " * 49, "p q r " * 60, "s " + "q r p " * 25, ""]
    for _ in range(40):
        t = base[rng.integers(5)]
        lo, n = int(rng.integers(40)), int(rng.integers(20, 80))
        sep = rng.choice([" ", "\n", " \t"])
        texts.append(say(int(rng.integers(30)), 400) + " " + sep.join(t[lo : lo + n]) + " " + say(int(rng.integers(30)), 400))
    texts += texts[-3:]
    docs = [(i, t) for i, t in enumerate(texts)] + [(6, texts[6])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = [(r["doc_id"], r["text"].encode()) for r in passages.cut_repeats(df).collect()]
    assert bag(got) == bag(zip([i for i, _ in docs], words_and_bytes([t for _, t in docs], passages.WORDS, passages.LENGTH)))


def test_word_anchors_of_long_texts(monkeypatch):
    """Few anchors in runs and periods; stretches own all windows once."""
    assert len(list(passages.word_anchors(b"z " * 500_000))) <= 8
    data = " ".join(f"w{i * i % 997}" for i in range(3000)).encode()
    monkeypatch.setattr(passages, "_STRETCH_WORDS", 700)
    found = list(passages.word_anchors(data))
    assert [w for r in found for w in range(r[2], r[4] + 1)] == list(range(3000 - passages.WORDS + 1))
    split = data.split()
    assert all(data[r[5] : r[6]] == b" ".join(split[r[2] : r[3] + passages.WORDS]) for r in found)


def test_columns_of_any_name(spark):
    same = "the same passage in both of them, word by word; " * 12
    docs = spark.createDataFrame([(0, "a " + same, 1, "x", 2, 3), (1, "b " + same, 4, "y", 5, 6)], "doc_id long, text string, _cut int, _spans string, _SPAN_ID int, _span_hash int")
    got = passages.cut_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r)[2:] for r in got.collect()) == [(1, "x", 2, 3), (4, "y", 5, 6)]


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 1 + seed, int(rng.integers(1, 400))).astype(np.uint8)
    data, order = bytes(text), suffix_array(text)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    lcp = common_prefixes(text, order, 30, lanes=16).tolist()
    for k in range(1, len(order)):
        a, b = data[order[k - 1] :], data[order[k] :]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == min(same, 30)
    valid = np.arange(len(text)) <= len(text) - 10
    repeated, _ = repeated_windows(text, valid, 10)
    seen = Counter(data[i : i + 10] for i in range(max(0, len(data) - 9)))
    assert repeated.tolist() == [bool(v) and seen[data[i : i + 10]] > 1 for i, v in enumerate(valid)]
