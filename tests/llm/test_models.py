"""Language ID and toxicity: held-out accuracy, and defined results of odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from farespark.llm import language, toxicity
from tests.llm.conftest import bag, rows_of

LARGER = "/root/testdata/sf0.01"


def auc(scores, labels) -> float:
    s, y = np.array(scores), np.array(labels)
    above = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    return float(above + (s[y == 1][:, None] == s[y == 0][None, :]).mean() / 2)


def test_op6_held_out(spark):
    truth = {r["doc_id"]: r["lang"] for r in rows_of(spark, LARGER, "documents")}
    got = [r for r in language.op6_language(spark, LARGER).collect()]
    assert {r["doc_id"] for r in got} == set(truth)
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]] is not None and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_op8_held_out(spark):
    labels = {r["doc_id"]: r["toxic"] for r in rows_of(spark, LARGER, "labels") if r["toxic"] is not None}
    got = toxicity.op8_toxicity(spark, LARGER).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert auc([r["score"] for r in held], [labels[r["doc_id"]] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


@pytest.mark.parametrize("where", ["edge", "empty"])
def test_odd_rows(spark, request, where):
    d = request.getfixturevalue(where)
    docs = rows_of(spark, d, "documents")
    lang = language.op6_language(spark, d).collect()
    assert bag((r["doc_id"],) for r in lang) == bag((r["doc_id"],) for r in docs)
    by_id = {r["doc_id"]: r for r in lang}
    for i in (0, 1, 2) if docs else ():
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    tox = toxicity.op8_toxicity(spark, d).collect()
    assert bag((r["doc_id"],) for r in tox) == bag((r["doc_id"],) for r in docs)
    assert all(0 <= r["score"] <= 1 for r in tox)
    assert all(r["score"] == 0 for r in tox if r["doc_id"] in (0, 1))


def test_offending_sentence_is_found(spark):
    rng = np.random.default_rng(5)
    plain = [f"word{i}" for i in range(60)]

    def sentence(bad: bool) -> str:
        words = list(rng.choice(plain, 8)) + (["vilest"] if bad else [])
        return " ".join(words) + "."

    rows = []
    for i in range(400):
        toxic = int(i % 4 == 0)
        bad = int(rng.integers(5)) if toxic else -1
        rows.append((i, " ".join(sentence(n == bad) for n in range(5)), toxic))
    df = spark.createDataFrame(rows, "_id long, text string, toxic int")
    model = toxicity.train(df)
    got = toxicity.scored(df, model).collect()
    for r in got:
        said = [r["text"][s["start"] : s["end"]] for s in r["_toxicity"]["sentences"]]
        assert (r["_toxicity"]["score"] >= 0.5) == bool(r["toxic"])
        assert len(said) == r["toxic"] and all("vilest" in s for s in said)


def test_length_alone_is_not_toxic(spark, tmp_path):
    """Clean documents of tens of thousands of sentences stay; the same with one toxic sentence go."""
    rng = np.random.default_rng(7)
    plain = [f"word{i}" for i in range(60)]
    mixed = [f"{a}{i}x" for i in range(12) for a in ("mild", "calm")]  # seen in both kinds of documents

    def sentence(bad: bool = False) -> str:
        words = list(rng.choice(plain, 8)) + (["vilest"] if bad else []) + ([str(rng.choice(mixed))] if rng.random() < 0.02 else [])
        return " ".join(words) + "."

    rows = []
    for i in range(600):
        toxic = int(i % 5 == 0)
        bad = int(rng.integers(30)) if toxic else -1
        rows.append((i, " ".join(sentence(n == bad) for n in range(30)), toxic))
    long = [sentence() for _ in range(40_000)]
    texts = {1000: " ".join(long), 1001: " ".join([*long[:25_000], sentence(True), *long[25_000:]]), 1002: "Nothing known here. " * 50_000}
    docs = [(i, t) for i, t, _ in rows] + list(texts.items())
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: r for r in toxicity.op8_toxicity(spark, str(tmp_path)).collect()}
    assert [got[i]["predicted"] for i in texts] == [0, 1, 0]
    assert got[1001]["n_offending"] == 1 and got[1000]["n_offending"] == got[1002]["n_offending"] == 0
    kept = toxicity.drop_toxic(*(spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "labels")))
    assert {r["doc_id"] for r in kept.collect()} & set(texts) == {1000, 1002}


def test_clean_words_do_not_crowd_out_toxic_ones(spark):
    """More frequent words of clean documents alone, and a rare toxic word."""
    rows = [(i, "the same words in both. " + " ".join(f"{c}lean{c}" for c in "abcdefghijklmnopqrstuvwxyz") + ".", 0) for i in range(300)]
    rows += [(300 + i, "the same words in both. you are the vilest.", 1) for i in range(30)]
    df = spark.createDataFrame(rows, "_id long, text string, toxic int")
    model = toxicity.train(df)
    assert model.weights.get("vilest", 0) > 0
    assert all((r["_toxicity"]["score"] >= 0.5) == bool(r["toxic"]) for r in toxicity.scored(df, model).collect())


def plain_score(model, text: str) -> float:
    """The noisy-or by its definition, feature sets from scratch."""
    shares = []
    for s, e in toxicity.sentences(text):
        z = model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(text[s:e]))
        shares.append(-np.log(1 - 1 / (1 + np.exp(-z))))
    if not shares:
        return 0.0
    return 1 - np.exp(-(sum(max(0, x - toxicity.FLOOR) for x in shares) + min(toxicity.FLOOR, max(shares))))


def test_scores_never_fall_with_a_sentence_added():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}" for i in range(20)]
    model = toxicity.Model({w: float(x) for w, x in zip(words, rng.normal(0, 2.5, 20))}, -5.0)
    for _ in range(200):
        texts = [" ".join(rng.choice(words + ["plain", "other"], rng.integers(1, 6))) + "." for _ in range(rng.integers(1, 8))]
        scores = [model.score(" ".join(texts[:n]))[0] for n in range(len(texts) + 1)]
        assert all(b >= a - 1e-12 for a, b in zip(scores, scores[1:]))
        assert abs(scores[-1] - plain_score(model, " ".join(texts))) < 1e-9
        assert abs(model.score(" ".join(texts) + " Plain and other." * 1000)[0] - scores[-1]) < 0.01


def test_sample_is_bounded_and_repeatable(spark):
    docs = [(i % 90, f"text {i} " + "long " * (200 if i % 90 == 7 else 1)) for i in range(300)] + [(None, "no id")]
    labels = [(i, i % 2) for i in range(100)] + [(4, 1), (None, 1), (6, None)]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [bag(toxicity.sample(d, labels, max_fit=10, fit_chars=500).collect()) for d in (docs, docs.repartition(7))]
    assert got[0] == got[1] and len(got[0]) == 20
    every = toxicity.sample(docs, labels, fit_chars=500).collect()
    taught = {i for i in range(90) if zlib.crc32(str(i).encode()) % 5 and i != 7}
    assert sorted(int(r["text"].split()[1]) % 90 for r in every) == sorted(taught)
    assert all(r["toxic"] == (1 if int(r["text"].split()[1]) % 90 == 4 else int(r["text"].split()[1]) % 90 % 2) for r in every)


def test_drop_toxic_keeps_columns(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    kept = toxicity.drop_toxic(docs, spark.read.parquet(f"{edge}/labels.parquet"))
    assert kept.columns == docs.columns
