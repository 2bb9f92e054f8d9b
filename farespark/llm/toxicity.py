"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores sigmoid(b + sum of the
weights of its features), a document the noisy-or of its sentences:
1 - prod(1 - s). The weights are fitted to document labels only, by the
noisy-or likelihood; the sentence scores then tell which sentences offend.

A sentence's share of the noisy-or is its -log(1 - s). Shares up to ``FLOOR`` are
background and count once for a document, by its strongest sentence; beyond
that the shares of all sentences add up:

    -log(1 - score) = sum of max(0, share - FLOOR) + min(FLOOR, largest share)

So neutral sentences add nothing however many there are, and a sentence added
never lowers the score. The weights are fitted by the likelihood of this score.

Features: each distinct word of a sentence, and its first ``PREFIXES``
letters, lower-cased. The model is fitted on a bounded sample of labelled
documents: of either label the ``MAX_FIT`` ids of smallest hash, with at most
``FIT_CHARS`` code points of text (one text an id, the smallest). Only these texts are
fetched, by a broadcast of their ids, so no text is shuffled at any size. The
model keeps the features that ``min_docs`` documents of the sample hold and
whose rate differs between the labels; both bounds follow from the sample's.

Defined results: null and empty texts have no sentence and score 0. Labels that are null
teach nothing; documents with the same id as several labels count with the
largest label. Without any document of either label every score is 0. Repeated rows
score alike. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm.common import crc_mod, giving_back, land, table, text_of

#: Bounds of the sample that the model is fitted on: documents of each label, and code points of a document.
MAX_FIT, FIT_CHARS = 6_000, 200_000
PREFIXES = (4, 5)
MIN_DOCS = 12
#: A feature is kept if its rate in one label is so many times the other's.
RATIO = 4.0
#: Rounds of the fit with the plain noisy-or, and then with the background held apart.
ROUNDS, LAST_ROUNDS = 150, 60
#: Shares of sentences up to here are background.
FLOOR = 0.05
#: The bias stays under this, so that a sentence without a known feature is background.
MAX_BIAS = -4.0
#: Words whose features a worker keeps.
WORDS = 100_000

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+(?:[.!?]+|\n|$)")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence that holds a letter or digit, as code points."""
    return [m.span() for m in _SENTENCE.finditer(text)]


def features(sentence: str) -> set[str]:
    words = set(_WORD.findall(sentence.lower()))
    out = set(words)
    for w in words:
        for n in PREFIXES:
            if len(w) > n:
                out.add(w[:n] + "*")
            elif len(w) == n:
                out.add(w + "*")
    return out


class Model:
    """weights: feature -> weight; bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float, trained: bool = True):
        self.bias, self.trained, self.weights = min(bias, MAX_BIAS), trained, weights
        # A sentence's features come from its words, so the weight of a word is looked up once.
        self.words: dict[str, float] = {}
        self.plain = math.log1p(math.exp(self.bias))  # the share of a sentence without a known feature

    def word(self, w: str) -> tuple:
        """The known features of a word."""
        hit = self.words.get(w)
        if hit is None:
            known = {w, *(w[:n] + "*" for n in PREFIXES if len(w) >= n)}
            hit = tuple(f for f in known if f in self.weights)
            if len(self.words) >= WORDS:
                self.words.clear()
            self.words[w] = hit
        return hit

    def score(self, text: str | None, at_least: float | None = None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and the sentences that score ``at_least`` so much."""
        if not text or not self.trained:
            return 0.0, []
        low = text.lower()
        moved = len(low) != len(text)
        spans = sentences(text)
        beyond, largest, found = 0.0, 0.0, []
        for s, e in spans:
            part = text[s:e].lower() if moved else low[s:e]
            held = set()
            for w in _WORD.findall(part):
                known = self.words.get(w)
                held.update(self.word(w) if known is None else known)
            if not held:
                largest = max(largest, self.plain)
                continue
            z = self.bias + sum(map(self.weights.__getitem__, held))
            share = z if z > 30 else math.log1p(math.exp(z))
            beyond += max(0.0, share - FLOOR)
            largest = max(largest, share)
            if at_least is not None and (p := -math.expm1(-share)) >= at_least:
                found.append((s, e, p))
        return -math.expm1(-(beyond + min(FLOOR, largest))), found


def fit(bags: list[list[set[str]]], labels: np.ndarray, vocabulary: list[str], rounds: int = ROUNDS, last_rounds: int = LAST_ROUNDS) -> Model:
    """Maximum likelihood by Adam, with a small ridge; classes weigh alike."""
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return Model({}, -20.0, trained=False)
    number = {f: i for i, f in enumerate(vocabulary)}
    feat, row, doc, plain = [], [], [], np.zeros(len(bags))
    n_rows = 0
    for d, bag in enumerate(bags):
        for held in bag:
            ids = [number[f] for f in held if f in number]
            if ids:
                feat += ids
                row += [n_rows] * len(ids)
                doc.append(d)
                n_rows += 1
            else:
                plain[d] += 1
    feat, row, doc = np.array(feat, np.int64), np.array(row, np.int64), np.array(doc, np.int64)
    w, b = np.zeros(len(vocabulary)), MAX_BIAS
    weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)
    m, v, rate = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0.1
    new = np.concatenate([[True], doc[1:] != doc[:-1]])[:n_rows]
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    for step in range(1, rounds + last_rounds + 1):
        floor = FLOOR if step > rounds else 0.0
        z = b + np.bincount(row, w[feat], n_rows) if n_rows else np.zeros(0)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        share = np.logaddexp(0, z)
        p0, share0 = 1 / (1 + np.exp(-b)), np.logaddexp(0, b)
        # How much a sentence's share counts: whole beyond the background, and as the strongest of its document within it.
        counts = (share > floor).astype(float)
        total = np.bincount(doc, np.maximum(share - floor, 0), len(bags)) + plain * max(share0 - floor, 0)
        if floor and n_rows:
            top = np.maximum.reduceat(share, starts)
            total[doc[starts]] += np.minimum(top, floor)
            strongest = (share == top[group]) & (share <= floor)
            counts[strongest] = 1.0
        score = np.clip(-np.expm1(-total), 1e-9, 1 - 1e-9)
        # d(-log likelihood)/dz of a sentence: p for a clean document, -p * (1 - score) / score for a toxic one
        pull = weight * np.where(labels > 0, -(1 - score) / score, 1.0)
        gz = pull[doc] * p * counts
        g = np.concatenate([np.bincount(feat, gz[row], len(w)) + 1e-5 * w, [gz.sum() + (pull * plain).sum() * p0 * (share0 > floor)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], min(b - move[-1], MAX_BIAS)
    return Model({f: float(x) for f, x in zip(vocabulary, w) if abs(x) > 0.05}, float(b))


def _bag(text: str | None) -> list[set[str]]:
    return [features(text[s:e]) for s, e in sentences(text or "")]


def sample(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT, fit_chars: int = FIT_CHARS) -> DataFrame:
    """text, toxic of the documents that the model is fitted on. They are among those whose crc32(doc_id as text) mod 5 is not 0."""
    truth = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of(docs).alias("text")).where((crc_mod("id", 5) != 0) & (F.char_length("text") <= fit_chars))
    known = rows.select("id").distinct().join(truth.hint("merge"), "id").withColumn("h", F.xxhash64("id", F.lit(7)))
    # Bounded by max_fit ids of either label.
    ids = [r for y in (0, 1) for r in known.where(F.col("toxic") == y).orderBy("h", "id").limit(max_fit).select("id", "toxic").collect()]
    chosen = docs.sparkSession.createDataFrame([(r["id"], r["toxic"]) for r in ids], "id long, toxic int")
    return rows.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def train(rows: DataFrame, min_docs: int = MIN_DOCS) -> Model:
    """``rows``: text, toxic (0/1) of a bounded sample."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 100):
                part = b.slice(at, 100)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array([[sorted(x) for x in _bag(t)] for t in part.column(0).to_pylist()], pa.list_(pa.list_(pa.string())))], names=["y", "bag"]
                )

    got = land(rows.select("text", "toxic").mapInArrow(giving_back(bags), "y int, bag array<array<string>>"), "toxicity-sample")
    n = {r["y"]: r["n"] for r in got.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return Model({}, -20.0, trained=False)
    held = got.select("y", F.explode(F.array_distinct(F.flatten("bag"))).alias("feature")).groupBy("feature")
    counts = held.agg(F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1"))
    rate = (F.col("n1") + 0.5) / (n1 + 1.0) / ((F.col("n0") + 0.5) / (n0 + 1.0))
    kept = counts.where((F.col("n0") + F.col("n1") >= max(2, min(min_docs, n1 // 8))) & (F.abs(F.log(rate)) >= float(np.log(RATIO))))
    vocabulary = sorted(r["feature"] for r in kept.select("feature").collect())
    names = set(vocabulary)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bag = [[[f for f in held if f in names] for held in sentences] for sentences in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bag, pa.list_(pa.list_(pa.string())))], names=["y", "bag"])

    # Sorted, so that the sums of the fit do not depend on which task came first.
    told = sorted((r["y"], r["bag"]) for r in got.mapInArrow(giving_back(known), "y int, bag array<array<string>>").collect())
    return fit([[set(s) for s in bag] for _, bag in told], np.array([y for y, _ in told]), vocabulary)


def scored(docs: DataFrame, model: Model, text_col: str = "text", at_least: float = 0.5, name: str = "_toxicity") -> DataFrame:
    """``docs`` with a struct column: score, and offending sentences (start, end, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, sentences array<struct<start:int,end:int,score:double>>")
    def of(texts: pd.Series) -> pd.DataFrame:
        got = [shared.value.score(t, at_least) for t in texts]
        return pd.DataFrame({"score": [g[0] for g in got], "sentences": [[{"start": s, "end": e, "score": p} for s, e, p in g[1]] for g in got]})

    return docs.withColumn(name, of(text_of(docs, text_col)))


#: Texts that a worker holds as strings, and rows that it gives back at once.
_SOME = 200


def _scores(model: Broadcast, texts: pa.Array, at_least: float | None, some: int = _SOME) -> Iterator[tuple[float, list]]:
    for at in range(0, len(texts), some):
        for t in texts.slice(at, some).to_pylist():
            yield model.value.score(t, at_least)


def document_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_offending (sentences that score 0.5 or more) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            got = [(score, len(found)) for score, found in _scores(shared, b.column(1), 0.5)]
            cols = list(zip(*got)) or [(), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int32())], names=["doc_id", "score", "n_offending"])
        shared.value.words.clear()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(giving_back(run), "doc_id long, score double, n_offending int")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(sample(docs, table(spark, sf_dir, "labels")))
    return document_scores(docs, model).select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_offending",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under 0.5, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(train(sample(docs, labels)))
    place = docs.columns.index("text")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, _SOME):
                part = b.slice(at, _SOME)
                yield part.filter(pa.array([score < 0.5 for score, _ in _scores(shared, part.column(place), None)], pa.bool_()))
        shared.value.words.clear()

    return docs.mapInArrow(giving_back(run), docs.schema)
