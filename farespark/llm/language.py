"""Language identification by nearest centroids.

A text is a vector of character n-grams (1 to 3 letters, words bounded by a
space) hashed to ``BINS`` bins: 1 + log count, times the inverse document
frequency of the bin, scaled to length 1. Each language has up to ``CLUSTERS``
centroids, found by spherical k-means in its own texts, and a text takes the
language of the centroid with the largest cosine. A text farther from every
centroid than nearly all learned texts are from theirs is marked as rejected;
it still gets the nearest language.

Document frequencies cover all learning texts. The centroids of a language are
fitted on a bounded sample of its texts, ``MAX_FIT``, taken by a hash.

Defined results: null texts, and texts without a letter, are "und" with score
0. Without any learning text all are. Null languages teach nothing. Repeated rows are alike. An
empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm.common import crc_mod, table
from farespark.llm.pretokens import LETTER, SHORT, L, classes

BINS = 4096
CLUSTERS = 4
#: Texts of a language that its centroids are fitted on.
MAX_FIT = 2_000
ROUNDS = 12
#: Share of the learned texts that are farther from their language than the limit.
REJECTED = 0.005
_STRETCH = 1 << 19


def bin_counts(text: str) -> np.ndarray | None:
    """Counts of the text's n-grams by bin; None without a letter."""
    total = None
    low = text.lower()
    for at in range(0, len(low), _STRETCH):
        points = np.frombuffer(low[at : at + _STRETCH].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        kind = classes()[points]
        letter = (kind == LETTER) | ((kind >= SHORT) & (kind <= L))
        if not letter.any():
            continue
        # One space for every run of other signs, and around the text.
        keep = letter | np.concatenate([[False], letter[:-1]])
        p = np.where(letter, points, 32)[keep].astype(np.uint64)
        p = np.concatenate([[np.uint64(32)], p, [np.uint64(32)]])
        grams = []
        h = p * np.uint64(0x9E3779B97F4A7C15)
        for n in (1, 2, 3):
            if n > 1:
                h = h[:-1] * np.uint64(0xD6E8FEB86659FD93) + p[n - 1 :] * np.uint64(0x9E3779B97F4A7C15)
            grams.append(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(52)).astype(np.int64) % BINS)
        count = np.bincount(np.concatenate(grams), minlength=BINS)
        total = count if total is None else total + count
    return total


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # (centroids, BINS), unit length
    idf: np.ndarray
    limits: np.ndarray  # least cosine of each centroid

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        count = bin_counts(text) if text and len(self.languages) else None
        if count is None:
            return "und", 0.0, True
        cos = self.centroids @ vector(count, self.idf)
        best = int(cos.argmax())
        return self.languages[best], float(min(max(cos[best], 0.0), 1.0)), bool(cos[best] < self.limits[best])


def vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0.0) * idf
    return (v / max(np.linalg.norm(v), 1e-12)).astype("f4")


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with a letter, and how many hold each bin: one partial vector a task, added up by bin."""

    def count(frames):
        total, n = np.zeros(BINS, np.int64), 0
        for f in frames:
            for t in f["text"]:
                c = bin_counts(t)
                if c is not None:
                    total += c > 0
                    n += 1
        yield pd.DataFrame({"bin": np.arange(-1, BINS), "n": np.concatenate([[n], total])})

    got = texts.select("text").mapInPandas(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    n = {r["bin"]: r["n"] for r in got}
    return n.get(-1, 0), np.array([n.get(b, 0) for b in range(BINS)], float)


def _clustered(vectors: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids by spherical k-means; the first seeds are far apart."""
    seeds = [0]
    near = vectors @ vectors[0]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[seeds[-1]])
    c = vectors[seeds]
    for _ in range(ROUNDS):
        own = (vectors @ c.T).argmax(axis=1)
        c = np.stack([vectors[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1)[:, None], 1e-12)
    return c


def train(rows: DataFrame, max_fit: int = MAX_FIT, clusters: int = CLUSTERS) -> Model:
    """``rows``: doc_id, text, lang. Learns from rows with a text and a language."""
    rows = rows.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    n, df = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not per:
        return Model([], np.zeros((0, BINS), "f4"), idf, np.zeros(0))
    # A pseudo-random share of each language.
    below = F.create_map(*[F.lit(x) for lang, n in sorted(per.items()) for x in (lang, min(1 << 30, (max_fit << 30) // n))])
    part = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 30)) < F.element_at(below, F.col("lang")))

    def vectors(frames):
        for f in frames:
            got = [(lang, bin_counts(t)) for lang, t in zip(f["lang"], f["text"])]
            got = [(lang, vector(c, idf).astype("<f4").tobytes()) for lang, c in got if c is not None]
            yield pd.DataFrame(got, columns=["lang", "v"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.stack([np.frombuffer(x, "<f4") for x in pdf["v"].head(2 * max_fit)])
        c = _clustered(v, clusters)
        cos = v @ c.T
        own = cos.argmax(axis=1)
        limit = [float(np.quantile(cos[own == i, i], REJECTED)) if (own == i).any() else 1.0 for i in range(len(c))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "c": [x.astype("<f4").tobytes() for x in c], "limit": limit})

    got = part.select("lang", "text").mapInPandas(vectors, "lang string, v binary").groupBy("lang").applyInPandas(fit, "lang string, c binary, limit double").collect()
    got = sorted(got, key=lambda r: (r["lang"], bytes(r["c"])))
    c = np.stack([np.frombuffer(r["c"], "<f4") for r in got]) if got else np.zeros((0, BINS), "f4")
    return Model([r["lang"] for r in got], c, idf, np.array([r["limit"] for r in got]))


def predicted(docs: DataFrame, model: Model, text_col: str = "text", name: str = "_language") -> DataFrame:
    """``docs`` with a struct column: lang, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score", "rejected"])

    return docs.withColumn(name, of(F.col(f"`{text_col}`")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(crc_mod("doc_id", 4) != 2))
    return predicted(docs, model).select(
        "doc_id",
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        F.col("_language.lang").alias("lang_pred"),
        F.col("_language.score").alias("score"),
        F.col("_language.rejected").alias("rejected"),
    )
