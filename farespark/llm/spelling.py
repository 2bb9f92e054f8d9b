"""Spelling variants: words one inserted, deleted or replaced code point apart, by a dictionary of trie-node pairs.

The words' forward trie and the trie of the reversed words have numbered
nodes: a node is a distinct prefix, or a distinct suffix. Sorted words are read
in turn; the nodes of a word are those of the word before it as far as both
agree, and new numbers (the code points written so far) beyond. Parts of the
sorted words are numbered side by side: a part needs only the last word of the
part before it with that word's nodes, and these are worked out from one
summary row a part.

A word gives a pair (node of the prefix, node of the suffix) for each gap
between its code points and for each code point left out. Two words of one
length that share a pair with a code point left out differ by that code point;
a word whose pair with one left out is another's gap has one more. Of a run
of equal code points only the first one counts as left out there, so each pair
of near words meets exactly once. A pair is shared by at most one gap and as
many words as there are letters, since these differ in one code point: a group
cannot grow with the data.

Forms strictly rise in count, so roots come from a logarithmic number of
pointer jumps, each cut with ``checkpoint()``.

Defined results: null and empty texts have no runs; a null doc_id is the empty
text in the checksum. Repeated rows count each time. Empty tables give an
empty result. Words may be of any length; their nodes take as many integers as
they have code points. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm.common import land, table
from farespark.session import checkpoint_root

#: Fixed values of the contract: letters of a run, the divisor of planted deletions, the shortest word, the fewest occurrences, the factor of a form.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
EVERY, SHORTEST, FEWEST, FACTOR = 199, 6, 5, 5
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
GAP, LEFT_OUT, FIRST_LEFT_OUT = 0, 1, 2


def runs_of(text: str) -> list[str]:
    """The runs of a text, only A-Z lower-cased."""
    return RUN.findall(text.encode().lower().decode())


def as_written(doc_id, run: str) -> str:
    """The run, or the run without one code point where its checksum says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % EVERY:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter[str] = Counter()
    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1)):
            for run, n in Counter(runs_of(text.as_py() or "")).items():
                if len(run) >= SHORTEST and len(word := as_written(i, run)) >= SHORTEST:
                    words[word] += n
            if len(words) >= COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], schema=_COUNTS)
                words.clear()
    yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], schema=_COUNTS)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of the words of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_counting, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= FEWEST)


# -- numbering trie nodes ------------------------------------------------------------------------------------------


def shared(a: str, b: str) -> int:
    """Code points that both start with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def nodes_after(before: tuple[str, np.ndarray], word: str, first: int) -> np.ndarray:
    """Nodes of the prefixes of ``word``; ``before`` is the word before it with its nodes, new ones count from ``first``."""
    k = shared(before[0], word)
    return np.concatenate([before[1][:k], np.arange(first + k, first + len(word), dtype=np.int64)])


NOBODY = ("", np.zeros(0, np.int64))
_SUMMARY = "part int, points long, first string, last string, nodes array<long>"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, points, first, now = None, 0, None, NOBODY

    def told():
        return pa.RecordBatch.from_pylist(
            [{"part": part, "points": points, "first": first, "last": now[0], "nodes": now[1].tolist()}],
            schema=pa.schema([("part", pa.int32()), ("points", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("nodes", pa.list_(pa.int64()))]),
        )

    for b in batches:
        for p, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if p != part:
                if part is not None:
                    yield told()
                part, points, first, now = p, 0, word, NOBODY
            now = (word, nodes_after(now, word, points))
            points += len(word)
    if part is not None:
        yield told()


def carried(summaries: list) -> dict[int, tuple[int, str, np.ndarray]]:
    """For each part its first number, and the last word before it with that word's nodes. One summary a part."""
    out, base, before = {}, 0, NOBODY
    for s in sorted(summaries, key=lambda s: s["part"]):
        out[s["part"]] = (base, *before)
        local = np.array(s["nodes"], np.int64)
        # Numbers below the first word's length are its own; as far as it agrees with the word before, so do their nodes.
        k = shared(before[0], s["first"])
        old = local < min(k, len(s["first"]))
        nodes = local + base
        nodes[old] = before[1][local[old]]
        before = (s["last"], nodes)
        base += s["points"]
    return out


def in_order(words: DataFrame, key: str) -> DataFrame:
    """``words`` landed with ``part``, the number of their range of ``key``."""
    sized = words.repartitionByRange(key).withColumn("part", F.spark_partition_id())
    return land(sized, f"spelling-{key}")


def numbered(words: DataFrame, key: str, read, schema: str) -> DataFrame:
    """``words`` (with a distinct ``key``) in the order of ``key``, through ``read(batches of part, key and the rest, carried)``."""
    ordered = in_order(words, key)
    rest = [c for c in words.columns if c != key]
    rows = ordered.select("part", key, *rest).repartition("part").sortWithinPartitions("part", key)
    given = carried(rows.select("part", key).mapInArrow(_summaries, _SUMMARY).collect())  # one row a part
    return rows.mapInArrow(lambda batches: read(batches, given), schema)


def _walk(batches, given):
    """(batch, [first number and nodes of each row]) in turn."""
    part, base, now = None, 0, NOBODY
    for b in batches:
        out = []
        for p, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if p != part:
                part, (base, *before) = p, given[p]
                now = tuple(before)
            now = (word, nodes_after(now, word, base))
            out.append((base, now[1]))
            base += len(word)
        yield b, out


def _forward(batches, given):
    for b, got in _walk(batches, given):
        nodes = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for _, x in got])]).astype(np.int32), np.concatenate([x for _, x in got] or [np.zeros(0, np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int64()), b.column(1), b.column(2), nodes], names=["id", "word", "n", "nodes"])


def pairs_of(word: str, pre: np.ndarray, suf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix node, suffix node, kind) of a word; -1 is the empty prefix and suffix. ``suf`` are the nodes of its suffixes, shortest first."""
    before = np.concatenate([[-1], pre])  # of the prefix of length i
    after = np.concatenate([[-1], suf])[::-1]  # of the suffix from i
    points = np.frombuffer(word.encode("utf-32-le"), "<u4")
    kinds = np.full(2 * len(word) + 1, GAP, np.int32)
    kinds[len(word) + 1 :] = np.where(np.concatenate([[True], points[1:] != points[:-1]]), FIRST_LEFT_OUT, LEFT_OUT)
    return np.concatenate([before, before[:-1]]), np.concatenate([after, after[1:]]), kinds


#: Rows of a batch of pairs.
_PAIRS, _AT_ONCE = "a long, b long, kind int, id long, n long", 1 << 16


def _backward(batches, given):
    """Pairs of the words; columns: part, drow (the reversed word), id, n, nodes (of its prefixes)."""

    def batch(rows):
        cols = [np.concatenate(c) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "b", "kind", "id", "n"])

    rows, size = [], 0
    for b, got in _walk(batches, given):
        for i, (_, suf) in enumerate(got):
            word = b.column(1)[i].as_py()[::-1]
            a, z, kind = pairs_of(word, b.column(4)[i].values.to_numpy(), suf)
            rows.append((a, z, kind, np.full(len(a), b.column(2)[i].as_py()), np.full(len(a), b.column(3)[i].as_py())))
            size += len(a)
            if size >= _AT_ONCE:
                yield batch(rows)
                rows, size = [], 0
    if rows:
        yield batch(rows)


# -- neighbours, forms, roots --------------------------------------------------------------------------------------

# Of a member x of a group m: the words near it that the group shows.
_PARTNERS = f"""transform(m, x -> named_struct('id', x.id, 'near',
  filter(m, y -> (x.kind = {GAP} and y.kind = {FIRST_LEFT_OUT}) or (x.kind = {FIRST_LEFT_OUT} and y.kind = {GAP})
    or (x.kind != {GAP} and y.kind != {GAP} and x.id != y.id))))"""


def near(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) of all words in code-point order, and (id, n_near, best_n, best) of those that have a near word."""
    first = land(numbered(words.select("word", "n"), "word", _forward, "id long, word string, n long, nodes array<long>"), "spelling-words")
    pairs = numbered(first.select(F.reverse("word").alias("drow"), "id", "n", "nodes"), "drow", _backward, _PAIRS)
    groups = pairs.groupBy("a", "b").agg(F.collect_list(F.struct("kind", "id", "n")).alias("m")).where(F.size("m") > 1)
    each = groups.select(F.explode(F.expr(_PARTNERS)).alias("x")).where(F.size("x.near") > 0)
    best = F.array_max(F.transform("x.near", lambda y: F.struct(y["n"].alias("n"), (-y["id"]).alias("minus_id"))))
    found = each.select(F.col("x.id").alias("id"), F.size("x.near").cast("long").alias("k"), best.alias("best"))
    found = found.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))
    return first.select("id", "word", "n"), land(found.select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.minus_id")).alias("best")), "spelling-near")


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form), by pointer jumping; forms must not go round."""
    checkpoint_root(forms.sparkSession)
    at = forms.select("id", F.col("form").alias("root")).checkpoint()
    while True:
        on = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        jumped = at.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        at = jumped.select("id", "root")
        if jumped.where("moved").isEmpty():
            return at


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of ``words`` (word, n; words distinct)."""
    every, found = near(words)
    told = land(every.join(found, "id", "left").withColumn("form", F.when(F.col("best_n") >= factor * F.col("n"), F.col("best"))), "spelling-forms")
    at = roots(told.where("form is not null").select("id", "form"))
    names = every.select("id", F.col("word"))
    return (
        told.join(at, "id", "left")
        .join(names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form", "left")
        .join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", "left")
        .select(
            "word",
            F.col("form_word").alias("form"),
            F.coalesce("root_word", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
        )
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
