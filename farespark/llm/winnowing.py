"""Document fingerprints by winnowing, in DataFrame functions only.

A text is cut into tokens: a run of up to ``RUN`` letters or digits, each letter or
digit of a longer run (base64, scripts without spaces), or one other sign. So where a
token starts and ends does not depend on how far away its run began. Every ``K`` consecutive tokens are hashed, and of every window of ``W``
consecutive hashes the smallest is chosen, the rightmost of equals. Hash and
place are kept. Two texts that share K + W - 1 consecutive tokens share a
chosen hash; no match shorter than K tokens is reported.

Hash and place are one number, the hash above the complement of the place, so
the smallest of a window is also its rightmost; windows are reduced by
doubling. Every array is of one text; nothing is exploded.

Defined results: null and empty texts, and texts of white space only, have an
empty fingerprint; a text of fewer than K tokens has one hash of all of them,
and of fewer than W hashes the smallest. The likeness is the share of common
hashes among all (Jaccard); two empty fingerprints are alike (1). The next
document is the next in the order of (doc_id, hash of the text), after the
last the first; rows that repeat both are one document for that, and come back
as often as they went in. Null ids come first. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespark.llm.common import land, table, text_of

K, W = 4, 8
RUN = 32
_TOKEN = r"(?<![\p{L}\p{N}])[\p{L}\p{N}]{1,%d}+(?![\p{L}\p{N}])|[\p{L}\p{N}]|[^\s\p{L}\p{N}]" % RUN
_PLACE = 31  # bits of the place


def fingerprint(df: DataFrame, text: Column, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with an array column of the chosen hashes with their places; w is a power of two.

    Each step is a column of its own, so that no array is computed twice.
    """
    c = [f"_{name}_{i}" for i in range(4)]
    none, last = F.array().cast("array<bigint>"), F.lit((1 << _PLACE) - 1)
    df = df.withColumn(c[0], F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0)))
    # Hashes of k tokens: of one, then of that and what follows.
    df = df.withColumn(c[1], F.transform(c[0], lambda t: F.xxhash64(t)))
    df = df.withColumn(c[2], F.col(c[1]))
    for d in range(1, k):
        df = df.withColumn(c[3], F.slice(c[1], F.lit(d + 1), F.greatest(F.size(c[1]) - d, F.lit(0))))
        df = df.withColumn(c[2], F.zip_with(F.slice(c[2], F.lit(1), F.size(c[3])), c[3], lambda a, b: F.xxhash64(a, b)))
    few = F.array(F.xxhash64(F.array_join(c[0], " ")))
    df = df.withColumn(c[1], F.when(F.size(c[0]) >= k, F.col(c[2])).when(F.size(c[0]) > 0, few).otherwise(none))
    # The hash above the complement of the place.
    df = df.withColumn(c[2], F.transform(c[1], lambda h, i: F.shiftleft(h.bitwiseAND(F.lit(0xFFFFFFFF)), _PLACE) + (last - i)))
    step = 1
    while step < w:
        df = df.withColumn(c[3], F.slice(c[2], F.lit(step + 1), F.greatest(F.size(c[2]) - step, F.lit(0))))
        df = df.withColumn(c[2], F.zip_with(c[2], c[3], lambda a, b: F.least(a, b)))
        step *= 2
    chosen = F.array_distinct(F.slice(c[2], F.lit(1), F.greatest(F.size(c[2]) - (w - 1), F.lit(1))))
    return df.withColumn(name, chosen).drop(*c)


def with_places(chosen: Column) -> Column:
    """Array of (hash, place): the hash of a chosen k-gram and the number of its first token."""
    last = F.lit((1 << _PLACE) - 1)
    return F.transform(chosen, lambda x: F.struct(F.shiftright(x, _PLACE).alias("hash"), (last - x.bitwiseAND(last)).cast("int").alias("place")))


def hashes(chosen: Column) -> Column:
    """The hashes of a fingerprint in the order of their places, four bytes each."""
    return F.transform(chosen, lambda x: (F.shiftright(x, _PLACE) - F.lit(1 << 31)).cast("int"))


def written(own: Column) -> Column:
    """Hashes as eight hex digits each."""
    return F.lower(F.array_join(F.transform(own, lambda x: F.substring(F.hex(x.cast("bigint") + F.lit(3 << 31)), 2, 8)), ""))


def likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with the Jaccard likeness of two columns of hashes, as sets."""
    both = f"_{name}_both"
    df = df.withColumn(both, F.size(F.array_intersect(a, b)))
    every = F.size(F.array_union(a, b))
    return df.withColumn(name, F.when(every == 0, F.lit(1.0)).otherwise(F.col(both) / every)).drop(both)


def next_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, next_id, next_hash) in ascending order; ``docs``: doc_id, text_hash, n.

    The order is dealt into ranges; each range is ordered by itself, and its
    last document is followed by the first of the next range that has one.
    """
    keys = docs.groupBy("doc_id", "text_hash").agg(F.max("n").alias("n"))
    dealt = land(keys.repartitionByRange("doc_id", "text_hash").withColumn("part", F.spark_partition_id()), "winnowing-order")
    key = F.struct("doc_id", "text_hash")
    heads = dealt.groupBy("part").agg(F.min(key).alias("head"))
    # One row a range.
    by_part = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part)).alias("after"))
    nxt = F.lead(key).over(Window.partitionBy("part").orderBy("doc_id", "text_hash"))
    return (
        dealt.withColumn("nxt", nxt)
        .join(after, "part")
        .withColumn("nxt", F.coalesce("nxt", "after"))
        .select("doc_id", "text_hash", "n", F.col("nxt.doc_id").alias("next_id"), F.col("nxt.text_hash").alias("next_hash"))
    )


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edited_likeness(docs.select("doc_id", "text"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, and how like they and the next document's are."""
    text = text_of(docs)
    # A key without nulls: the lowest bit of the hash tells a null id from id 0. Both joins below then
    # need the same columns of a document, and so take the same exchange.
    hashed = F.xxhash64(text).bitwiseAND(F.lit(-2)).bitwiseOR(F.col("doc_id").isNull().cast("long"))
    keyed = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), hashed.alias("text_hash"), text.alias("text"))
    doc_id = F.when(F.col("text_hash").bitwiseAND(F.lit(1)) == 0, F.col("id"))
    order = land(next_documents(keyed.select(doc_id.alias("doc_id"), "text_hash", F.char_length("text").cast("long").alias("n"))), "winnowing-next")
    before = order.select(
        F.coalesce("next_id", F.lit(0)).cast("long").alias("id"),
        F.col("next_hash").alias("text_hash"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("prev_id"),
        F.col("text_hash").alias("prev_hash"),
        F.floor(F.col("n") / 4).cast("int").alias("need"),
    )
    own = fingerprint(keyed, F.col("text"), "fp").withColumn("own", hashes(F.col("fp"))).drop("fp")
    nexts = own.join(before, ["id", "text_hash"]).select(
        F.col("prev_id").alias("id"), F.col("prev_hash").alias("text_hash"), F.expr("left(text, need)").alias("head"), F.col("own").alias("next_own")
    )
    nexts = nexts.dropDuplicates(["id", "text_hash"])
    both = own.join(nexts, ["id", "text_hash"]).withColumn("n", F.char_length("text").cast("long"))
    both = both.withColumn("edited", F.concat(F.expr("left(text, cast(n - floor(n / 4) as int))"), F.col("head")))
    both = fingerprint(both, F.col("edited"), "fp_edited").withColumn("own_edited", hashes(F.col("fp_edited")))
    both = likeness(likeness(both, "own", "own_edited", "near_edited"), "own", "next_own", "near_next")
    return both.select(
        doc_id.alias("doc_id"),
        F.col("n").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("own_edited")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
