"""Mixing sources to target weights over a tree domain - language - source.

A budget of tokens goes down the tree. Each node's part is dealt to its
children by weight; a child that has fewer tokens than its part (times
``max_epochs``) takes what it has, and what it leaves goes to its siblings by
their weights. Only what a whole family cannot take goes up to the parent's
siblings. A leaf takes whole epochs of its documents and then a prefix of one
more epoch, in an order drawn by (seed, leaf, epoch). The prefix is one of
tokens: the document that would go beyond the leaf's budget is cut at it, so
each leaf gives its part to the token. A cut document is a row of its own
beside the whole copies of it.

The token counts of the leaves cover all documents. They and the cuts of the
prefixes are one row a leaf, so the driver solves the tree; the number of
leaves is the size of the mixture's plan, not of the corpus. The prefix of a
leaf is found without sorting the leaf: tokens are summed by ``BUCKETS`` ranges of the
drawn order, and only the range that holds the cut is ordered, in as many
tasks as there are leaves. Texts are not shuffled.

Defined results: null and empty texts have no tokens and cost nothing: they
are taken with the part of the order they fall into. Null languages and
sources are nodes of their own. Documents that tie in the order (repeated
rows) are taken one by one; which of them is cut is open. An empty table, or a
budget of 0, gives an empty result. Other columns than the text stay as they
are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespark.llm.common import fresh, land, table, text_of

BUCKETS = 12  # bits: 4096 ranges of the drawn order
LEVELS = ("_domain", "_language", "_source")


@dataclass(frozen=True)
class Mixture:
    """Weights by node; a node that is not named has ``default`` (a share of its siblings, any scale)."""

    domains: dict[str, float] = field(default_factory=dict)
    languages: dict[str, float] = field(default_factory=dict)
    sources: dict[str, float] = field(default_factory=dict)
    default: float = 1.0
    fraction: float = 0.5  # budget as a share of all tokens
    max_epochs: int = 4
    seed: int = 42

    def weight(self, level: int, name: str | None) -> Fraction:
        named = (self.domains, self.languages, self.sources)[level]
        return Fraction(str(named.get(name, self.default)))


#: The mixture of the registered query: three domains, four languages, sources alike.
PLAN = Mixture(
    domains={"web": 5, "books": 3, "reference": 2},
    languages={"en": 5, "de": 2, "fr": 2, "es": 1},
    fraction=0.5,
)


def deal(budget: int, children: list[tuple[Fraction, int]]) -> list[int]:
    """Parts of ``budget`` by (weight, capacity); what a full child leaves goes to the others by weight."""
    part = [0] * len(children)
    left = Fraction(budget)
    live = [i for i, (w, cap) in enumerate(children) if w > 0 and cap > 0]
    while live:
        level = left / sum(children[i][0] for i in live)
        full = [i for i in live if children[i][1] <= children[i][0] * level]
        if not full:
            break
        for i in full:
            part[i] = children[i][1]
            left -= part[i]
        live = [i for i in live if i not in full]
    if live:
        level = left / sum(children[i][0] for i in live)
        exact = {i: children[i][0] * level for i in live}
        for i in live:
            part[i] = int(exact[i])
        over = int(left) - sum(part[i] for i in live)
        for i in sorted(live, key=lambda i: (part[i] - exact[i], i))[:over]:
            part[i] += 1
    return part


def solve(leaves: dict[tuple, int], mix: Mixture, budget: int) -> dict[tuple, int]:
    """Tokens that each leaf (domain, language, source) gives; ``leaves``: tokens that each holds."""
    out: dict[tuple, int] = {}

    def down(level: int, prefix: tuple, part: int) -> None:
        if level == len(LEVELS):
            out[prefix] = part
            return
        names = sorted({k[level] for k in leaves if k[:level] == prefix}, key=lambda x: (x is None, x))
        room = [sum(v for k, v in leaves.items() if k[: level + 1] == (*prefix, n)) * mix.max_epochs for n in names]
        for name, p in zip(names, deal(part, [(mix.weight(level, n), c) for n, c in zip(names, room)])):
            down(level + 1, (*prefix, name), p)

    down(0, (), budget)
    return out


def tokens_of(text: Column) -> Column:
    """Number of words."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(t) == 0, 0).otherwise(F.size(F.split(t, " "))).cast("long")


def first_tokens(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it is."""
    return F.array_join(F.slice(F.split(text, r"(?<=\S)(?=\s)"), 1, n.cast("int")), "")


def domain_of(source: Column) -> Column:
    """The domain of a source: by the number in its name; sources without one are web."""
    n = F.coalesce(F.regexp_extract(source, r"(\d{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(F.lit("web"), F.lit("books"), F.lit("reference")), (n % 3 + 1).cast("int"))


def _draw(seed: int, epoch: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, *LEVELS, "_key", "_text_hash"), 1)


def mixed(docs: DataFrame, mix: Mixture, domain: Column, id_col: str = "doc_id") -> DataFrame:
    """``docs`` that are chosen, with columns named by :func:`added`: domain, tokens (of one copy), copies (how often each is taken)."""
    spark = docs.sparkSession
    # Columns of ``docs`` go by their number here, so that no name of theirs can clash.
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    told = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in own.items()],
        domain.alias("_domain"),
        F.col("lang").alias("_language"),
        F.col("source").alias("_source"),
        F.col(f"`{id_col}`").alias("_key"),
        F.xxhash64(text_of(docs)).alias("_text_hash"),
        tokens_of(text_of(docs)).alias("_tokens"),
    )
    # Read three times below: the words of a text are counted once for it.
    narrow = land(told.select(*LEVELS, "_key", "_text_hash", "_tokens"), "mixing-rows")
    sums = narrow.groupBy(*LEVELS).agg(F.sum("_tokens").alias("n")).collect()
    leaves = {tuple(r[c] for c in LEVELS): r["n"] for r in sums}
    budget = int(Fraction(str(mix.fraction)) * sum(leaves.values()))
    parts = solve(leaves, mix, budget)
    plan = [(*k, parts[k] // n, parts[k] % n) for k, n in leaves.items() if n and parts[k]]
    schema = "_domain string, _language string, _source string, _full long, _rest long"
    tree = spark.createDataFrame(plan, schema)
    drawn = _with_leaf(narrow, tree).where("_rest > 0").withColumn("_r", _draw(mix.seed, F.col("_full"))).withColumn("_b", F.shiftright("_r", 63 - BUCKETS))
    # Tokens of each range of the order, then the range that holds the cut.
    up_to = Window.partitionBy(*LEVELS).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        drawn.groupBy(*LEVELS, "_b", "_rest")
        .agg(F.sum("_tokens").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(up_to), F.lit(0)))
        .where("_before <= _rest and _before + _n > _rest")
        .groupBy(*LEVELS)
        .agg(F.min_by(F.struct("_b", "_before"), "_b").alias("_at"))
        .collect()
    )
    at = spark.createDataFrame([(*[r[c] for c in LEVELS], r["_at"]["_b"], r["_at"]["_before"]) for r in ranges], "_domain string, _language string, _source string, _cut long, _before long")
    order = Window.partitionBy(*LEVELS).orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The place in the order where the budget ends: rows that tie there, tokens of each, and what is left for them.
    edges = (
        _with_leaf(drawn, at)
        .where("_b = _cut")
        .groupBy(*LEVELS, "_before", "_rest", "_r")
        .agg(F.sum("_tokens").alias("_n"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_sum", F.col("_before") + F.sum("_n").over(order))
        .where("_sum > _rest")
        .groupBy(*LEVELS)
        .agg(F.min_by(F.struct("_r", "_rows", F.expr("_n div _rows").alias("_each"), F.expr("_rest - _sum + _n").alias("_room")), "_r").alias("_edge"))
        .collect()
    )
    ends = {tuple(r[c] for c in LEVELS): (r["_edge"]["_r"], r["_edge"]["_rows"], *divmod(r["_edge"]["_room"], r["_edge"]["_each"])) for r in edges}
    chosen = [(*row[:4], *(ends[row[:3]] if row[4] else (-1, 0, 0, 0))) for row in plan]
    picks = spark.createDataFrame(chosen, f"{schema.removesuffix(', _rest long')}, _edge long, _rows long, _whole long, _part long")
    drawn = _with_leaf(told, picks).withColumn("_r", _draw(mix.seed, F.col("_full")))
    numbered = drawn.withColumn("_number", F.lit(1))
    if any(row[5] > 1 for row in chosen):
        tie = (F.col("_r") == F.col("_edge")) & (F.col("_rows") > 1)
        number = F.row_number().over(Window.partitionBy(*LEVELS).orderBy("_r"))  # the rows of one place of the order
        numbered = numbered.where(~tie).unionByName(drawn.where(tie).withColumn("_number", number))
    at_edge = F.col("_r") == F.col("_edge")
    whole = F.col("_full") + ((F.col("_r") < F.col("_edge")) | (at_edge & (F.col("_number") <= F.col("_whole")))).cast("long")
    cut = (at_edge & (F.col("_number") == F.col("_whole") + 1) & (F.col("_part") > 0)).cast("long")
    takes = F.array(
        F.struct(F.col("_tokens").alias("n"), whole.alias("copies"), F.lit(False).alias("cut")),
        F.struct(F.col("_part").alias("n"), cut.alias("copies"), F.lit(True).alias("cut")),
    )
    whole_text = F.col(own["text"])
    text = F.when(F.col("_take.cut"), first_tokens(whole_text, F.col("_take.n"))).otherwise(whole_text)
    domain_name, tokens_name, copies_name = added(docs)
    return numbered.withColumn("_take", F.explode(F.filter(takes, lambda t: t["copies"] > 0))).select(
        *[(text if c == "text" else F.col(n)).alias(c) for c, n in own.items()],
        F.col("_domain").alias(domain_name),
        F.col("_take.n").alias(tokens_name),
        F.col("_take.copies").alias(copies_name),
    )


def added(docs: DataFrame) -> tuple[str, str, str]:
    """Names of the columns that :func:`mixed` adds: domain, tokens, copies."""
    return fresh(docs, "_domain"), fresh(docs, "_tokens"), fresh(docs, "_copies")


def _with_leaf(df: DataFrame, leaves: DataFrame) -> DataFrame:
    b = leaves.select(*[F.col(c).alias(f"_leaf{c}") if c in LEVELS else F.col(c) for c in leaves.columns])
    same = [df[c].eqNullSafe(b[f"_leaf{c}"]) for c in LEVELS]
    return df.join(b, same[0] & same[1] & same[2]).drop(*[f"_leaf{c}" for c in LEVELS])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    m = mixed(docs, PLAN, domain_of(F.col("source")))
    return m.select("doc_id", F.col("_domain").alias("domain"), "lang", "source", F.col("_tokens").alias("n_tokens"), F.col("_copies").alias("copies"))


def take_mix(docs: DataFrame, mix: Mixture = PLAN, domain: Column | None = None) -> DataFrame:
    """The chosen documents, each as often as it is taken; columns unchanged, but for the text of the cut ones.

    ``domain``: a column of the documents or a mapping of them; by the source's name if it is not given.
    """
    m = mixed(docs, mix, domain_of(F.col("source")) if domain is None else domain)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(added(docs)[2])))
    return m.select(*[F.col(f"`{c}`") for c in docs.columns], again.alias(fresh(docs, "_epoch"))).select(*[F.col(f"`{c}`") for c in docs.columns])
