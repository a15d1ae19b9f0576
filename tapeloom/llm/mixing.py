"""Mixing sources to target weights: a token budget handed down a tree of domains, languages and sources.

Each node gets its share of its parent's budget by weight, and no more than it can supply. What a node cannot
use goes to its siblings first; only what all of them cannot use stays with the parent, whose own siblings
have had it then. A leaf takes whole epochs of its documents and the beginning of one more, in an order drawn
by the seed. Built-in functions only; whole numbers throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import fresh
from tapeloom.llm.quality_rules import SPACE, SPACES
from tapeloom.operators.joins import BROADCAST_BYTES, join_lookup
from tapeloom.operators.skew import GROUP_ROWS

LEVELS = ("domain", "lang", "source")
# Documents of a leaf in one piece of its order, about.
PIECE = 1_000
_BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Targets:
    """Whole-number weights of names at each level (1 for others), the budget and how it may be met.

    ``per_mille`` of all tokens is the budget; a document is used ``epochs`` times at most.
    """

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    per_mille: int = 1000
    epochs: int = 2
    seed: str = "mix"


def words_in(text: Column) -> Column:
    """Number of words, the tokens that are counted here unless others are given."""
    bare = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE))
    single = F.regexp_replace(bare, SPACES, " ")
    gaps = F.length(single) - F.length(F.replace(single, F.lit(" "), F.lit("")))
    return F.when(bare == "", F.lit(0)).otherwise(gaps + 1).cast("bigint")


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    if any(weight < 1 for weight in weights.values()):
        raise ValueError("weights are whole numbers from 1")
    found = F.lit(1)
    for known, weight in weights.items():
        found = F.when(name == known, F.lit(weight)).otherwise(found)
    return found.cast("bigint")


def _share(children: DataFrame, parents: list[str], own: Sequence[str]) -> DataFrame:
    """Split each parent's ``budget`` among its children by ``weight``, up to the ``capacity`` of each.

    Children are full from the least capacity for their weight on, until the rest gets less than it holds;
    that rest is split by weight alone, rounded down. The children of one parent are one task, at the top all
    names of the first level: rows of names, not of documents.
    """
    # capacity / weight in whole numbers: parts of a billionth keep the order, names decide ties.
    ratio = F.col("capacity").cast(_BIG) * 1_000_000_000 / F.col("weight")
    order = Window.partitionBy(*parents).orderBy(ratio.cast(_BIG), *own)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    each = children.withColumns(
        {
            "before": F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_BIG),
            "onward": F.sum("weight").over(onward).cast(_BIG),
        }
    )
    weight, capacity, budget = (F.col(name).cast(_BIG) for name in ("weight", "capacity", "budget"))
    each = each.withColumn("full", F.col("before") * weight + capacity * F.col("onward") <= budget * weight)
    of_parent = Window.partitionBy(*parents)
    full = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(of_parent).cast(_BIG)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(of_parent).cast(_BIG)
    rest = F.expr("cast(floor(cast(weight as decimal(38,0)) * (budget - _full) div nullif(_open, 0)) as bigint)")
    shared = each.withColumns({"_full": full, "_open": open_weight})
    given = F.when(F.col("full"), F.col("capacity")).otherwise(F.least(rest, F.col("capacity")))
    return shared.withColumn("given", given).drop("before", "onward", "full", "_full", "_open")


def budgets(docs: DataFrame, targets: Targets = Targets(), levels: Sequence[str] = LEVELS) -> DataFrame:
    """One row for each leaf with its ``documents``, ``tokens`` and ``budget``.

    ``docs`` has a ``tokens`` column, a bigint, and the levels; NULL names count as one name. Documents
    are summed up per leaf first; all that follows works on those rows.
    """
    levels = list(levels)
    leaves = docs.groupBy(*levels).agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens").alias("budget"))
    total = total.select((F.expr(f"coalesce(budget, 0L) * {targets.per_mille} div 1000")).cast("bigint").alias("budget"))
    given = total
    for depth, level in enumerate(levels, 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumns(
            {"capacity": F.col("tokens") * targets.epochs, "weight": _weight(F.col(level), targets.weights.get(level, {}))}
        ).drop("tokens")
        if depth == 1:
            children = nodes.crossJoin(F.broadcast(given))  # the one row of the total
        else:
            parents = given.select(*[F.col(name).alias(f"_{name}") for name in path[:-1]], F.col("given").alias("budget"))
            same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in path[:-1]]
            children = nodes.join(parents, same).drop(*[f"_{name}" for name in path[:-1]])
        given = _share(children, path[:-1], path[-1:])
    own = given.select(*[F.col(name).alias(f"_{name}") for name in levels], F.col("given").alias("budget"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in levels]
    return leaves.join(own, same).select(*levels, "documents", "tokens", "budget")


def selected(
    docs: DataFrame,
    targets: Targets = Targets(),
    levels: Sequence[str] = LEVELS,
    keep: Sequence[str] = (),
    piece: int = PIECE,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = GROUP_ROWS,
) -> DataFrame:
    """doc_id, the levels, ``epoch``, ``tokens`` and ``taken``: each use of a document, and how many tokens of it.

    A leaf whose budget is over its tokens uses all documents once for each full epoch. The rest is the
    beginning of the next epoch in the order of MD5 of seed, epoch and doc_id, up to the budget; the last
    document may be taken in part. Documents without tokens are not taken. ``keep`` names columns to carry
    along. NULL ids and repeated rows are documents like others.

    No leaf is sorted as a whole: its order is cut into pieces of about ``piece`` documents by the leading
    bits, the pieces are summed up first, and documents are only ordered inside a piece. The budgets are
    written and measured; ``broadcast_bytes`` and ``hot_rows`` are those of ``join_lookup``, by which
    documents meet them.
    """
    levels = list(levels)
    leaves = budgets(docs, targets, levels)
    pieces = F.expr(f"documents div {piece} + 1")
    plan = leaves.select(
        *levels,
        pieces.alias("_pieces"),
        F.expr("if(tokens > 0, budget div tokens, 0L)").alias("_epochs"),
        F.expr("if(tokens > 0, budget % tokens, 0L)").alias("_rest"),
    )
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in levels]
    rows = docs.select("doc_id", *levels, "tokens", *keep).where(F.col("tokens") > 0)
    limits = {"broadcast_bytes": broadcast_bytes, "hot_rows": hot_rows}
    rows = join_lookup(rows, plan, levels, "inner", null_safe=True, spread_by=["doc_id"], unique=True, **limits)

    name = F.concat_ws("|", F.lit(targets.seed), F.col("_epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("_order", F.md5(name))
    place = F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint")
    rows = rows.withColumn("_piece", F.expr("0L") + F.floor(place * F.col("_pieces") / (1 << 32)))
    partial = rows.where(F.col("_rest") > 0)

    sums = partial.groupBy(*levels, "_piece").agg(F.sum("tokens").alias("_sum"))
    earlier = Window.partitionBy(*levels).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(level).alias(f"_{level}") for level in levels],
        F.col("_piece").alias("_at"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("bigint")).alias("_before"),
    )
    met = partial.join(sums, [*same, F.col("_piece") == F.col("_at")]).where(F.col("_before") < F.col("_rest"))
    inside = Window.partitionBy(*levels, "_piece").orderBy("_order", "doc_id", "tokens")
    upto = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("_before", F.col("_before") + F.coalesce(upto, F.lit(0)))
    begun = met.where(F.col("_before") < F.col("_rest")).select(
        "doc_id", *levels, F.col("_epochs").alias("epoch"), "tokens",
        F.least(F.col("tokens"), F.col("_rest") - F.col("_before")).alias("taken"), *keep,
    )
    whole = rows.where(F.col("_epochs") > 0).select(
        "doc_id", *levels, F.explode(F.expr("sequence(0L, _epochs - 1)")).alias("epoch"), "tokens",
        F.col("tokens").alias("taken"), *keep,
    )
    return whole.unionByName(begun)


def domain_of(source: Column) -> Column:
    """Three domains of the supplied sources: the largest one, and two by number."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return (
        F.when(source.isNull() | (number == ""), F.lit("other"))
        .when(source == "src0", F.lit("crawl"))
        .when(F.substring(number, -1, 1) < "5", F.lit("books"))
        .otherwise(F.lit("forums"))
    )


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, domain, lang, source and tokens of each document."""
    return docs.select(
        "doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", words_in(F.col("text")).alias("tokens")
    )


#: Weights of the query: languages and domains apart from their shares, a few sources more than others.
TARGETS = Targets(
    weights={
        "domain": {"crawl": 2, "books": 5, "forums": 3},
        "lang": {"en": 5, "fr": 2, "de": 2, "es": 1},
        "source": {"src1": 3, "src7": 2},
    },
    per_mille=1000,
    epochs=2,
)


def mixed_documents(docs: DataFrame, targets: Targets) -> DataFrame:
    """The rows of ``docs`` that the mix uses, once for each epoch, whole and with their own columns."""
    whole = fresh(docs.columns, "_row")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias(whole), *leaves_of(docs).columns[:1],
        domain_of(F.col("source")).alias("domain"), "lang", "source", words_in(F.col("text")).alias("tokens"),
    )
    return selected(rows, targets, keep=[whole]).select(*[F.col(whole)[name].alias(name) for name in docs.columns])
