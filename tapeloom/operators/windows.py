"""Ranks, group totals and running totals.

A window puts each group into one task. That is right for groups of bounded size; the rows of keys
found to hold more are handled in pieces, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.operators import skew
from tapeloom.operators.joins import BROADCAST_BYTES, join_lookup


# Names of helper columns, which no table of a user has.
_BEFORE = {"__tapeloom_sum": "__tapeloom_before_sum", "__tapeloom_count": "__tapeloom_before_count"}


# Sums that are exact: wide enough for values below 10^19 and 18 places after the point. Two of the narrower
# type add up to the wider one without a digit lost.
_WIDE, _NARROW = "decimal(38,18)", "decimal(37,18)"


def _sum_and_mean(value: str, exact: bool, over: Callable[[Column], Column] = lambda measure: measure) -> tuple[Column, Column]:
    """Sum and average; as doubles from a sum of wide decimals where ``exact``, so that no order of adding shows."""
    if not exact:
        return over(F.sum(value)), over(F.avg(value))
    wide = F.col(value).cast(_WIDE)
    total, count = over(F.sum(wide)).cast("double"), over(F.count(wide))
    return total, F.when(count > 0, total / count)


def _listed(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def rank_within(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    name: str = "rank",
    group_rows: int = skew.GROUP_ROWS,
    hot: skew.Hot | None = None,
    rank_type: str = "int",
    looked: bool = False,
) -> DataFrame:
    """Number the rows of each group from 1, in the order of ``order_by``; any order among equals.

    ``hot``, as ``skew.hot_among`` gives it, spares the pass that looks for hot keys, and so does
    ``looked`` where there are none. A group of over
    2 billion rows needs ``rank_type="bigint"``; with ``int`` it is an error, not a wrap.
    """
    keys, order_by = _listed(keys), _listed(order_by)
    if not order_by:
        raise ValueError("a rank needs columns to order by")

    def windowed(part: DataFrame) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
        return part.withColumn(name, number.cast(rank_type))

    def by_position(part: DataFrame, rows: int) -> DataFrame:
        spans = _sorted_spans(part, keys, order_by, rows)
        heads = spans.groupBy(*keys, "__tapeloom_span").agg(F.min("__tapeloom_position").alias("__tapeloom_first"), F.count(F.lit(1)).alias("__tapeloom_rows"))
        earlier = Window.partitionBy(*keys).orderBy("__tapeloom_span").rowsBetween(Window.unboundedPreceding, -1)
        heads = heads.withColumn("__tapeloom_before", F.coalesce(F.sum("__tapeloom_rows").over(earlier), F.lit(0))).drop("__tapeloom_rows")
        ranked = join_lookup(spans, heads, [*keys, "__tapeloom_span"], "inner", null_safe=True, spread_by=["__tapeloom_position"], unique=True)
        rank = F.col("__tapeloom_before") + F.col("__tapeloom_position") - F.col("__tapeloom_first") + 1
        return ranked.withColumn(name, rank.cast(rank_type)).select(*part.columns, name)

    if hot is None and not looked:
        hot = skew.hot_keys(df, keys, group_rows)
    return skew.on_hot_and_cold(df, keys, hot, windowed, by_position)


def _sorted_spans(df: DataFrame, keys: list[str], order_by: list[str], rows: int) -> DataFrame:
    """The rows in sorted order, cut into spans of about equal size, a written table.

    A group of any size spreads over as many spans as it fills, and so do rows equal in every sort
    column: the partition they come from sets them apart, the same one when a task runs again.
    ``_span`` and ``_position`` rise with the order. ``rows`` is the number expected.
    """
    order = [*keys, *order_by, "__tapeloom_from"]
    df = df.withColumn("__tapeloom_from", F.spark_partition_id())
    spans = rows // skew.GROUP_ROWS + 1
    if spans > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        ranged = df.repartitionByRange(spans, *order)
    else:
        ranged = df.repartitionByRange(*order)
    sorted_rows = ranged.sortWithinPartitions(*order).drop("__tapeloom_from")
    numbered = sorted_rows.withColumns({"__tapeloom_span": F.spark_partition_id(), "__tapeloom_position": F.monotonically_increasing_id()})
    return scratch.keep(numbered, "spans")


def totals_over(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    total: str = "total",
    average: str = "average",
    form: str = "join",
    spread_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    group_rows: int = skew.GROUP_ROWS,
    exact: bool = False,
) -> DataFrame:
    """Sum and average over each whole group, on every row. NULL keys form a group.

    Sums of doubles depend on the order in which they are added, in the last digits. With ``exact`` values are
    summed as decimals of 18 places after the point and both results are doubles, the same in every form; a value
    or sum of 10^19 and more is an error then.

    ``form="join"`` totals each group and joins the totals back, so wide rows stay where they are.
    ``form="window"`` reads the rows once and sorts them by key, one task per group; rows of hot keys
    take the other form. It suits input that is dear to read or already partitioned by the key.
    """
    keys = _listed(keys)

    def windowed(part: DataFrame) -> DataFrame:
        group = Window.partitionBy(*keys)
        return part.withColumns(dict(zip((total, average), _sum_and_mean(value, exact, lambda measure: measure.over(group)))))

    def joined(part: DataFrame, _: int) -> DataFrame:
        measures = zip((total, average), _sum_and_mean(value, exact))
        totals = part.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures])
        limits = {"broadcast_bytes": broadcast_bytes, "hot_rows": group_rows, "unique": True}
        back = join_lookup(part, totals, keys, null_safe=True, spread_by=spread_by, **limits)
        return back.select(*part.columns, total, average)

    if form == "join":
        return joined(df, 0)
    if form == "window":
        return skew.on_hot_and_cold(df, keys, skew.hot_keys(df, keys, group_rows), windowed, joined)
    raise ValueError(f"unknown form: {form}")


def running_totals(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    value: str,
    total: str = "total",
    average: str = "average",
    group_rows: int = skew.GROUP_ROWS,
    hot: skew.Hot | None = None,
    spread_by: Sequence[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Sum and average from the start of each group up to the row; rows equal in order share a value.

    ``exact`` is as in ``totals_over``: sums that do not depend on how a group is split.

    A hot group is first summed per step, that is per value of ``order_by``. The steps are summed up
    in order, in pieces if they too are many, and joined back.
    """
    keys, order_by = _listed(keys), _listed(order_by)

    def up_to_here(by: list[str]) -> Window:
        ordered = Window.partitionBy(*by).orderBy(*order_by)
        return ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def windowed(part: DataFrame) -> DataFrame:
        frame = up_to_here(keys)
        return part.withColumns(dict(zip((total, average), _sum_and_mean(value, exact, lambda measure: measure.over(frame)))))

    def by_steps(part: DataFrame, _: int) -> DataFrame:
        summand = F.col(value).cast(_WIDE) if exact else F.col(value)
        steps = part.groupBy(*keys, *order_by).agg(F.sum(summand).alias("__tapeloom_sum"), F.count(summand).alias("__tapeloom_count"))
        steps = scratch.keep(steps, "steps")
        sums = {"__tapeloom_sum": F.sum("__tapeloom_sum"), "__tapeloom_count": F.sum("__tapeloom_count")}

        def summed(some: DataFrame) -> DataFrame:
            frame = up_to_here(keys)
            return some.withColumns({name: measure.over(frame) for name, measure in sums.items()})

        def in_spans(some: DataFrame, rows: int) -> DataFrame:
            spans = _sorted_spans(some, keys, order_by, rows)
            heads = spans.groupBy(*keys, "__tapeloom_span").agg(*[m.alias(_BEFORE[n]) for n, m in sums.items()])
            earlier = Window.partitionBy(*keys).orderBy("__tapeloom_span").rowsBetween(Window.unboundedPreceding, -1)
            heads = heads.withColumns({_BEFORE[n]: F.sum(_BEFORE[n]).over(earlier) for n in sums})
            frame = up_to_here([*keys, "__tapeloom_span"])
            local = spans.withColumns({name: measure.over(frame) for name, measure in sums.items()})
            offset = join_lookup(local, heads, [*keys, "__tapeloom_span"], "inner", null_safe=True, spread_by=["__tapeloom_position"], unique=True)
            zero = F.lit(0)
            own, before = (F.coalesce(name, zero) for name in ("__tapeloom_sum", "__tapeloom_before_sum"))
            added = own.cast(_NARROW) + before.cast(_NARROW) if exact else own + before
            both = F.when(F.coalesce("__tapeloom_sum", "__tapeloom_before_sum").isNotNull(), added)
            count = F.col("__tapeloom_count") + F.coalesce("__tapeloom_before_count", zero)
            return offset.withColumns({"__tapeloom_sum": both, "__tapeloom_count": count}).select(*some.columns)

        hot_steps = skew.hot_keys(steps, keys, group_rows)
        steps = skew.on_hot_and_cold(steps, keys, hot_steps, summed, in_spans)
        joined = join_lookup(part, steps, [*keys, *order_by], "inner", null_safe=True, spread_by=spread_by, unique=True)
        sum_here = F.col("__tapeloom_sum").cast("double") if exact else F.col("__tapeloom_sum")
        mean = F.when(F.col("__tapeloom_count") > 0, sum_here / F.col("__tapeloom_count"))
        return joined.withColumns({total: sum_here, average: mean}).select(*part.columns, total, average)

    if hot is None:
        hot = skew.hot_keys(df, keys, group_rows)
    return skew.on_hot_and_cold(df, keys, hot, windowed, by_steps)
