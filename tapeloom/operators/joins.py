"""Joins of rows to a table of totals, and the check of what such a join will put out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.operators import skew

# A lookup measured at up to this size is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A join in which some row meets at least this many deals its rows out evenly first.
MULTIPLIES = 4
# Fixed value: a helper column, which no table of a user has.
_MET = "__tapeloom_met"


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    spread_by: Sequence[str] | None = None,
    size: scratch.Size | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = skew.GROUP_ROWS,
    dealt: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Left or inner equi-join of ``rows`` to ``lookup``; keys come first in the result.

    ``lookup`` is written once and measured, unless the caller passes its ``size``. If it fits, every
    executor gets it and ``rows`` stay where they are. If not, both sides are shuffled by the keys, and what
    a hot key puts out is cut into a grid of cells, about ``hot_rows`` rows in each, whether it has many
    rows, many lookup rows or both.

    Rows are dealt out by ``spread_by``, best a unique key, or else by turns. That is also done before a
    join that multiplies them, so that each row is worked out once and then multiplied in tasks of even
    size; ``dealt`` says that they come stored in even parts already, and ``unique`` that no key is twice in
    ``lookup``. With ``null_safe`` a NULL key meets a NULL key.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "inner"):
        raise ValueError(f"join_lookup does left and inner joins, not {how}")
    for key in on:
        if rows.schema[_spelt(rows, key)].dataType != lookup.schema[_spelt(lookup, key)].dataType:
            raise TypeError(f"{key} has two types; cast one side first")
    if size is None:
        lookup, size, _ = scratch.keep_measured(lookup, "lookup", on)
    if size.bytes <= broadcast_bytes:
        if not dealt and not unique and _most_met(lookup, on) >= MULTIPLIES:
            by_turns = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.repartition(*spread_by) if spread_by else rows.repartition(by_turns)
        return _equi_join(rows, F.broadcast(lookup), on, how, null_safe)
    # The planner would send a lookup whose file is small, and takes a grid's copies for no larger than what is copied.
    grid = skew.gridded(rows, lookup, on, hot_rows, spread_by or rows.columns, null_safe)
    if grid is None:
        return _equi_join(rows, lookup.hint("merge"), on, how, null_safe)
    met = grid.lookup.withColumn(_MET, F.lit(True)).hint("merge")
    joined = _equi_join(grid.rows, met, on, how, null_safe, extra=skew.CELL)
    return joined.where(F.col(_MET).isNotNull() | (F.col(skew.LOOKUP_PARTS) == 1)).drop(_MET, skew.LOOKUP_PARTS)


def _most_met(lookup: DataFrame, on: list[str]) -> int:
    """Rows of the key that has most of them in a lookup that fits in memory."""
    return lookup.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def _spelt(df: DataFrame, key: str) -> str:
    """The column's name as the frame spells it; names resolve without regard to case."""
    return next(name for name in df.columns if name.lower() == key.lower())


def _equi_join(rows, lookup, on, how, null_safe, extra=()) -> DataFrame:
    keys = [*on, *extra]
    key_names = {key.lower() for key in keys}
    row_columns = [name for name in rows.columns if name.lower() not in key_names]
    lookup_columns = [name for name in lookup.columns if name.lower() not in key_names]
    twice = {name.lower() for name in row_columns} & {name.lower() for name in lookup_columns}
    if twice:
        raise ValueError(f"on both sides and not a key: {', '.join(sorted(twice))}")
    renamed = lookup.withColumnsRenamed({_spelt(lookup, key): f"_of_{key}" for key in keys})
    same = [
        F.col(key).eqNullSafe(F.col(f"_of_{key}")) if null_safe else F.col(key) == F.col(f"_of_{key}") for key in keys
    ]
    joined = rows.join(renamed, reduce(lambda a, b: a & b, same), how)
    key_columns = [_spelt(rows, key) for key in on]
    return joined.select(*[F.col(f"`{name}`") for name in key_columns + row_columns + lookup_columns])


def fanout_report(rows: DataFrame, lookup: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Per key of a left join: rows on each side, rows it will put out, and what to look at.

    Both sides are counted per key before anything is shuffled, so no pair of rows is ever formed.
    """
    on = [on] if isinstance(on, str) else list(on)
    left = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("left_rows"))
    right = lookup.groupBy(*on).agg(F.count(F.lit(1)).alias("right_rows"))
    right = right.select(*[F.col(key).alias(f"_of_{key}") for key in on], "right_rows")
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in on])
    both = left.join(right, same, "full")
    has_key = reduce(lambda a, b: a & b, [F.coalesce(key, f"_of_{key}").isNotNull() for key in on])
    counts = both.select(
        *[F.coalesce(key, f"_of_{key}").alias(key) for key in on],
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
        F.when(has_key, F.coalesce("right_rows", F.lit(0))).otherwise(F.lit(0)).alias("_matches"),
    )
    return counts.select(
        *on,
        "left_rows",
        "right_rows",
        (F.col("left_rows") * F.greatest("_matches", F.lit(1))).alias("output_rows"),
        F.when(F.col("_matches") == 0, F.col("left_rows")).otherwise(F.lit(0)).alias("unmatched_left_rows"),
        (F.col("right_rows") > 1).alias("right_repeats"),
    )


def join_rows(rows: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> int:
    """How many rows a left or inner join will put out, from counts per key on both sides; no pair is formed."""
    if how not in ("left", "inner"):
        raise ValueError(f"left and inner joins are counted, not {how}")
    wanted = F.col("output_rows") if how == "left" else F.col("output_rows") - F.col("unmatched_left_rows")
    return int(fanout_report(rows, lookup, on).agg(F.sum(wanted.cast("decimal(38,0)"))).first()[0] or 0)
