"""Finding the keys that hold too many rows, and spreading those rows over many tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tapeloom import scratch

# A group of up to this many rows is one task's work.
GROUP_ROWS = 5_000_000
# A table of hot keys measured at up to this size is sent to every executor.
HOT_BYTES = 64 * 1024 * 1024
# Names of helper columns, which no table of a user has.
HASH, ROWS, PIECES = "__tapeloom_hash", "__tapeloom_rows", "__tapeloom_pieces"
ROW_PARTS, LOOKUP_PARTS = "__tapeloom_row_parts", "__tapeloom_lookup_parts"
ROW_PART, LOOKUP_PART = CELL = "__tapeloom_row_part", "__tapeloom_lookup_part"


@dataclass(frozen=True)
class Hot:
    """The keys over the bound: a written table of their hashes and rows, how many they are, and their rows.

    A table of n rows has fewer than n / bound such keys, so nothing limits their number.
    """

    table: DataFrame
    keys: int
    rows: int

    def small(self) -> DataFrame:
        """The table, to be broadcast if it is measured to fit."""
        return F.broadcast(self.table) if 32 * self.keys <= HOT_BYTES else self.table


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys])


def _kept(over: DataFrame) -> Hot | None:
    """None where no key is over the bound, and then nothing is written."""
    keys, rows = over.agg(F.count(F.lit(1)), F.sum(ROWS)).first()
    return Hot(scratch.keep(over, "hot"), keys, rows) if keys else None


def hot_keys(df: DataFrame, keys: Sequence[str], above: int = GROUP_ROWS) -> Hot | None:
    """Every key that holds over ``above`` rows, counted exactly; None if there is none.

    One narrow pass with partial counts, so a hot key shuffles one row per task; a second one writes the
    keys down if there are any.
    """
    counts = df.select(key_hash(keys).alias(HASH)).groupBy(HASH).agg(F.count(F.lit(1)).alias(ROWS))
    return _kept(counts.where(F.col(ROWS) > above))


def hot_among(counts: DataFrame, keys: Sequence[str], rows: str, above: int = GROUP_ROWS) -> Hot | None:
    """The same from a table that already holds the number of rows per key."""
    over = counts.where(F.col(rows) > above).select(key_hash(keys).alias(HASH), F.col(rows).alias(ROWS))
    return _kept(over.groupBy(HASH).agg(F.max(ROWS).alias(ROWS)))


def on_hot_and_cold(
    df: DataFrame,
    keys: Sequence[str],
    hot: Hot | None,
    cold_form: Callable[[DataFrame], DataFrame],
    hot_form: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """Treat rows of hot keys one way, told how many to expect, and all others another way.

    The result has the types of the cold form whether or not a key is hot.
    """
    if not hot:
        return cold_form(df)
    is_hot = key_hash(keys) == F.col(HASH)
    cold = cold_form(df.join(hot.small(), is_hot, "left_anti"))
    split = hot_form(df.join(hot.small(), is_hot, "left_semi"), hot.rows)
    return cold.unionByName(split.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in cold.schema]))


@dataclass(frozen=True)
class Grid:
    """Both sides of a join, to be joined on CELL besides the keys.

    Rows carry LOOKUP_PARTS, over 1 where their key's lookup rows are dealt out; such a key has lookup
    rows, so that in a left join a row that meets nothing in one of its cells is no result.
    """

    rows: DataFrame
    lookup: DataFrame


def gridded(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    above: int,
    spread_by: Sequence[str],
    null_safe: bool = False,
) -> Grid | None:
    """Cut what each key puts out into a grid of cells; None if no key puts out over ``above`` rows.

    A key with l rows and r lookup rows that puts out over ``above`` rows has its rows dealt into p parts
    and its lookup rows into q, so that a cell, one part of each, puts out about ``above`` rows. Each row
    goes to the q cells of its part and each lookup row to p, and p : q = l : r makes l * q + r * p copies as
    few as can be; p is at most l, and q at most r. Keys that put out less are one cell. Parts also depend
    on the input partition, which spreads copies of one row and is the same when a task runs again.
    """
    left = rows.groupBy(*[F.col(key) for key in keys]).agg(F.count(F.lit(1)).alias(ROWS))
    right = lookup.select(*[F.col(key).alias(f"_of_{key}") for key in keys])
    if not null_safe:
        right = right.dropna()  # NULL keys meet nothing
    right = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias(PIECES))
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])
    both = left.join(right, same, "left").withColumn(PIECES, F.coalesce(PIECES, F.lit(0)))
    l, r = F.col(ROWS).cast("double"), F.greatest(F.col(PIECES), F.lit(1)).cast("double")
    cells = F.ceil(l * r / above).cast("double")
    p = F.least(l, cells, F.greatest(F.lit(1.0), F.round(F.sqrt(cells * l / r)), F.ceil(cells / r)))
    q = F.least(r, F.greatest(F.lit(1.0), F.ceil(cells / F.col(ROW_PARTS))))
    over = both.where(l * r > above).withColumn(ROW_PARTS, p.cast("bigint")).withColumn(LOOKUP_PARTS, q.cast("bigint"))
    over = over.select(*[F.col(key).alias(f"_of_{key}") for key in keys], ROW_PARTS, LOOKUP_PARTS)
    parts, size, _ = scratch.keep_measured(over, "parts", [f"_of_{key}" for key in keys])
    if not size.rows:
        return None
    parts = F.broadcast(parts) if size.bytes <= HOT_BYTES else parts
    one = F.lit(1).cast("bigint")

    def with_parts(df: DataFrame) -> DataFrame:
        met = df.join(parts, same, "left").drop(*[f"_of_{key}" for key in keys])
        return met.withColumns({name: F.coalesce(name, one) for name in (ROW_PARTS, LOOKUP_PARTS)})

    def part(columns: Sequence[str], count: str) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in columns], F.spark_partition_id()), F.col(count))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    dealt = with_parts(rows).withColumn(ROW_PART, part(spread_by, ROW_PARTS)).withColumn(LOOKUP_PART, every(LOOKUP_PARTS))
    hashed = [field.name for field in lookup.schema if not isinstance(field.dataType, MapType)]
    met = with_parts(lookup).withColumn(LOOKUP_PART, part(hashed, LOOKUP_PARTS)).withColumn(ROW_PART, every(ROW_PARTS))
    return Grid(dealt.drop(ROW_PARTS), met.drop(ROW_PARTS, LOOKUP_PARTS))
