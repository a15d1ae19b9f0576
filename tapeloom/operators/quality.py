"""Checks and previews: one pass with partial counts, never the rows themselves."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tapeloom import scratch
from tapeloom.operators import skew
from tapeloom.operators.joins import join_lookup
from tapeloom.operators.windows import rank_within

# Places of a hash, 15 hexadecimal digits, and names of helper columns, which no table of a user has.
_PLACES = 1 << 60
_DRAW, _PLACE, _ALL, _ROWS, _BOUND, _GOT, _RANK = (
    f"__tapeloom_{name}" for name in ("draw", "place", "all", "rows", "bound", "got", "rank")
)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """The number of rows, as a frame of one row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def preview(df: DataFrame, order_by: str | Sequence[str], rows: int = 20) -> DataFrame:
    """The first rows by a key. Each task keeps only its own first rows."""
    return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(rows)


def sample_by_key(df: DataFrame, key: str, one_in: int) -> DataFrame:
    """About one key in ``one_in``, with all its rows, chosen by the key's MD5: the same on every run."""
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return df.where(F.conv(digits, 16, 10).cast("bigint") % one_in == 0)


def sample_exact(
    df: DataFrame,
    rows: int,
    by: str | Sequence[str],
    keys: str | Sequence[str] = (),
    seed: str = "",
    group_rows: int = skew.GROUP_ROWS,
) -> DataFrame:
    """Exactly ``rows`` rows of each group, all of a smaller one: those with the smallest MD5 of seed and ``by``.

    The same rows on every run where ``by`` is unique; among rows that share it the other columns do not
    decide. NULL keys form a group; without ``keys`` all rows are one.

    Nothing is sorted as a whole. Groups are counted, and a bound on the hash lets through a little over
    ``rows`` of each; only those are ranked. Where too few came through, as when many rows share ``by``, the
    bound of that group is raised and its rows are read again.
    """
    by, keys = ([names] if isinstance(names, str) else list(names) for names in (by, keys))
    if rows < 1 or not by:
        raise ValueError("a sample has rows, and columns to draw them by")
    text = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in by]
    drawn = df.withColumn(_DRAW, F.md5(F.concat_ws("|", F.lit(seed), *text)))
    drawn = drawn.withColumn(_PLACE, F.conv(F.substring(_DRAW, 1, 15), 16, 10).cast("bigint"))
    groups = keys
    if not keys:
        drawn, groups = drawn.withColumn(_ALL, F.lit(0)), [_ALL]
    wanted = rows + 6 * math.isqrt(rows) + 30
    bound = F.when(F.col(_ROWS) <= wanted, _PLACES).otherwise(F.floor(F.lit(float(_PLACES)) * wanted / F.col(_ROWS)))
    bounds = drawn.groupBy(*groups).agg(F.count(F.lit(1)).alias(_ROWS)).withColumn(_BOUND, bound.cast("bigint"))
    bounds = scratch.keep(bounds, "bounds")

    def within(limits: DataFrame) -> DataFrame:
        met = join_lookup(drawn, limits.select(*groups, _BOUND), groups, "inner", null_safe=True, hot_rows=group_rows, unique=True)
        return scratch.keep(met.where(F.col(_PLACE) < F.col(_BOUND)).drop(_BOUND), "drawn")

    parts = []
    while True:
        some = within(bounds)
        got = some.groupBy(*[F.col(name).alias(f"_of_{name}") for name in groups]).agg(F.count(F.lit(1)).alias(_GOT))
        same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in groups])
        checked = bounds.join(got, same, "left").drop(*[f"_of_{name}" for name in groups])
        short = F.coalesce(_GOT, F.lit(0)) < F.least(F.lit(rows), F.col(_ROWS))
        again = scratch.keep(checked.where(short).drop(_GOT), "bounds")
        missing = not again.isEmpty()
        if missing:
            renamed = again.select(*[F.col(name).alias(f"_of_{name}") for name in groups])
            some = some.join(renamed, same, "left_anti")
        parts.append(some)
        if not missing:
            break
        raised = F.when(F.col(_BOUND) < _PLACES // 32, F.col(_BOUND) * 16 + (1 << 40)).otherwise(F.lit(_PLACES))
        bounds = again.withColumn(_BOUND, raised)
    through = reduce(DataFrame.unionByName, parts)
    ranked = rank_within(through, groups, [_DRAW, *by], _RANK, group_rows, rank_type="bigint")
    return ranked.where(F.col(_RANK) <= rows).select(*[F.col(f"`{name}`") for name in df.columns])


# Values of one column on a path: a function that sums up a count over all of them in a row.
_Over = Callable[[Callable[[Column], Column]], Column]


def _violations(path: str, found: DataType, wanted: DataType, over: _Over) -> Iterator[tuple]:
    """Path, problem, expected and found type, and the count in a row, for all that is wrong below ``path``."""

    def known(count: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda value: F.when(value.isNotNull(), count(value)).otherwise(F.lit(0).cast("bigint"))

    def each(items: Callable[[Column], Column]) -> _Over:
        start = F.lit(0).cast("bigint")
        return lambda count: over(known(lambda value: F.aggregate(items(value), start, lambda sum, x: sum + count(x))))

    def nulls(place: str, kind: DataType, within: _Over) -> tuple:
        return place, "null", kind.simpleString(), kind.simpleString(), within(lambda value: value.isNull().cast("bigint"))

    if isinstance(found, StructType) and isinstance(wanted, StructType):
        have = {field.name.lower(): field for field in found.fields}
        for field in wanted.fields:
            place, own = f"{path}.{field.name}" if path else field.name, have.pop(field.name.lower(), None)
            if own is None:
                yield place, "missing", field.dataType.simpleString(), None, None
                continue
            inside: _Over = lambda count, name=own.name: over(known(lambda value: count(value.getField(name))))
            if not path:
                inside = lambda count, name=own.name: count(F.col(f"`{name}`"))
            if not field.nullable:
                yield nulls(place, own.dataType, inside)
            yield from _violations(place, own.dataType, field.dataType, inside)
        for own in have.values():
            yield f"{path}.{own.name}" if path else own.name, "extra", None, own.dataType.simpleString(), None
    elif isinstance(found, ArrayType) and isinstance(wanted, ArrayType):
        inside = each(lambda value: value)
        if not wanted.containsNull:
            yield nulls(f"{path}.element", found.elementType, inside)
        yield from _violations(f"{path}.element", found.elementType, wanted.elementType, inside)
    elif isinstance(found, MapType) and isinstance(wanted, MapType):
        yield from _violations(f"{path}.key", found.keyType, wanted.keyType, each(F.map_keys))
        inside = each(F.map_values)
        if not wanted.valueContainsNull:
            yield nulls(f"{path}.value", found.valueType, inside)
        yield from _violations(f"{path}.value", found.valueType, wanted.valueType, inside)
    elif found != wanted:
        nested = isinstance(found, (StructType, ArrayType, MapType)) or isinstance(wanted, (StructType, ArrayType, MapType))

        def unfit(value: Column) -> Column:
            bad = value.isNotNull() if nested else value.isNotNull() & value.try_cast(wanted).isNull()
            return bad.cast("bigint")

        yield path, "mistyped", wanted.simpleString(), found.simpleString(), over(unfit)


def schema_violations(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per column that is missing, extra, of another type, or NULL where the schema forbids it.

    Columns inside structs, arrays and maps count too, by their path: ``a.b`` for a field, ``a.element``,
    ``a.key`` and ``a.value`` for what arrays and maps hold. For one of another type ``unfit`` counts the values
    that do not convert to the expected one, all of them where only one of both is nested; for one that
    may not be NULL it counts NULLs, and there is no row without any. A value inside a NULL is not counted.
    Names go without regard to case. All counts are taken in one pass.
    """
    entries = list(_violations("", df.schema, expected, lambda count: count(F.lit(None))))
    report = "column string, problem string, expected string, found string, unfit bigint, rows bigint"
    if not entries:
        return df.sparkSession.createDataFrame([], report)
    nothing = F.lit(None).cast("bigint")
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            (nothing if unfit is None else F.coalesce(F.sum(unfit), F.lit(0).cast("bigint"))).alias(f"unfit_{i}")
            for i, (*_, unfit) in enumerate(entries)
        ],
    )
    lines = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(problem).alias("problem"),
            F.lit(want).cast("string").alias("expected"),
            F.lit(have).cast("string").alias("found"),
            F.col(f"unfit_{i}").alias("unfit"),
            F.col("rows"),
        )
        for i, (column, problem, want, have, _) in enumerate(entries)
    ]
    return counted.select(F.inline(F.array(*lines))).where((F.col("problem") != "null") | (F.col("unfit") > 0))


def quality_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that pass, fail, or leave undecided each named boolean rule, counted in one pass."""
    if not rules:
        raise ValueError("no rules to check")
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, rule in enumerate(rules.values()):
        counts += [F.count_if(rule).alias(f"passed_{i}"), F.count_if(~rule).alias(f"failed_{i}")]
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col("rows"),
            F.col(f"passed_{i}").alias("passed"),
            F.col(f"failed_{i}").alias("failed"),
            (F.col("rows") - F.col(f"passed_{i}") - F.col(f"failed_{i}")).alias("undecided"),
        )
        for i, name in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))
