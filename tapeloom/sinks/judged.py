"""Writes that are judged before anybody sees them.

Rows are written once, into a hidden folder beside the target, and counted while they are. The counts decide:
within the bounds the folder is moved into place, else it is removed and the target stays as it was. Rows that
fail a rule can go to a folder of their own in that same write, each with the names of its rules.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.sinks import folders
from tapeloom.sinks.writers import MODES, setting

# The column and folder that names the rules a row fails, and its value where there are none.
FAILED, PASSED = "failed_rules", "passed"
# A task holds up to this many folders open at once, so that rows need no sort by folder; past that it sorts the rest.
FOLDERS_OPEN = 8


class Refused(ValueError):
    """A write, or a job before its write, that was held against its bounds and refused; ``seen`` has the counts."""

    def __init__(self, message: str, seen: Mapping[str, int]):
        super().__init__(message)
        self.seen = dict(seen)


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row fails, joined by commas, ``<rule> undecided`` for one that is NULL; else PASSED."""
    names = [F.when(rule.isNull(), F.lit(f"{name} undecided")).when(~rule, F.lit(name)) for name, rule in rules.items()]
    failed = F.concat_ws(",", *names)  # passes over NULLs
    return F.when(failed == "", F.lit(PASSED)).otherwise(failed)


def _checked(df: DataFrame, rules: Mapping[str, Column], most_failing: Mapping[str, float]) -> None:
    if not rules:
        raise ValueError("no rules to judge by")
    unknown = set(most_failing) - set(rules)
    if unknown:
        raise ValueError(f"a bound for no rule: {', '.join(sorted(unknown))}")
    for name in rules:
        if name in ("rows", PASSED) or "," in name or "/" in name:
            raise ValueError(f"a rule cannot be named {name}")
    if FAILED in {name.lower() for name in df.columns}:
        raise ValueError(f"rows have a column {FAILED}")


def counts_of(rules: Mapping[str, Column]) -> dict[str, Column]:
    """What is counted while rows are written: all rows, and for each rule those that fail it or leave it open."""
    counts = {"rows": F.count(F.lit(1))}
    for name, rule in rules.items():
        counts |= {name: F.count_if(~rule), f"{name} undecided": F.count_if(rule.isNull())}
    return counts


def over_bounds(seen: Mapping[str, int], most_failing: Mapping[str, float]) -> list[str]:
    """The rules that a larger share of rows than their bound fails or leaves open."""
    return [
        name for name, share in most_failing.items() if seen[name] + seen[f"{name} undecided"] > share * seen["rows"]
    ]


def write_judged(
    df: DataFrame,
    rules: Mapping[str, Column],
    path: str | None = None,
    table: str | None = None,
    rejects: str | None = None,
    most_failing: Mapping[str, float] | None = None,
    mode: str = "overwrite",
    format: str = "parquet",
    options: Mapping[str, object] | None = None,
) -> dict[str, int]:
    """Write ``df`` to a folder or a table if its rows keep within the bounds; returns the counts.

    ``rules`` are named boolean conditions; ``most_failing`` gives for some of them the share of rows, 0 to 1,
    that may fail or be undecided. Over it ``Refused`` is raised and the target is as it was before.

    With ``rejects``, a folder, rows that fail or leave open a rule go there instead of the target, in folders
    ``failed_rules=<names>``, so reading it back gives that column; it is replaced or added to like the
    target. Both are written in one pass, and their rows add up to those of ``df``.

    Modes are those of ``write_files``; ``ignore`` with a target that is there does nothing and returns an
    empty result. With ``append`` files are moved in one by one. Between taking out the old folder and
    putting in the new there is a moment without a target; if the second step fails the first is undone.
    A table is filled from the judged files in a second write, to a table beside it that takes its name.
    """
    spark, bounds, options = df.sparkSession, dict(most_failing or {}), dict(options or {})
    mode = mode.lower()
    if bool(path) == bool(table):
        raise ValueError("give a path or a table")
    if mode not in MODES:
        raise ValueError(f"unknown write mode: {mode}")
    _checked(df, rules, bounds)
    there = spark.catalog.tableExists(table) if table else folders.exists(spark, path)
    if there and mode == "ignore":
        return {}
    if there and mode in ("error", "errorifexists"):
        raise FileExistsError(f"{table or path} is there already")

    staged = scratch.new_path(spark, "judged") if table else folders.aside_of(path, "judged")
    observation = Observation()
    judged = df.withColumn(FAILED, failed_rules(rules)) if rejects else df
    judged = judged.observe(observation, *[count.alias(name) for name, count in counts_of(rules).items()])
    try:
        writer = judged.write.format(format).options(**options)
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(FOLDERS_OPEN)):
            (writer.partitionBy(FAILED) if rejects else writer).save(staged)
        seen = observation.get
        over = over_bounds(seen, bounds)
        if over:
            raise Refused(f"too many rows fail {', '.join(over)}: {seen}", seen)
        passed = f"{staged}/{FAILED}={PASSED}" if rejects else staged
        if rejects and not folders.exists(spark, passed):
            df.limit(0).write.format(format).options(**options).save(passed)
        _publish(df, passed, path, table, mode if there else "overwrite", format, options)
        if rejects:
            if folders.exists(spark, passed):
                folders.remove(spark, passed)
            _publish_folder(df, staged, rejects, mode)
        return seen
    finally:
        folders.remove(spark, staged)


def _publish_folder(df: DataFrame, staged: str, target: str, mode: str) -> None:
    spark = df.sparkSession
    if mode == "append" and folders.exists(spark, target):
        folders.add_files(spark, staged, target)
    else:
        folders.swap_in(spark, staged, target)


def _publish(df, staged, path, table, mode, format, options) -> None:
    if path:
        _publish_folder(df, staged, path, mode)
        return
    spark = df.sparkSession
    rows = spark.read.format(format).schema(df.schema).options(**options).load(staged)
    if mode == "append":
        rows.write.insertInto(table)
        return
    beside = f"{table}_{uuid.uuid4().hex}"
    fresh, old = f"{beside}_new", f"{beside}_old"
    rows.write.format(format).options(**options).saveAsTable(fresh)
    there = spark.catalog.tableExists(table)
    if there:
        spark.sql(f"alter table {table} rename to {old}")
    try:
        spark.sql(f"alter table {fresh} rename to {table}")
    except Exception:
        if there:
            spark.sql(f"alter table {old} rename to {table}")
        raise
    if there:
        spark.sql(f"drop table {old}")
