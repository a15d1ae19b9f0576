"""A pipeline from a source table to a target, as one call."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom.operators.quality import schema_violations
from tapeloom.plans.flat_table import flat
from tapeloom.plans.silver_table import SilverOptions, silver, silver_by_company, silver_rows
from tapeloom.sinks import Refused, dated_path, write_days, write_files, write_judged, write_table
from tapeloom.sinks.judged import counts_of
from tapeloom.sources import read_table, table_exists

# The columns raw trades have.
RAW_COLUMNS = ["Time", "Company", "Exchange", "Price", "percentage_change"]
# What files of text are written with unless the job says otherwise. A trade's rows are alike but for the
# company, so they take a small part of the disk; such files are read by one task each, and so hold a bounded number of rows.
TEXT_FORMATS = {"csv", "json", "xml"}
TEXT_OPTIONS = {"compression": "gzip", "maxRecordsPerFile": 4_000_000}


@dataclass(frozen=True)
class Job:
    """What to read, which pipeline to run, and where to write.

    Text (csv, json, xml) is written compressed, in files of bounded size; ``writer_options`` that name a
    ``compression`` (``none`` for plain text) or ``maxRecordsPerFile`` come first.

    With ``target_table`` the result is saved as a table; otherwise as files in a folder of the day
    below ``target_root``. With ``day_column`` the table is partitioned by that column, which holds ``day``,
    and only that day is replaced; ``mode`` does not count then.

    ``rules`` are conditions on the result; rows that fail one are counted while they are written. With
    ``most_failing``, the share of rows that may fail a rule, or with ``rejects_root``, below which rows that
    fail go to a folder of the day, the result is judged before it takes its place: see ``write_judged``.

    Before anything is written, ``schema`` is held against the source, and ``most_rows`` against the number
    of rows that the plan will put out. Columns that the schema does not name are let through.
    """

    source_table: str
    target_table: str | None = None
    target_root: str | None = None
    day: date | None = None
    plan: str = "silver"
    predicate: str | None = None
    format: str = "parquet"
    mode: str = "overwrite"
    writer_options: Mapping[str, object] = field(default_factory=dict)
    row_key: tuple[str, ...] = ("trade_id",)
    options: SilverOptions = SilverOptions()
    rules: Mapping[str, Column] = field(default_factory=dict)
    most_failing: Mapping[str, float] = field(default_factory=dict)
    rejects_root: str | None = None
    day_column: str | None = None
    schema: StructType | None = None
    most_rows: int | None = None


def run(spark: SparkSession, job: Job) -> dict[str, int]:
    """Run a job; returns the rows written, and for each rule the rows that fail it.

    Rows for which a rule is NULL are counted as ``<rule> undecided``. With ``most_rows`` the result also has
    the ``rows foreseen``. A job over one of its bounds raises ``Refused`` and leaves the target as it was.
    With mode ``ignore`` and a target that exists nothing is written and the result has nothing counted.
    """
    if {"rows", "rows foreseen"} & set(job.rules):
        raise ValueError("a rule cannot be named rows or rows foreseen")
    if bool(job.target_table) == bool(job.target_root):
        raise ValueError("give a target table or a target root")
    if job.target_root and job.day is None:
        raise ValueError("files go to a folder of the day, so give a day")
    if (job.day_column or job.rejects_root) and job.day is None:
        raise ValueError("give the day that is replaced, or of which rows are rejected")
    if job.day_column and (job.target_root or job.most_failing or job.rejects_root):
        raise ValueError("a day of a table is replaced; its rows are counted, not judged")
    if (job.most_failing or job.rejects_root) and not job.rules:
        raise ValueError("no rules to judge by")
    if job.plan not in ("silver", "silver_by_company", "flat"):
        raise ValueError(f"unknown plan: {job.plan}")
    if not table_exists(spark, job.source_table):
        raise ValueError(f"no such table: {job.source_table}")
    trades = read_table(spark, job.source_table, job.predicate)
    present = {name.lower() for name in trades.columns}
    missing = [name for name in [*RAW_COLUMNS, *job.row_key] if name.lower() not in present]
    if missing:
        raise ValueError(f"{job.source_table} lacks {', '.join(missing)}")

    if job.schema is not None:
        wrong = schema_violations(trades, job.schema).where("problem != 'extra'").collect()
        if wrong:
            listed = ", ".join(f"{row['column']} {row['problem']}" for row in wrong)
            raise Refused(f"{job.source_table}: {listed}", {f"{row['column']} {row['problem']}": row["unfit"] or 0 for row in wrong})
    foreseen = {}
    if job.most_rows is not None:
        foreseen = {"rows foreseen": silver_rows(trades) if job.plan == "silver" else trades.count()}
        if foreseen["rows foreseen"] > job.most_rows:
            raise Refused(f"{job.plan} puts out {foreseen['rows foreseen']} rows, {job.most_rows} at most are wanted", foreseen)

    if job.plan == "flat":
        result = flat(trades, job.row_key, job.options.group_rows)
    else:
        build = silver if job.plan == "silver" else silver_by_company
        result = build(trades, job.row_key, job.options)
    return {**_written(result, job), **foreseen}


def _options(job: Job) -> dict[str, object]:
    """The writer's options, with those of text that the job does not name; names go without regard to case."""
    named = {name.lower() for name in job.writer_options} | {"compression" for name in job.writer_options if name.lower() == "codec"}
    text = TEXT_OPTIONS if job.format.lower() in TEXT_FORMATS else {}
    return {**{name: value for name, value in text.items() if name.lower() not in named}, **job.writer_options}


def _written(result: DataFrame, job: Job) -> dict[str, int]:
    observe, options = counts_of(job.rules), _options(job)
    if job.day_column:
        dated = result.withColumn(job.day_column, F.lit(job.day))
        return write_days(dated, job.target_table, job.day_column, [job.day], job.format, options, observe)
    path = dated_path(job.target_root, job.day) if job.target_root else None
    if job.most_failing or job.rejects_root:
        rejects = dated_path(job.rejects_root, job.day) if job.rejects_root else None
        judged = {"most_failing": job.most_failing, "mode": job.mode, "format": job.format, "options": options}
        return write_judged(result, job.rules, path, job.target_table, rejects, **judged)
    if job.target_table:
        return write_table(result, job.target_table, job.mode, job.format, options, observe)
    return write_files(result, path, job.mode, job.format, options, observe)
