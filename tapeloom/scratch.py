"""Intermediate tables that are written once and read more than once.

A written table cuts lineage, survives lost executors, and tells the planner its real size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own_folder: list[str] = []


def folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="tapeloom-"))
        shared = _own_folder[0]
    return f"{shared.rstrip('/')}/tapeloom/{spark.conf.get('spark.app.id', 'app')}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Size:
    """Rows of a table, distinct keys among them (an estimate), and bytes it takes in memory."""

    rows: int
    keys: int
    bytes: int


def keep_measured(
    df: DataFrame, label: str, keys: Sequence[str], largest: str | None = None
) -> tuple[DataFrame, Size, int]:
    """``keep``, with the size and the largest value of a column observed during the write.

    A value counts as 16 bytes, and the length of its text on top.
    """
    per_row = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if field.dataType.typeName() not in _PLAIN:
            per_row = per_row + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.approx_count_distinct(F.xxhash64(*keys)).alias("keys"),
        F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(largest) if largest else F.lit(None), F.lit(0)).cast("bigint").alias("largest"),
    )
    kept = keep(observed, label)
    found = seen.get
    return kept, Size(found["rows"], found["keys"], found["bytes"]), found["largest"]


# Types that fit in the 16 bytes.
_PLAIN = {
    "boolean",
    "byte",
    "short",
    "integer",
    "long",
    "float",
    "double",
    "decimal",
    "date",
    "timestamp",
    "timestamp_ntz",
}
