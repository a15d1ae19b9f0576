"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows handled at once inside a Python task, and the characters after which a slice ends sooner.
SLICE_ROWS = 500
SLICE_CHARS = 2_000_000


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column in ``taken`` has it; case does not count."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that the operators read."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def residue(key: str, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus``; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, by rows and by length of the text column."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for i, length in enumerate(lengths):
            if i > start and (i - start >= SLICE_ROWS or held + length > chars):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += length
        if start < len(lengths):
            yield batch.slice(start)


@contextmanager
def released(*caches: dict) -> Iterator[None]:
    """Empty what a task remembers when it ends, as its Python worker goes on to other tasks."""
    try:
        yield
    finally:
        for cache in caches:
            cache.clear()
        pa.default_memory_pool().release_unused()


def id_bounds(docs: DataFrame, key: str = "doc_id", parts: int | None = None) -> list[int]:
    """Up to ``parts - 1`` values that cut a numeric key into ranges of about equal numbers of rows.

    ``parts`` is the number of shuffle partitions unless given. One narrow pass with a sketch.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(F.col(key), at, 10 * parts).alias("bounds")).first()["bounds"]
    return sorted(set(found or []))
