"""Lempel-Ziv phrase fingerprints: documents that compress alike have signatures that agree.

A text is parsed from left to right into dictionary phrases, each the shortest run of characters that is not
a phrase yet. The set of phrases is hashed into bins, and the smallest hash in each bin is the signature; the
share of bins in which two signatures agree estimates how much the sets have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import id_and_text, id_bounds

BINS = 128
# Characters hashed at once, so that a long text needs no more memory than that.
BLOCK = 1_000_000
# Odd multipliers that spread bits.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_NONE = np.uint64(2**64 - 1)
_FIRST_KEY = -(2**63)


class Parse:
    """The phrases of a text so far; ``copy`` lets two texts with one beginning share its parse."""

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.open = ""
        self.least = np.full(BINS, _NONE)

    def copy(self) -> Parse:
        other = Parse()
        other.seen, other.open, other.least = self.seen.copy(), self.open, self.least.copy()
        return other

    def add(self, text: str) -> Parse:
        seen, phrase, lengths = self.seen, self.open, []
        whole = phrase + text
        note, found = lengths.append, seen.add
        for character in text:
            phrase += character
            if phrase not in seen:
                found(phrase)
                note(len(phrase))
                phrase = ""
        self.open = phrase
        self._hash(whole, np.array(lengths, np.int64))
        return self

    def _hash(self, text: str, lengths: np.ndarray) -> None:
        """Hash the phrases, which stand in ``text`` one after the other, into the bins."""
        ends = np.cumsum(lengths)
        first = 0
        while first < len(lengths):
            start = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, start + BLOCK, side="right")))
            part = lengths[first:last]
            points = np.frombuffer(text[start : int(ends[last - 1])].encode("utf-32-le", "surrogatepass"), np.uint32)
            heads = np.cumsum(part) - part
            place = np.arange(len(points)) - np.repeat(heads, part)
            powers = np.cumprod(np.full(int(part.max()), SPREAD))
            hashes = np.add.reduceat((points.astype(np.uint64) + np.uint64(1)) * powers[place], heads)
            for factor in MIX:
                hashes = (hashes ^ (hashes >> np.uint64(30))) * factor
            hashes ^= hashes >> np.uint64(31)
            np.minimum.at(self.least, (hashes % np.uint64(BINS)).astype(np.int64), hashes >> np.uint64(7))
            first = last

    def signature(self) -> np.ndarray:
        """16 bits for each bin; an empty bin takes those of the next one that is not, changed by the distance."""
        filled = np.flatnonzero(self.least != _NONE)
        if not len(filled):
            return np.zeros(BINS, np.uint16)
        bins = np.arange(BINS)
        after = np.searchsorted(filled, bins)
        source = filled[after % len(filled)]
        away = ((source - bins) % BINS).astype(np.uint64)
        return (((self.least[source] + away) * SPREAD) >> np.uint64(48)).astype(np.uint16)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """The share of bins that agree; a text without phrases is like another such text only."""
    if not left.any() or not right.any():
        return float(not left.any() and not right.any())
    return float(np.mean(left == right))


def signature(text: str) -> np.ndarray:
    return Parse().add(text).signature()


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    """doc_id and the fingerprint of every whole text, as hexadecimal text. Rows stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [written(signature(text or "")) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", fingerprint])

    return id_and_text(docs).mapInArrow(run, f"doc_id bigint, {fingerprint} string")


def _with_next(docs: DataFrame, parts: int | None) -> DataFrame:
    """Rows in ascending doc_id order within ranges of it; each range ends with the first row of the next.

    That last row has ``guest`` set; the last range ends with the first row of all. Equal ids are ordered
    by text, and NULL ids come first.
    """
    rows = id_and_text(docs).withColumns(
        {"key": F.coalesce("doc_id", F.lit(_FIRST_KEY)), "text": F.coalesce("text", F.lit(""))}
    )
    bounds = F.lit(id_bounds(docs, parts=parts)).cast("array<bigint>")
    rows = rows.withColumn("part", F.size(F.filter(bounds, lambda bound: bound <= F.col("key"))))
    # One entry for each range, of which there are as many as shuffle partitions at most.
    heads = sorted((row["part"], row["key"]) for row in rows.groupBy("part").agg(F.min("key").alias("key")).collect())
    if not heads:
        return rows.withColumn("guest", F.lit(False))
    before = [(part, key, heads[i - 1][0]) for i, (part, key) in enumerate(heads)]
    wanted = docs.sparkSession.createDataFrame(before, "part int, key bigint, target int")
    guests = rows.join(F.broadcast(wanted), ["part", "key"]).groupBy("target", "key", "doc_id").agg(F.min("text").alias("text"))
    rows = rows.withColumn("guest", F.lit(False))
    guests = guests.select("doc_id", "text", "key", F.col("target").alias("part"), F.lit(True).alias("guest"))
    dealt = rows.unionByName(guests).repartitionById(heads[-1][0] + 1, F.col("part"))
    return dealt.sortWithinPartitions("part", "guest", "key", "text")


def compared_with_edits(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of an edited one, and how like they are.

    The edited text has the last quarter (rounded down, in code points) replaced by as many first code
    points of the next document in ascending doc_id order, or all of them; the first document follows the
    last. ``near_edited`` and ``near_next`` are the likeness to the edited text's and to the next
    document's fingerprint, 0 to 1. A NULL text counts as empty; a single document is its own next one.
    Texts are shuffled once, by ranges of doc_id, and a task holds two of them at a time.
    """
    columns = {
        "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            made = []
            for key, text, part, guest in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "part", "guest"))):
                text = text or ""
                tail = len(text) // 4
                cut = len(text) - tail
                start = Parse().add(text[:cut])
                own = start.copy().add(text[cut:]).signature()
                if held and held[0] == part:
                    _, before, whole, quarter, begun, theirs = held
                    other = text[:quarter]
                    edited = begun.add(other).signature()
                    digest = hashlib.sha256((whole[: len(whole) - quarter] + other).encode("utf-8", "surrogatepass"))
                    near = likeness(theirs, edited), likeness(theirs, own)
                    made.append((before, len(whole), digest.hexdigest(), written(theirs), written(edited), *near))
                held = None if guest else (part, key, text, tail, start, own)
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*made), columns.values())] if made else []
            if arrays:
                yield pa.RecordBatch.from_arrays(arrays, list(columns))

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_next(docs, parts).select("doc_id", "text", "part", "guest").mapInArrow(run, schema)
