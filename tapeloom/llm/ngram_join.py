"""Jaccard self-join of documents on word shingles, and the components its links make.

Exact: two documents link when ``100 * intersection >= percent * union``, and no link is lost.

* Documents with one and the same set are one class; only one of each goes on.
* Shingles are ordered from rare to frequent, in one order for all. Documents that link share one of the first
  few in that order, so only those are looked up, and passages that many documents share come last.
* In a first round each document is held against one other, the one that heads most of the groups it is in.
  A group's head is the document with the fewest shingles of its own, so the original among its edited copies:
  two copies may be too far apart, but the original links with both. Most copies are then in one component, and
  a pair inside a component needs no further look.
* In a second round groups are cut into tiles by bands of size, and tiles into blocks where they are large. All
  pairs of a tile from two components are looked at there, and only those that may link leave it.
* A pair's bitmaps, in which each shingle turns one bit, bound its overlap from above. What passes is decided
  by the intersection of the sorted sets, made again from the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.llm.common import fresh, id_and_text, released, slices
from tapeloom.llm.components import components
from tapeloom.operators.joins import BROADCAST_BYTES, join_lookup
from tapeloom.operators.skew import GROUP_ROWS

# Odd multipliers that spread bits.
SPREAD = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
# 64-bit words of the bitmap that goes into a tile.
SKETCH = 8
SKETCHES = [f"sketch_{i}" for i in range(SKETCH)]
# Words whose hashes a task remembers.
REMEMBERED = 200_000
# Partners that one copy of a document's set is sent out for, and bytes of sets that leave a task at once.
SENDS, SENT_BYTES = 1_000, 8 * 1024 * 1024


@dataclass(frozen=True)
class Settings:
    """Words in a shingle, and the percentage of the union that the intersection must reach.

    ``often``: a shingle is noted as frequent in a task when it is in that many of its documents, and
    fewer than ``noted`` such shingles are put last in the order. Both only move work, never results.
    ``members``: rows of a group, block or pivot in one task, about. ``broadcast_bytes`` and ``hot_rows`` are
    those of ``join_lookup``.
    """

    words: int = 4
    percent: int = 85
    often: int = 2
    noted: int = 1 << 20
    members: int = 4_000
    broadcast_bytes: int = BROADCAST_BYTES
    hot_rows: int = GROUP_ROWS

    def met(
        self, rows: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "inner", **options: object
    ) -> DataFrame:
        """``join_lookup`` to a table that has each key once."""
        limits = {"unique": True, "broadcast_bytes": self.broadcast_bytes, "hot_rows": self.hot_rows, **options}
        return join_lookup(rows, lookup, on, how, **limits)

    def least_overlap(self, sizes: np.ndarray | int) -> np.ndarray | int:
        """The intersection that two sets need whose sizes add up to ``sizes``."""
        return -(-(self.percent * sizes) // (100 + self.percent))

    def least_size(self, size: np.ndarray | int) -> np.ndarray | int:
        """The smallest set that a set of this size can link with."""
        return -(-(self.percent * size) // 100)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of all words where they are fewer."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    hashed = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    length = min(words, len(hashed))
    mixed = np.full(len(hashed) - length + 1, length, np.uint64)
    for i in range(length):
        mixed = (mixed ^ hashed[i : i + len(mixed)]) * SPREAD[i % len(SPREAD)]
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit for each shingle's low bits, turned by each one; at least four bits for each shingle."""
    width = max(64, 1 << (4 * max(1, len(shingles)) - 1).bit_length())
    turned = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(turned.astype(np.uint8), bitorder="little").tobytes()


def sketch(first: np.ndarray) -> np.ndarray:
    """A bitmap of SKETCH words for the first shingles alone, turned in the same way."""
    width = 64 * SKETCH
    turned = np.bincount((first & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(turned.astype(np.uint8), bitorder="little").view(np.int64)


def most_overlap(left: bytes, right: bytes, sizes: int) -> int:
    """A bound from above on the intersection: each bit that differs is a shingle that one set lacks.

    The wider bitmap is folded to the width of the other.
    """
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return (sizes - int(np.bitwise_count(folded ^ b).sum())) // 2


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """The size of the intersection of two sorted arrays."""
    if len(left) < len(right):
        left, right = right, left
    if not len(right):
        return 0
    at = np.searchsorted(left, right)
    at[at == len(left)] = 0
    return int(np.count_nonzero(left[at] == right))


def _signed(array: np.ndarray) -> pa.Array:
    return pa.array(array.view(np.int64))


def frequent_shingles(docs: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles of all documents and about how many have them, fewer than ``noted``.

    Shingles are counted exactly inside a task, in stretches of bounded size, and those seen ``often``
    there are summed up over all tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            often = times >= settings.often
            return pa.RecordBatch.from_arrays(
                [_signed(values[often]), pa.array(times[often].astype(np.int64))], ["shingle", "times"]
            )

        with released(_hashes):
            for part in slices(batches):
                for text in part.column("text").to_pylist():
                    held.append(shingle_set(text, settings.words))
                    size += len(held[-1])
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
            yield flush()

    counted = id_and_text(docs).mapInArrow(count, "shingle bigint, times bigint")
    summed = scratch.keep(counted.groupBy("shingle").agg(F.sum("times").alias("times")), "frequent")
    total = summed.agg(F.sum("times")).first()[0] or 0
    # Fewer than ``noted`` shingles can each have more than one in ``noted`` of what was counted.
    top = summed.where(F.col("times") * settings.noted > total).toArrow()
    values = top.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], top.column("times").to_numpy()[order]


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """What the join needs of each document: its size, a digest of its set, its bitmap and first shingles.

    ``spread`` holds for each of those over how many tasks its group is dealt. ``alone`` is the number of
    shingles that are not noted as frequent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, settings))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with released(_hashes):
            yield from signed_slices(batches)

    def signed_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, times = shared.value
        for part in slices(batches):
            sizes, digests, bitmaps, firsts, spreads, sketches, alone = [], [], [], [], [], [], []
            for text in part.column("text").to_pylist():
                own = shingle_set(text, settings.words)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                bitmaps.append(bitmap(own))
                seen = np.zeros(len(own), np.int64)
                if len(frequent) and len(own):
                    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                    seen = np.where(frequent[at] == own, times[at], 0)
                alone.append(int(np.count_nonzero(seen == 0)))
                needed = len(own) - settings.least_size(len(own)) + 1 if len(own) else 0
                first = np.argsort(seen, kind="stable")[:needed]
                firsts.append(own[first].view(np.int64))
                sketches.append(sketch(own[first]))
                spreads.append((seen[first] // settings.members + 1).astype(np.int32))
            ends = pa.array(np.cumsum([0, *map(len, firsts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bitmaps, pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*firsts, np.zeros(0, np.int64)]))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*spreads, np.zeros(0, np.int32)]))),
                    pa.array(alone, pa.int64()),
                    *(pa.array([words[i] for words in sketches], pa.int64()) for i in range(SKETCH)),
                ],
                ["doc_id", "n", "digest", "bitmap", "first", "spread", "alone", *SKETCHES],
            )

    schema = "doc_id bigint, n bigint, digest binary, bitmap binary, first array<bigint>, spread array<int>, alone bigint"
    schema += "".join(f", {name} bigint" for name in SKETCHES)
    return id_and_text(docs).mapInArrow(sign, schema)


def _may_link(n: np.ndarray, at: np.ndarray, m: np.ndarray, other: np.ndarray, settings: Settings) -> np.ndarray:
    """Whether sets of sizes n >= m can link if a shingle at these places is the first they share."""
    rest = 1 + np.minimum(n - at - 1, m - other - 1)
    return (m >= settings.least_size(n)) & (rest >= settings.least_overlap(n + m))


def _groups(postings: DataFrame, settings: Settings) -> DataFrame:
    """Postings of shingles that at least two classes have among their first, and the head of their group.

    ``partner`` is that head where the two may link: the class with the fewest shingles alone. Groups are read in order, so a task holds
    two rows of the group before, whatever its size.
    """
    names = ["shingle", "salt", "alone", "n", "rep", "at", "spread"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows not put out yet: the last one read
        head = previous = None  # the first row of the last row's group, and the last row put out

        def emit(rows: np.ndarray, following: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            nonlocal head, previous
            if not len(rows):
                return
            same = np.zeros(len(rows), bool)
            same[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
            same[0] = previous is not None and bool((rows[0, :2] == previous[:2]).all())
            index = np.arange(len(rows))
            starts = np.maximum.accumulate(np.where(same, -1, index))
            heads = np.where((starts >= 0)[:, None], rows[np.maximum(starts, 0)], head if head is not None else rows[0])
            next_same = np.zeros(len(rows), bool)
            next_same[:-1] = same[1:]
            next_same[-1] = following is not None and bool((rows[-1, :2] == following[:2]).all())
            active = same | next_same | (rows[:, 6] > 1)  # others of the shingle may have another salt
            larger = (rows[:, 3] >= heads[:, 3])[:, None]
            (n, at), (m, other) = np.where(larger, rows, heads)[:, [3, 5]].T, np.where(larger, heads, rows)[:, [3, 5]].T
            fits = same & (heads[:, 4] != rows[:, 4]) & _may_link(n, at, m, other, settings)
            partner = pa.array(heads[:, 4][active], mask=~fits[active])
            head, previous = heads[-1].copy(), rows[-1].copy()
            if active.any():
                kept = rows[active]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.ascontiguousarray(kept[:, i])) for i in (0, 3, 4, 5)), partner],
                    ["shingle", "n", "rep", "at", "partner"],
                )

        for batch in batches:
            rows = np.column_stack([batch.column(name).to_numpy() for name in names])
            if rest is not None:
                rows = np.vstack([rest, rows])
            if len(rows):
                yield from emit(rows[:-1], rows[-1])
                rest = rows[-1:]
        if rest is not None:
            yield from emit(rest, None)

    dealt = postings.select(*[F.col(name).cast("bigint") for name in names]).repartition("shingle", "salt")
    schema = "shingle bigint, n bigint, rep bigint, at bigint, partner bigint"
    return dealt.sortWithinPartitions(*names).mapInArrow(run, schema)


def _bounded(pairs: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b), a written table, whose bitmaps leave it open that they link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("n_a", "n_b", "bits_a", "bits_b")]
            open_ones = [
                most_overlap(left, right, n + m) >= settings.least_overlap(n + m)
                for n, m, left, right in zip(*columns)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(open_ones, pa.bool_()))

    met = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    signed = settings.met(signed.select("doc_id", "n", "bitmap"), met, "doc_id")
    signed, size, _ = scratch.keep_measured(signed, "bitmaps", ["doc_id"])

    def with_side(rows: DataFrame, name: str) -> DataFrame:
        own = signed.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bitmap").alias(f"bits_{name}"))
        # The head of a group stands in as many pairs as the group has classes.
        return settings.met(rows, own, name, size=size, spread_by=["a", "b"], hot_rows=min(settings.members, settings.hot_rows))

    both = with_side(with_side(pairs.select("a", "b"), "a"), "b")
    return scratch.keep(both.mapInArrow(run, "a bigint, b bigint").distinct(), "pairs")


def _linked(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that link, by the intersection of their sets.

    The sets of all partners of ``a`` go where its own set is, one copy for each pair. Partners of one
    document in large numbers are spread over several copies of it, and a document that goes out to many
    others does so from several rows, a few sets at a time.
    """
    counts = pairs.groupBy("a").agg(F.expr(f"count(1) div {settings.members} + 1").alias("copies"))
    counts, size, _ = scratch.keep_measured(counts, "counts", ["a"])
    members = settings.met(pairs, counts, "a", size=size).select(
        F.col("b").alias("doc_id"), F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), F.col("copies")).alias("copy"), F.lit(True).alias("member")
    )
    pivots = counts.select(
        F.col("a").alias("doc_id"), F.col("a").alias("pivot"), F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"), F.lit(False).alias("member")
    )
    each = scratch.keep(members.unionByName(pivots), "sends")
    many = each.groupBy("doc_id").agg(F.expr(f"count(1) div {SENDS} + 1").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("pivot", "copy", "member"), F.coalesce("parts", F.lit(1)))
    dealt = settings.met(each, many, "doc_id", "left", spread_by=["pivot", "copy"]).withColumn("part", part)
    sends = dealt.groupBy("doc_id", "part").agg(F.collect_list(F.struct("pivot", "copy", "member")).alias("sends")).drop("part")
    least = min(16 * 1024 * 1024, settings.broadcast_bytes)
    sent = settings.met(id_and_text(docs), sends, "doc_id", broadcast_bytes=least, spread_by=["doc_id"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
        names = ["pivot", "copy", "member", "doc_id", "shingles"]

        def copies(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names)

        rows, size = [], 0
        with released(_hashes):
            for part in slices(batches):
                for key, text, sends in zip(*(part.column(name).to_pylist() for name in ("doc_id", "text", "sends"))):
                    own = shingle_set(text, settings.words).tobytes()
                    for to in sends:
                        rows.append((to["pivot"], to["copy"], to["member"], key, own))
                        size += len(own)
                        if size > SENT_BYTES:
                            yield copies(rows)
                            rows, size = [], 0
            yield copies(rows)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, sets = None, []
        for batch in batches:
            found = []
            for at, copy, member, key, held in zip(*(column.to_pylist() for column in batch.columns)):
                if (at, copy) != pivot:
                    pivot, sets = (at, copy), []
                own = np.frombuffer(held, np.uint64)
                if not member:
                    sets.append(own)
                elif any(overlap(own, other) >= settings.least_overlap(len(own) + len(other)) for other in sets):
                    found.append((at, key))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    made = sent.select("doc_id", "text", "sends").mapInArrow(
        make, "pivot bigint, copy bigint, member boolean, doc_id bigint, shingles binary"
    )
    placed = made.repartition("pivot", "copy").sortWithinPartitions("pivot", "copy", "member", "doc_id")
    return placed.mapInArrow(decide, "a bigint, b bigint")


def _firsts_may_link(n: int, bits: np.ndarray, m: np.ndarray, others: np.ndarray, settings: Settings) -> np.ndarray:
    """Whether enough of the first shingles can be shared, by the bitmaps of those.

    Of the first p of n shingles at most n - p of the needed overlap can lie behind, and what one set has
    before its own cut the other has before its cut, for the set whose cut comes first.
    """
    least = settings.least_overlap(n + m)
    first_n, first_m = n - settings.least_size(n) + 1, m - settings.least_size(m) + 1
    shared = np.minimum(least - n + first_n, least - m + first_m)
    return np.bitwise_count((others ^ bits).view(np.uint64)).sum(axis=1) <= first_n + first_m - 2 * shared


def _tiles(groups: DataFrame, labels: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b), a before b in size, of two components that share one of their first shingles.

    A tile is a shingle and a band of sizes, with the classes of the band and those of the band below. A
    tile with many rows is cut into blocks, and each pair of blocks is a tile of its own.
    """
    band = F.floor(F.log(F.col("n")) / math.log(100 / settings.percent)).cast("bigint")
    known = labels.select(F.col("node").alias("rep"), "label")
    rows = settings.met(groups.select("shingle", "n", "rep", "at"), known, "rep", "left")
    rows = rows.withColumns({"label": F.coalesce("label", "rep"), "own": band})
    # Rounding may put equal sizes a band apart, never two; so the two bands below are looked at.
    below = F.expr("sequence(own, own + 2)")
    placed = rows.select("*", F.explode(below).alias("band"))
    mixed = placed.groupBy("shingle", "band").agg(
        F.expr(f"count(1) div {settings.members} + 1").alias("blocks"),
        F.min("label").alias("least"), F.max("label").alias("largest"), F.max("own").alias("highest"),
    )
    # The larger one of a pair is of the tile's own band, so a tile without such a row has no pairs.
    mixed = mixed.where("least != largest and highest = band").drop("least", "largest", "highest")
    tiled = settings.met(placed, mixed, ["shingle", "band"])
    tiled = tiled.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    tiled = tiled.select("*", other.alias("other"))
    bits = signed.select(F.col("doc_id").alias("rep"), *SKETCHES, F.col("n").alias("size")).distinct()
    tiled = settings.met(tiled, bits, "rep").where("n = size").drop("size")
    tiled = tiled.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    names = ["shingle", "band", "low", "high", "n", "rep", "at", "label", "own", "block", *SKETCHES]
    keys = names[:4]

    def pairs_of(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``rows`` of one tile in order of size."""
        band, low, high = rows[0, 1], rows[0, 2], rows[0, 3]
        n, rep, at, label, own, block = rows[:, 4:10].T
        bits = rows[:, 10:]
        least = np.searchsorted(n, settings.least_size(n))
        for i in np.flatnonzero(own == band):
            start = least[i]
            fits = (label[start:i] != label[i]) & _may_link(n[i], at[i], n[start:i], at[start:i], settings)
            if low != high:
                fits &= block[start:i] != block[i]
            if fits.any():
                fits[fits] = _firsts_may_link(n[i], bits[i], n[start:i][fits], bits[start:i][fits], settings)
            if fits.any():
                yield rep[start:i][fits], np.full(int(fits.sum()), rep[i])

    def together(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sides = [pa.array(np.concatenate([pair[i] for pair in found])) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(sides, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, len(names)), np.int64)
        for last, batch in _with_last(batches):
            rows = np.vstack([rest, np.column_stack([batch.column(name).to_numpy() for name in names])])
            cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(rows)]
            if not last:
                rest, edges = rows[edges[-2] :], edges[:-1]
            found, size = [], 0
            for a, b in zip(edges, edges[1:]):
                for pair in pairs_of(rows[a:b]) if b - a > 1 else ():
                    found.append(pair)
                    size += len(pair[0])
                    if size > 200_000:
                        yield together(found)
                        found, size = [], 0
            if found:
                yield together(found)

    dealt = tiled.select(*names).repartition(*keys).sortWithinPartitions(*names[:6])
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            yield False, held
        held = batch
    if held is not None:
        yield True, held


def _prepared(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, of those that may link, their classes, and the groups of first shingles."""
    signed = scratch.keep(signatures(docs, settings), "signatures")
    filled = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    sets = filled.groupBy("digest", "n").agg(F.min("doc_id").alias("rep"))
    kinds, size, _ = scratch.keep_measured(sets, "kinds", ["digest", "n"])
    # A class is represented by the document with its smallest id; its other documents go no further.
    own = settings.met(filled.select("doc_id", "digest", "n"), kinds, ["digest", "n"], size=size)
    copies = own.where("doc_id <> rep").select("doc_id", "digest", F.lit(True).alias("is_copy")).distinct()
    firsts = settings.met(filled.select("doc_id", "digest", "n", "first", "spread", "alone"), copies, ["doc_id", "digest"], "left")
    posted = firsts.where(F.col("is_copy").isNull()).select(
        F.col("doc_id").alias("rep"), "n", "alone", F.posexplode(F.arrays_zip("first", "spread")).alias("at", "entry")
    )
    postings = posted.select(
        F.col("entry.first").alias("shingle"), F.pmod(F.xxhash64("rep"), F.col("entry.spread")).alias("salt"),
        "alone", "n", "rep", "at", F.col("entry.spread").alias("spread"),
    )
    return signed, filled, kinds, scratch.keep(_groups(postings, settings), "groups")


def _links(filled: DataFrame, groups: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """A written table of all pairs (a, b) of classes that link, each once; no pair is spared as in components."""
    apart = docs.sparkSession.createDataFrame([], "node bigint, label bigint")
    pairs = scratch.keep(_tiles(groups, apart, filled, settings), "candidates")
    found = _linked(_bounded(pairs, filled, settings), docs, settings)
    return scratch.keep(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def linked_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """a and b, a < b, for every link between two different sets: the smallest doc_id of each of the two classes.

    Rows with one and the same set are one class, so copies are not expanded into pairs; ``link_counts`` says
    which class a row is in. There are as many rows as there are links, so a group of edited copies of one
    text has about half its square. Nulls, empty texts and ties are as in ``near_duplicates``; doc_ids are
    taken to be unique, and rows that share one share its links.
    """
    _, filled, _, groups = _prepared(docs, settings)
    return _links(filled, groups, docs, settings)


def link_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, class_id and n_links of each row of ``docs``.

    ``class_id`` is the smallest doc_id with the same set, and ``n_links`` counts the other rows that a row links
    with: those of its own class, and all rows of each class that links with it. A text without words and a
    NULL doc_id have no links. Otherwise as ``linked_classes``.
    """
    signed, filled, kinds, groups = _prepared(docs, settings)
    links = _links(filled, groups, docs, settings)
    sizes = filled.groupBy("digest", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"))
    of_rep = scratch.keep(sizes.groupBy("rep").agg(F.sum("size").alias("size")), "sizes")
    both = links.select(F.col("a").alias("from"), F.col("b").alias("rep")).unionByName(
        links.select(F.col("b").alias("from"), F.col("a").alias("rep"))
    )
    beyond = settings.met(both, of_rep, "rep", spread_by=["from"]).groupBy("from").agg(F.sum("size").alias("beyond"))
    known = settings.met(kinds, of_rep, "rep")
    known = settings.met(known, beyond.withColumnRenamed("from", "rep"), "rep", "left")
    known = known.select("digest", "n", "rep", (F.col("size") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"))
    met = settings.met(signed.select("doc_id", "n", "digest"), known, ["digest", "n"], "left")
    links_here = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return met.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(links_here, F.col("rep")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(links_here, F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
    )


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs``.

    Words are runs of anything but white space, A-Z in lower case. With fewer words than a shingle has,
    all of them are one shingle. ``component_id`` is the smallest doc_id that links lead to. A text
    without words, NULL or empty, links with nothing. Repeated rows stay, and rows that share a doc_id go
    by their own texts. A NULL doc_id has a NULL component and links nothing. Other columns are not read.
    """
    signed, filled, kinds, groups = _prepared(docs, settings)

    # The first round takes for each class the one partner that it shares most with.
    shared = groups.where(F.col("partner").isNotNull()).groupBy("rep", "partner").agg(F.count(F.lit(1)).alias("n"))
    best = shared.groupBy("rep").agg(F.max(F.struct(F.col("n"), F.col("partner"))).alias("best"))
    first = scratch.keep(best.select(F.col("best.partner").alias("a"), F.col("rep").alias("b")), "first")
    links = scratch.keep(_linked(_bounded(first, filled, settings), docs, settings), "links")
    labels = components(links)

    seen = first.unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    second = scratch.keep(_tiles(groups, labels, filled, settings).join(seen, ["a", "b"], "left_anti"), "second")
    more = scratch.keep(_linked(_bounded(second, filled, settings), docs, settings), "links")
    final = components(links.unionByName(more)) if not more.isEmpty() else labels

    joined = settings.met(kinds, final.withColumnRenamed("node", "rep"), "rep", "left")
    joined = joined.select("digest", "n", F.coalesce("label", "rep").alias("label"))
    met = settings.met(signed.select("doc_id", "n", "digest"), joined, ["digest", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("label")).otherwise(F.col("doc_id"))
    return met.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each component of ``docs``, with its own columns: the first by doc_id, text's digest and place.

    Rows are told apart by their place in a written table, not by doc_id: repeated rows, rows that share an
    id and rows without one, which come last, are rows like others. A text without words, NULL or empty, is
    near to nothing, and its row stays. No rows: no rows. A clash of column names does not matter.
    """
    row = fresh(docs.columns, "_row")
    numbered = scratch.keep(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered.select(F.col(row).alias("doc_id"), F.col("text")), settings)
    found = scratch.keep(found.select("doc_id", "component_id"), "components")
    several = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    members = settings.met(found, several, "component_id", spread_by=["doc_id"])
    key = F.col("doc_id").cast("bigint")
    names = numbered.select(F.col(row).alias("doc_id"), F.struct(key.isNull().alias("none"), key.alias("key"), F.md5(F.col("text")).alias("digest")).alias("name"))
    named = scratch.keep(members.join(names, "doc_id"), "members")
    first = named.groupBy("component_id").agg(F.min(F.struct("name", "doc_id")).alias("first"))
    stays = first.select("component_id", F.col("first.doc_id").alias("stays"))
    gone = settings.met(named, stays, "component_id", spread_by=["doc_id"]).where("doc_id <> stays")
    away = fresh(docs.columns, "_gone")
    marked = settings.met(numbered, gone.select(F.col("doc_id").alias(row), F.lit(True).alias(away)), row, "left")
    return marked.where(F.col(away).isNull()).select(*[F.col(f"`{name}`") for name in docs.columns])
