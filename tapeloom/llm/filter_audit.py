"""Filter interaction audit: what each filter removes in every order, and what others would have removed anyway.

A table-driven transducer runs once over the bytes of a text. It tells code points, capitals and symbols, and
where words start and end; the spans of the words go into a hash table that compares bytes before it takes two
for one. Each document then has one bit for each filter it fails, and all orders follow from counts by bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.llm.common import slices
from tapeloom.operators.joins import join_lookup

# Byte classes: white space, the end of a text, A-Z, symbols, bytes inside a character, and all others.
SPACE, END, CAPITAL, SYMBOL, TAIL, PLAIN = range(6)
# The symbols, and a byte that no UTF-8 text has.
SYMBOLS = b"#$%&*|"
LAST = 0xFF
# States: outside and inside a word. A class leads to one state from either, so a run needs no loop.
OUTSIDE, INSIDE = 0, 1
NEXT = np.array([[OUTSIDE, OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE]] * 2, np.uint8)
# What a step puts out, as bits.
STARTS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_TAIL = 1, 2, 4, 8, 16
# Bytes that the transducer takes at once, and the longest word that is hashed in steps of eight bytes.
BLOCK = 1 << 20
LONG_WORD = 64
MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def _classes() -> np.ndarray:
    table = np.full(256, PLAIN, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0] = TAIL
    table[LAST] = END
    return table


def _puts_out() -> np.ndarray:
    own = {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL, TAIL: IS_TAIL}
    table = np.zeros((2, 6), np.uint8)
    for state in (OUTSIDE, INSIDE):
        for kind in range(6):
            after = NEXT[state, kind]
            table[state, kind] = own.get(kind, 0) | STARTS * (after > state) | ENDS * (after < state)
    return table


CLASS, PUTS_OUT = _classes(), _puts_out()


@dataclass(frozen=True)
class Scan:
    """What the transducer found in some texts, by the number of the text; spans are places in ``data``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    capitals: np.ndarray
    points: np.ndarray
    symbols: np.ndarray


def transduce(texts: Sequence[bytes]) -> Scan:
    """One pass over the bytes of all ``texts``, UTF-8 each; the state goes on from block to block."""
    data = np.frombuffer(bytes([LAST]).join([*texts, b""]) + bytes(8), np.uint8)  # eight more, to read words by eights
    lengths = np.array([len(text) for text in texts], np.int64)
    lasts = np.cumsum(lengths + 1) - 1
    found: dict[int, list[np.ndarray]] = {bit: [] for bit in (STARTS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_TAIL)}
    state, size = OUTSIDE, len(data) - 8
    for at in range(0, size, BLOCK):
        kinds = CLASS[data[at : min(at + BLOCK, size)]]
        after = NEXT[OUTSIDE][kinds]
        before = np.empty_like(after)
        before[0], before[1:] = state, after[:-1]
        state = after[-1]
        out = PUTS_OUT.ravel()[kinds + before * PUTS_OUT.shape[1]]
        for bit, places in found.items():
            places.append(np.flatnonzero(out & bit) + at)
    places = {bit: np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64) for bit, parts in found.items()}

    def per_text(bit: int) -> np.ndarray:
        return np.bincount(np.searchsorted(lasts, places[bit]), minlength=len(texts))

    owner = np.searchsorted(lasts, places[STARTS])
    points = lengths - per_text(IS_TAIL)
    return Scan(data, places[STARTS], places[ENDS], owner, per_text(IS_CAPITAL), points, per_text(IS_SYMBOL))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def _masks(lengths: np.ndarray) -> np.ndarray:
    """Keeps as many of eight bytes as a word has left."""
    bits = 8 * np.clip(lengths, 0, 8).astype(np.uint64)
    return np.where(bits == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1))


def span_hashes(scan: Scan) -> np.ndarray:
    """A hash of each word's text and of the text's bytes in it."""
    eights, lengths = _eights(scan.data), scan.ends - scan.starts
    hashes = (lengths.astype(np.uint64) ^ (scan.owner.astype(np.uint64) << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    rest = np.flatnonzero(lengths <= LONG_WORD)
    for offset in range(0, LONG_WORD, 8):
        rest = rest[lengths[rest] > offset]
        if not len(rest):
            break
        piece = eights[scan.starts[rest] + offset] & _masks(lengths[rest] - offset)
        mixed = (hashes[rest] ^ piece) * np.uint64(0xD6E8FEB86659FD93)
        hashes[rest] = mixed ^ (mixed >> np.uint64(32))
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        own = xxhash.xxh64_intdigest(scan.data[scan.starts[i] : scan.ends[i]].data, int(scan.owner[i]))
        hashes[i] = np.uint64(own)
    return hashes


def _same(scan: Scan, lengths: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the words numbered ``left`` and ``right`` are the same bytes in the same text."""
    eights = _eights(scan.data)
    same = (scan.owner[left] == scan.owner[right]) & (lengths[left] == lengths[right])
    rest = np.flatnonzero(same & (lengths[left] <= LONG_WORD))
    for offset in range(0, LONG_WORD, 8):
        rest = rest[lengths[left[rest]] > offset]
        if not len(rest):
            break
        mask = _masks(lengths[left[rest]] - offset)
        a, b = eights[scan.starts[left[rest]] + offset] & mask, eights[scan.starts[right[rest]] + offset] & mask
        same[rest] = a == b
        rest = rest[a == b]
    for i in np.flatnonzero(same & (lengths[left] > LONG_WORD)).tolist():
        a, b = scan.starts[left[i]], scan.starts[right[i]]
        size = lengths[left[i]]
        same[i] = bool((scan.data[a : a + size] == scan.data[b : b + size]).all())
    return same


def first_of_each(scan: Scan, hashes: np.ndarray) -> np.ndarray:
    """Which spans are the first of their word in their text.

    A hash table with open addressing, into which all spans go at once. In each round a span takes its slot
    if that is free, goes if the holder is the same word, which the bytes decide, and else tries the next
    slot. Equal words try the same slots in the same order, so hashes that collide cost time only.
    """
    lengths = scan.ends - scan.starts
    slots = np.uint64((1 << max(3, (2 * len(hashes)).bit_length())) - 1)
    table = np.full(int(slots) + 1, -1, np.int64)
    slot = (hashes & slots).astype(np.int64)
    is_first = np.zeros(len(hashes), bool)
    waiting = np.arange(len(hashes))
    while len(waiting):
        at = slot[waiting]
        free = np.flatnonzero(table[at] < 0)[::-1]  # in reverse, so that the earliest one is what stays
        table[at[free]] = waiting[free]
        holder = table[at]
        taken = holder == waiting
        is_first[waiting[taken]] = True
        others = np.flatnonzero(~taken)
        waiting, holder = waiting[others], holder[others]
        equal = hashes[waiting] == hashes[holder]
        equal[equal] = _same(scan, lengths, waiting[equal], holder[equal])
        waiting = waiting[~equal]
        slot[waiting] = (slot[waiting] + 1) & int(slots)
    return is_first


def measure(texts: Sequence[bytes]) -> dict[str, np.ndarray]:
    """MEASURES of each text."""
    scan = transduce(texts)
    is_first = first_of_each(scan, span_hashes(scan))
    return {
        "n_words": np.bincount(scan.owner, minlength=len(texts)),
        "n_distinct": np.bincount(scan.owner[is_first], minlength=len(texts)),
        "n_capitals": scan.capitals,
        "n_points": scan.points,
        "n_symbols": scan.symbols,
    }


@dataclass(frozen=True)
class Filter:
    """One letter, and the condition on the measurements under which a document fails."""

    letter: str
    fails: str


FILTERS = (
    Filter("A", "n_words < 50"),
    Filter("B", "100 * n_distinct < 65 * n_words"),
    Filter("C", "100 * n_capitals > 5 * n_points"),
    Filter("D", "n_symbols > 0"),
    Filter("E", "is_copy"),
)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, MEASURES and is_copy of each row of ``docs``, which has doc_id, text and source.

    ``part`` is the source, empty where it is NULL. A NULL text counts as empty. ``is_copy``: some row with a
    smaller doc_id has the same text; rows that share a doc_id are no copies of each other, and a row
    without an id is no copy. Repeated rows stay, a row each; other columns are not read. Texts are
    compared by length and SHA-256; a group of copies meets as one row for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [text or b"" for text in part.column("text").cast(pa.binary()).to_pylist()]
            found = measure(texts)
            digests = [hashlib.sha256(text).digest() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("part"),
                    *(pa.array(found[name].astype(np.int64)) for name in MEASURES), pa.array(digests, pa.binary()),
                ],
                ["doc_id", "part", *MEASURES, "digest"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id bigint, part string, " + "".join(f"{name} bigint, " for name in MEASURES) + "digest binary"
    kept = scratch.keep(rows.mapInArrow(run, schema), "measures")
    groups = kept.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("largest"))
    copied = groups.where("least < largest").select("digest", "least")
    joined = join_lookup(kept, copied, "digest", "left")
    return joined.select(
        "doc_id", "part", *MEASURES, F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("is_copy")
    )


def failed_bits(filters: Sequence[Filter] = FILTERS) -> Column:
    """The filters a row of measurements fails, the first one as the lowest bit."""
    bits = F.lit(0)
    for i, rule in enumerate(filters):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)))
    return bits


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``, 0 or 1: some label of the doc_id has quality 1, or toxic 1."""

    def some(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, F.lit(1)).otherwise(F.lit(0)))

    by_id = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marks = by_id.agg(some("quality").alias("good"), some("toxic").alias("toxic")).where("good + toxic > 0")
    joined = join_lookup(rows, marks, "doc_id", "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("good", "toxic")})


def audit(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] = FILTERS) -> DataFrame:
    """What each filter does at each step of each order, for every part: a row each, zeros included.

    part, filter_order, step from 1, and counts of documents: ``kept`` after the step, ``removed`` in it,
    ``redundant`` (fail its filter, but are gone), ``unique_fails`` (fail this filter only), ``good_lost``
    and ``toxic_lost`` (removed with such a label), ``shapley`` (removed by its filter, over all orders).
    Labels of a doc_id that repeat count once, labels with other values or NULL not at all. Documents that
    share a doc_id share its labels. No documents: no rows.

    Documents are counted by part and bits first; orders are worked out on those counts. Up to seven
    filters, as the orders are all permutations.
    """
    if not 1 <= len(filters) <= 7:
        raise ValueError("an audit takes one to seven filters")
    letters = "".join(rule.letter for rule in filters)
    rows = measured(docs).select("doc_id", "part", failed_bits(filters).alias("failed"))
    counts = labelled(rows, labels).groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    # At most one entry for each set of filters, so a part's list is short whatever it holds.
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("entries"))
    orders = ["".join(order) for order in permutations(letters)]
    each = by_part.select("*", F.explode(F.lit(orders)).alias("filter_order"))
    each = each.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    bit = f"shiftleft(1, instr('{letters}', substring(filter_order, {{}}, 1)) - 1)"
    each = each.withColumn("bit", F.expr(bit.format("step")))
    each = each.withColumn(
        "earlier",
        F.expr(f"aggregate(slice(sequence(1, {len(letters)}), 1, step - 1), 0, (bits, i) -> bits | {bit.format('i')})"),
    )

    def total(value: str, condition: str) -> Column:
        return F.expr(f"aggregate(entries, 0L, (sum, e) -> sum + if({condition}, {value}, 0L))")

    removed = "e.failed & bit != 0 and e.failed & earlier = 0"
    return each.select(
        "part", "filter_order", "step",
        total("e.n", "e.failed & (earlier | bit) = 0").alias("kept"),
        total("e.n", removed).alias("removed"),
        total("e.n", "e.failed & bit != 0 and e.failed & earlier != 0").alias("redundant"),
        total("e.n", "e.failed = bit").alias("unique_fails"),
        total("e.good", removed).alias("good_lost"),
        total("e.toxic", removed).alias("toxic_lost"),
        # Of k filters that a document fails, each is the first one in the same number of orders.
        total(f"e.n * ({math.factorial(len(letters))}L div bit_count(e.failed))", "e.failed & bit != 0").alias("shapley"),
    )


# The same for DuckDB, with the five filters.
ORACLE_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents
),
least as (select t, min(doc_id) as least from texts group by t),
words as (
  select doc_id, part, x.t, l.least, regexp_extract_all(x.t, '[^ \t-\r]+') as w from texts x join least l on x.t = l.t
),
bits as (
  select doc_id, part,
    (case when len(w) < 50 then 1 else 0 end
     + case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end
     + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) then 4 else 0 end
     + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
     + case when doc_id > least then 16 else 0 end)::integer as failed
  from words
),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id
),
counts as (
  select part, failed, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from bits left join marks using (doc_id) group by part, failed
),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps as (
  select filter_order, s::integer as step, l.bit,
    coalesce((select sum(p.bit) from letters p where instr(filter_order, p.letter) < s), 0)::integer as earlier
  from orders, unnest(range(1, 6)) as u(s) join letters l on l.letter = substr(filter_order, s::integer, 1)
)
select part, filter_order, step,
  sum(case when failed & (earlier | bit) = 0 then n else 0 end)::bigint as kept,
  sum(case when failed & bit <> 0 and failed & earlier = 0 then n else 0 end)::bigint as removed,
  sum(case when failed & bit <> 0 and failed & earlier <> 0 then n else 0 end)::bigint as redundant,
  sum(case when failed = bit then n else 0 end)::bigint as unique_fails,
  sum(case when failed & bit <> 0 and failed & earlier = 0 then good else 0 end)::bigint as good_lost,
  sum(case when failed & bit <> 0 and failed & earlier = 0 then toxic else 0 end)::bigint as toxic_lost,
  sum(case when failed & bit <> 0 then n * 120 // bit_count(failed) else 0 end)::bigint as shapley
from counts, steps group by part, filter_order, step
"""
