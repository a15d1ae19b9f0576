"""Benchmark decontamination by Wu-Manber search for word windows.

Texts and benchmark items are sequences of word numbers; a word that no item has is 0. For the windows of one
length, a table tells for each block of words how far the search may move on at least, as no window ends before;
where it may not move, the blocks at a window's end and beginning select the windows to test, and comparing all
of their words decides. Many pieces of text are searched side by side, each with its own place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.llm.common import fresh, slices

WINDOW = 10
# Words in a block of the shift table, and the table's slots.
BLOCK, SLOTS = 2, 1 << 18
# Words of a text in one lane of the search, and bytes that are cut into words at once.
LANE, BYTES = 512, 1 << 22
# Benchmark text that is searched for in one pass; more of it takes more passes.
GROUP_BYTES = 16 * 1024 * 1024


def _separators() -> bytes:
    """A byte table: A-Z in lower case, and a space for every ASCII byte that is no letter or digit."""
    table = bytearray(range(256))
    for byte in range(128):
        table[byte] = ord(chr(byte).lower()) if chr(byte).isalnum() else ord(" ")
    return bytes(table)


BYTE_TABLE = _separators()


class _Numbers(dict):
    """Numbers of words that items have, from 1; 0 for others."""

    def __missing__(self, word: bytes) -> int:
        return 0


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, block by block."""
    plain, at = text.translate(BYTE_TABLE), 0
    while at < len(plain):
        cut = plain.find(b" ", at + BYTES)
        cut = len(plain) if cut < 0 else cut
        yield plain[at:cut].split()
        at = cut


def word_numbers(text: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    found = [np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)) for words in word_blocks(text)]
    return np.concatenate([*found, np.zeros(0, np.int32)])


def _mixed(words: Sequence[np.ndarray]) -> np.ndarray:
    """64 bits for a block, given as one array for each of its words."""
    key = np.zeros(len(words[0]), np.uint64)
    for part in words:
        key = (key ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


@dataclass(frozen=True)
class Tables:
    """The tables for windows of one length: shifts, and the windows in order of their end and beginning."""

    length: int
    block: int
    shift: np.ndarray
    keys: np.ndarray  # of the last and the first block, ascending
    windows: np.ndarray  # in that order, a row of word numbers each
    numbers: np.ndarray  # the number of each of those windows

    @staticmethod
    def of(windows: np.ndarray, numbers: np.ndarray) -> Tables:
        length = windows.shape[1]
        block = min(BLOCK, length)
        shift = np.full(SLOTS, length - block + 1, np.uint8)
        for end in range(block, length + 1):
            slots = _mixed([windows[:, end - block + i] for i in range(block)]) % np.uint64(SLOTS)
            np.minimum.at(shift, slots.astype(np.int64), np.uint8(length - end))
        keys = Tables._keys(windows, block)
        order = np.argsort(keys, kind="stable")
        return Tables(length, block, shift, keys[order], windows[order], numbers[order])

    @staticmethod
    def _keys(windows: np.ndarray, block: int) -> np.ndarray:
        length = windows.shape[1]
        last = _mixed([windows[:, length - block + i] for i in range(block)])
        first = _mixed([windows[:, i] for i in range(block)])
        return last ^ (first << np.uint64(1) | first >> np.uint64(63))

    def candidates(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where in ``words`` a window may end, in texts of ``sizes`` words that begin at ``starts``.

        Long texts are cut into lanes that share as many words as a window over their border has.
        """
        lanes = np.maximum(0, -(-(sizes - self.length + 1) // LANE))
        owner = np.repeat(np.arange(len(sizes)), lanes)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = starts[owner] + number * LANE + self.length - 1
        end = np.minimum(starts[owner] + sizes[owner], at + LANE)
        found = []
        while len(at):
            slots = _mixed([words[at - self.block + 1 + i] for i in range(self.block)]) % np.uint64(SLOTS)
            shift = self.shift[slots.astype(np.int64)]
            found.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            live = at < end
            at, end = at[live], end[live]
        return np.sort(np.concatenate([*found, np.zeros(0, np.int64)]))

    def occurrences(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the last word of each window that occurs, and the window's number."""
        ends, places, numbers = self.candidates(words, starts, sizes), [], []
        for part in np.array_split(ends, len(ends) // 65536 + 1):
            texts = np.stack([words[part - self.length + 1 + i] for i in range(self.length)], axis=1)
            keys = Tables._keys(texts, self.block)
            low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
            # Windows with the same end and beginning, one after the other, until no place has any more.
            left = np.flatnonzero(low < high)
            while len(left):
                same = (self.windows[low[left]] == texts[left]).all(axis=1)
                places.append(part[left[same]])
                numbers.append(self.numbers[low[left[same]]])
                low[left] += 1
                # Windows are distinct, so a place is done with the one that occurs there.
                left = left[~same & (low[left] < high[left])]
        none = np.zeros(0, np.int64)
        return np.concatenate([*places, none]).astype(np.int64), np.concatenate([*numbers, none]).astype(np.int64)


@dataclass(frozen=True)
class Search:
    """Word numbers, the tables for each length, and for each window the items that have it, one after the other."""

    words: dict[bytes, int]
    tables: list[Tables]
    bounds: np.ndarray
    items: np.ndarray

    @staticmethod
    def of(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> Search:
        """``items``: id and text. An item without an id has windows, but is not listed where they occur."""
        words, windows = _Numbers(), {}
        for key, text in items:
            found = [word for block in word_blocks(text) for word in block]
            numbers = np.fromiter((words.setdefault(word, len(words) + 1) for word in found), np.int32, len(found))
            length = min(window, len(numbers))
            for i in range(len(numbers) - length + 1 if length else 0):
                windows.setdefault(numbers[i : i + length].tobytes(), set()).add(key)
        lists = [sorted(key for key in keys if key is not None) for keys in windows.values()]
        bounds = np.cumsum([0, *map(len, lists)])
        by_length: dict[int, list[tuple[int, bytes]]] = {}
        for number, held in enumerate(windows):
            by_length.setdefault(len(held) // 4, []).append((number, held))
        tables = [
            Tables.of(
                np.frombuffer(b"".join(held for _, held in some), np.int32).reshape(-1, length),
                np.array([number for number, _ in some], np.int64),
            )
            for length, some in sorted(by_length.items())
        ]
        return Search(words, tables, bounds, np.array([key for keys in lists for key in keys], object))

    def find(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text its number of words, the spans of words that are hit, first and last, and the items."""
        each = [word_numbers(text, self.words) for text in texts]
        sizes = np.array([len(words) for words in each], np.int64)
        starts = np.cumsum(sizes) - sizes
        flat = np.concatenate([*each, np.zeros(0, np.int32)])
        change = np.zeros(len(flat) + 1, np.int32)
        owners, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for tables in self.tables:
            ends, found = tables.occurrences(flat, starts, sizes)
            np.add.at(change, ends - tables.length + 1, 1)
            np.add.at(change, ends + 1, -1)
            owners.append(np.searchsorted(starts + sizes, ends, "right"))
            numbers.append(found)
        # A text ends at the next one's start, so spans of two texts that touch are cut there.
        hit = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
        owner, number = np.concatenate(owners), np.concatenate(numbers)
        order = np.argsort(owner, kind="stable")
        owner, number = owner[order], number[order]
        result = [(int(size), [], []) for size in sizes]
        for i in np.unique(owner).tolist():
            own = hit[1 + starts[i] : 1 + starts[i] + sizes[i]]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
            spans = [(int(a), int(b) - 1) for a, b in edges.reshape(-1, 2)]
            of_text = np.unique(number[np.searchsorted(owner, i, "left") : np.searchsorted(owner, i, "right")])
            keys = {key for w in of_text.tolist() for key in self.items[self.bounds[w] : self.bounds[w + 1]]}
            result[i] = (int(sizes[i]), spans, sorted(keys))
        return result


SPANS = "array<struct<first: bigint, last: bigint>>"


def _scan(rows: DataFrame, search: Search, key: str) -> DataFrame:
    """``key``, n_words, spans and items of each row, which has ``key`` and text."""
    shared = rows.sparkSession.sparkContext.broadcast(search)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = shared.value.find([text or b"" for text in part.column("text").cast(pa.binary()).to_pylist()])
            spans = [[{"first": a, "last": b} for a, b in spans] for _, spans, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(key), pa.array([n for n, _, _ in found], pa.int64()), pa.array(spans, kind),
                    pa.array([items for _, _, items in found], pa.list_(pa.string())),
                ],
                [key, "n_words", "spans", "items"],
            )

    names = rows.select(key).schema.simpleString()[len("struct<") : -1].replace(":", " ", 1)
    return rows.select(key, "text").mapInArrow(run, f"{names}, n_words bigint, spans {SPANS}, items array<string>")


def _joined_spans(spans: str) -> str:
    """SQL: spans in order of their first word, with those that touch made one."""
    return f"""
        aggregate(array_sort({spans}), cast(array() as {SPANS}), (done, s) ->
          if(size(done) > 0 and element_at(done, -1).last >= s.first - 1,
             concat(slice(done, 1, size(done) - 1),
                    array(named_struct('first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, s.last)))),
             concat(done, array(s))))
    """


def found_in(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` with n_words, spans and items; columns of those names are replaced.

    ``spans``: the first and last word, from 0, of each stretch of words inside occurrences of windows.
    ``items``: the ids, as text, of items that have a window there. Words are runs of ASCII letters,
    A-Z in lower case, digits and all other characters beyond ASCII. A window is ``window`` words in a row
    of an item, or all of them where it has fewer; an item without words, NULL or empty, has none. An item
    without an id has windows but is not listed; items that share an id are one in the list. A NULL text has
    no words. Repeated rows stay, a row each. No documents: no rows; no items: nothing is found.

    The benchmark's size is measured. Up to ``group_bytes`` every executor gets its tables, and documents
    are read once and not shuffled; a larger one is dealt into groups of about that size, each searched for
    in a pass of its own.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    items = items.withColumn("of", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    kept = [name for name in docs.columns if name.lower() not in ("n_words", "spans", "items")]
    own = F.struct(*[F.col(f"`{name}`") for name in kept]) if kept else F.lit(None)
    whole, row = fresh(docs.columns, "_whole"), fresh(docs.columns, "_row")
    rows = docs.select(own.alias(whole), F.col("text").cast("string").alias("text"))

    def search(group: int) -> Search:
        some = items.where(F.col("of") == group).select("item_id", "text")  # about group_bytes
        return Search.of([(r["item_id"], r["text"].encode("utf-8", "surrogatepass")) for r in some.collect()], window)

    def back(found: DataFrame, key: str) -> DataFrame:
        return found.select(*[F.col(key)[name].alias(name) for name in kept], "n_words", "spans", "items")

    if groups == 1:
        return back(_scan(rows, search(0), whole), whole)
    numbered = scratch.keep(rows.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = [scratch.keep(_scan(numbered, search(group), row), "found") for group in range(groups)]
    hits = found[0].where("size(spans) > 0")
    for other in found[1:]:
        hits = hits.unionByName(other.where("size(spans) > 0"))
    merged = hits.groupBy(row).agg(
        F.expr(_joined_spans("flatten(collect_list(spans))")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    none = {"spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")}
    met = numbered.join(found[0].select(row, "n_words"), row).join(merged, row, "left")
    return back(met.withColumns({name: F.coalesce(name, value) for name, value in none.items()}), whole)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (ids in order, joined by commas) and contaminated."""
    found = found_in(docs.select("doc_id", "text"), benchmark, window, group_bytes)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"] + 1)
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_hit: float = 0.0) -> DataFrame:
    """The rows of ``docs`` of whose words no larger share than ``most_hit`` is hit, with their own columns."""
    n_words, spans, items = "n_words", "spans", "items"
    whole = fresh(docs.columns, "_own")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias(whole), "text")
    found = found_in(rows, benchmark, window)
    hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"] + 1)
    passed = found.where(hit <= F.col(n_words) * most_hit).drop(n_words, spans, items)
    return passed.select(*[F.col(whole)[name].alias(name) for name in docs.columns])


# The same for DuckDB.
ORACLE_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
items as (
  select item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as k
  from items, unnest(range(1, len(w) - least(len(w), 10) + 2)) as u(i) where len(w) > 0
),
places as (
  select r, i, n, array_to_string(w[i : i + n - 1], ' ') as k
  from docs, (select distinct n from windows), unnest(range(1, len(w) - n + 2)) as u(i)
),
occurs as (select distinct p.r, p.i, p.n, x.item_id from places p join windows x on p.n = x.n and p.k = x.k),
hit as (select r, count(distinct j) as n_hit from occurs, unnest(range(i, i + n)) as u(j) group by r),
named as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct r, item_id::varchar as id from occurs) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit on docs.r = hit.r left join named on docs.r = named.r
"""
