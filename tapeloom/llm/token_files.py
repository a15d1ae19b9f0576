"""Token ids in files: one compressed frame for each document, all with one shared dictionary.

A file is a Parquet file of shards, which Spark writes and reads in any store. A shard holds the frames of
some documents in ascending doc_id order, one after the other, an index with each document's id, place and
number of ids, and the digest of the dictionary. Reading a document takes its frame and the dictionary only.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.llm.byte_bpe import encoder
from tapeloom.llm.common import id_and_text, id_bounds, slices

TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
# Fixed value: the id that ends each document.
END_ID = 2
# The dictionary is trained on about this many documents, chosen by a hash of their ids, each of no more
# characters than LONGEST; longer ones compress well without it.
SAMPLE = 600
LONGEST = 20_000
DICTIONARY_BYTES = 16 * 1024
LEVEL = 3
# A shard ends at the document that takes its frames over this many bytes.
SHARD_BYTES = 4 * 1024 * 1024

INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "<u1"), ("at", "<u8"), ("bytes", "<u8"), ("ids", "<u8")])
SHARDS = """
    part int, shard int, first_token bigint, n_tokens bigint, width int, dictionary_sha256 string,
    index binary, frames binary
"""


def _zstd_dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(arrays: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for serialized id arrays; where they are too few to train one, the arrays themselves."""
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(arrays)[:size]


def sample_texts(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """About ``sample`` texts for the dictionary, at most twice as many, by a hash: the same ones on every run."""
    short = id_and_text(docs).where(F.length("text") <= LONGEST)
    every = max(1, docs.count() // sample)
    chosen = short.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    first = chosen.orderBy(F.xxhash64("doc_id", "text"), "text").limit(2 * sample)  # each task keeps its own first ones
    return sorted(row["text"] for row in first.select("text").collect())


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str = TOKENIZER_FILE, end_id: int = END_ID, parts: int | None = None
) -> None:
    """Encode every whole text and write the files under ``path``, a folder that does not exist yet.

    A NULL text counts as empty and has the end id alone. A NULL doc_id comes before all others, and
    repeated ids stay, ordered by their frames. No rows: files without shards. Texts are encoded where
    they are read; only frames are shuffled, by ranges of doc_id, and no task holds more than a shard.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        serialized = file.read()
    pieces, _, _ = encoder(serialized)
    arrays = [ids.tobytes() for ids in pieces.encode(sample_texts(docs))]
    dictionary = train_dictionary(arrays)
    digest = hashlib.sha256(dictionary).hexdigest()
    width = np.dtype(pieces.dtype).itemsize
    bounds = id_bounds(docs, parts=parts)
    shared = spark.sparkContext.broadcast((serialized, dictionary, bounds))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serialized, dictionary, bounds = shared.value
        pieces, _, _ = encoder(serialized)
        zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dictionary(dictionary), write_dict_id=False)
        end = np.array([end_id], pieces.dtype).tobytes()
        for part in slices(batches):
            ids = pieces.encode([text or "" for text in part.column("text").to_pylist()])
            frames = [zstd.compress(array.tobytes() + end) for array in ids]
            keys = part.column("doc_id").to_pylist()
            places = np.searchsorted(bounds, [-(2**63) if key is None else key for key in keys], side="right")
            counts = pa.array([len(array) + 1 for array in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(places.astype(np.int32)), part.column("doc_id"), counts, pa.array(frames, pa.binary())],
                ["part", "doc_id", "n_tokens", "frame"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard() -> pa.RecordBatch:
            index = np.zeros(len(frames), INDEX)
            index["doc_id"] = [0 if key is None else key for key in keys]
            index["has_id"] = [key is not None for key in keys]
            index["bytes"] = [len(frame) for frame in frames]
            index["at"] = np.cumsum(index["bytes"]) - index["bytes"]
            index["ids"] = counts
            row = [part, number, first, sum(counts), width, digest, index.tobytes(), b"".join(frames)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()]
            names = ["part", "shard", "first_token", "n_tokens", "width", "dictionary_sha256", "index", "frames"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        part, number, first, held = None, 0, 0, 0
        keys, counts, frames = [], [], []
        for batch in batches:
            for where, key, count, frame in zip(*(column.to_pylist() for column in batch.columns)):
                if frames and (where != part or held > SHARD_BYTES):
                    yield shard()
                    number, first = number + 1, first + sum(counts)
                    keys, counts, frames, held = [], [], [], 0
                if where != part:
                    part, number, first = where, 0, 0
                keys.append(key)
                counts.append(count)
                frames.append(frame)
                held += len(frame)
        if frames:
            yield shard()

    frames = id_and_text(docs).mapInArrow(compress, "part int, doc_id bigint, n_tokens bigint, frame binary")
    ordered = frames.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "doc_id", "frame")
    ordered.mapInArrow(pack, SHARDS).write.option("compression", "none").parquet(f"{path}/shards")
    kept = spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, dictionary binary")
    kept.coalesce(1).write.parquet(f"{path}/dictionary")


@lru_cache(maxsize=2)
def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(dictionary))


def _read(spark: SparkSession, path: str, shards: DataFrame, column: str, kind: str, value: Callable) -> DataFrame:
    """doc_id, start, n_tokens and ``value`` of the ids of each document in ``shards``."""
    whole = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    totals = sorted(whole.groupBy("part").agg(F.sum("n_tokens")).collect())  # a row for each range of ids
    starts = dict(zip((part for part, _ in totals), np.cumsum([0, *(n for _, n in totals)]).tolist()))
    kept = spark.read.parquet(f"{path}/dictionary").first()
    shared = spark.sparkContext.broadcast((kept["sha256"], bytes(kept["dictionary"]), starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha256, dictionary, starts = shared.value
        zstd = _decompressor(dictionary)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != sha256:
                    raise ValueError("a shard was written with another dictionary")
                index, frames = np.frombuffer(row["index"], INDEX), row["frames"]
                ends = np.cumsum(index["ids"])
                wanted = np.arange(len(index)) if row.get("wanted") is None else np.isin(
                    index["doc_id"], row["wanted"]
                ).nonzero()[0]
                values = []
                for at, size in index[["at", "bytes"]][wanted].tolist():
                    ids = np.frombuffer(zstd.decompress(frames[at : at + size]), f"<u{row['width']}")
                    values.append(value(ids))
                index, first = index[wanted], starts[row["part"]] + row["first_token"] + (ends - index["ids"])[wanted]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(index["doc_id"], mask=index["has_id"] == 0),
                        pa.array(first.astype(np.int64)),
                        pa.array(index["ids"].astype(np.int64)),
                        pa.array(values, pa.int64() if kind == "bigint" else pa.list_(pa.int32())),
                    ],
                    ["doc_id", "start", "n_tokens", column],
                )

    return shards.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {column} {kind}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document in the files."""
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    return _read(spark, path, shards, "ids", "array<int>", lambda ids: ids.astype(np.int32))


def read_documents(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """The same for some documents: the index tells their frames, no other frame is decompressed."""
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    chosen = shards.withColumn("wanted", F.lit([int(key) for key in wanted]).cast("array<bigint>"))
    return _read(spark, path, chosen, "ids", "array<int>", lambda ids: ids.astype(np.int32))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    return _read(spark, path, shards, "ids_crc32", "bigint", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def tokens_round_trip(docs: DataFrame) -> DataFrame:
    """Write all documents to new files in the shared folder, and read checksums back from them."""
    path = scratch.new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return checksums(docs.sparkSession, path)
