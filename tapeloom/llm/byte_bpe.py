"""Byte-level BPE: text to ids and ids to bytes, by the tokenizers library over Arrow batches.

Bytes are written as characters, one each, so that the library can hold any byte in a string. A rank file
gives the vocabulary; the merges follow from the ranks. Texts are cut into pieces at spaces, and pieces into
matches of the pattern; what a Python worker has seen before is not encoded again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Split
from tokenizers.pre_tokenizers import Sequence as InTurn

from tapeloom.llm.common import id_and_text, released, slices

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Pieces, and matches, that a worker remembers; when they are more it starts anew.
REMEMBERED = 500_000
# Characters below this one are sorted into letters, digits and others alike by all three libraries, which tests check.
CHECKED = "\u3100"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shown = {byte: chr(byte) for byte in prints}
    hidden = (byte for byte in range(256) if byte not in shown)
    shown |= {byte: chr(256 + i) for i, byte in enumerate(hidden)}
    return [shown[byte] for byte in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_from_ranks(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts each longer token is merged from, in order of rank.

    Its bytes are merged by all lower ranks, lowest first, until two parts are left; a token that is
    not reached that way has no merge.
    """
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda entry: entry[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
            if best >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizer that gives the ids of the ranks, each match of ``pattern`` by itself."""
    shown = byte_characters()

    def written(token: bytes) -> str:
        return "".join(shown[byte] for byte in token)

    vocabulary = {written(token): rank for token, rank in ranks.items()}
    merges = [(written(left), written(right)) for left, right in merges_from_ranks(ranks)]
    made = Tokenizer(BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    made.pre_tokenizer = InTurn(
        [Split(Regex(pattern), behavior="isolated"), ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return made


def byte_table(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each id, by the byte characters in reverse; no bytes for an id that is not in use."""
    bytes_of = {character: byte for byte, character in enumerate(byte_characters())}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, number in vocabulary.items():
        inside = all(character in bytes_of for character in token)
        table[number] = bytes(bytes_of[character] for character in token) if inside else token.encode()
    return table


def decode(ids: Sequence[int], table: list[bytes]) -> bytes:
    """The bytes of a text; ids may split a character, so only the whole is sure to be UTF-8."""
    return b"".join(map(table.__getitem__, ids))


def decode_text(ids: Sequence[int], table: list[bytes]) -> str:
    """The text; what is no whole character, as at the end of a cut list of ids, is shown as U+FFFD."""
    return decode(ids, table).decode("utf-8", errors="replace")


def encode_with_offsets(tokenizer: Tokenizer, text: str) -> tuple[list[int], list[tuple[int, int]]]:
    """Ids, and the first and last code point (exclusive) each one comes from.

    Ids that share a character have the same span of it.
    """
    encoded = tokenizer.encode(text, add_special_tokens=False)
    return encoded.ids, encoded.offsets


def ascii_pattern(pattern: str) -> str:
    """The pattern for ASCII text, where letters and numbers are those of the alphabet and ten digits."""
    inside = pattern.replace(r"\p{L}\p{N}]", "A-Za-z0-9]")
    return inside.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")


class _Whole(Exception):
    """The text must be encoded in one piece."""


class _Matches(dict):
    """Ids of single matches of the pattern, straight from the library's model when first asked for."""

    def __init__(self, tokenizer: Tokenizer, dtype: type):
        super().__init__()
        self.tokenize, shown = tokenizer.model.tokenize, byte_characters()
        self.shown, self.space = dict(enumerate(shown)), shown[ord(" ")]
        size = max(tokenizer.get_vocab().values(), default=-1) + 1
        self.packed = [number.tobytes() for number in np.arange(size, dtype=dtype)]

    def of_word(self, word: str) -> bytes:
        """Ids of a space and an ASCII word after it, whose characters stand for themselves; not remembered."""
        return b"".join([self.packed[token.id] for token in self.tokenize(self.space + word)])

    def __missing__(self, match: str) -> bytes:
        written = match.encode().decode("latin-1").translate(self.shown)
        ids = self[match] = b"".join([self.packed[token.id] for token in self.tokenize(written)])
        return ids


class _Pieces(dict):
    """Ids of pieces that follow a space, put together from those of their matches."""

    def __init__(self, tokenizer: Tokenizer, dtype: type):
        super().__init__()
        self.tokenizer, self.code = tokenizer, np.dtype(dtype).char
        self.cut, self.matches = regex.compile(public_tokenizers.PATTERN).findall, _Matches(tokenizer, dtype)
        self.cut_ascii = re.compile(ascii_pattern(public_tokenizers.PATTERN), re.ASCII).findall

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace():
            raise _Whole
        if piece.isascii():
            if piece.isalpha():
                ids = self.matches.of_word(piece)
            else:
                first, *own = self.cut_ascii(f" {piece}")
                word = first[1:]
                start = self[word] if word.isalpha() else self.matches[first]
                ids = start + b"".join(map(self.matches.__getitem__, own))
        elif max(piece) < CHECKED:
            own = (f" {piece}",) if piece.isalpha() else self.cut(f" {piece}")
            ids = b"".join(map(self.matches.__getitem__, own))
        else:
            ids = array(self.code, self.tokenizer.encode(f" {piece}", add_special_tokens=False).ids).tobytes()
        self[piece] = ids
        return ids


class PieceEncoder:
    """Ids of whole texts, as a numpy array each.

    A text may be cut before a space that stands before a character other than white space: no match of
    the pattern goes over such a cut, and the matches on both sides are the same without the other side.
    A text in which a space stands elsewhere is encoded in one piece. A piece is cut into the matches of the
    pattern, which both tokenizers share, and the model is asked for each of those.
    """

    def __init__(self, tokenizer: Tokenizer, remembered: int = REMEMBERED):
        self.tokenizer, self.remembered = tokenizer, remembered
        self.dtype = np.uint16 if tokenizer.get_vocab_size() <= 65536 else np.uint32
        self.pieces = _Pieces(tokenizer, self.dtype)
        self.caches = (self.pieces, self.pieces.matches)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        found = []
        for text in texts:
            for seen in self.caches:
                if len(seen) > self.remembered:
                    seen.clear()
            head, *tail = text.split(" ")
            try:
                ids = self._whole(head) + b"".join(map(self.pieces.__getitem__, tail))
            except _Whole:
                ids = self._whole(text)
            found.append(np.frombuffer(ids, self.dtype))
        return found


@lru_cache(maxsize=4)
def encoder(serialized: str) -> tuple[PieceEncoder, list[bytes], list[str]]:
    """The encoder, byte table and decimal texts of a serialized tokenizer, kept by the Python worker."""
    tokenizer = Tokenizer.from_str(serialized)
    tokenizer.encode_special_tokens = True
    table = byte_table(tokenizer)
    return PieceEncoder(tokenizer), table, [str(i) for i in range(len(table))]


def encoded(docs: DataFrame, serialized: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text; a NULL text counts as empty and has no ids.

    Tasks forget what they have seen, as their workers go on to other stages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(serialized)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _, _ = encoder(shared.value)
        with released(*pieces.caches):
            for part in slices(batches):
                ids = pieces.encode([text or "" for text in part.column("text").to_pylist()])
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate([*ids, np.zeros(0, pieces.dtype)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def round_trip(docs: DataFrame, serialized: str) -> DataFrame:
    """Encode every whole text of ``docs``, decode the ids, and return digests of both.

    doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by a space) and decoded_sha256 (of the
    decoded bytes). A NULL text counts as empty: no ids, no bytes. Repeated rows and NULL ids stay, one
    row each; other columns are not read. Rows stay in their partitions, so nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(serialized)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table, decimals = encoder(shared.value)
        for part in slices(batches):
            counts, written, decoded = [], [], []
            for ids in pieces.encode([text or "" for text in part.column("text").to_pylist()]):
                listed = ids.tolist()
                counts.append(len(listed))
                written.append(hashlib.sha256(" ".join(map(decimals.__getitem__, listed)).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode(listed, table)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(written), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    columns = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs).mapInArrow(run, columns)


@lru_cache(maxsize=2)
def serialized_ranks(path: str = RANK_FILE, pattern: str = public_tokenizers.PATTERN) -> str:
    """The tokenizer of a rank file in the library's own text form, as it is sent to the executors."""
    return tokenizer_from_ranks(read_ranks(path), pattern).to_str()
