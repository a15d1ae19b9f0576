from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tapeloom import scratch
from tapeloom.llm import byte_bpe, token_files
from tests.llm import data


@pytest.fixture(scope="module")
def rank_encoding():
    ranks = byte_bpe.read_ranks(byte_bpe.RANK_FILE)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(token_files.TOKENIZER_FILE)
    tokenizer.encode_special_tokens = True
    return tokenizer


def random_texts(count: int) -> list[str]:
    draw = random.Random(11)
    parts = [*" \t\n\r  ab1'sé,.东é😀\x1c\x85 ", "'ll", "  ", " word", " words, and", "<|endoftext|>"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 16))) for _ in range(count)]


def test_pieces_give_the_ids_of_whole_texts(rank_encoding, library):
    texts = random_texts(20_000)
    by_ranks = byte_bpe.PieceEncoder(Tokenizer.from_str(byte_bpe.serialized_ranks()), remembered=500).encode(texts)
    assert [ids.tolist() for ids in by_ranks] == [rank_encoding.encode_ordinary(text) for text in texts]
    by_file = byte_bpe.PieceEncoder(library).encode(texts)
    assert [ids.tolist() for ids in by_file] == [entry.ids for entry in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_splits_as_in_the_other_library(rank_encoding):
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} ,{chr(c)}  {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    checked = texts[: ord(byte_bpe.CHECKED)]
    encoder = byte_bpe.PieceEncoder(Tokenizer.from_str(byte_bpe.serialized_ranks()))
    assert [ids.tolist() for ids in encoder.encode(checked)] == [rank_encoding.encode_ordinary(text) for text in checked]


def test_pieces_with_every_character_are_those_of_the_library(library):
    texts = [f"a {chr(c)}b.{chr(c)}\nc{chr(c)}1 x" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = byte_bpe.PieceEncoder(library).encode(texts)
    for at in range(0, len(texts), 50_000):
        part = slice(at, at + 50_000)
        want = [entry.ids for entry in library.encode_batch(texts[part], add_special_tokens=False)]
        assert [ids.tolist() for ids in found[part]] == want


def test_decoding_and_split_characters(rank_encoding):
    tokenizer = Tokenizer.from_str(byte_bpe.serialized_ranks())
    table = byte_bpe.byte_table(tokenizer)
    ids = rank_encoding.encode_ordinary("naïve 😀東")
    assert byte_bpe.decode_text(ids, table) == "naïve 😀東"
    assert all(table[i] == rank_encoding.decode_single_token_bytes(i) for i in range(len(table)))
    split = next(n for n in range(len(ids)) if byte_bpe.decode_text(ids[:n], table).endswith("�"))
    assert byte_bpe.decode(ids[:split], table) + byte_bpe.decode(ids[split:], table) == "naïve 😀東".encode()
    found, offsets = byte_bpe.encode_with_offsets(tokenizer, "naïve 東")
    assert found == rank_encoding.encode_ordinary("naïve 東") and offsets[-1][1] == len("naïve 東")


def test_round_trip(awkward, rank_encoding):
    want = []
    for row in awkward.collect():
        ids = rank_encoding.encode_ordinary(row["text"] or "")
        decimal = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((row["doc_id"], len(ids), decimal, hashlib.sha256((row["text"] or "").encode()).hexdigest()))
    got = map(tuple, byte_bpe.round_trip(awkward, byte_bpe.serialized_ranks()).collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files(spark, awkward, library, parts, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2_000)
    path = scratch.new_path(spark, "tokens")
    token_files.write_tokens(awkward, path, parts=parts)
    got = [tuple(row) for row in token_files.checksums(spark, path).collect()]
    ids = {}
    for row in awkward.collect():
        own = [*library.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        ids.setdefault(row["doc_id"], []).append(own)
    crc = lambda own: zlib.crc32(np.array(own, "<u4").tobytes())
    assert sorted(((k, n, c) for k, _, n, c in got), key=repr) == sorted(
        ((k, len(own), crc(own)) for k, many in ids.items() for own in many), key=repr
    )
    ordered = sorted(got, key=lambda row: row[1])
    assert [row[0] for row in ordered] == sorted((row[0] for row in got), key=lambda key: (key is not None, key or 0))
    start = 0
    for _, at, count, _ in ordered:
        assert at == start
        start += count
    some = token_files.read_documents(spark, path, [3, 12, 999]).collect()
    assert {row["doc_id"]: row["ids"] for row in some} == {3: ids[3][0], 12: ids[12][0]}
    whole = token_files.read_tokens(spark, path)
    assert whole.count() == len(got) and whole.where("size(ids) != n_tokens").count() == 0


def test_no_dictionary_from_too_little():
    assert token_files.train_dictionary([]) == b""
    assert token_files.train_dictionary([b"ab"]) == b"ab"


def test_encoded_ids(awkward, rank_encoding):
    rows = {(row["doc_id"], row["text"]) for row in awkward.where("doc_id > 5").collect()}
    texts = dict(rows)
    for row in byte_bpe.encoded(awkward.where("doc_id > 5"), byte_bpe.serialized_ranks()).collect():
        assert row["ids"] == rank_encoding.encode_ordinary(texts[row["doc_id"]] or "")


def test_prose_has_words():
    assert data.words_of("A\x0bB c  D") == ["a", "b c", "d"]
