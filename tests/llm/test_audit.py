"""Filter audit, whitening and decontamination against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from tapeloom.llm import decontamination, filter_audit, whitening
from tests.llm import data

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text: str) -> tuple[int, ...]:
    words = WORDS.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


def texts_of_all_kinds(seed: int) -> list[str]:
    draw = random.Random(seed)
    kinds = ["", " ", "a", "A", "é", "😀", "\n\nx\x0b", "x" * 9, "x" * 63 + " " + "x" * 64 + " " + "x" * 65, "y" * 200 + " " + "y" * 200]
    kinds += [" ".join(draw.choice(["ab", "abc", "abcdefgh", "abcdefghi", "é", "É#", "東京", "x" * 70]) for _ in range(size)) for size in (1, 5, 80)]
    return kinds + [data.prose(draw, draw.randint(0, 200)) for _ in range(20)]


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_transducer_and_table(monkeypatch, block):
    monkeypatch.setattr(filter_audit, "BLOCK", block)
    texts = texts_of_all_kinds(block)
    found = filter_audit.measure([text.encode() for text in texts])
    got = list(zip(*(found[name].tolist() for name in filter_audit.MEASURES)))
    assert got == [plain_measures(text) for text in texts]


def test_spans_are_the_words():
    texts = texts_of_all_kinds(3)
    scan = filter_audit.transduce([text.encode() for text in texts])
    words = [bytes(scan.data[a:b]).decode() for a, b in zip(scan.starts, scan.ends)]
    assert words == [word for text in texts for word in WORDS.findall(text)]


def test_words_whose_hashes_collide(monkeypatch):
    texts = [text.encode() for text in texts_of_all_kinds(4)]
    scan = filter_audit.transduce(texts)
    same = np.full(len(scan.starts), 12345, np.uint64)
    by_length = (scan.ends - scan.starts).astype(np.uint64)
    want = filter_audit.first_of_each(scan, filter_audit.span_hashes(scan))
    for hashes in (same, by_length):
        assert (filter_audit.first_of_each(scan, hashes) == want).all()


def test_text_of_over_a_megabyte():
    text = data.prose(random.Random(8), 300_000)
    found = filter_audit.measure([text.encode(), b"a b"])
    assert tuple(int(found[name][0]) for name in filter_audit.MEASURES) == plain_measures(text)


def plain_audit(docs, labels) -> dict[tuple, tuple]:
    good = {row["doc_id"] for row in labels if row["quality"] == 1}
    toxic = {row["doc_id"] for row in labels if row["toxic"] == 1}
    least = {}
    for row in docs:
        if row["doc_id"] is not None:
            text = row["text"] or ""
            least[text] = min(least.get(text, row["doc_id"]), row["doc_id"])
    entries = []
    for row in docs:
        text, key = row["text"] or "", row["doc_id"]
        words, distinct, capitals, points, symbols = plain_measures(text)
        fails = {
            letter
            for letter, failed in {
                "A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * points, "D": symbols > 0,
                "E": key is not None and key > least[text],
            }.items()
            if failed
        }
        entries.append((row["source"] or "", fails, key is not None and key in good, key is not None and key in toxic))
    want, by_filter = {}, Counter()
    for part in {entry[0] for entry in entries}:
        for order in permutations("ABCDE"):
            left = [entry for entry in entries if entry[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                out = [entry for entry in left if letter in entry[1]]
                redundant = sum(letter in entry[1] for entry in gone)
                left = [entry for entry in left if letter not in entry[1]]
                alone = sum(entry[1] == {letter} for entry in entries if entry[0] == part)
                want[part, "".join(order), step] = (
                    len(left), len(out), redundant, alone, sum(entry[2] for entry in out), sum(entry[3] for entry in out)
                )
                by_filter[part, letter] += len(out)
                gone += out
    return {key: (*value, by_filter[key[0], key[1][key[2] - 1]]) for key, value in want.items()}


def test_audit_equals_plain_filters(spark, awkward, folders):
    labels = spark.read.parquet(f"{folders['awkward']}/labels.parquet")
    got = {tuple(row)[:3]: tuple(row)[3:] for row in filter_audit.audit(awkward, labels).collect()}
    assert got == plain_audit(awkward.collect(), labels.collect())


def test_audit_of_other_filters_and_sources(spark):
    docs = spark.createDataFrame([(1, "a a", None), (2, "a", ""), (3, "$", "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rules = (filter_audit.Filter("x", "n_words > 1"), filter_audit.Filter("y", "n_symbols > 0"))
    got = {tuple(row)[:3]: tuple(row)[3:] for row in filter_audit.audit(docs, labels, rules).collect()}
    assert got["", "xy", 1] == (1, 1, 0, 1, 0, 0, 2) and got["s", "xy", 2] == (0, 1, 0, 1, 0, 0, 2) and len(got) == 8
    with pytest.raises(ValueError):
        filter_audit.audit(docs, labels, ())


def plain_whitening(vectors: list[list[float]], components: int):
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in vector] for vector in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    return deviations, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


@pytest.mark.parametrize("per_block", [2, 256])
def test_whitening_equals_plain(spark, monkeypatch, per_block):
    monkeypatch.setattr(whitening, "LEAST_ROWS", per_block)
    draw = np.random.default_rng(2)
    vectors = (draw.standard_normal((60, 12)) @ draw.standard_normal((12, 12))).astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>").repartition(7)
    rows = whitening.whitened(df, 5).collect()
    deviations, white, shares = plain_whitening(vectors, 5)
    got = np.zeros((60, 5))
    for row in rows:
        got[row["vec_id"], row["component"] - 1] = row["whitened"]
        assert row["deviation"] == deviations[row["vec_id"]] == int(row["deviation_exact"]) and row["n"] == 60
        assert row["explained"] == pytest.approx(shares[row["component"] - 1], rel=1e-9) and row["identity_error"] < 1e-9
    signs = np.sign((got * white).sum(axis=0))
    assert len(rows) == 300 and np.allclose(got * signs, white, atol=1e-8)


def test_awkward_vectors(spark, folders):
    rows = whitening.whitened(spark.read.parquet(f"{folders['awkward']}/embeddings.parquet")).collect()
    assert sorted({row["vec_id"] for row in rows if row["vec_id"] is not None}) == [1, 8, 9]
    assert {row["n"] for row in rows} == {5} and max(row["identity_error"] for row in rows) < 1e-4


def test_vectors_without_spread(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id bigint, embedding array<double>")
    rows = whitening.whitened(same).collect()
    assert len(rows) == 8 and all(row["whitened"] == row["explained"] == row["deviation"] == 0 for row in rows)


def test_vectors_beyond_64_bits(spark):
    far = spark.createDataFrame([(0, [4e6, 0.0]), (1, [-4e6, 1.0])], "vec_id bigint, embedding array<double>")
    x = [[4096000000 + 100000, 100000], [-4096000000 + 100000, 101024]]
    want = sum((2 * a - a - b) ** 2 for a, b in zip(*x))
    rows = whitening.whitened(far).collect()
    assert want > 2**63 and {row["deviation_exact"] for row in rows} == {str(want)} and {row["deviation"] for row in rows} == {None}
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(spark.createDataFrame([(i, [1e15, 0.0]) for i in range(9)], "vec_id bigint, embedding array<double>"))


ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text: str | None) -> list[str]:
    return ITEM_WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(docs: list[tuple], items: list[tuple], window: int) -> list[tuple]:
    windows = []
    for key, text in items:
        words = item_words(text)
        size = min(window, len(words))
        windows += [(key, tuple(words[i : i + size])) for i in range(len(words) - size + 1) if size]
    result = []
    for key, text in docs:
        words, hit, named = item_words(text), set(), set()
        for item, wanted in windows:
            for i in range(len(words) - len(wanted) + 1):
                if tuple(words[i : i + len(wanted)]) == wanted:
                    hit |= set(range(i, i + len(wanted)))
                    named |= {str(item)} - {"None"}
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        result.append((key, len(words), len(hit), len(named), digest, bool(hit)))
    return result


@pytest.mark.parametrize("window,group_bytes,lane", [(10, 1 << 24, 512), (3, 1 << 24, 2), (4, 40, 3), (1, 1 << 24, 512)])
def test_contamination_equals_plain(spark, awkward, folders, monkeypatch, window, group_bytes, lane):
    monkeypatch.setattr(decontamination, "LANE", lane)
    benchmark = spark.read.parquet(f"{folders['awkward']}/benchmark.parquet")
    got = decontamination.contamination(awkward, benchmark, window, group_bytes)
    docs, items = [(r["doc_id"], r["text"]) for r in awkward.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_contamination(docs, items, window), key=repr)


def test_search_with_slots_and_keys_that_collide(monkeypatch):
    monkeypatch.setattr(decontamination, "SLOTS", 1)
    monkeypatch.setattr(decontamination.Tables, "_keys", staticmethod(lambda windows, block: np.zeros(len(windows), np.uint64)))
    monkeypatch.setattr(decontamination, "BYTES", 20)
    draw = random.Random(9)
    items = [(str(i), " ".join(draw.choice("ab") for _ in range(draw.randint(0, 7)))) for i in range(20)]
    docs = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 40)))) for i in range(30)]
    found = decontamination.Search.of([(key, text.encode()) for key, text in items], 3).find([text.encode() for _, text in docs])
    want = plain_contamination(docs, items, 3)
    got = [
        (key, n, sum(b - a + 1 for a, b in spans), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(spans))
        for (key, _), (n, spans, named) in zip(docs, found)
    ]
    assert got == want


def test_long_text_and_clean_documents(spark):
    draw = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(12))
    long = data.prose(draw, 250_000) + " " + passage.upper() + " " + data.prose(draw, 50_000)
    docs = spark.createDataFrame([(1, long, 5), (2, "clean", 6), (3, None, 7), (4, passage, 8)], "doc_id bigint, text string, items int")
    benchmark = spark.createDataFrame([(1, passage), (2, passage)], "item_id bigint, text string")
    got = {row["doc_id"]: (row["n_hit"], row["n_items"]) for row in decontamination.contamination(docs, benchmark).collect()}
    assert got == {1: (12, 2), 2: (0, 0), 3: (0, 0), 4: (12, 2)}
    assert {tuple(row)[::2] for row in decontamination.clean_documents(docs, benchmark).collect()} == {(2, 6), (3, 7)}
    assert decontamination.clean_documents(docs, benchmark, most_hit=0.5).columns == docs.columns
    assert decontamination.clean_documents(docs, benchmark, most_hit=0.5).count() == 3
