from __future__ import annotations

import random

import pytest

from tapeloom import scratch
from tapeloom.llm import lz_fingerprint as lz
from tapeloom.llm.components import components
from tapeloom.llm.ngram_join import (
    Settings,
    bitmap,
    link_counts,
    linked_classes,
    most_overlap,
    near_duplicates,
    one_of_each,
    overlap,
    shingle_set,
)
from tests.llm import data

SETTINGS = [Settings(), Settings(often=1, members=3, noted=8), Settings(words=5, percent=80), Settings(words=2, percent=50, members=4)]


def families(seed: int) -> list[tuple[int, str]]:
    """Copies of a few texts with some words changed, from exact to far apart."""
    draw, rows = random.Random(seed), []
    for family in range(4):
        base = data.prose(draw, draw.choice([6, 30, 150])).split(" ")
        for _ in range(25):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 8])):
                own[draw.randrange(len(own))] = f"w{draw.randrange(50)}"
            rows.append((len(rows) * 3 + 1, " ".join(own[: draw.choice([len(own), len(own), len(own) - 1])])))
    return rows


def sort_key(row):
    return tuple((value is not None, value or 0) for value in row)


@pytest.mark.parametrize("settings", SETTINGS)
def test_awkward_documents(awkward, settings):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    got = sorted(map(tuple, near_duplicates(awkward, settings).collect()), key=sort_key)
    assert got == sorted(data.components(rows, settings.words, settings.percent), key=sort_key)


@pytest.mark.parametrize("settings", SETTINGS)
def test_families_of_copies(spark, settings):
    rows = families(len(str(settings)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(map(tuple, near_duplicates(docs, settings).collect())) == sorted(
        data.components(rows, settings.words, settings.percent)
    )


def plain_links(rows, settings):
    """Pairs of classes and each row's class and number of links, by comparing all sets."""
    sets = {key: frozenset(shingle_set(text, settings.words).tolist()) for key, text in rows}
    first = {key: min((other for other in sets if sets[other] == own), default=key) if own else key for key, own in sets.items()}

    def links(a, b):
        common = len(sets[a] & sets[b])
        return common > 0 and 100 * common >= settings.percent * len(sets[a] | sets[b])

    reps = sorted({first[key] for key, own in sets.items() if own})
    pairs = [(a, b) for i, a in enumerate(reps) for b in reps[i + 1 :] if links(a, b)]
    counts = [(key, len(own), first[key], sum(links(key, other) for other in sets if other != key)) for key, own in sets.items()]
    return pairs, sorted(counts)


@pytest.mark.parametrize("settings", SETTINGS[:2])
def test_links_of_families(spark, settings):
    rows = [*families(4)[10:70], (900, ""), (901, None)]
    pairs, counts = plain_links(rows, settings)
    assert len(pairs) > 20 and any(row[3] > 1 for row in counts)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, linked_classes(docs, settings).collect())) == pairs
    assert sorted(map(tuple, link_counts(docs, settings).collect())) == counts


def test_links_of_awkward_documents(awkward, nothing):
    counts = link_counts(awkward)
    for row in counts.collect():
        if row["doc_id"] is None or row["n_shingles"] == 0:
            assert row["n_links"] == 0 and row["class_id"] == row["doc_id"]
    assert counts.count() == awkward.count()
    assert link_counts(nothing).count() == 0


def test_one_of_each_keeps_columns_and_rows(awkward):
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    keys = [row["doc_id"] for row in kept.collect()]
    # Of the two rows without an id one is a copy of document 1, and the other has no words.
    assert 1 in keys and 2 not in keys and 3 not in keys and keys.count(None) == 1 and 5 in keys and 8 in keys and 9 not in keys


def test_bounds_hold():
    draw = random.Random(1)
    for _ in range(300):
        left = shingle_set(data.prose(draw, draw.randint(0, 300)), 2)
        right = shingle_set(data.prose(draw, draw.randint(0, 300)), 2)
        common = len(set(left.tolist()) & set(right.tolist()))
        assert overlap(left, right) == common <= most_overlap(bitmap(left), bitmap(right), len(left) + len(right))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(90, 80)], "a bigint, b bigint")
    found = {row["node"]: row["label"] for row in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 80: 80, 90: 80}


def test_components_write_no_copy_of_their_labels(spark, monkeypatch):
    written, new_path = [], scratch.new_path
    monkeypatch.setattr(scratch, "new_path", lambda spark, label: written.append(label) or new_path(spark, label))
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(40, 30), (41, 30)], "a bigint, b bigint")
    found = {row["node"]: row["label"] for row in components(links).collect()}
    assert found == {**dict.fromkeys(range(1, 21), 1), **dict.fromkeys((30, 40, 41), 30)}
    assert set(written) == {"ends", "labels"}


def plain_phrases(text: str) -> set[str]:
    seen, phrase = set(), ""
    for character in text:
        phrase += character
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def test_fingerprint_depends_on_the_phrases_only():
    draw = random.Random(5)
    for size in (0, 1, 5, 300):
        text = data.prose(draw, size)
        whole = lz.Parse().add(text)
        parts = lz.Parse().add(text[:7]).copy().add(text[7:])
        assert whole.seen == parts.seen == plain_phrases(text)
        assert (whole.signature() == parts.signature()).all()
        assert len(lz.written(whole.signature())) == 4 * lz.BINS
    assert lz.likeness(lz.signature(""), lz.signature("")) == 1.0
    assert lz.likeness(lz.signature(""), lz.signature("a")) == 0.0


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = data.prose(random.Random(6), 500)
    whole = lz.signature(text)
    monkeypatch.setattr(lz, "BLOCK", 50)
    assert (lz.signature(text) == whole).all()


def test_likeness_follows_what_phrases_share():
    draw = random.Random(7)
    text = data.prose(draw, 400)
    other = data.prose(draw, 400)
    edited = text[: len(text) * 3 // 4] + other[: len(text) // 4]
    own, close, far = map(lz.signature, (text, edited, other))
    shared = len(plain_phrases(text) & plain_phrases(edited)) / len(plain_phrases(text) | plain_phrases(edited))
    assert abs(lz.likeness(own, close) - shared) < 0.15
    assert lz.likeness(own, close) > lz.likeness(own, far)


@pytest.mark.parametrize("parts", [1, 7])
def test_comparison_with_edits(awkward, parts):
    import hashlib

    rows = sorted(((row["doc_id"], row["text"]) for row in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        tail = len(text) // 4
        edited = text[: len(text) - tail] + after[:tail]
        own, other, following = lz.signature(text), lz.signature(edited), lz.signature(after)
        want.append(
            (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), lz.written(own), lz.written(other),
             lz.likeness(own, other), lz.likeness(own, following))
        )
    got = map(tuple, lz.compared_with_edits(awkward, parts).collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_fingerprints_of_equal_texts(awkward):
    made = {}
    for row in lz.fingerprints(awkward).collect():
        made.setdefault(row["doc_id"], set()).add(row["fingerprint"])
    assert made[1] == made[2] and made[8] == made[9] == made[19] and made[1] != made[3]


SPLIT = [Settings(members=3, noted=8, broadcast_bytes=0, hot_rows=5), Settings(words=5, percent=80, members=2, broadcast_bytes=0, hot_rows=3)]


@pytest.mark.parametrize("settings", SPLIT)
def test_families_without_broadcasts(spark, settings, monkeypatch):
    monkeypatch.setattr("tapeloom.llm.ngram_join.SENDS", 2)
    monkeypatch.setattr("tapeloom.llm.ngram_join.SENT_BYTES", 2_000)
    rows = families(3)[:60]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, near_duplicates(docs, settings).collect())) == sorted(
        data.components(rows, settings.words, settings.percent)
    )


@pytest.mark.parametrize("settings", [Settings(), SPLIT[0]])
def test_one_row_of_each_component_stays(spark, settings):
    a, b, c = (data.prose(random.Random(seed), 40) for seed in range(3))
    near = c + " more"
    rows = [(1, a, "x"), (1, a, "y"), (2, b, "x"), (2, a, "x"), (None, c, "x"), (None, c, "y"), (7, near, "z"), (3, None, "n"), (3, None, "n"), (4, "", "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string").repartition(2)
    kept = one_of_each(docs, settings)
    assert kept.columns == docs.columns
    got = sorted(((row["doc_id"], row["text"]) for row in kept.collect()), key=repr)
    # Copies and the near one of c: the one with an id comes first.
    assert got == sorted([(1, a), (2, b), (7, near), (3, None), (3, None), (4, "")], key=repr)
    two = docs.where("doc_id is null or doc_id < 3")
    assert sorted(((row["doc_id"], row["text"]) for row in one_of_each(two, settings).collect()), key=repr) == sorted([(1, a), (2, b), (None, c)], key=repr)
