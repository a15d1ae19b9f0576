from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapeloom import scratch
from tapeloom.llm import byte_bpe, lm_score, quality_rules
from tests.llm import data

SMALL = lm_score.Settings(vocabulary=64, class_words=8, hidden=8, window=4, lanes=8)


def base_scores(rows):
    counts, tokens, held = Counter(), [], []
    for key, text in rows:
        held.append(zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0)
        tokens.append([*data.words_of(text), None])
        if not held[-1]:
            counts.update(tokens[-1])
    total, distinct = sum(counts.values()), len(counts)
    for (key, _), own, out in zip(rows, tokens, held):
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        yield key, out, len(own), sum(counts[t] > 0 for t in own), total, base


@pytest.mark.parametrize("known", [1, 40, 1 << 19])
def test_base_scores(awkward, known):
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    settings = lm_score.Settings(**{**SMALL.__dict__, "known": known, "rounds": 1})
    got = sorted(map(tuple, lm_score.scored(awkward, settings).collect()), key=repr)
    want = sorted(base_scores(rows), key=repr)
    assert [row[:5] for row in got] == [row[:5] for row in want]
    assert [row[5] for row in got] == pytest.approx([row[5] for row in want], rel=1e-9)
    assert all(math.isfinite(row[6]) and row[6] < 0 for row in got)


def test_model_is_better_than_the_base_on_held_out_documents(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")
    held = lm_score.scored(docs).where("held_out").groupBy().sum("base_score", "score").first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_every_training_document_is_learnt_from_once(awkward):
    settings = lm_score.Settings(**{**SMALL.__dict__, "rounds": 3})
    rows = lm_score.fitted(awkward, settings).sequences.collect()
    assert {row["turn"] for row in rows} == {0, 1, 2} and len({row["row"] for row in rows}) == len(rows) == awkward.count()
    assert all(len(row["ids"]) == 2 * row["n_tokens"] for row in rows)
    one = awkward.sparkSession.createDataFrame([(5, turn, bytearray(b"\3\0\0\0")) for turn in (0,)], "row bigint, turn int, ids binary")
    start = lm_score.Network.new(settings)
    for turn in range(3):
        moved = lm_score.train(one.withColumn("turn", F.lit(turn)), lm_score.Network.new(settings))
        assert moved.packed() != start.packed()
    assert lm_score.train(one.withColumn("turn", F.lit(3)), lm_score.Network.new(settings)).packed() == start.packed()


@pytest.mark.parametrize("lanes", [1, 3, 8])
def test_lanes_hold_every_token_once(monkeypatch, lanes):
    met = []

    def learn(self, ids, state, before, adam):
        met.append((ids.copy(), before.copy()))
        return state

    monkeypatch.setattr(lm_score.Network, "learn", learn)
    settings = lm_score.Settings(**{**SMALL.__dict__, "lanes": lanes})
    flat = np.arange(1, 104).astype(np.uint16)
    lm_score.Network.new(settings).train(flat, {})
    assert sorted(np.concatenate([ids.ravel() for ids, _ in met]).tolist()) == flat.tolist()
    for ids, before in met:
        assert (np.vstack([before[None], ids[:-1]]) + 1 == ids).all()


def test_gradients():
    settings = lm_score.Settings(vocabulary=8, class_words=4, hidden=3, window=3, rate=0.0)
    network = lm_score.Network.new(settings)
    network.w = {name: value.astype(np.float64) for name, value in network.w.items()}
    ids, before = np.array([[3, 8], [0, 9], [12, 12]]), np.array([0, 1])
    state = np.full((3, 2), 0.1)

    def loss():
        rows, held, total = network.input_rows(), state, 0.0
        inputs = np.vstack([before[None], ids[:-1]])
        for t in range(3):
            held = network.step(rows[:, inputs[t]], held * (inputs[t] != 0))[3]
            total -= network.log_prob(held, ids[t]).sum()
        return total / ids.size

    adam = {}
    network.learn(ids, state, before, adam)
    for name, value in network.w.items():
        place = tuple(np.unravel_index(int(np.abs(adam[name][0]).argmax()), value.shape))
        kept, step = value[place], 1e-5
        value[place] = kept + step
        up = loss()
        value[place] = kept - step
        down = loss()
        value[place] = kept
        assert adam[name][0][place] == pytest.approx(0.1 * (up - down) / (2 * step), rel=1e-3, abs=1e-7)


def plain_score(network, ids):
    """One text at a time and one token at a time, in double precision."""
    w, settings = {name: value.astype(float) for name, value in network.w.items()}, network.settings
    h, state, before, total = settings.hidden, np.zeros(settings.hidden), 0, 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    softmax = lambda x: np.exp(x) / np.exp(x).sum()
    for token in ids:
        row = w["embed"][before] @ w["to_gates"] + w["gate_bias"]
        gates = sigmoid(row[: 2 * h] + state @ w["from_state"])
        new = np.tanh(row[2 * h :] + (gates[:h] * state) @ w["to_new"])
        state = (1 - gates[h:]) * state + gates[h:] * new
        classes = softmax(state @ w["to_class"] + w["class_bias"])
        if token == 0:
            total += np.log(classes[0])
        elif token > settings.vocabulary:
            total += np.log(classes[network.word_classes + token - settings.vocabulary])
        else:
            own, word = divmod(token - 1, settings.class_words)
            total += np.log(classes[1 + own]) + np.log(softmax(state @ w["to_word"][own] + w["word_bias"][own])[word])
        before = token
    return total


@pytest.mark.parametrize("known", [40, 1 << 19])
def test_scores_are_those_of_a_plain_pass(awkward, known):
    model = lm_score.fitted(awkward, lm_score.Settings(**{**SMALL.__dict__, "vocabulary": 16, "known": known}))
    learnt, counts = Counter(), {}
    rows = [(row["doc_id"], row["text"]) for row in awkward.collect()]
    held = [zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0 for key, _ in rows]
    for (_, text), out in zip(rows, held):
        if not out:
            learnt.update(word.encode() for word in data.words_of(text))
    first = [word for word, _ in sorted(learnt.items(), key=lambda entry: (-entry[1], entry[0]))][:16]
    for word, n in learnt.items():
        if word not in first:
            shape = counts.setdefault(int(lm_score.shapes_of([word])[0]), [0, 0])
            shape[0], shape[1] = shape[0] + n, shape[1] + 1
    want = []
    for key, text in rows:
        words = [word.encode() for word in data.words_of(text)]
        ids = [1 + first.index(word) if word in first else 17 + int(lm_score.shapes_of([word])[0]) for word in words]
        total = plain_score(model.network, [*ids, 0]) / math.log(10)
        for word in words:
            if word not in first:
                n, distinct = counts.get(int(lm_score.shapes_of([word])[0]), (0, 0))
                total += math.log10((learnt[word] + 0.1) / (n + 0.1 * (distinct + 1)))
        want.append((key, total))
    got = [(row["doc_id"], row["score"]) for row in lm_score.apply(model).collect()]
    order = lambda entry: (entry[0] is not None, entry[0] or 0, entry[1])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [key for key, _ in got] == [key for key, _ in want]
    assert [score for _, score in got] == pytest.approx([score for _, score in want], rel=2e-4)


def test_scores_do_not_depend_on_the_batch():
    network = lm_score.Network.new(SMALL)
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 1 + SMALL.vocabulary + lm_score.SHAPES, size).astype(np.int32) for size in (1, 900, 7, 64, 65, 3)]
    together = network.score(texts)
    assert together == pytest.approx([network.score([text])[0] for text in texts], rel=1e-4)
    assert len(network.score([])) == 0
    assert together == pytest.approx([plain_score(network, text) for text in texts], rel=1e-4)


def test_stages(spark, testdata):
    """Each stage against a plain version, on what the stage before it kept."""
    folder = str(testdata / "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {row["doc_id"]: row for row in docs.collect()}
        result = scratch.keep(stage(spark, docs, folder), name)
        rows = result.collect()
        if name != "byte_bpe":
            assert result.columns == docs.columns
            assert all(row == before[row["doc_id"]] for row in rows)
        kept[name] = {row["doc_id"] for row in rows}
        if name == "quality_rules":
            judged = quality_rules.judged(docs).where("kept").collect()
            assert kept[name] == {row["doc_id"] for row in judged} and 0 < len(kept[name]) < len(before)
        if name == "language_id":
            assert len(kept[name]) > 0.95 * len(before)
        if name == "ngram_join":
            found = data.components([(key, row["text"]) for key, row in before.items()], 5, 80)
            assert kept[name] == {component for _, _, component in found} and len(kept[name]) < len(before)
        if name == "mixing":
            words = lambda keys: sum(len(data.words_of(before[key]["text"])) for key in keys)
            assert 0.85 * words(before) < words(kept[name]) < words(before)
        if name == "byte_bpe":
            table = byte_bpe.encoder(byte_bpe.serialized_ranks())[1]
            assert all(byte_bpe.decode_text(row["ids"], table) == before[row["doc_id"]]["text"] for row in rows)
            assert kept[name] == set(before) and all(row["n_tokens"] == len(row["ids"]) for row in rows)
        docs = result
    assert {row["doc_id"] for row in corpus_pipeline.run(spark, folder).collect()} == kept["byte_bpe"]
