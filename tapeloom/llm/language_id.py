"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log probabilities, one row for each bucket and one column for each language, of a
size that the parameters fix; executors get it as a broadcast and score batches with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import fresh, released, residue, slices

UNKNOWN = "und"
# Characters whose n-grams are counted at once; each takes some tens of bytes.
CHARS = 500_000


@dataclass(frozen=True)
class Settings:
    """``sample``: texts to learn from for each language, about that many, chosen by a hash of the id.

    ``buckets`` times languages is the size of the model; more than ``languages`` languages are an error.
    """

    orders: tuple[int, ...] = (2, 3)
    buckets: int = 1 << 16
    sample: int = 10_000
    smoothing: float = 0.5
    languages: int = 250
    # The evidence counts as that of this many n-grams at most, so that scores of long texts differ.
    evidence: float = 30.0


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray
    settings: Settings


def grams(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and for each the text it is from.

    Texts are in lower case, with a space before and after; n-grams are of code points.
    """
    padded = [f" {text.lower()} " for text in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(padded)), [len(text) for text in padded])
    buckets, owners = [], []
    for order in settings.orders:
        count = max(0, len(points) - order + 1)
        mixed = np.full(count, order, np.uint64)
        for i in range(order):
            mixed = (mixed ^ points[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        inside = owner[:count] == owner[order - 1 : order - 1 + count]
        buckets.append((mixed[inside] % np.uint64(settings.buckets)).astype(np.int64))
        owners.append(owner[:count][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def train(docs: DataFrame, settings: Settings = Settings(), learn_from: Column | None = None) -> Model:
    """Learn from the texts and labels of ``docs`` where ``learn_from`` holds.

    Rows without text or lang teach nothing. With no rows to learn from the model knows no language.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    usable = usable.where(learn_from) if learn_from is not None else usable
    usable = usable.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    totals = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(settings.languages + 1)
    found = {row["lang"]: row["n"] for row in totals.collect()}
    if len(found) > settings.languages:
        raise ValueError(f"more than {settings.languages} languages")
    languages = list(found)
    total = np.array(list(found.values()), float)
    if not languages:
        return Model([], np.zeros(0), np.zeros((settings.buckets, 0), np.float32), settings)

    draw = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 20)) / float(1 << 20)
    shares = [F.when(F.col("lang") == name, F.lit(settings.sample / n)) for name, n in found.items()]
    learned = usable.where(draw < F.coalesce(*shares))
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(place), settings.buckets), np.int64)
        for part in slices(batches, chars=CHARS):
            buckets, owner = grams(part.column("text").to_pylist(), settings)
            which = np.array([place[name] for name in part.column("lang").to_pylist()], np.int64)
            counts += np.bincount(which[owner] * settings.buckets + buckets, minlength=counts.size).reshape(counts.shape)
        for i in np.flatnonzero(counts.any(axis=1)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(i)], pa.int32()), pa.array([counts[i].tobytes()], pa.binary())], ["language", "counts"]
            )

    # The sample is bounded, so a fixed number of tasks counts it and the driver gets that many tables.
    tables = learned.select("text", "lang").repartition(8).mapInArrow(count, "language int, counts binary")
    counts = np.zeros((len(languages), settings.buckets))
    for row in tables.toLocalIterator():
        counts[row["language"]] += np.frombuffer(row["counts"], np.int64)
    smooth = counts + settings.smoothing
    log_prob = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
    return Model(languages, np.log(total / total.sum()), np.ascontiguousarray(log_prob), settings)


def score(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; ``und`` and 0 for a text that is None or has no letter."""
    settings, names = model.settings, model.languages
    held = [text or "" for text in texts]
    lettered = np.array([any(map(str.isalpha, text)) for text in held], bool)
    if not names:
        return [UNKNOWN] * len(held), np.zeros(len(held))
    buckets, owner = grams(held, settings)
    sums = np.zeros((len(held), len(names)))
    for i in range(len(names)):
        sums[:, i] = np.bincount(owner, model.log_prob[:, i][buckets], len(held))
    number = np.maximum(np.bincount(owner, minlength=len(held)), 1)
    total = sums + model.log_prior
    best = total.argmax(axis=1)
    tempered = total * np.minimum(1, settings.evidence / number)[:, None]
    likely = np.exp(tempered - tempered.max(axis=1, keepdims=True))
    share = likely[np.arange(len(held)), best] / likely.sum(axis=1)
    picked = [names[i] if ok else UNKNOWN for i, ok in zip(best, lettered)]
    return picked, np.where(lettered, share, 0.0)


def with_language(docs: DataFrame, model: Model, lang: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, 0 to 1; columns of those names are replaced.

    Only the text is looked at. Rows stay in their partitions.
    """
    kept = [name for name in docs.columns if name.lower() not in (lang.lower(), score_name.lower())]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = fresh(kept, "_read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with released():
            for part in slices(batches, read, CHARS):
                names, shares = score(part.column(read).to_pylist(), shared.value)
                rest = [part.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(names), pa.array(shares)], [*kept, lang, score_name])

    rows = docs.select(*[F.col(f"`{name}`") for name in kept], F.col("text").cast("string").alias(read))
    schema = docs.select(*[F.col(f"`{name}`") for name in kept]).schema
    return rows.mapInArrow(run, schema.add(lang, "string").add(score_name, "double"))


def predicted(docs: DataFrame, settings: Settings = Settings(), hold_out: int = 2, modulus: int = 4) -> DataFrame:
    """Learn from all but one fold of ``docs`` and predict every row: doc_id, held_out, lang_pred, score."""
    fold = residue("doc_id", modulus)
    model = train(docs, settings, fold != hold_out)
    rows = docs.select("doc_id", (fold == hold_out).alias("held_out"), "text")
    return with_language(rows, model).drop("text")


def known_documents(docs: DataFrame, settings: Settings = Settings(), least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least``, with their own columns."""
    model = train(docs, settings)
    lang, share = fresh(docs.columns, "_lang_pred"), fresh(docs.columns, "_lang_score")
    rows = with_language(docs, model, lang, share).where((F.col(lang) != UNKNOWN) & (F.col(share) >= least))
    return rows.select(*[F.col(f"`{name}`") for name in docs.columns])
