"""Document log-likelihood under a gated recurrent language model with a class-factored softmax.

Words that are frequent in the training documents are in the vocabulary and have a class each belongs to; all
other words belong to classes by their shape. The network gives each token's class, and the word within its
class for the vocabulary; within a shape class a word has its share of the training counts. The counts cover
all training documents and are joined to the texts, never sent whole to a task.

Texts become arrays of small numbers once, in a written table that training and scoring read. The network is
trained in numpy by truncated backpropagation, on tasks that each start from the last round's mean and learn
from their own documents, laid back to back in lanes of equal length. In scoring its state goes on from window
to window to the end of a document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.llm.common import id_and_text, residue, slices

# Shapes of words outside the vocabulary: eight lengths, each with and without a character that is no letter.
SHAPES = 16
SMOOTHING = 0.1
# Words that a task remembers.
REMEMBERED = 300_000
# Rows of a softmax at once, few enough to stay in a core's cache.
ROWS = 4096
_LOG10 = np.float64(np.log(10))


@dataclass(frozen=True)
class Settings:
    """``vocabulary`` words in classes of ``class_words``; ``hidden`` is the size of state and embedding.

    ``window`` tokens of each of ``lanes`` lanes are one step of backpropagation. Training documents are dealt
    into ``rounds`` parts, and each round learns from one of them, so that every document is learnt from
    once. A task holds up to about ``held`` tokens at a time. ``known`` bounds the table of frequent words.
    """

    vocabulary: int = 2048
    class_words: int = 32
    hidden: int = 16
    window: int = 16
    rounds: int = 4
    lanes: int = 1024
    held: int = 4_000_000
    rate: float = 0.01
    seed: int = 7
    known: int = 1 << 19

    def __post_init__(self) -> None:
        if 1 + self.vocabulary + SHAPES > 1 << 16:
            raise ValueError("ids are two bytes each, so the vocabulary is smaller")


def tokens_of(text: str | None) -> list[bytes]:
    """Words, A-Z in lower case; white space is space and \\t to \\r."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_keys(words: list[bytes]) -> np.ndarray:
    """64 bits that stand for each word in joins, signed."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def shapes_of(words: list[bytes]) -> np.ndarray:
    """The shape of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.fromiter(map(bytes.isalpha, words), np.int64, len(words))
    return 2 * np.minimum(7, (lengths - 1) // 2) + 1 - letters


def _sigmoid(values: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place; far below 0 it is 0."""
    np.negative(values, out=values)
    with np.errstate(over="ignore"):
        np.exp(values, out=values)
    values += 1
    return np.reciprocal(values, out=values)


def _small(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no logit of a state can leave -60 to 60, as states are within -1 to 1.

    Then all exponentials fit in a float, and no sum of them is 0.
    """
    return bool((np.abs(weights).sum(axis=-2) + np.abs(bias)).max(initial=0) < 60)


def _exponentials(logits: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray | float]:
    """The sum of each column's exponentials, which take the place of ``logits``, and what was taken off before."""
    top = 0.0
    if not small:
        top = logits.max(axis=0)
        logits -= top
    return np.exp(logits, out=logits).sum(axis=0), top


def _log_softmax_at(logits: np.ndarray, chosen: np.ndarray, small: bool) -> np.ndarray:
    """The logarithm of the softmax of each column in the row ``chosen``; ``logits`` are used up."""
    own = logits[chosen, np.arange(len(chosen))].astype(np.float64)
    sums, top = _exponentials(logits, small)
    return own - np.log(sums) - top


def _softmax_less(logits: np.ndarray, chosen: np.ndarray, small: bool) -> np.ndarray:
    """The softmax of each column, in place, less 1 in the row ``chosen``."""
    sums, _ = _exponentials(logits, small)
    logits *= 1 / sums
    logits[chosen, np.arange(len(chosen))] -= 1
    return logits


class Network:
    """Weights by name, and the passes over them. Classes: the end, the vocabulary's, then the shapes."""

    def __init__(self, weights: dict[str, np.ndarray], settings: Settings):
        self.w, self.settings = weights, settings
        self.word_classes = -(-settings.vocabulary // settings.class_words)
        self.classes = 1 + self.word_classes + SHAPES

    @staticmethod
    def new(settings: Settings) -> Network:
        draw = np.random.default_rng(settings.seed)
        word_classes = -(-settings.vocabulary // settings.class_words)
        h, inputs, classes = settings.hidden, 1 + settings.vocabulary + SHAPES, 1 + word_classes + SHAPES
        shapes = {
            "embed": (inputs, h), "to_gates": (h, 3 * h), "from_state": (h, 2 * h), "to_new": (h, h), "gate_bias": (3 * h,),
            "to_class": (h, classes), "class_bias": (classes,),
            "to_word": (word_classes, h, settings.class_words), "word_bias": (word_classes, settings.class_words),
        }
        weights = {
            name: np.zeros(shape, np.float32) if "bias" in name else (draw.standard_normal(shape) * 0.15).astype(np.float32)
            for name, shape in shapes.items()
        }
        return Network(weights, settings)

    def start_from(self, ends: int, words: list[int], shapes: list[int]) -> Network:
        """Biases that give each class, and each word in its class, its share of the training counts."""
        counts = np.zeros(self.word_classes * self.settings.class_words)
        counts[: len(words)] = words
        counts = counts.reshape(self.w["word_bias"].shape)
        self.w["word_bias"][:] = np.log(counts + SMOOTHING)
        self.w["class_bias"][:] = np.log(np.concatenate([[ends], counts.sum(axis=1), shapes]) + SMOOTHING)
        return self

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        """Ids: 0 the end, then the vocabulary, then shapes."""
        vocabulary, size = self.settings.vocabulary, self.settings.class_words
        shape = ids - vocabulary + self.word_classes
        return np.where(ids == 0, 0, np.where(ids <= vocabulary, 1 + (ids - 1) // size, shape))

    # States, gates and logits have a column for each text: numpy then works along many texts at once.

    def step(self, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """One token further: reset and update gate, candidate and new state. ``inputs``: columns of the gates."""
        h = self.settings.hidden
        gates = _sigmoid(self.w["from_state"].T @ state + inputs[: 2 * h])
        reset, update = gates[:h], gates[h:]
        new = _sigmoid(2 * (self.w["to_new"].T @ (reset * state) + inputs[2 * h :]))  # tanh, by way of exp
        new *= 2
        new -= 1
        return reset, update, new, state + update * (new - state)

    def class_logits(self, states: np.ndarray) -> np.ndarray:
        logits = self.w["to_class"].T @ states
        logits += self.w["class_bias"][:, None]
        return logits

    def word_logits(self, states: np.ndarray, word_class: int) -> np.ndarray:
        logits = self.w["to_word"][word_class].T @ states
        logits += self.w["word_bias"][word_class][:, None]
        return logits

    def _by_class(self, ids: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """Places of ids in the vocabulary, in order of class, and each class with where it stands there."""
        inside = np.flatnonzero((ids > 0) & (ids <= self.settings.vocabulary))
        order = inside[np.argsort(classes[inside].astype(np.uint16), kind="stable")]
        cuts = [0, *(np.flatnonzero(np.diff(classes[order])) + 1).tolist(), len(order)]
        spans = [slice(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        return order, [(int(classes[order[span.start]]) - 1, span) for span in spans]

    def small_logits(self) -> tuple[bool, bool]:
        """Whether the logits of classes, and of words, are small for any state."""
        return _small(self.w["to_class"], self.w["class_bias"]), _small(self.w["to_word"], self.w["word_bias"])

    def log_prob(self, states: np.ndarray, ids: np.ndarray, small: tuple[bool, bool] | None = None) -> np.ndarray:
        """Natural logarithm of each id's class, and of the word in it for the vocabulary."""
        small = small or self.small_logits()
        classes, found = self.class_of(ids), np.empty(len(ids))
        for at in range(0, len(ids), ROWS):
            part = slice(at, at + ROWS)
            found[part] = _log_softmax_at(self.class_logits(np.ascontiguousarray(states[:, part])), classes[part], small[0])
        order, spans = self._by_class(ids, classes)
        held, words, inside = np.take(states, order, axis=1), (ids[order] - 1) % self.settings.class_words, np.empty(len(order))
        for own, span in spans:
            inside[span] = _log_softmax_at(self.word_logits(held[:, span], own), words[span], small[1])
        found[order] += inside
        return found

    def input_rows(self) -> np.ndarray:
        """What each input adds to the gates, in columns."""
        return np.ascontiguousarray((self.w["embed"] @ self.w["to_gates"] + self.w["gate_bias"]).T)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood of whole id sequences; the network reads the token before, at first the end."""
        order = np.argsort([-len(ids) for ids in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        total = np.zeros(len(texts))
        state = np.zeros((self.settings.hidden, len(texts)), np.float32)
        rows, window, small = self.input_rows(), self.settings.window, self.small_logits()
        falling = -lengths
        flat = np.concatenate([texts[i] for i in order]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
        heads = np.cumsum(lengths) - lengths
        at = 0
        while at < (lengths[0] if len(lengths) else 0):
            most = at
            states, wanted, owners = [], [], []
            # As many steps at once as keep the states that wait for the softmax few.
            active = int(np.searchsorted(falling, -at, side="left"))
            for step in range(at, min(at + max(1, min(window, 65536 // active), ROWS // active), int(lengths[0]))):
                active = int(np.searchsorted(falling, -step, side="left"))
                before = flat[heads[:active] + step - 1] if step else np.zeros(active, np.int64)
                state[:, :active] = self.step(np.take(rows, before, axis=1), state[:, :active])[3]
                states.append(state[:, :active].copy())
                wanted.append(flat[heads[:active] + step])
                owners.append(np.arange(active))
                most = step + 1
            found = self.log_prob(np.concatenate(states, axis=1), np.concatenate(wanted), small)
            total += np.bincount(np.concatenate(owners), found, len(texts))
            at = most
        result = np.zeros(len(texts))
        result[order] = total
        return result

    def learn(self, ids: np.ndarray, state: np.ndarray, before: np.ndarray, adam: dict) -> np.ndarray:
        """One step of truncated backpropagation over a window, ids of (window, lanes).

        Returns the state after it. ``before`` is the token in front of the window. After the end of a
        document the next one starts from no state.
        """
        w, h = self.w, self.settings.hidden
        window, lanes = ids.shape
        inputs = np.vstack([before[None], ids[:-1]])
        used, place = np.unique(inputs, return_inverse=True)
        place = place.ravel()
        embedded = w["embed"][used]
        rows = np.take(np.ascontiguousarray((embedded @ w["to_gates"] + w["gate_bias"]).T), place, axis=1)
        goes_on = (inputs != 0).astype(state.dtype)
        trace, states = [], np.empty((h, window * lanes), state.dtype)
        for t in range(window):
            own = slice(t * lanes, (t + 1) * lanes)
            old = state * goes_on[t]
            reset, update, new, state = self.step(rows[:, own], old)
            trace.append((old, reset, update, new))
            states[:, own] = state

        flat_ids, count, small = ids.ravel(), ids.size, self.small_logits()
        grads = {name: np.zeros_like(w[name]) for name in ("to_word", "word_bias", "to_new", "from_state", "embed")}
        classes = self.class_of(flat_ids)
        back = np.empty_like(states)
        grads["to_class"], grads["class_bias"] = np.zeros_like(w["to_class"]), np.zeros_like(w["class_bias"])
        for at in range(0, count, ROWS):
            some = slice(at, at + ROWS)
            held = np.ascontiguousarray(states[:, some])
            out = _softmax_less(self.class_logits(held), classes[some], small[0])
            grads["to_class"] += held @ out.T
            grads["class_bias"] += out.sum(axis=1)
            back[:, some] = w["to_class"] @ out
        order, spans = self._by_class(flat_ids, classes)
        held, words = np.take(states, order, axis=1), (flat_ids[order] - 1) % self.settings.class_words
        through = np.empty_like(held)
        for own, span in spans:
            word = _softmax_less(self.word_logits(held[:, span], own), words[span], small[1])
            grads["to_word"][own] = held[:, span] @ word.T
            grads["word_bias"][own] = word.sum(axis=1)
            through[:, span] = w["to_word"][own] @ word
        back[:, order] += through

        d_rows = np.empty_like(rows)
        carried = np.zeros((h, lanes), state.dtype)
        for t in reversed(range(window)):
            own = slice(t * lanes, (t + 1) * lanes)
            old, reset, update, new = trace[t]
            through = back[:, own] + carried
            d_new = through * update
            past = through - d_new
            d_new *= 1 - new * new
            mixed, d_mixed = reset * old, w["to_new"] @ d_new
            d_mixed *= reset
            d_gates = d_rows[: 2 * h, own]
            d_gates[:h] = d_mixed * (old - mixed)
            d_gates[h:] = past * (states[:, own] - old)  # the state less the one before is update * (new - old)
            d_rows[2 * h :, own] = d_new
            grads["to_new"] += mixed @ d_new.T
            grads["from_state"] += old @ d_gates.T
            carried = past + d_mixed
            carried += w["from_state"] @ d_gates
            carried *= goes_on[t]
        # Gradients of the rows are added up for each input that was met; only those embeddings move.
        order = np.argsort(place.astype(np.uint16), kind="stable")
        heads = np.searchsorted(place[order], np.arange(len(used)))
        d_used = np.add.reduceat(np.take(d_rows, order, axis=1), heads, axis=1)
        grads["gate_bias"] = d_used.sum(axis=1)
        grads["to_gates"] = (d_used @ embedded).T
        grads["embed"][used] = (w["to_gates"] @ d_used).T

        adam["t"] = adam.get("t", 0) + 1
        scale = self.settings.rate * (1 - 0.99 ** adam["t"]) ** 0.5 / (1 - 0.9 ** adam["t"])
        for name, grad in grads.items():
            grad /= count
            np.clip(grad, -1, 1, out=grad)
            first, second = adam.setdefault(name, (np.zeros_like(grad), np.zeros_like(grad)))
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            w[name] -= scale * first / (np.sqrt(second) + 1e-8)
        return state

    def train(self, flat: np.ndarray, adam: dict) -> None:
        """Learn from documents laid back to back, each with its end.

        They are cut into lanes of about equal length, so that every step has all lanes to work on. A lane
        that begins inside a document knows its last token, but starts from no state there.
        """
        lanes = max(1, min(self.settings.lanes, len(flat) // self.settings.window))
        bounds = np.arange(lanes + 1) * len(flat) // lanes
        starts, size = bounds[:-1], len(flat) // lanes
        before = np.where(starts > 0, flat[starts - 1], 0).astype(np.int64)
        state = np.zeros((self.settings.hidden, lanes), np.float32)
        for at in range(0, size, self.settings.window):
            places = starts + np.arange(at, min(at + self.settings.window, size))[:, None]
            ids = flat[places].astype(np.int64)
            state = self.learn(ids, state, before, adam)
            before = ids[-1]
        longer = np.flatnonzero(np.diff(bounds) > size)  # by one token
        if len(longer):
            self.learn(flat[starts[longer] + size].astype(np.int64)[None], state[:, longer], before[longer], adam)

    def packed(self) -> bytes:
        return np.concatenate([self.w[name].ravel() for name in sorted(self.w)]).tobytes()

    def unpacked(self, data: np.ndarray) -> Network:
        weights, at = {}, 0
        for name in sorted(self.w):
            size = self.w[name].size
            weights[name] = data[at : at + size].reshape(self.w[name].shape).astype(np.float32)
            at += size
        return Network(weights, self.settings)


def word_counts(docs: DataFrame, learn: str) -> DataFrame:
    """word_key, word, shape and count of every distinct word in rows where ``learn`` holds.

    Each task counts its own words first, in stretches of bounded size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = list(counts)
            arrays = [
                pa.array(word_keys(words)), pa.array(words, pa.binary()),
                pa.array(shapes_of(words).astype(np.int32)), pa.array(list(counts.values()), pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["word_key", "word", "shape", "n"])

        for part in slices(batches):
            for text in part.column("text").to_pylist():
                counts.update(tokens_of(text))
            if len(counts) > 500_000:
                yield flush()
                counts.clear()
        yield flush()

    rows = docs.where(learn).select("text").mapInArrow(count, "word_key bigint, word binary, shape int, n bigint")
    return rows.groupBy("word_key", "word", "shape").agg(F.sum("n").alias("n"))


def train(sequences: DataFrame, network: Network) -> Network:
    """Rounds of training on all tasks at once; the mean of their weights, by tokens, starts the next.

    ``sequences`` has ``row``, ``turn`` and ``ids``, a document's ids in two bytes each.
    """
    settings = network.settings
    spark = sequences.sparkSession
    for turn in range(settings.rounds):
        shared = spark.sparkContext.broadcast(network.packed())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Network.new(settings).unpacked(np.frombuffer(shared.value, np.float32))
            adam, tokens, held, waiting = {}, 0, [], 0
            for batch in batches:
                for data in batch.column("ids").to_pylist():
                    held.append(np.frombuffer(data, np.uint16))
                    waiting += len(held[-1])
                    if waiting >= settings.held:
                        own.train(np.concatenate(held), adam)
                        tokens, held, waiting = tokens + waiting, [], 0
            if waiting:
                own.train(np.concatenate(held), adam)
                tokens += waiting
            if tokens:
                sums = np.frombuffer(own.packed(), np.float32) * np.float64(tokens)
                yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([sums.tobytes()], pa.binary())], ["tokens", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, sums = 0, None
            for batch in batches:
                for n, data in zip(batch.column("tokens").to_pylist(), batch.column("sums").to_pylist()):
                    one = np.frombuffer(data, np.float64)
                    tokens, sums = tokens + n, one if sums is None else sums + one
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([sums.tobytes()], pa.binary())], ["tokens", "sums"])

        schema = "tokens bigint, sums binary"
        parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        chosen = sequences.where(F.col("turn") == turn).repartition(parts, "row").select("ids")
        trained = chosen.mapInArrow(run, schema)
        # Sums of about as many tables as tasks, in two steps: no task and not the driver gets all of them.
        merged = trained.repartition(max(1, int(parts**0.5))).mapInArrow(add, schema)
        tokens, sums = 0, None
        for row in merged.toLocalIterator():
            one = np.frombuffer(row["sums"], np.float64)
            tokens, sums = tokens + row["tokens"], one if sums is None else sums + one
        shared.unpersist()
        if tokens:
            network = network.unpacked(sums / tokens)
    return network


@dataclass(frozen=True)
class Counts:
    """What the training documents hold, as far as a task needs it.

    ``place``: frequent words by their number, the most frequent first; ``log``: log10 of their counts with
    0.1 added; ``shape`` of each. ``tail``: log10 of what a count of a word outside the vocabulary is
    divided by, for each shape. ``ends`` is the number of training documents.
    """

    place: dict[bytes, int]
    log: np.ndarray
    shape: np.ndarray
    tail: np.ndarray
    ends: int
    total: int
    floor: float



class _Seen(dict):
    """Numbers of the words that a task has met: those of frequent words, and from -1 down those of others."""

    def __init__(self, place: dict[bytes, int]):
        super().__init__()
        self.place, self.rare = place, []
        self.shapes, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self.place.get(word)
        if number is None:
            self.rare.append(word)
            number = -len(self.rare)
        self[word] = number
        return number

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each word, and the shapes and keys of all others met, the last one first."""
        if len(self) > REMEMBERED:
            self.clear()
            self.rare.clear()
            self.shapes, self.keys = self.shapes[:0], self.keys[:0]
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        new = self.rare[len(self.keys) :]
        self.shapes, self.keys = np.concatenate([self.shapes, shapes_of(new)]), np.concatenate([self.keys, word_keys(new)])
        return found, self.shapes[::-1], self.keys[::-1]


def counted(counts: DataFrame, ends: int, settings: Settings) -> tuple[Counts, Network]:
    """The counts of words, a written table, as tasks need them, and a network that starts from them."""
    sums = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    total, distinct = sum(row["n"] for row in sums) + ends, sum(row["words"] for row in sums) + bool(ends)
    # Fewer than ``known`` words can each have more than one in ``known`` tokens.
    often = counts.where(F.col("n") * settings.known > total).select("word", "shape", "n").collect()
    table = sorted(often, key=lambda row: (-row["n"], bytes(row["word"])))
    # Words in the vocabulary are no longer words of their shape.
    tail, words = np.zeros(SHAPES), np.zeros(SHAPES)
    for row in sums:
        tail[row["shape"]], words[row["shape"]] = row["n"], row["words"]
    for row in table[: settings.vocabulary]:
        tail[row["shape"]] -= row["n"]
        words[row["shape"]] -= 1
    numbers = np.array([row["n"] for row in table], np.float64)
    shared = Counts(
        {bytes(row["word"]): i for i, row in enumerate(table)}, np.log10(numbers + SMOOTHING),
        np.array([row["shape"] for row in table], np.int64), np.log10(tail + SMOOTHING * (words + 1)),
        ends, total, float(np.log10(total + SMOOTHING * (distinct + 1))),
    )
    first = [row["n"] for row in table[: settings.vocabulary]]
    return shared, Network.new(settings).start_from(ends, first, tail.tolist())


def encoded(rows: DataFrame, shared, settings: Settings) -> DataFrame:
    """A written table of all rows with their ids, and what the counts alone say of them.

    ``base`` and ``inside`` are sums of log10 over frequent words: of their share of all tokens, and, outside the
    vocabulary, of their share of their shape. Words that are not frequent are listed by key, and how often.
    """
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inside", "keys", "times", "ids", "turn"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counts = shared.value
        end, seen, vocabulary = float(np.log10(counts.ends + SMOOTHING)), _Seen(counts.place), settings.vocabulary
        for part in slices(batches):
            each = [tokens_of(text) for text in part.column("text").to_pylist()]
            sizes = np.array([len(words) for words in each], np.int64)
            words = list(chain.from_iterable(each))
            owner = np.repeat(np.arange(len(each)), sizes)
            place, other_shapes, other_keys = seen.numbers(words)
            # Places from the end of these tables are those of words that are not frequent.
            shape = np.concatenate([counts.shape, other_shapes])[place]
            log = np.concatenate([counts.log, np.zeros(len(other_keys))])[place]
            known, outside = place >= 0, (place < 0) | (place >= vocabulary)
            ids = np.where(outside, 1 + vocabulary + shape, place + 1)

            def per_row(values: np.ndarray) -> np.ndarray:
                return np.bincount(owner, values, len(each))

            inside = per_row(np.where(outside, log - counts.tail[shape], 0))
            base = per_row(log) + end - (sizes + 1) * counts.floor
            rare = np.flatnonzero(~known)
            keys = other_keys[place[rare]]
            order = np.lexsort((keys, owner[rare]))
            keys, owners = keys[order], owner[rare][order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])) if len(keys) else rare
            times = np.diff(np.concatenate([first, [len(keys)]]))
            ends = np.concatenate([[0], np.cumsum(np.bincount(owners[first], minlength=len(each)))]).astype(np.int32)
            bounds = np.cumsum(sizes) - sizes
            whole = ids.astype(np.uint16)
            sequences = [
                np.append(whole[a : a + n], np.uint16(0)).tobytes() for a, n in zip(bounds.tolist(), sizes.tolist())
            ]
            arrays = [
                part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(sizes + 1),
                pa.array(per_row(known.astype(float)).astype(np.int64) + (1 if counts.ends else 0)), pa.array(base), pa.array(inside),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[first])),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
                pa.array(sequences, pa.binary()), part.column("turn"),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, inside double, "
        "keys array<bigint>, times array<int>, ids binary, turn int"
    )
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("turn", F.pmod(F.xxhash64("row"), F.lit(settings.rounds)).cast("int"))
    return scratch.keep(dealt.select("row", "doc_id", "text", "held_out", "turn").mapInArrow(run, schema), "sequences")


@dataclass(frozen=True)
class Fitted:
    """A trained model, the counts it goes with, of all words, and the documents as ids."""

    network: Network
    counts: Counts
    words: DataFrame
    sequences: DataFrame


def fitted(docs: DataFrame, settings: Settings = Settings(), hold_out: int = 0, modulus: int = 10) -> Fitted:
    """Learn from all but one fold of ``docs``."""
    rows = id_and_text(docs).withColumn("held_out", residue("doc_id", modulus) == hold_out)
    words = scratch.keep(word_counts(rows, "not held_out"), "words")
    counts, network = counted(words, rows.where("not held_out").count(), settings)
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    sequences = encoded(rows, shared, settings)
    shared.unpersist()
    return Fitted(train(sequences.where("not held_out").select("row", "turn", "ids"), network), counts, words, sequences)


def scored(docs: DataFrame, settings: Settings = Settings(), hold_out: int = 0, modulus: int = 10) -> DataFrame:
    """Base and model score of every whole text, learning from all but one fold.

    doc_id, held_out, n_tokens (words and one end), n_known (tokens the training documents have),
    train_tokens, base_score (log10, unigram with 0.1 added to each count) and score (log10 of the model's
    probability). A NULL text counts as empty: one end. NULL ids are the empty text to the hash; repeated
    rows stay, a row each. Without training documents all counts are 0 and the network is as it was drawn.

    Frequent words, each over one in ``settings.known`` tokens, are scored where the text is read, from a
    table that can have no more words than that. The others go by word to the counts and come back as one
    sum for each row; none of them has many rows.
    """
    return apply(fitted(docs, settings, hold_out, modulus))


def apply(model: Fitted) -> DataFrame:
    """The scores of the documents that ``model`` has as ids."""
    settings = model.network.settings
    local = model.sequences
    shared = local.sparkSession.sparkContext.broadcast(model.network.packed())
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.new(settings).unpacked(np.frombuffer(shared.value, np.float32))
        for part in batches:  # whole batches: the more documents side by side, the fewer steps
            likely = network.score([np.frombuffer(data, np.uint16) for data in part.column("ids").to_pylist()]) / _LOG10
            own = part.column("inside").to_numpy() + likely
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in names[:-1]), pa.array(own)], names)

    schema = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
    likely = local.select(*names[:-1], "inside", "ids").mapInArrow(run, schema)
    rare = local.select("row", F.explode(F.arrays_zip("keys", "times")).alias("entry"))
    rare = rare.select("row", F.col("entry.keys").alias("word_key"), F.col("entry.times").alias("times"))
    met = rare.join(model.words.groupBy("word_key").agg(F.sum("n").alias("n")), "word_key", "left")
    seen = F.coalesce("n", F.lit(0))
    back = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(seen + F.lit(SMOOTHING))).alias("log"),
        F.sum(F.when(seen > 0, F.col("times").cast("bigint")).otherwise(F.lit(0))).alias("known"),
    )
    joined = likely.join(back, "row", "left")
    log = F.coalesce("log", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.counts.total).cast("bigint").alias("train_tokens"), (F.col("base") + log).alias("base_score"),
        (F.col("score") + log).alias("score"),
    )
