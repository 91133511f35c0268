"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Every word of a text is predicted from the ``REACH`` words on both its sides, and the
logs of these conditional probabilities are summed. The most frequent words are classes
of their own, all others fall into classes by their hash and are predicted on: digit by
digit of the hash, each digit from the words around, given the digits before it. What a
digit has by itself is its share of the corpus after those digits, counted over all words,
so words of all frequencies are told by their surroundings, and without any surroundings
each has its share of the corpus. Words that agree in all digits share the rest by their
counts.

Word counts cover all texts: tasks count, Spark adds up. The network is trained on all
texts too: in each round every task starts from the same weights, runs once over its
partition in minibatches, and the tasks' weights are averaged by their numbers of words
(a grouped sum over weights, so nothing but the average comes to the driver, whose size
is that of the network). Every counted word has its own share of its digits: those of
the ``KEPT_WORDS`` most frequent words are broadcast, the counts of the words beyond stay in
Spark and are joined to the texts' rarer words. The shares of digits are a table of about
``LEAVES`` numbers, whatever the corpus.

Defined results: a null or empty text has no words, a log-probability of 0 and a null
mean; a corpus without words gives an untrained network, and no word is scored;
repeated rows count each time and are scored one by one; a null id is an id; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.store import Store, small_batches
from cohortline.llm.textscan import LOWER, NOT_SPACE, Block, SpanHash, blocks

REACH = 2
OWN_CLASSES = 64
HASHED_CLASSES = 32
OWN_INPUTS = 512
HASHED_INPUTS = 512
WIDTH = 12
KEPT_WORDS = 50_000
ROUNDS = 2
MINIBATCH = 4_096
RATE = 0.1
# Distinct words counted in a task before it hands them on.
COUNTED_AT_ONCE = 1 << 20

# Digits of a hash after its class, and the values of each.
DIGITS = 4
BASE = 16

CLASSES = OWN_CLASSES + HASHED_CLASSES
LEAVES = HASHED_CLASSES * BASE**DIGITS
INPUTS = OWN_INPUTS + HASHED_INPUTS
OFFSETS = [k for k in range(-REACH, REACH + 1) if k]
# Row INPUTS stands for what lies beyond a text's ends.
SHAPES = {
    "words": (INPUTS + 1, WIDTH),
    "places": (len(OFFSETS), WIDTH),
    "bias": (WIDTH,),
    "out": (WIDTH, CLASSES),
    "out_bias": (CLASSES,),
    "digits": (WIDTH, DIGITS * BASE),
}
SIZE = sum(int(np.prod(shape)) for shape in SHAPES.values())


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a block, and each text's first word."""
    starts, ends = block.runs(NOT_SPACE)
    return SpanHash(block.data, LOWER)(starts, ends).view(np.int64), np.searchsorted(starts, block.offsets)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> pa.RecordBatch:
        words, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "n"])

    for batch in batches:
        for block in blocks(batch.column("text")):
            held.append(np.unique(words_of(block)[0], return_counts=True))
            if sum(len(words) for words, _ in held) > COUNTED_AT_ONCE:
                yield merged()
    if held:
        yield merged()


@dataclass
class Vocabulary:
    """The kept words, sorted by hash, with their class, input and log share of their class or last digit.

    ``rest_shares`` are, by class, the log shares of a word beyond them without the log of
    its count, which is 0 for a word seen once, and without those of its digits. ``digits``
    has a row for each class and digits before a digit (``paths``): the shares of its values.
    """

    words: np.ndarray
    classes: np.ndarray
    inputs: np.ndarray
    shares: np.ndarray
    rest_shares: np.ndarray
    digits: np.ndarray
    directory: np.ndarray | None = None

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class, input and log share of each word, and whether it is beyond the kept ones."""
        hashed = words.view(np.uint64)
        classes = OWN_CLASSES + (hashed % np.uint64(HASHED_CLASSES)).astype(np.int64)
        inputs = OWN_INPUTS + ((hashed >> np.uint64(20)) % np.uint64(HASHED_INPUTS)).astype(np.int64)
        shares, beyond = self.rest_shares[classes], np.ones(len(words), bool)
        if len(self.words):
            # Words are sorted by hash; a directory of their top bits leaves a step or two of search.
            if self.directory is None:
                tops = (self.words >> 48) + (1 << 15)
                self.directory = np.searchsorted(tops, np.arange((1 << 16) + 1))
            top = (words >> 48) + (1 << 15)
            at, end = self.directory[top], self.directory[top + 1]
            open_ = np.flatnonzero(at < end)
            while len(open_):
                found = self.words[at[open_]] == words[open_]
                hit, place = open_[found], at[open_[found]]
                classes[hit], inputs[hit], shares[hit] = self.classes[place], self.inputs[place], self.shares[place]
                beyond[hit] = False
                open_ = open_[~found]
                at[open_] += 1
                open_ = open_[at[open_] < end[open_]]
        return classes, inputs, shares, beyond


def paths(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each digit of each word, the row of ``Vocabulary.digits`` of what is before it, and its value."""
    hashed = words.view(np.uint64)
    before = (hashed % np.uint64(HASHED_CLASSES)).astype(np.int64)
    left = (hashed // np.uint64(HASHED_CLASSES) % np.uint64(BASE**DIGITS)).astype(np.int64)
    rows, values = np.empty((len(words), DIGITS), np.int64), np.empty((len(words), DIGITS), np.int64)
    first = 0
    for k in range(DIGITS):
        rows[:, k] = first + before
        values[:, k] = left % BASE
        left //= BASE
        first += HASHED_CLASSES * BASE**k
        before = before * BASE + values[:, k]
    return rows, values


def digit_shares(leaves: np.ndarray) -> np.ndarray:
    """Rows of ``Vocabulary.digits`` from the counts of words by the rest of their hash by ``LEAVES``."""
    # Of that rest, the class is what counts least, then the first digit.
    by_path = leaves.reshape([BASE] * DIGITS + [HASHED_CLASSES]).transpose(range(DIGITS, -1, -1))
    levels = []
    for k in range(1, DIGITS + 1):
        level = by_path.sum(tuple(range(k + 1, DIGITS + 1))).reshape(-1, BASE)
        levels.append(level / np.maximum(level.sum(1, keepdims=True), 1))
    return np.concatenate(levels).astype(np.float32)


def vocabulary(documents: DataFrame, store: Store) -> tuple[Vocabulary, DataFrame]:
    """The kept words, and word, n of all words."""
    counts = documents.select("text").mapInArrow(_count, "word bigint, n bigint")
    counts = store.write(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # At most KEPT_WORDS rows of two numbers.
    top = counts.orderBy(F.desc("n"), "word").limit(KEPT_WORDS).toArrow()
    words, n = top["word"].to_numpy(), top["n"].to_numpy().astype(float)
    # 2^64 is divisible by the number of leaves, so pmod of the signed number is that of the hash.
    leaf = F.pmod(F.col("word"), F.lit(LEAVES)).cast("int").alias("leaf")
    # At most LEAVES rows of two numbers.
    leaves, of_leaf = np.zeros(LEAVES), counts.groupBy(leaf).agg(F.sum("n").alias("n")).toArrow()
    leaves[of_leaf["leaf"].to_numpy()] = of_leaf["n"].to_numpy()
    rank = np.arange(len(words))
    hashed = words.view(np.uint64)
    by_leaf = (hashed % np.uint64(LEAVES)).astype(np.int64)
    by_hash = OWN_CLASSES + by_leaf % HASHED_CLASSES
    # Words with a class of their own leave their hashed class.
    own = rank < OWN_CLASSES
    np.subtract.at(leaves, by_leaf[own], n[own])
    mass = np.concatenate([np.zeros(OWN_CLASSES), leaves.reshape(-1, HASHED_CLASSES).sum(0)])
    classes = np.where(own, rank, by_hash)
    inputs = np.where(rank < OWN_INPUTS, rank, OWN_INPUTS + ((hashed >> np.uint64(20)) % np.uint64(HASHED_INPUTS)).astype(np.int64))
    shares = np.where(own, 0.0, np.log(np.maximum(n, 1)) - np.log(np.maximum(leaves[by_leaf], 1)))
    order = np.argsort(words)
    kept = (words[order], classes[order], inputs[order], shares[order])
    return Vocabulary(*kept, -np.log(np.maximum(mass, 1)), digit_shares(leaves)), counts


def initial(seed: int = 3) -> np.ndarray:
    random = np.random.default_rng(seed)
    parts = []
    for name, shape in SHAPES.items():
        scale = {"words": 0.3, "out": 0.3}.get(name, 0.0)
        parts.append(random.normal(0, scale, shape) if scale else np.full(shape, 1.0 if name == "places" else 0.0))
    return np.concatenate([part.ravel() for part in parts])


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    weights, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        weights[name] = flat[at : at + size].reshape(shape)
        at += size
    return weights


def contexts(inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Inputs around each word, one column per offset; INPUTS beyond a text's ends."""
    counts = np.diff(first)
    place = np.arange(len(inputs)) + np.repeat(np.arange(1, len(counts) + 1) * REACH, counts)
    line = np.full(len(inputs) + REACH * (len(counts) + 1), INPUTS, np.int64)
    line[place] = inputs
    return np.stack([line[place + offset] for offset in OFFSETS], 1)


def _raised(logits: np.ndarray, weights: np.ndarray, bias: float = 0.0) -> np.ndarray:
    """Exponentials of logits, which the hidden layer, within -1 and 1, bounds by the weights."""
    if np.abs(weights).sum(0).max() + bias > 80:
        logits = logits - logits.max(1, keepdims=True)
    return np.exp(logits)


def _forward(w: dict[str, np.ndarray], around: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Read vectors by offset, hidden layer, probabilities of all classes up to a factor, and their sums."""
    read = [w["words"].take(column, 0) for column in around.T]
    summed = read[0] * w["places"][0] + w["bias"]
    for part, place in zip(read[1:], w["places"][1:], strict=True):
        summed += part * place
    hidden = np.tanh(summed)
    logits = hidden @ w["out"]
    logits += w["out_bias"]
    raised = _raised(logits, w["out"], np.abs(w["out_bias"]).max())
    return read, hidden, raised, raised @ np.ones(CLASSES, raised.dtype)


def _forward_digits(w: dict[str, np.ndarray], hidden: np.ndarray, shares: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words of hashed classes, probabilities of all values of each digit up to a factor, and their sums."""
    raised = _raised(hidden @ w["digits"], w["digits"]).reshape(-1, DIGITS, BASE)
    raised *= shares.take(rows, 0)
    # One product: a product for each word would take longer.
    return raised, (raised.reshape(-1, BASE) @ np.ones(BASE, raised.dtype)).reshape(-1, DIGITS)


@dataclass
class Targets:
    """Words to be predicted: their classes, and which are of hashed classes, with their ``paths``."""

    classes: np.ndarray
    hashed: np.ndarray
    rows: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, classes: np.ndarray) -> Targets:
        hashed = np.flatnonzero(classes >= OWN_CLASSES)
        return cls(classes, hashed, *paths(words[hashed]))

    def __getitem__(self, at: slice) -> Targets:
        low, high = np.searchsorted(self.hashed, [at.start, at.stop])
        return Targets(self.classes[at], self.hashed[low:high] - at.start, self.rows[low:high], self.values[low:high])


def log_probabilities(w: dict[str, np.ndarray], shares: np.ndarray, around: np.ndarray, targets: Targets) -> np.ndarray:
    """Log-probability of each target's class and digits."""
    _, hidden, raised, sums = _forward(w, around)
    logs = np.log(raised[np.arange(len(sums)), targets.classes] / sums)
    digits, of_digits = _forward_digits(w, hidden[targets.hashed], shares, targets.rows)
    own = np.take_along_axis(digits, targets.values[:, :, None], 2)[:, :, 0]
    logs[targets.hashed] += np.log(own / of_digits).sum(1)
    return logs


def train_step(w: dict[str, np.ndarray], squares: dict[str, np.ndarray], shares: np.ndarray, around: np.ndarray, targets: Targets) -> None:
    """One Adagrad step on a minibatch, up the mean log-probability of classes and digits."""
    count, hashed = len(targets.classes), targets.hashed
    read, hidden, error, sums = _forward(w, around)
    seen = hidden[hashed]
    wrong, of_digits = _forward_digits(w, seen, shares, targets.rows)
    error /= (sums * count)[:, None]
    error[np.arange(count), targets.classes] -= 1 / count
    wrong /= (of_digits * count)[:, :, None]
    wrong[np.arange(len(hashed))[:, None], np.arange(DIGITS), targets.values] -= 1 / count
    wrong = wrong.reshape(-1, DIGITS * BASE)
    to_hidden = error @ w["out"].T
    to_hidden[hashed] += wrong @ w["digits"].T
    to_hidden *= 1 - hidden**2
    words = np.zeros((INPUTS + 1) * WIDTH)
    dims = np.arange(WIDTH)
    for column, place in zip(around.T, w["places"], strict=True):
        cells = (column[:, None] * WIDTH + dims).ravel()
        words += np.bincount(cells, (to_hidden * place).ravel(), len(words))
    gradients = {
        "words": words.reshape(INPUTS + 1, WIDTH),
        "places": np.stack([(part * to_hidden).sum(0) for part in read]),
        "bias": to_hidden.sum(0),
        "out": (error.T @ hidden).T,
        "out_bias": np.ones(count, error.dtype) @ error,
        "digits": (wrong.T @ seen).T,
    }
    for name, gradient in gradients.items():
        gradient = gradient.astype(np.float32)
        squares[name] += gradient**2
        w[name] -= RATE * gradient / np.sqrt(squares[name])


def _train(weights, shared):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        flat = weights.value.astype(np.float32)
        w = unpack(flat)
        squares = {name: np.full(shape, 1e-4, np.float32) for name, shape in SHAPES.items()}
        seen = 0
        for batch in batches:
            for block in blocks(batch.column("text")):
                hashes, first = words_of(block)
                classes, inputs, _, _ = words.look_up(hashes)
                around, targets = contexts(inputs, first), Targets.of(hashes, classes)
                for at in range(0, len(classes), MINIBATCH):
                    part = slice(at, min(at + MINIBATCH, len(classes)))
                    train_step(w, squares, words.digits, around[part], targets[part])
                seen += len(classes)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SIZE)), pa.array(flat.astype(np.float64) * seen), pa.array(np.full(SIZE, seen))],
                ["weight", "value", "words"],
            )

    return train


def train(documents: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Network weights after rounds of training on all partitions and averaging."""
    context = documents.sparkSession.sparkContext
    shared, flat = context.broadcast(words), initial()
    for _ in range(rounds):
        trained = documents.select("text").mapInArrow(
            _train(context.broadcast(flat), shared), "weight bigint, value double, words bigint"
        )
        average = trained.groupBy("weight").agg((F.sum("value") / F.sum("words")).alias("value")).toArrow()
        # SIZE numbers, or none without words.
        flat = flat.copy()
        flat[average["weight"].to_numpy()] = average["value"].to_numpy()
    return flat


def score_block(block: Block, words: Vocabulary, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of words, summed log-probability and number of words beyond the kept ones of each text, and those words."""
    hashes, first = words_of(block)
    classes, inputs, shares, beyond = words.look_up(hashes)
    around, targets = contexts(inputs, first), Targets.of(hashes, classes)
    logs = shares.copy()
    # A word beyond the kept ones has one part in what its class and digits have.
    rare = beyond[targets.hashed]
    taken = words.digits[targets.rows[rare], targets.values[rare]]
    logs[targets.hashed[rare]] -= np.log(taken, dtype=float).sum(1)
    for at in range(0, len(classes), MINIBATCH):
        part = slice(at, min(at + MINIBATCH, len(classes)))
        logs[part] += log_probabilities(w, words.digits, around[part], targets[part])
    sums = np.concatenate([[0.0], np.cumsum(logs)])
    rest = np.concatenate([[0], np.cumsum(beyond)])
    return np.diff(first), sums[first[1:]] - sums[first[:-1]], rest[first[1:]] - rest[first[:-1]], hashes[beyond]


def score(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, log_probability (sum) and mean_log_probability of every document."""
    small_batches(documents)
    store = Store(documents, "lm-scoring")
    words, counts = vocabulary(documents, store)
    context = documents.sparkSession.sparkContext
    shared, flat = context.broadcast(words), context.broadcast(train(documents, words))

    def score_texts(texts: pa.Array) -> pa.Array:
        w = unpack(flat.value.astype(np.float32))
        parts = [score_block(block, shared.value, w) for block in blocks(texts)]
        n, sums, sizes, rest = (np.concatenate(column) for column in zip(*parts, strict=True)) if parts else ([], [], [], [])
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [
                pa.array(n, pa.int64()),
                pa.array(sums, pa.float64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rest, pa.int64())),
            ],
            ["n_words", "log_probability", "rest"],
        )

    scored = documents.select(
        "doc_id", arrow_udf(score_texts, "n_words bigint, log_probability double, rest array<bigint>")("text").alias("s")
    )
    # Numbers of rows are written, so that they stay the same for both readers.
    scored = store.write(scored.select("doc_id", "s.*", F.monotonically_increasing_id().alias("row")), "scored")
    # Each of these words has at most 1 / KEPT_WORDS of all, so none is a hot key; a word seen once adds log 1 = 0.
    rest = scored.select("row", F.explode("rest").alias("word"))
    added = rest.join(counts.where("n > 1"), "word").groupBy("row").agg(F.sum(F.ln("n")).alias("added"))
    total = F.col("log_probability") + F.coalesce("added", F.lit(0.0))
    return (
        scored.drop("rest")
        .join(added, "row", "left")
        .select(
            "doc_id",
            "n_words",
            total.alias("log_probability"),
            F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_probability"),
        )
    )
