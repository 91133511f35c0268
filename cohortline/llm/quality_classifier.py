"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is described by
byte-class shares, word-shape statistics and a hashed bigram histogram, and encoded
by a small network; gated attention, learned from the labels of whole texts, weighs
the passages, and the weighted representation gives the score. Fitting reads at most
``FIT_TEXTS`` labelled texts, drawn by a hash of their id, and of each at most
``FIT_PASSAGES`` passages, spread evenly from its first to its last (bounds, so that the
fit does not grow with the corpus or with one text); scoring reads every passage of every
text.

Defined results: a null or empty text is one blank passage and gets a score like any
other; without labelled texts, or with one class only, every score is that of the
share of label 1 (0.5 without labels); labels repeated for an id count once (the
smaller); a null id is not held out; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.store import small_batches
from cohortline.llm.textscan import LOWER, NOT_SPACE, Block, SpanHash, blocks, byte_class

PASSAGE_WORDS = 64
FIT_TEXTS = 3_000
FIT_PASSAGES = 128
BIGRAMS = 48
HIDDEN = 24
GATES = 12
PREDICT_FROM = 0.3

_CLASSES = [
    byte_class((0x61, 0x7A)),
    byte_class((0x41, 0x5A)),
    byte_class((0x30, 0x39)),
    byte_class((0x80, 0xFF)),
    byte_class((0x0A, 0x0A)),
    byte_class((0x20, 0x20), (0x09, 0x09), (0x0B, 0x0D)),
    byte_class((0x2C, 0x2C), (0x2E, 0x2E), (0x3B, 0x3B), (0x3A, 0x3A)),
    byte_class((0x21, 0x21), (0x3F, 0x3F)),
    byte_class((0x23, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7F)),
]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[_members] = _k
_SHARES = len(_CLASSES) + 1
FEATURES = _SHARES + 6 + BIGRAMS


def passage_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a block, and each text's first passage."""
    starts, ends = block.runs(NOT_SPACE)
    first = np.searchsorted(starts, block.offsets)
    counts = np.diff(first)
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first_passage = np.concatenate([[0], np.cumsum(passages)])
    total = int(first_passage[-1])
    features = np.zeros((total, FEATURES), np.float32)
    if not len(starts):
        return features, first_passage
    text_of_word = np.repeat(np.arange(len(block)), counts)
    within = np.arange(len(starts)) - first[text_of_word]
    passage_of_word = first_passage[text_of_word] + within // PASSAGE_WORDS
    begins = within % PASSAGE_WORDS == 0
    # Bytes before a passage's first word belong to the passage before it.
    edges = np.append(starts[begins], len(block.data))
    passage_of_byte = np.repeat(passage_of_word[begins], np.diff(edges))
    data = block.data[edges[0] :]
    size = np.maximum(1, np.bincount(passage_of_byte, minlength=total)).astype(np.float32)

    classes = _CLASS_OF[data]
    shares = np.bincount(passage_of_byte * _SHARES + classes, minlength=total * _SHARES)
    features[:, :_SHARES] = shares.reshape(total, _SHARES) / size[:, None]

    words = np.maximum(1, np.bincount(passage_of_word, minlength=total)).astype(np.float32)
    lengths = (ends - starts).astype(np.float32)
    mean = np.bincount(passage_of_word, lengths, total) / words
    square = np.bincount(passage_of_word, lengths**2, total) / words
    hashes = SpanHash(block.data, LOWER)(starts, ends)
    same_passage = passage_of_word[1:] == passage_of_word[:-1]
    repeats = np.bincount(passage_of_word[1:][(hashes[1:] == hashes[:-1]) & same_passage], minlength=total)
    keyed = np.sort((passage_of_word.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    distinct = np.bincount(
        (keyed[np.append(True, keyed[1:] != keyed[:-1])] >> np.uint64(40)).astype(np.int64), minlength=total
    )
    turns = classes[1:] != classes[:-1]
    changes = np.bincount(passage_of_byte[1:][turns], minlength=total)
    columns = (mean / 10, np.sqrt(np.maximum(0, square - mean**2)) / 10, repeats / words, distinct / words)
    for k, column in enumerate((*columns, changes / size, np.log1p(words) / 5)):
        features[:, _SHARES + k] = column

    lowered = LOWER[data].astype(np.int64)
    pair = ((lowered[:-1] * 257 + lowered[1:]) * 40503 >> 7) % BIGRAMS
    bigrams = np.bincount(passage_of_byte[:-1] * BIGRAMS + pair, minlength=total * BIGRAMS)
    features[:, _SHARES + 6 :] = bigrams.reshape(total, BIGRAMS) / size[:, None] * 10
    return features, first_passage


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def encode(self, features: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.clip((features - self.mean) / self.scale, -6, 6)
        hidden = np.maximum(0, x @ w["encode"] + w["encode_bias"])
        tanh, gate = np.tanh(hidden @ w["value"]), _sigmoid(hidden @ w["gate"])
        return {"x": x, "hidden": hidden, "tanh": tanh, "gate": gate, "energy": (tanh * gate) @ w["attend"]}

    def attention(self, energy: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Softmax of the energies within each bag."""
        counts = np.diff(first)
        top = np.repeat(np.maximum.reduceat(energy, first[:-1]), counts)
        raised = np.exp(energy - top)
        return raised / np.repeat(np.add.reduceat(raised, first[:-1]), counts)

    def score(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        state = self.encode(features)
        weight = self.attention(state["energy"], first)
        bag = np.add.reduceat(state["hidden"] * weight[:, None], first[:-1], axis=0)
        return _sigmoid(bag @ self.weights["out"] + self.weights["out_bias"])


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, epochs: int = 60, seed: int = 5) -> Model:
    """Gradient training (Adam) on bags given as passage features and first passages."""
    bags = len(labels)
    if bags == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if bags else 0.5
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, share)
    random = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape)

    weights = {
        "encode": start(FEATURES, HIDDEN),
        "encode_bias": np.zeros(HIDDEN),
        "value": start(HIDDEN, GATES),
        "gate": start(HIDDEN, GATES),
        "attend": start(GATES),
        "out": start(HIDDEN),
        "out_bias": np.zeros(1),
    }
    model = Model(features.mean(0), features.std(0) + 1e-3, weights)
    moments = {name: (np.zeros_like(w), np.zeros_like(w)) for name, w in weights.items()}
    step = 0
    for _ in range(epochs):
        order = random.permutation(bags)
        for at in range(0, bags, 64):
            chosen = np.sort(order[at : at + 64])
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in chosen])
            bounds = np.concatenate([[0], np.cumsum(first[chosen + 1] - first[chosen])])
            gradients = _gradients(model, features[rows], bounds, labels[chosen])
            step += 1
            for name, gradient in gradients.items():
                one, two = moments[name]
                one += 0.1 * (gradient - one)
                two += 0.001 * (gradient**2 - two)
                rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[name] -= rate * (one / (np.sqrt(two) + 1e-8) + 1e-3 * weights[name])
    return model


def _gradients(model: Model, features: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the log loss of some bags."""
    w, state, counts = model.weights, model.encode(features), np.diff(first)
    hidden, weight = state["hidden"], model.attention(state["energy"], first)
    bag = np.add.reduceat(hidden * weight[:, None], first[:-1], axis=0)
    error = (_sigmoid(bag @ w["out"] + w["out_bias"]) - labels) / len(labels)
    to_bag = np.repeat(error[:, None] * w["out"], counts, axis=0)
    to_weight = (to_bag * hidden).sum(1)
    to_energy = weight * (to_weight - np.repeat(np.add.reduceat(weight * to_weight, first[:-1]), counts))
    gated = state["tanh"] * state["gate"]
    to_gated = to_energy[:, None] * w["attend"]
    to_value = to_gated * state["gate"] * (1 - state["tanh"] ** 2)
    to_gate = to_gated * gated * (1 - state["gate"])
    to_hidden = to_bag * weight[:, None] + to_value @ w["value"].T + to_gate @ w["gate"].T
    to_hidden = to_hidden * (hidden > 0)
    return {
        "encode": state["x"].T @ to_hidden,
        "encode_bias": to_hidden.sum(0),
        "value": hidden.T @ to_value,
        "gate": hidden.T @ to_gate,
        "attend": gated.T @ to_energy,
        "out": bag.T @ error,
        "out_bias": np.array([error.sum()]),
    }


def spread_passages(count: int, most: int) -> np.ndarray:
    """All passages of a text, or ``most`` of them, spread evenly from the first to the last."""
    return np.arange(count) if count <= most else np.linspace(0, count - 1, most).round().astype(np.int64)


def _bags(most: int):
    def bags(texts: pa.Array) -> pa.Array:
        """Passages of each text as one binary of float32 features."""
        packed = []
        for block in blocks(texts):
            features, first = passage_features(block)
            for k in range(len(block)):
                own = spread_passages(int(first[k + 1] - first[k]), most)
                packed.append(features[first[k] + own].tobytes())
        return pa.array(packed, pa.binary())

    return bags


def held_out(key: Column) -> Column:
    """Whether an id is kept from fitting: crc32 of its text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, fit_texts: int = FIT_TEXTS, fit_passages: int = FIT_PASSAGES) -> Model:
    """A model fitted on a bounded sample of the labelled texts that are not held out."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    chosen = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_texts)
    # At most fit_texts narrow rows, so a broadcast of proven size.
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    encode = arrow_udf(_bags(fit_passages), "binary")
    # Repeated rows of an id are cut after that many texts in all.
    rows = sample.select("doc_id", "quality", encode("text").alias("bag")).orderBy("doc_id", "bag").limit(fit_texts)
    table = rows.toArrow()
    bags = [np.frombuffer(bag.as_py(), np.float32).reshape(-1, FEATURES) for bag in table["bag"]]
    first = np.concatenate([[0], np.cumsum([len(bag) for bag in bags])]).astype(np.int64)
    features = np.concatenate(bags) if bags else np.zeros((0, FEATURES), np.float32)
    return fit(features, first, table["quality"].to_numpy().astype(float))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    small_batches(documents)

    def score_texts(texts: pa.Array) -> pa.Array:
        scores = []
        for block in blocks(texts):
            scores.append(model.score(*passage_features(block)))
        return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

    scored = documents.select("doc_id", arrow_udf(score_texts, "double")("text").alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
    )
