"""Packing of tokenised documents into sequences of a fixed capacity.

A document is its token ids and an end id, cut into pieces of at most ``capacity``. How
pieces of each length fill sequences is decided on the histogram of lengths, which has at
most ``capacity`` rows whatever the corpus:

1. Lengths above a third of the capacity go at most twice into a sequence. From the
   longest on, each is matched with the longest partner that still fits.
2. Smaller lengths, from the longest on, fill the smallest remaining gap that holds them;
   where none does, a new sequence is opened.

The plan is a bounded list of slots: "pieces number a to b of length l go, q to a
sequence, into sequences from s on, at offset o". Pieces are numbered within their length
by their task's place and their order in it, so no task sees all pieces of a length.

Tokenising keeps the ids of words met before in a bounded cache: the tokenizer works on
words between white space independently, so a text of Latin letters is looked up word by
word, and any other text is encoded as a whole.

Defined results: a null or empty text is the end id alone; rows are packed one by one,
repeated ids included; a null id is an id; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.store import Store, small_batches
from cohortline.llm.textscan import blocks

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 1_200_000
# Words met first, which hold the frequent ones, stay when the cache is full.
KEPT_WORDS = 200_000

# Texts with anything else (other scripts, odd white space, special tokens) are encoded whole.
_PLAIN = regex.compile(r"[^\x00-ɏ]|[\x1c-\x1f\x85\xa0]|<\|")


class WordEncoder:
    """Token ids of texts, the same as the tokenizer's, with a cache of words."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.closes[number] = token.endswith("</w>")
        self.cached = cached
        self.index: dict[str, int] = {}
        self.ids, self.begins = array("I"), array("q", [0])

    def _trim(self, kept: int) -> None:
        self.index = dict(islice(self.index.items(), kept))
        del self.begins[len(self.index) + 1 :]
        del self.ids[self.begins[-1] :]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 2048):
            chunk = words[at : at + 2048]
            ids = np.array(self.encode_whole(" ".join(chunk)), np.uint32)
            # Each piece of a word that the tokenizer cuts off ends in a closing token.
            counts = [1 if word.isalpha() else len(_PIECES.findall(word)) for word in chunk]
            ends = np.flatnonzero(self.closes[ids]) + 1
            wanted = np.cumsum(counts)
            if wanted[-1] != len(ends):
                encoded = [self.encode_whole(word) for word in chunk]
                ids = np.array([one for ids in encoded for one in ids], np.uint32)
                bounds = np.cumsum([len(one) for one in encoded])
            else:
                bounds = np.concatenate([[0], ends])[wanted]
            base = len(self.ids)
            self.ids.frombytes(ids.tobytes())
            self.begins.extend((bounds + base).tolist())
            for word in chunk:
                self.index[word] = len(self.index)

    def encode_whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        results: list[np.ndarray | None] = [None] * len(texts)
        plain, words, counts = [], [], []
        for k, text in enumerate(texts):
            if _PLAIN.search(text):
                results[k] = np.array(self.encode_whole(text), np.uint32)
            else:
                own = text.lower().split()
                plain.append(k)
                counts.append(len(own))
                words += own
        new = set(words).difference(self.index)
        if len(self.index) + len(new) > self.cached:
            self._trim(min(KEPT_WORDS, self.cached // 2))
            new = set(words).difference(self.index)
        self._learn(sorted(new))
        place = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        begins = np.frombuffer(self.begins, np.int64)
        lengths = begins[place + 1] - begins[place]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) - np.repeat(ends - lengths - begins[place], lengths)
        flat = np.frombuffer(self.ids, np.uint32)[at] if total else np.zeros(0, np.uint32)
        # Views of growing arrays must not outlive this call.
        del begins
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        for n, k in enumerate(plain):
            results[k] = flat[bounds[n] : bounds[n + 1]]
        return results


_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process; its cache is kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, ordinal bigint"


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            for block in blocks(texts):
                own = texts.slice(block.first, len(block)).to_pylist()
                rows = []
                for k, ids in enumerate(encode.encode([text or "" for text in own])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append((keys[block.first + k], piece, start, len(part), zlib.crc32(part.tobytes()), part))
                columns = list(zip(*rows, strict=True))
                lengths = np.array(columns[3], np.int64)
                order = np.argsort(lengths, kind="stable")
                heads = np.searchsorted(lengths[order], lengths[order])
                ordinal = np.empty(len(order), np.int64)
                ordinal[order] = np.arange(len(order)) - heads + seen[lengths[order]]
                seen += np.bincount(lengths, minlength=capacity + 1)
                arrays = [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(columns[k], pa.int64()) for k in (2, 3, 4)),
                    pa.array(np.full(len(rows), task), pa.int32()),
                    pa.array(ordinal),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "ordinal"]
                if with_ids:
                    arrays.append(pa.array([part.tolist() for part in columns[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequences as (how many, [(length, pieces of it), ...])."""
    left = {length: count for length, count in histogram.items() if count}
    kinds: list[tuple[int, list[tuple[int, int]]]] = []
    open_kinds: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def put(count: int, parts: list[tuple[int, int]], gap: int) -> None:
        if gap not in open_kinds:
            open_kinds[gap] = []
            insort(gaps, gap)
        open_kinds[gap].append((count, parts))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        longest = large[-1]
        at = bisect_left(large, capacity - longest + 1) - 1
        if at < 0:
            put(left.pop(longest), [(longest, 1)], capacity - longest)
            large.pop()
            continue
        partner = large[at]
        pairs = left[longest] // 2 if partner == longest else min(left[longest], left[partner])
        if pairs:
            put(pairs, [(longest, 1), (partner, 1)], capacity - longest - partner)
        if partner == longest:
            if left[longest] % 2:
                left[longest] = 1
                if at > 0:
                    # The odd one is matched with the next shorter length.
                    other = large[at - 1]
                    put(1, [(longest, 1), (other, 1)], capacity - longest - other)
                    left[other] -= 1
                    if not left[other]:
                        del left[other]
                        large.remove(other)
                else:
                    put(1, [(longest, 1)], capacity - longest)
            left.pop(longest)
            large.remove(longest)
            continue
        for length in (longest, partner):
            left[length] -= pairs
            if not left[length]:
                del left[length]
                large.remove(length)

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length
                put(max(1, count // fit), [], capacity)
                continue
            gap = gaps[at]
            bins, parts = open_kinds[gap].pop()
            if not open_kinds[gap]:
                del open_kinds[gap]
                gaps.pop(at)
            fit = gap // length
            if count < fit:
                fit = count
            filled = min(bins, count // fit)
            if filled < bins:
                put(bins - filled, parts, gap)
            count -= filled * fit
            put(filled, [*parts, (length, fit)], gap - fit * length)
    for gap in gaps:
        kinds += open_kinds[gap]
    return kinds


def slots(kinds: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows of (length, first number, pieces of it a sequence, first sequence, offset), sorted."""
    numbers: dict[int, int] = {}
    rows, sequence = [], 0
    for count, parts in kinds:
        offset = 0
        for length, pieces in parts:
            first = numbers.get(length, 0)
            rows.append((length, first, pieces, sequence, offset))
            numbers[length] = first + count * pieces
            offset += length * pieces
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, number = (batch.column(name).to_numpy() for name in ("length", "number"))
            row = table[np.searchsorted(keys, (length << 44) + number, "right") - 1]
            turn = number - row[:, 1]
            sequence, within = row[:, 3] + turn // row[:, 2], turn % row[:, 2]
            arrays = [batch.column(name) for name in batch.schema.names if name != "number"]
            names = [name for name in batch.schema.names if name != "number"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(row[:, 4] + within * length)], [*names, "sequence_id", "offset"]
            )

    return place


def pack(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    small_batches(documents)
    store = Store(documents, "packing")
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    # Written, so that a piece's task and order in it are the same for every reader.
    pieces = store.write(read.mapInArrow(_cut(tokenizer, capacity, end_id, with_ids), schema), "pieces")
    counts = store.write(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    # At most ``capacity`` rows.
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan_sequences(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = pieces.join(offsets, ["task", "length"]).withColumn("number", F.col("ordinal") + F.col("before"))
    shown = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    shared = documents.sparkSession.sparkContext.broadcast(table)
    result = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    result += (", ids array<int>" if with_ids else "") + ", sequence_id bigint, offset bigint"
    return numbered.select(*shown, "number").mapInArrow(_place(shared), result)
