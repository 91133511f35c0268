"""Benchmark decontamination by a broadcast hash set of normalised word windows.

Benchmark items are lower-cased (A-Z) and cut into words; every ``width`` consecutive
words are a window, and an item of fewer words is one window. The windows' hashes are
broadcast in parts of at most ``PART_WINDOWS``; a benchmark beyond that takes further
parts over the same scan, so nothing is left out and no broadcast grows with it. Each
task hashes all windows of its texts, looks them up, verifies hits word by word, and
marks the words that any occurrence covers.

Defined results: null and empty texts and items have no words; items without words
match nothing; repeated items of one id count once; a null item id is written as an
empty string; repeated rows are scanned one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.store import small_batches
from cohortline.llm.textscan import (
    ALPHANUMERIC,
    LOWER,
    SpanHash,
    blocks,
    isin_hashes,
    screen_of,
    window_hashes,
    window_starts,
)

WIDTH = 10
# Windows of one broadcast; with their words about 100 bytes each.
PART_WINDOWS = 200_000
# Bytes of benchmark text read to the driver at a time.
READ_BYTES = 16 << 20

FOUND = "words int, hits array<int>, items array<string>"


class WindowSet:
    """Some windows of the benchmark: by window length, sorted hashes with words and item ids."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.by_length: dict[int, tuple] = {}
        for length in sorted({len(words) for words in windows}):
            chosen = [words for words in windows if len(words) == length]
            flat = np.frombuffer(b"".join(b"".join(words) for words in chosen), np.uint8)
            sizes = np.array([len(word) for words in chosen for word in words])
            ends = np.cumsum(sizes)
            hashes = SpanHash(flat)(ends - sizes, ends)
            keys = np.array([window_hashes(hashes[k : k + length], length)[0] for k in range(0, len(hashes), length)])
            distinct, place = np.unique(keys, return_inverse=True)
            entries: list[list] = [[] for _ in distinct]
            for at, words in zip(place.tolist(), chosen, strict=True):
                entries[at].append((words, sorted(windows[words])))
            self.by_length[length] = (distinct, entries)


def text_words(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    inside = np.concatenate([[False], ALPHANUMERIC[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    lowered = LOWER[data].tobytes()
    return [lowered[start:end] for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def window_sets(benchmark: DataFrame, width: int) -> list[WindowSet]:
    """The benchmark's windows in parts of bounded size.

    Items are read to the driver in slices of bounded bytes.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = -(-size // READ_BYTES) or 1
    parts: list[WindowSet] = []
    windows: dict[tuple[bytes, ...], set[str]] = {}
    for k in range(slices):
        chosen = items if slices == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        for item, text in chosen.toLocalIterator():
            words = text_words(text)
            for start in range(max(1, len(words) - width + 1)) if words else ():
                windows.setdefault(tuple(words[start : start + width]), set()).add(item)
                if len(windows) >= PART_WINDOWS:
                    parts.append(WindowSet(windows))
                    windows = {}
    return parts + [WindowSet(windows)] if windows or not parts else parts


def scan_texts(column: pa.Array, part: WindowSet, screens: dict[int, np.ndarray]) -> pa.Array:
    """Per text: its number of words, the positions of hit words, the items found."""
    counts, hits, items = [], [], []
    for block in blocks(column):
        starts, ends = block.runs(ALPHANUMERIC)
        first = np.searchsorted(starts, block.offsets)
        words = SpanHash(block.data, LOWER)(starts, ends)
        covered = np.zeros(len(words), bool)
        found: dict[int, set[str]] = {}
        for length, (hashes, entries) in part.by_length.items():
            if len(words) < length:
                continue
            at = isin_hashes(window_hashes(words, length), hashes, screens[length])
            at[~window_starts(first, length)[: len(at)]] = -1
            for start in np.flatnonzero(at >= 0).tolist():
                spelled = tuple(
                    LOWER[block.data[starts[k] : ends[k]]].tobytes() for k in range(start, start + length)
                )
                for window, ids in entries[at[start]]:
                    if window == spelled:
                        covered[start : start + length] = True
                        found.setdefault(int(np.searchsorted(first, start, "right")) - 1, set()).update(ids)
        marked = np.flatnonzero(covered)
        bounds = np.searchsorted(marked, first)
        counts.append(np.diff(first))
        for text in range(len(block)):
            hits.append(marked[bounds[text] : bounds[text + 1]] - first[text])
            items.append(sorted(found.get(text, ())))
    return pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(counts) if counts else [], pa.int32()),
            pa.array(hits, pa.list_(pa.int32())),
            pa.array(items, pa.list_(pa.string())),
        ],
        ["words", "hits", "items"],
    )


def _scanner(shared: Broadcast):
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        part = shared.value
        screens = {length: screen_of(hashes) for length, (hashes, _) in part.by_length.items()}
        for column in texts:
            yield scan_texts(column, part, screens)

    return arrow_udf(scan, FOUND)


def findings(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> Column:
    """A column of ``documents``: words, positions of hit words, ids of the items found."""
    small_batches(documents)
    context = documents.sparkSession.sparkContext
    parts = [_scanner(context.broadcast(part))(F.col("text")) for part in window_sets(benchmark, width)]
    if len(parts) == 1:
        return parts[0]
    return F.struct(
        parts[0].getField("words").alias("words"),
        F.sort_array(reduce(F.array_union, (part.getField("hits") for part in parts))).alias("hits"),
        F.sort_array(reduce(F.array_union, (part.getField("items") for part in parts))).alias("items"),
    )


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, words, hits, items."""
    found = documents.select("doc_id", findings(documents, benchmark, width).alias("found"))
    return found.select("doc_id", "found.*")


def _without_hits(texts: pa.Array, hits: pa.Array) -> pa.Array:
    """Each text without its hit words; the gap they leave keeps one separator."""
    kept = []
    for text, marked in zip(texts.to_pylist(), hits.to_pylist(), strict=True):
        if not marked:
            kept.append(text)
            continue
        data = text.encode()
        inside = np.concatenate([[False], ALPHANUMERIC[np.frombuffer(data, np.uint8)], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1]).tolist()
        runs = np.split(np.array(marked), np.flatnonzero(np.diff(marked) > 1) + 1)
        pieces, at = [], 0
        for run in runs:
            pieces.append(data[at : edges[2 * int(run[0])]])
            at = edges[2 * int(run[-1]) + 1]
        kept.append((b"".join(pieces) + data[at:]).decode())
    return pa.array(kept, pa.string())


def decontaminate(documents: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH) -> DataFrame:
    """The documents without benchmark passages, with the columns they came with.

    ``remove`` is ``documents`` (those with a hit go) or ``spans`` (the hit words go).
    """
    marked = documents.withColumn("_found_", findings(documents, benchmark, width))
    if remove == "documents":
        return marked.where(F.size("_found_.hits") == 0).drop("_found_")
    if remove != "spans":
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    cut = arrow_udf(_without_hits, "string")
    return marked.withColumn("text", cut("text", "_found_.hits")).select(*documents.columns)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from ``contamination``."""
    return found.select(
        "doc_id",
        F.col("words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
