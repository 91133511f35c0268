"""Quality rules with risk-controlled thresholds.

Each text gets counts of words, symbols, repeated lines and repeated word windows.
A base rule rejects what is short or mostly repetition. Beyond it, the cutoff of
each statistic is chosen per stratum on labelled texts: walking from the most
lenient grid value to stricter ones, a cutoff is accepted while the exact binomial
test rejects "the share of good texts it would drop is above ``risk``". The walk
stops at the first failure, so its grid needs no correction; the level is divided by
the number of families and statistics (Bonferroni).

A stratum with labels enough to certify a cutoff is a family of its own. All others share
one: the union of their labels or, if that is too small as well, the labels of all strata.
The shared certificate bounds the share of good texts dropped of that union. Within it, a
stratum whose own good labels contradict a shared cutoff (more than ``risk`` of them would
go) gets the strictest one they allow; a stratum without labels takes the shared cutoffs.
Families are formed by numbers of labels alone, so the tests stay valid. If even all
labels together are too few, no cutoff can be certified at that risk, and only the base
rule drops texts.

Defined results: a null or empty text has no words and fails the base rule; a null
stratum is a stratum of its own; repeated rows are judged one by one; labels without
a text, or of null quality, count for nothing; extra columns are ignored.
"""

from __future__ import annotations

from math import lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.store import Store, small_batches
from cohortline.llm.textscan import NOT_SPACE, Block, SpanHash, blocks, byte_class, mix, window_hashes, window_starts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("symbol_ratio", "repeat_ratio", "dup_line_ratio", "word_length", "word_shortness")
GRID = 1_000
WINDOW = 3

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LEADS = ~byte_class((0x80, 0xBF))
_NEWLINE = byte_class((0x0A, 0x0A))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def count_block(block: Block) -> np.ndarray:
    """The five counts of each text of a block, one row per text."""
    starts, ends = block.runs(NOT_SPACE)
    first = np.searchsorted(starts, block.offsets)
    hashes = SpanHash(block.data)
    words = hashes(starts, ends)
    counts = np.diff(first)
    text_salt = mix(np.arange(len(block), dtype=np.uint64) + np.uint64(1))

    chars = block.per_text(NOT_SPACE[block.data] & _LEADS[block.data])
    symbols = block.per_text(_SYMBOLS[block.data])

    breaks = np.flatnonzero(_NEWLINE[block.data])
    text_of_break = np.searchsorted(block.offsets, breaks, "right") - 1
    inner = breaks + 1 < block.offsets[text_of_break + 1]
    line_starts = np.concatenate([block.offsets[:-1], breaks[inner] + 1])
    text_of_line = np.concatenate([np.arange(len(block)), text_of_break[inner]])
    next_break = np.append(breaks, len(block.data))[np.searchsorted(breaks, line_starts)]
    line_ends = np.minimum(next_break, block.offsets[text_of_line + 1])
    spoken = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, text_of_line = line_starts[spoken], line_ends[spoken], text_of_line[spoken]
    lines = np.bincount(text_of_line, minlength=len(block))
    keys = np.unique(np.stack([text_of_line.astype(np.uint64), hashes(line_starts, line_ends)]), axis=1)
    duplicates = lines - np.bincount(keys[0].astype(np.int64), minlength=len(block))

    covered = np.zeros(len(words), bool)
    if len(words) >= WINDOW:
        whole = np.flatnonzero(window_starts(first, WINDOW))
        salts = np.repeat(text_salt, counts)
        keys = mix(window_hashes(words, WINDOW)[whole] ^ salts[whole])
        again = whole[_repeated(keys)]
        for shift in range(WINDOW):
            covered[again + shift] = True
    sums = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
    return np.stack([counts, chars, symbols, duplicates, sums[first[1:]] - sums[first[:-1]]], axis=1)


def count_texts(column: pa.Array) -> pa.Array:
    parts = [count_block(block) for block in blocks(column)]
    table = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)
    return pa.StructArray.from_arrays([pa.array(table[:, k], pa.int64()) for k in range(len(COUNTS))], list(COUNTS))


def with_statistics(counts: DataFrame) -> DataFrame:
    """Each statistic on an integer grid 0..GRID where higher is worse."""
    words = F.greatest(F.col("n_words"), F.lit(1))

    def grid(value):
        return F.least(F.greatest(F.floor(value), F.lit(0)), F.lit(GRID)).cast("int")

    length = F.col("word_chars") / words
    return counts.select(
        "*",
        F.struct(
            grid(F.col("n_symbols") * 200 / words).alias("symbol_ratio"),
            grid(F.col("n_repeat_words") * GRID / words).alias("repeat_ratio"),
            grid(F.col("n_dup_lines") * GRID / words).alias("dup_line_ratio"),
            grid(length * 20).alias("word_length"),
            grid(F.lit(200) - length * 20).alias("word_shortness"),
        ).alias("statistics"),
    )


def binomial_lower_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly, from log terms."""
    i = np.arange(0, k + 1)
    logs = np.array([lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) for j in i.tolist()])
    logs += i * log(p) + (n - i) * log(1 - p)
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def certified_cutoff(values: np.ndarray, counts: np.ndarray, risk: float, level: float) -> int:
    """Smallest grid value v for which dropping good texts at v and above is certified.

    GRID + 1 drops nothing and needs no certificate.
    """
    total = int(counts.sum())
    per_value = np.bincount(values, counts, minlength=GRID + 2).astype(np.int64)
    dropped = np.cumsum(per_value[::-1])[::-1]
    cutoff = GRID + 1
    last, passed = None, False
    for value in range(GRID, 0, -1):
        if dropped[value] != last:
            last = int(dropped[value])
            passed = last <= risk * total and binomial_lower_tail(last, total, risk) <= level
        if not passed:
            break
        cutoff = value
    return cutoff


def needed_labels(risk: float, level: float) -> int:
    """Good labels with which a cutoff that drops none of them is certified."""
    return int(np.ceil(log(level) / log(1 - risk)))


def families(totals: dict[str, int], risk: float, error: float) -> tuple[list[str], float]:
    """The strata that stand alone, as many as the correction allows, and the level of each test.

    The family that the other strata share counts in the correction.
    """
    ranked = sorted(totals, key=lambda name: (-totals[name], name))
    for alone in range(len(ranked), 0, -1):
        level = error / ((alone + 1) * len(STATISTICS))
        if totals[ranked[alone - 1]] >= needed_labels(risk, level):
            return ranked[:alone], level
    return [], error / len(STATISTICS)


def cutoffs(judged: DataFrame, risk: float, error: float) -> tuple[DataFrame, dict[str, int]]:
    """stratum, statistic, cutoff from labelled rows of (stratum, statistics, quality), and
    the cutoffs of strata without labels, by statistic.

    Labelled texts are first counted per grid value, so a stratum and statistic has at
    most GRID + 1 rows whatever the number of texts.
    """
    values = F.array(
        *(F.struct(F.lit(s).alias("statistic"), F.col(f"statistics.{s}").alias("value")) for s in STATISTICS)
    )
    good = judged.where("quality = 1").select("stratum", F.explode(values).alias("s"))
    counted = Store(judged, "quality-rules").write(
        good.groupBy("stratum", "s.statistic", "s.value").agg(F.count(F.lit(1)).alias("n")), "histogram"
    )
    # Only strata that could stand alone come to the driver.
    least = needed_labels(risk, error / len(STATISTICS))
    labelled = counted.where(F.col("statistic") == STATISTICS[0]).groupBy("stratum").agg(F.sum("n").alias("n"))
    alone, level = families({r["stratum"]: r["n"] for r in labelled.where(F.col("n") >= least).collect()}, risk, error)
    rest = ~F.col("stratum").isin(alone) if alone else F.lit(True)
    if (labelled.where(rest).agg(F.sum("n")).first()[0] or 0) < needed_labels(risk, level):
        rest = F.lit(True)
    # At most GRID + 1 rows a statistic.
    pooled = counted.where(rest).groupBy("statistic", "value").agg(F.sum("n").alias("n")).toPandas()
    shared = {}
    for name in STATISTICS:
        rows = pooled[pooled["statistic"] == name]
        shared[name] = certified_cutoff(rows["value"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), risk, level)

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values, n = rows["value"].to_numpy(), rows["n"].to_numpy()
        if key[0] in alone:
            cutoff = certified_cutoff(values, n, risk, level)
        else:
            dropped = np.cumsum(np.bincount(values, n, minlength=GRID + 2)[::-1])[::-1]
            cutoff = max(shared[key[1]], int(np.argmax(dropped <= risk * n.sum())))
        return pd.DataFrame({"stratum": [key[0]], "statistic": [key[1]], "cutoff": [cutoff]})

    chosen = counted.groupBy("stratum", "statistic").applyInPandas(
        choose, "stratum string, statistic string, cutoff int"
    )
    return chosen, shared


def judge(
    documents: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    risk: float = 0.005,
    error: float = 0.05,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and the statistics that rejected.

    ``risk`` bounds the share of good texts that one statistic drops in a family of strata,
    with probability ``1 - error`` over all families and statistics together.
    """
    small_batches(documents)
    text_counts = arrow_udf(count_texts, ", ".join(f"{name} bigint" for name in COUNTS))
    counted = documents.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("stratum"),
        text_counts("text").alias("c"),
    ).select("doc_id", "stratum", "c.*")
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    counted = Store(documents, "quality-rules").write(
        with_statistics(counted).select("*", base.alias("base_failed")), "counts"
    )
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    chosen, shared = cutoffs(counted.where("not base_failed").join(known, "doc_id"), risk, error)
    limits = chosen.groupBy("stratum").agg(
        *(F.max(F.when(F.col("statistic") == s, F.col("cutoff"))).alias(f"_{s}") for s in STATISTICS)
    )
    broken = F.filter(
        F.array(*(F.when(F.col(f"statistics.{s}") >= F.coalesce(f"_{s}", F.lit(shared[s])), F.lit(s)) for s in STATISTICS)),
        lambda name: name.isNotNull(),
    )
    # One row per stratum; adaptive execution broadcasts it if its size allows, and else splits hot strata.
    return counted.join(limits, "stratum", "left").select(
        "doc_id",
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & (F.size(broken) == 0)).alias("kept"),
        broken.alias("broken_rules"),
    )
