"""Language identification by Bayesian fusion of four kinds of evidence.

1. Text: byte-trigram likelihoods, counted over all texts by their declared language.
2. Declared markup language: how often each declaration goes with each language, as
   the texts tell it, over all rows.
3. Address suffix and 4. host: prior language shares, smoothed hierarchically (all rows
   -> suffix -> host), from grouped counts over all rows.

The languages are the declared values that ``MIN_DECLARED`` rows or more have; a background
hypothesis, ``other``, with uniform trigrams and priors of its own, stands for every other
language and for junk, and what it wins is not kept.

The log-likelihood of a text, tempered because neighbouring trigrams depend on each
other, is added to the logs of the other terms; the posterior picks the language.

Defined results: a null or empty text, or one without letters, gives no text evidence,
is called ``und`` and is not kept; declarations are compared by their first letters in
lower case (``en-GB`` is ``en``); a missing or rare one is a declaration value of its own; a null host or suffix is a host or suffix like any other; ties go to
the language listed first, the background last; without declarations all is ``other``; repeated rows are judged one by one and counted each time;
an empty table gives an empty result; extra columns are ignored. A null key is a key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.store import Store, small_batches
from cohortline.llm.textscan import LOWER, Block, blocks, byte_class

OTHER = "other"
# Rows that must declare a value for it to be a language.
MIN_DECLARED = 5
BUCKETS = 1 << 14
TEMPER = 1 / 3
PRIOR_ROWS = 20.0
ACCEPT = 0.5

_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_FOLD = LOWER.copy()
_FOLD[~_LETTER] = 0x20


def trigrams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each byte, and whether it has a letter and stays in its text."""
    folded = _FOLD[block.data].astype(np.uint32)
    code = folded.copy()
    code[:-1] += folded[1:] << np.uint32(8)
    code[:-2] += folded[2:] << np.uint32(16)
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 14)
    letter = _LETTER[block.data]
    valid = letter.copy()
    valid[:-1] |= letter[1:]
    valid[:-2] |= letter[2:]
    last = block.offsets[1:]
    for back in (1, 2):
        at = last - back
        valid[at[at >= 0]] = False
    return bucket.astype(np.int64), valid


def declared_languages(documents: DataFrame, declared: Column) -> list[str]:
    """The values that enough rows declare, by name."""
    counted = documents.groupBy(declared.alias("declared")).agg(F.count(F.lit(1)).alias("n"))
    listed = counted.where((F.col("n") >= MIN_DECLARED) & (F.col("declared") != OTHER))
    return sorted(row["declared"] for row in listed.collect())


def trigram_counts(documents: DataFrame, declared: Column, text: str, languages: Sequence[str]) -> np.ndarray:
    """Trigram counts per language over all texts declared to be in it.

    Tasks count into one dense table, tables are summed by Spark, and the sum, of
    languages x BUCKETS numbers whatever the corpus, comes to the driver.
    """
    listed = documents.select(
        F.array_position(F.array(*map(F.lit, languages)), declared).alias("language"), F.col(text).alias("text")
    ).where("language > 0")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch in batches:
            language = batch.column("language").to_numpy(zero_copy_only=False).astype(np.int64) - 1
            for block in blocks(batch.column("text")):
                bucket, valid = trigrams(block)
                rows = language[block.first : block.first + len(block)]
                bucket += np.repeat(rows * BUCKETS, np.diff(block.offsets))
                table += np.bincount(bucket[valid], minlength=len(table))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(table[at], pa.int64())], ["cell", "n"])

    summed = listed.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(len(languages) * BUCKETS)
    table[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return table.reshape(len(languages), BUCKETS)


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """Smoothed log probabilities; a language without texts is as likely as the mean of the others."""
    smoothed = counts + 0.5
    logs = np.log(smoothed / smoothed.sum(1, keepdims=True))
    seen = counts.sum(1) > 0
    if seen.any() and not seen.all():
        logs[~seen] = logs[seen].mean(0)
    return logs.astype(np.float32)


def _text_evidence(logs: np.ndarray):
    def evidence(texts: pa.Array) -> pa.Array:
        rows = []
        for block in blocks(texts):
            bucket, valid = trigrams(block)
            table = np.empty((len(block), len(logs) + 1))
            table[:, 0] = block.per_text(_LETTER[block.data])
            chosen, kept = bucket[valid], np.concatenate([[0], np.cumsum(valid)])
            for k, row in enumerate(logs):
                sums = np.concatenate([[0.0], np.cumsum(row[chosen], dtype=np.float64)])
                table[:, k + 1] = sums[kept[block.offsets[1:]]] - sums[kept[block.offsets[:-1]]]
            rows.append(table)
        table = np.concatenate(rows) if rows else np.zeros((0, len(logs) + 1))
        flat = pa.array(table.ravel(), pa.float64())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * table.shape[1], pa.int32()), flat)

    return arrow_udf(evidence, "array<double>")


def _vector_sum(column: Column, size: int) -> Column:
    return F.array(*(F.sum(F.when(column == k + 1, 1).otherwise(0)) for k in range(size)))


def _total(column: Column) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)


def identify(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    languages: Sequence[str] | None = None,
    accept: float = ACCEPT,
) -> DataFrame:
    """key, language, probability, text_language, declared, letters, kept for every row.

    Languages that are not given are those declared.
    """
    none = F.lit(None).cast("string")
    declared, host, suffix = (none if part is None else part for part in (declared, host, suffix))
    small_batches(documents)
    spoken = F.nullif(F.lower(F.regexp_extract(declared, "^[ ]*([A-Za-z]+)", 1)), F.lit(""))
    if languages is None:
        listed = declared_languages(documents, spoken)
        counts = trigram_counts(documents, spoken, text, listed) if listed else np.zeros((0, BUCKETS))
        # A value declared for empty texts alone tells nothing.
        languages, counts = [name for name, n in zip(listed, counts.sum(1), strict=True) if n], counts[counts.sum(1) > 0]
    else:
        counts = trigram_counts(documents, spoken, text, languages)
    background = np.full((1, BUCKETS), -np.log(BUCKETS), np.float32)
    logs = np.concatenate([log_likelihoods(counts), background])
    languages = [*languages, OTHER]
    size, names = len(languages), F.array(*map(F.lit, languages))
    store = Store(documents, "language-id")
    read = documents.select(
        F.col(key).alias("key"),
        declared.alias("declared"),
        spoken.alias("spoken"),
        # A prefix keeps null apart from any string.
        *(F.coalesce(F.concat(F.lit("="), part), F.lit("")).alias(name) for name, part in (("host", host), ("suffix", suffix))),
        _text_evidence(logs)(F.col(text)).alias("found"),
    )
    told_by_text = F.array_max(F.transform("logs", lambda x, k: F.struct(x.alias("log"), (-k).alias("place"))))
    evidence = store.write(
        read.select(
            "key",
            "declared",
            "host",
            "suffix",
            F.element_at("found", 1).cast("long").alias("letters"),
            F.slice("found", 2, size).alias("logs"),
            F.coalesce(F.array_position(names, F.nullif(F.col("spoken"), F.lit(OTHER))), F.lit(0)).cast("int").alias("said"),
        )
        # 1..n for what the text tells best, null where it tells nothing.
        .withColumn("told", F.when(F.col("letters") > 0, 1 - told_by_text["place"])),
        "evidence",
    )
    told = evidence.where("told is not null")

    # n + 1 declarations by n languages, whatever the corpus.
    pairs = {(r["said"], r["told"]): r["n"] for r in told.groupBy("said", "told").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_language = [sum(pairs.get((said, k + 1), 0) for said in range(size + 1)) for k in range(size)]
    all_rows = sum(per_language)
    declarations = F.array(
        *(
            F.array(*(F.lit(float(np.log((pairs.get((said, k + 1), 0) + 1.0) / (per_language[k] + size + 1.0)))) for k in range(size)))
            for said in range(size + 1)
        )
    )
    overall = F.array(*(F.lit((n + 1.0) / (all_rows + size)) for n in per_language))

    def smoothed(counts: Column, prior: Column) -> Column:
        rows = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, prior, lambda n, p: (n + F.lit(PRIOR_ROWS) * p) / (rows + PRIOR_ROWS))

    hosts = told.groupBy("suffix", "host").agg(_vector_sum(F.col("told"), size).alias("host_counts"))
    sums = F.array(*(F.sum(F.col("host_counts")[k]) for k in range(size)))
    suffixes = hosts.groupBy("suffix").agg(sums.alias("suffix_counts"))
    priors = store.write(
        hosts.join(suffixes, "suffix").select(
            "suffix", "host", smoothed(F.col("host_counts"), smoothed(F.col("suffix_counts"), overall)).alias("prior")
        ),
        "priors",
    )
    # Rows here are a few numbers each; a hot host is split by adaptive execution.
    joined = evidence.join(priors, ["suffix", "host"], "left").withColumn("prior", F.coalesce("prior", overall))
    score = reduce(
        lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
        (
            F.transform("logs", lambda x: x * TEMPER),
            declarations[F.col("said")],
            F.transform("prior", lambda p: F.ln(p)),
        ),
    )
    # Ties go to the language listed first.
    first = F.array_max(F.transform("score", lambda x, k: F.struct(x.alias("score"), (-k).alias("place"))))
    scored = joined.withColumn("score", score).withColumn("first", first).select(
        "*", F.col("first.score").alias("best"), (-F.col("first.place")).alias("place")
    )
    weight = F.transform("score", lambda x: F.exp(x - F.col("best")))
    probability = 1 / _total(weight)
    known = F.col("letters") > 0
    return scored.select(
        F.col("key").alias(key),
        F.when(known, F.get(names, F.col("place"))).otherwise("und").alias("language"),
        F.when(known, probability).otherwise(0.0).alias("probability"),
        F.coalesce(F.get(names, F.col("told") - 1), F.lit("und")).alias("text_language"),
        "declared",
        "letters",
        (known & (probability >= accept) & (F.col("place") < size - 1)).alias("kept"),
    )


def accepted(documents: DataFrame, decisions: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose id has an accepted row; a null id is an id."""
    kept = decisions.where("kept").select(F.col(key).alias("_kept_key")).distinct()
    return documents.join(kept, documents[key].eqNullSafe(kept["_kept_key"]), "left_semi")


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, host, suffix of raw pages: the text without markup, the lang
    attribute of the html element, the address's host and its last label."""
    html = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract(F.lower("url"), r"^[a-z]+://(?:[^/@]*@)?([^/:?#]+)", 1)
    return pages.select(
        "page_id",
        bare.alias("text"),
        F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit("")).alias("suffix"),
    )
