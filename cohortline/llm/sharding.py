"""Shards that all show the mixture of sources, by proportional stratified interleaving.

1. The rows of each source are put in a seeded random order and ranked.
2. A row's fractional rank is (rank - 1 + phase) / rows of its source. The phase, a seeded
   number of the source from 0 up to 1, spreads sources of few rows over all shards instead
   of the middle.
3. All rows are sorted by fractional rank and cut in ``shards`` runs whose numbers of rows
   differ by one at most (law ``rows``).

A run covers the same stretch of fractional ranks for every source, up to one row a source:
of a source with n of N rows, a shard of S sources holds n / shards rows, more or less
1 + S * n / N at most.

Both sorts are range partitions with the partitions' offsets; rows that are equal in all
compared values are told apart by a number, so that neither a hot source nor a row repeated
very often meets in one task. No window runs over a source, a shard or all rows.

Defined results: a null text is empty; a null or empty source is a source like any other; a
null id is an empty one in the order; repeated rows are placed one by one, in any order among
themselves; equal texts are placed independently; fewer rows than shards leave shards empty;
an empty table gives no rows; extra columns are passed on, but for those named like a column
that ``interleave`` adds, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.store import Store
from cohortline.operators.ranking import number_rows

SHARDS = 24
SEED = 20
LAW = "rows"
# What each row takes in a shard beside its text.
FRAMING_BYTES = 8


def _digest(seed: int, *parts: str | Column) -> Column:
    """60 random bits of a value."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts)), 1, 15), 16, 10).cast("bigint")


def measured(documents: DataFrame) -> DataFrame:
    """The documents with size (bytes of the text, and framing) and text_crc32."""
    text = F.coalesce("text", F.lit(""))
    return documents.withColumns(
        {
            "size": F.octet_length(text).cast("bigint") + FRAMING_BYTES,
            "text_crc32": F.crc32(text.cast("binary")),
        }
    )


def interleave(
    rows: DataFrame,
    by: str = "source",
    identity: Sequence[str] = ("doc_id", "text_crc32"),
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """The rows with shard (0 to ``shards`` - 1) and slot (from 0 in each shard).

    ``identity`` names the columns that decide a row's place among those of its source.
    """
    if shards < 1:
        raise ValueError(f"at least one shard, not {shards}")
    store = Store(rows, "sharding")
    kept = [name for name in rows.columns if name not in ("shard", "slot")]
    keyed = store.write(
        rows.select(
            F.struct(*kept).alias("row"),
            # A source is its text and whether there is any.
            F.struct(F.col(by).isNull().alias("none"), F.coalesce(F.col(by).cast("string"), F.lit("")).alias("name")).alias("stratum"),
            _digest(seed, *identity).alias("draw"),
        ).withColumn("repeat", F.monotonically_increasing_id()),
        "keyed",
    )
    identities = [F.col("row")[name] for name in identity]
    ordered = number_rows(keyed, "place", store.workspace, F.col("stratum"), F.col("draw"), *identities, F.col("repeat"))
    strata = store.write(
        ordered.groupBy("stratum").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size")), "strata"
    )
    total = strata.agg(F.sum("size")).first()[0] or 0
    phase = _digest(seed, F.col("stratum.none"), F.col("stratum.name")) / F.lit(float(1 << 60))
    ranked = ordered.join(strata, "stratum").select(
        "row", "stratum", "place", ((F.col("place") - F.col("first") + phase) / F.col("size")).alias("fraction")
    )
    cut = number_rows(ranked, "position", store.workspace, F.col("fraction"), F.col("stratum"), F.col("place"))
    position = F.col("position") - 1
    shard = F.expr(f"(position - 1) * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return cut.withColumn("shard", shard.cast("int")).select("row.*", "shard", (position - first).alias("slot"))


def shard_documents(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    The texts are read once, for their sizes and checksums, and are not sorted.
    """
    slim = measured(documents.select("doc_id", "source", "text")).drop("text")
    return interleave(slim, shards=shards, seed=seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(documents: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Whole documents in ``folder/shard=K``, files and rows in slot order, read back.

    A shard is as many files as its rows take, so that no task writes a whole one.
    """
    placed = interleave(measured(documents), shards=shards, seed=seed)
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .mode("overwrite")
        .parquet(folder)
    )
    return documents.sparkSession.read.parquet(folder)


ORACLE_SQL = f"""
WITH RECURSIVE crc_step(k, c, r) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT k, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, r + 1 FROM crc_step WHERE r < 8
), crc_table AS (SELECT list(c ORDER BY k) AS t FROM crc_step WHERE r = 8),
bytes AS (
  SELECT doc_id, source, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM documents
), measured AS (
  SELECT doc_id, source, len(b) + {FRAMING_BYTES} AS size,
    xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table
), drawn AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), text_crc32::VARCHAR)), 1, 15))::BIGINT AS draw,
    ('0x' || substr(md5(concat_ws(':', '{SEED}', (source IS NULL)::VARCHAR, coalesce(source, ''))), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE AS phase
  FROM measured
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST, text_crc32) AS place,
    count(*) OVER (PARTITION BY source) AS n
  FROM drawn
), positioned AS (
  SELECT *, row_number() OVER (
      ORDER BY (place - 1 + phase) / n, source IS NULL, coalesce(source, ''), place) - 1 AS position,
    count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, (position * {SHARDS} // total)::INTEGER AS shard,
  position - ((position * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} AS slot, NULL::INTEGER AS grown_shard
FROM positioned
"""
