"""Spelling variants of words, by asymmetric q-chunks.

1. ``word_counts``: words are the maximal runs of letters A-Z, a-z and U+00C0 to U+00FF in
   whole texts, lower-cased from A to Z only, counted over all rows. ``noise`` deletes one
   letter of about every 97th run, told by its document and run, as a typing error would.
2. ``near_words``: pairs of counted words that differ by exactly one inserted, deleted or
   replaced letter. The shorter word of a pair (either, at equal length) contributes two
   disjoint chunks, its halves; the other one contributes its positional grams. One edit
   leaves one chunk whole, and moves it by one place at most: the first half stands where it
   stood, the second half too or one place on. The grams elsewhere cannot meet a chunk within
   that shift and are not posted. Words are joined on (length, place, gram) and verified.
   A chunk that very many words share is not joined: for its words the half that the edit
   must lie in is cut in two, the chunk grows by one of its quarters, and so on. At a single
   letter, a chunk is all but that letter, and the alphabet bounds the words that share it.
   So no group gives more pairs than ``MOST_PAIRS`` or the alphabet allow, and no link is lost.
3. ``variants``: a word's form is the near word of largest count, if it has at least twice the
   word's; its root is the last of the chain of forms, found by doubling.

Defined results: a null or empty text has no words; a null id is empty in the noise's key; a
run of any length is one word; words of equal count tie in code-point order; repeated rows
count each time; an empty table has no words; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.store import Store
from cohortline.llm.textscan import LOWER, Block, blocks, byte_class

LEAST_LETTERS = 5
LEAST_COUNT = 3
NOISE = 97
# Pairs of words that one chunk may give before it is cut further.
MOST_PAIRS = 1_000
# Runs longer than this are hashed one by one.
_HASHED_TOGETHER = 64
# Distinct words a task gathers before it passes them on.
_FLUSH = 400_000

_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
# U+00C0 to U+00FF are the two-byte characters that begin with this byte.
_LATIN = 0xC3
_CONTINUED = byte_class((0x80, 0xBF))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def runs_of_letters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    latin = block.data == _LATIN
    inside = _LETTER[block.data] | latin
    inside[1:] |= latin[:-1]
    return block.runs_where(inside)


def crc_of_runs(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each run's bytes, continued from the CRC-32 of what stands before it."""
    lengths = ends - starts
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-lengths, kind="stable")
    order = order[int((lengths > _HASHED_TOGETHER).sum()) :]
    at, left, now = starts[order], lengths[order], state[order]
    for k in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -k, "left"))
        now[:live] = _CRC[(now[:live] ^ lower[at[:live] + k]) & np.uint32(0xFF)] ^ (now[:live] >> np.uint32(8))
    state[order] = now
    result = state ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(lengths > _HASHED_TOGETHER).tolist():
        result[k] = zlib.crc32(lower[starts[k] : ends[k]].tobytes(), int(before[k]))
    return result


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as texts."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    taken = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(taken))


def block_words(block: Block, ids: list, least_letters: int, noise: int | None) -> list[pa.Array]:
    """The words of a block's texts, those that noise changed in an array of their own."""
    starts, ends = runs_of_letters(block)
    lower = LOWER[block.data]
    letters = np.concatenate([[0], np.cumsum(~_CONTINUED[block.data])])
    size = letters[ends] - letters[starts]
    changed, words = np.zeros(len(starts), bool), []
    if noise:
        per_text = np.diff(np.searchsorted(starts, block.offsets))
        heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        draw = crc_of_runs(lower, starts, ends, np.repeat(heads, per_text))
        changed = draw % noise == 0
        for k in np.flatnonzero(changed & (size > least_letters)).tolist():
            word = lower[starts[k] : ends[k]].tobytes().decode()
            gone = int(draw[k]) % len(word)
            words.append(word[:gone] + word[gone + 1 :])
    whole = ~changed & (size >= least_letters)
    return [_spans(lower, starts[whole], ends[whole]), pa.array(words, pa.large_string())]


def _counted(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _count_words(least_letters: int, noise: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for block in blocks(batch.column("text")):
                for words in block_words(block, ids[block.first : block.first + len(block)], least_letters, noise):
                    found = pc.value_counts(words)
                    held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                    size += len(found)
                if size > _FLUSH:
                    held = [_counted(held)]
                    size = len(held[0])
                    if size > _FLUSH // 2:
                        yield from held[0].to_batches(50_000)
                        held, size = [], 0
        if held:
            yield from _counted(held).to_batches(50_000)

    return count


def word_counts(
    documents: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    noise: int | None = NOISE,
) -> DataFrame:
    """word, n: every word of at least so many letters and occurrences, counted over all texts."""
    counted = documents.select("doc_id", "text").mapInArrow(_count_words(least_letters, noise), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _chunk_key(inserted: Column) -> Column:
    """What stands before and behind the stretch ``low`` to ``high`` of a word, with its place; a
    word with an inserted letter has a stretch longer by one."""
    before = F.expr("substring(word, 1, low)")
    behind = F.substring("word", F.col("high") + 1 + inserted.cast("int"), F.length("word"))
    return F.xxhash64("length", "low", "high", before, behind)


def _posted(places: DataFrame) -> DataFrame:
    return places.withColumn("key", _chunk_key(F.col("inserted")))


def _halves(low: Column, high: Column) -> Column:
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))


def _cut(places: DataFrame) -> DataFrame:
    """Every stretch in which an edit may lie as its two halves; a chunk is what lies outside."""
    return places.withColumn("half", F.explode(_halves(F.col("low"), F.col("high")))).select(
        "word", "n", "length", "inserted", "half.low", "half.high"
    )


def near_words(words: DataFrame, store: Store, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """one, one_n, two, two_n: every pair of words (with n) one edit apart, once; one is the shorter
    or, at equal length, the first."""
    length = F.length("word")
    zero = F.lit(0)
    # As the word of a pair that contributes chunks, or grams of its own length, and as the longer one.
    roles = F.array(
        F.struct(length.alias("length"), F.lit(False).alias("inserted")),
        F.struct((length - 1).alias("length"), F.lit(True).alias("inserted")),
    )
    places = words.select("word", "n", F.inline(roles)).where("length > 0")
    places = _cut(places.select("*", zero.alias("low"), F.col("length").alias("high")))
    found = []
    while True:
        posted = store.write(_posted(places), "chunks")
        sizes = posted.groupBy("key").agg(
            F.count_if(~F.col("inserted")).alias("own"), F.count_if("inserted").alias("longer")
        )
        pairs = F.expr("own * (own - 1) div 2 + own * longer")
        shared = sizes.where(pairs > 0).select("key", (pairs > most_pairs).alias("hot"))
        held = store.write(
            posted.join(shared, "key").withColumn("hot", F.col("hot") & (F.col("high") - F.col("low") > 1)), "shared"
        )
        ready = held.where("not hot")
        chunks = ready.where("not inserted").select("key", F.col("word").alias("one"), F.col("n").alias("one_n"))
        grams = ready.select("key", F.col("word").alias("two"), F.col("n").alias("two_n"), "inserted")
        met = chunks.join(grams, "key").where("inserted or one < two").where(F.levenshtein("one", "two", 1) == 1)
        found.append(store.write(met.select("one", "one_n", "two", "two_n").distinct(), "pairs"))
        hot = held.where("hot")
        if hot.isEmpty():
            break
        places = _cut(hot)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs if len(found) == 1 else pairs.distinct()


def _roots(forms: DataFrame, store: Store) -> DataFrame:
    """word, root of every word with a form; counts at least double along a chain, so it is short."""
    steps = store.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = store.write(
            steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        steps = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return steps


def variants(documents: DataFrame, noise: int | None = NOISE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every counted word."""
    store = Store(documents, "spelling")
    words = store.write(word_counts(documents, noise=noise), "words")
    pairs = near_words(words, store)
    both = pairs.select(F.col("one").alias("word"), F.col("two").alias("near"), F.col("two_n").alias("near_n")).union(
        pairs.select(F.col("two").alias("word"), F.col("one").alias("near"), F.col("one_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    enough = -F.col("best.less") >= 2 * F.col("n")
    formed = store.write(
        words.join(best, "word", "left").select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null"), store)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# Words that lose one letter at the same place, or one of which loses a letter to be the other, are near.
ORACLE_SQL = f"""
WITH RECURSIVE crc_step(k, c, r) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT k, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, r + 1 FROM crc_step WHERE r < 8
), crc_table AS (SELECT list(c ORDER BY k) AS t FROM crc_step WHERE r = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
      regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM counted, crc_table
), words AS (
  SELECT CASE WHEN h % {NOISE} = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), shorter AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN vocabulary b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word
), formed AS (
  SELECT v.word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
