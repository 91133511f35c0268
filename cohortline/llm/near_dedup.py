"""Near-duplicate documents by a signature-coordinate inverted join.

A document is its set of distinct shingles of ``width`` words. Its MinHash signature has
``COORDINATES`` values.

1. Documents with the same set are one class, represented by the smallest id.
2. Representatives are posted under each of their first ``POSTED`` (coordinate, value)
   pairs. Two documents that agree in ``m`` of them or more must share one of the rarest
   ``POSTED - m + 1`` pairs of each (prefix merging, rarest first), so only
   those postings, and only pairs held twice, are merged. Common pairs come last and are
   never merged; agreement in them is counted by looking into the signatures instead
   (skip merging).
3. Merging postings gives groups of documents that may be linked. Groups are dealt in
   blocks, a large one in many. In a block, collisions over all coordinates are counted
   as arrays, and pairs with enough of them are confirmed on the full sets, most
   collisions first; a pair that confirmed links already connect is passed over, so a
   block gives one link fewer than it has documents at most. Every block of a group also
   holds the same few pivots, which ties the blocks of copies together. Blocks of groups
   that are not one component by then meet in pairs, passing over what is connected.
4. Components of the confirmed links are the answer. They are those of all links: what
   was passed over was connected.

The numbers of agreements asked for in 2 and 3 are set from exact binomial tails, so that
a pair at the similarity bound is missed in each with a probability below ``MISSED``, and
a closer pair with less.

Defined results: a null or empty text, or one without words, has an empty set and is
linked with nothing; a text of fewer words than ``width`` is one shingle; rows with one
id are one document, whose set is that of smallest digest among its texts; a null id is
linked with nothing, its component is null and it is kept; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.components import components
from cohortline.llm.store import Store, small_batches
from cohortline.llm.textscan import LOWER, NOT_SPACE, Block, SpanHash, blocks, random_words, window_hashes, window_starts

WIDTH = 5
PERCENT = 85
COORDINATES = 128
POSTED = 40
# Probability, for each count, that a pair at the similarity bound has too few collisions.
MISSED = 1e-5
# Documents, and shingles in all, of a block; a larger group is cut into blocks.
BLOCK = 768
BLOCK_SHINGLES = 4 << 20
# Documents, about, that are in every block of a group.
PIVOTS = 32
MEMBER = ("own", "id", "n", "label", "large", "signature", "shingles")
# Documents of a group whose links one task resolves; those of larger groups take distributed rounds.
RESOLVED_AT_ONCE = 200_000
LINKS = "group bigint, large boolean, one bigint, two bigint"


def least_matches(coordinates: int, percent: int, missed: float = MISSED) -> int:
    """The largest m with P(X < m) <= missed, X ~ Binomial(coordinates, percent / 100)."""
    tail, m = 0.0, 0
    while m < coordinates:
        tail += comb(coordinates, m) * (percent / 100) ** m * (1 - percent / 100) ** (coordinates - m)
        if tail > missed:
            break
        m += 1
    return max(1, m)


def shingles(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts of a block, and where each text's begin."""
    starts, ends = block.runs(NOT_SPACE)
    first = np.searchsorted(starts, block.offsets)
    words = SpanHash(block.data, LOWER)(starts, ends)
    counts = np.diff(first)
    hashes = window_hashes(words, width)
    kept = hashes[window_starts(first, width)[: len(hashes)]]
    per_text = np.maximum(0, counts - width + 1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    if len(short):
        whole = [window_hashes(words[first[k] : first[k + 1]], int(counts[k]), seed=13)[0] for k in short.tolist()]
        kept = np.insert(kept, bounds[short], np.array(whole, np.uint64))
        per_text[short] = 1
        bounds = np.concatenate([[0], np.cumsum(per_text)])
    return kept, bounds


def _distinct(hashes: np.ndarray) -> np.ndarray:
    ordered = np.sort(hashes)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


def _digest(members: bytes) -> bytes:
    return hashlib.blake2b(members, digest_size=16).digest()


def signatures(width: int):
    factors = random_words(COORDINATES, 17)

    def sign(texts: pa.Array) -> pa.Array:
        sizes, names, values = [], [], []
        for block in blocks(texts):
            hashes, bounds = shingles(block, width)
            filled = np.flatnonzero(np.diff(bounds))
            table = np.zeros((len(block), COORDINATES), np.uint32)
            if len(filled):
                for k, factor in enumerate(factors):
                    ranks = ((hashes * factor) >> np.uint64(32)).astype(np.uint32)
                    table[filled, k] = np.minimum.reduceat(ranks, bounds[filled])
            values.append(table.view(np.int32))
            for k in range(len(block)):
                own = _distinct(hashes[bounds[k] : bounds[k + 1]])
                sizes.append(len(own))
                names.append(_digest(own.tobytes()) if len(own) else None)
        flat = np.concatenate(values) if values else np.zeros((0, COORDINATES), np.int32)
        offsets = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * COORDINATES)
        signature = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), pa.int32()))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), signature], ["n", "same", "signature"]
        )

    return arrow_udf(sign, "n bigint, same binary, signature array<int>")


def full_sets(width: int):
    def gather(texts: pa.Array) -> pa.Array:
        sets = []
        for block in blocks(texts):
            hashes, bounds = shingles(block, width)
            sets += [_distinct(hashes[bounds[k] : bounds[k + 1]]).tobytes() for k in range(len(block))]
        names = [_digest(members) for members in sets]
        return pa.StructArray.from_arrays([pa.array(sets, pa.binary()), pa.array(names, pa.binary())], ["shingles", "same"])

    return arrow_udf(gather, "shingles binary, same binary")


def posted_groups(signed: DataFrame, matches: int, store: Store) -> DataFrame:
    """id, component: groups of representatives whose rarest postings meet."""
    postings = signed.select("id", F.posexplode(F.slice("signature", 1, POSTED)).alias("k", "value")).select(
        "id", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("value").cast("long")).alias("key")
    )
    held = postings.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = postings.join(held, "key").groupBy("id").agg(
        # At most POSTED entries.
        F.sort_array(F.collect_list(F.struct("held", "key"))).alias("entries")
    )
    # The pairs held by one document alone are the rarest; what they leave of the prefix is merged.
    prefix = shared.where(F.size("entries") >= matches).select(
        "id", F.explode(F.slice("entries", 1, F.size("entries") - (matches - 1))).alias("entry")
    )
    prefix = store.write(prefix.select("id", "entry.key"), "prefix")
    firsts = prefix.groupBy("key").agg(F.min("id").alias("least"))
    links = prefix.join(firsts, "key").where("id != least").select("id", "least").distinct()
    return components(links, store)


def _members(grouped: DataFrame) -> DataFrame:
    """Members with their group's number of blocks, their own, and whether they are pivots.

    Blocks are dealt by a hash of the id, so no task sees a whole large group.
    """
    sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingled"))
    parts = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingled") / BLOCK_SHINGLES)).cast("int")
    sized = grouped.join(sizes, "group").withColumn("parts", parts)
    return sized.select(
        "group",
        "parts",
        F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("own"),
        ((F.col("parts") > 1) & (F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.lit(1), F.expr(f"size div {PIVOTS}"))) == 0)).alias("pivot"),
        "id",
        "n",
        "label",
        (F.col("size") > RESOLVED_AT_ONCE).alias("large"),
        "signature",
        "shingles",
    )


def _in_blocks(members: DataFrame) -> DataFrame:
    blocks = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))
    return members.select("group", F.explode(blocks).alias("low"), F.lit(-1).alias("high"), *MEMBER)


def _in_pairs_of_blocks(members: DataFrame) -> DataFrame:
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: other != F.col("own"))
    pairs = F.transform(others, lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high")))
    return members.withColumn("pair", F.explode(pairs)).select("group", "pair.low", "pair.high", *MEMBER)


def _collisions(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(one), len(two)), np.int16)
    for k in range(COORDINATES):
        counts += one[:, k, None] == two[None, :, k]
    return counts


def _forest(percent: int):
    """Confirmed links of a block, or between two blocks, that connect what was not yet."""
    sure = least_matches(COORDINATES, percent)

    def confirm(table: pa.Table) -> pa.Table:
        # Sorted by id, so that repeated runs give the same links.
        table = table.sort_by("id")
        ids, sizes, labels, own = (table[name].to_numpy() for name in ("id", "n", "label", "own"))
        signature = np.array(table["signature"].combine_chunks().flatten()).reshape(len(table), COORDINATES)
        crossing = table["high"][0].as_py() >= 0
        a = np.flatnonzero(own == table["low"][0].as_py()) if crossing else np.arange(len(table))
        b = np.flatnonzero(own == table["high"][0].as_py()) if crossing else a
        counts = _collisions(signature[a], signature[b])
        small, big = np.minimum(sizes[a][:, None], sizes[b]), np.maximum(sizes[a][:, None], sizes[b])
        fits = (counts >= sure) & (small * 100 >= big * percent) & (labels[a][:, None] != labels[b])
        row, column = np.nonzero(fits if crossing else np.triu(fits, 1))
        best = np.argsort(-counts[row, column], kind="stable")
        sets = {}
        root = {label: label for label in labels.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def full(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = np.frombuffer(table["shingles"][k].as_py(), np.uint64)
            return sets[k]

        links = []
        for i, j in zip(a[row[best]].tolist(), b[column[best]].tolist(), strict=True):
            one, two = find(int(labels[i])), find(int(labels[j]))
            if one == two:
                continue
            shared = len(np.intersect1d(full(i), full(j), assume_unique=True))
            if shared * 100 >= (int(sizes[i]) + int(sizes[j]) - shared) * percent:
                root[max(one, two)] = min(one, two)
                links.append((int(ids[i]), int(ids[j])))
        return pa.table(
            {
                "group": pa.array([table["group"][0].as_py()] * len(links), pa.int64()),
                "large": pa.array([table["large"][0].as_py()] * len(links), pa.bool_()),
                "one": pa.array([i for i, _ in links], pa.int64()),
                "two": pa.array([j for _, j in links], pa.int64()),
            }
        )

    return confirm


def _resolve(table: pa.Table) -> pa.Table:
    """id, component of the links of one group."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for one, two in zip(table["one"].to_pylist(), table["two"].to_pylist(), strict=True):
        one, two = find(one), find(two)
        root[max(one, two)] = min(one, two)
    ids = list(root)
    return pa.table({"id": pa.array(ids, pa.int64()), "component": pa.array([find(x) for x in ids], pa.int64())})


def _components_of(links: DataFrame, store: Store) -> DataFrame:
    """id, component of confirmed links; links never leave their group."""
    within = links.where("not large").groupBy("group").applyInArrow(_resolve, "id bigint, component bigint")
    beyond = links.where("large").select("one", "two")
    return within if beyond.isEmpty() else within.union(components(beyond, store))


def link(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links are confirmed exactly."""
    small_batches(documents)
    store = Store(documents, "near-dedup")
    signed = store.write(
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .select("doc_id", signatures(width)("text").alias("s"))
        .select("doc_id", "s.*"),
        "signatures",
    )
    named = signed.where("doc_id is not null and n > 0")
    # One set per id and one id per set; both reductions combine before the shuffle.
    by_id = named.groupBy("doc_id").agg(F.min("same").alias("same"))
    classes = store.write(by_id.groupBy("same").agg(F.min("doc_id").alias("id")), "classes")
    classed = store.write(by_id.join(classes, "same").select("doc_id", "id", "same"), "members")
    representatives = store.write(
        named.join(classes.select(F.col("id").alias("doc_id"), "same"), ["doc_id", "same"])
        .dropDuplicates(["doc_id"])
        .select(F.col("doc_id").alias("id"), "same", "n", "signature"),
        "representatives",
    )
    groups = store.write(posted_groups(representatives, least_matches(POSTED, percent), store).select("id", F.col("component").alias("group")), "groups")
    named_groups = store.write(representatives.join(groups, "id"), "grouped")
    grouped = named_groups.drop("same")

    gather = full_sets(width)
    texts = documents.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sets = texts.join(groups.select("id").hint("shuffle_hash"), "id", "left_semi")
    sets = store.write(
        # Of an id's texts, that whose signature stands for it.
        sets.select("id", gather("text").alias("s"))
        .select("id", "s.*")
        .join(named_groups.select("id", "same"), ["id", "same"], "left_semi")
        .select("id", "shingles"),
        "sets",
    )

    def confirmed(dealt: DataFrame) -> DataFrame:
        found = dealt.groupBy("group", "low", "high").applyInArrow(_forest(percent), LINKS)
        return store.write(found, "confirmed")

    whole = grouped.join(sets.select("id", "shingles"), "id")
    links = confirmed(_in_blocks(_members(whole.withColumn("label", F.col("id")))))
    labels = store.write(_components_of(links, store), "labels")
    labelled = grouped.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    # Groups of one block, or of one component, have nothing left to compare.
    spread = _members(labelled.withColumn("shingles", F.lit(None))).where("parts > 1")
    open_groups = spread.groupBy("group").agg((F.min("label") != F.max("label")).alias("open")).where("open")
    open_members = spread.drop("shingles").join(open_groups.select("group"), "group", "left_semi")
    more = confirmed(_in_pairs_of_blocks(open_members.join(sets.select("id", "shingles"), "id")))
    final = store.write(_components_of(links.union(more), store), "components")

    placed = classed.join(final, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    return (
        signed.select("doc_id", "n")
        .join(placed, "doc_id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def one_of_each(documents: DataFrame, links: DataFrame) -> DataFrame:
    """The documents that ``link`` keeps, with the columns they came with."""
    gone = links.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone.hint("shuffle_hash"), documents["doc_id"] == gone["_gone"], "left_anti")
