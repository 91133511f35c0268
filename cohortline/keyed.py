"""Tables stored in hash buckets of their key, of which a change rewrites only what it touches.

A state is a manifest: the bucket count, the folder of every bucket, and how far the source
has been taken in. A change writes the touched buckets to a folder of its own and then
publishes a manifest that points to them and to the other buckets as they were. Until that
one write, and after a crash before it, readers see the former state. Both the number of
buckets and the manifest are independent of the rows.

Keys are hashed and unique within a table of records, so a bucket is an even share of it.
A key that very many incoming rows hold is reduced to its last one before rows are dealt
to buckets.

Stored rows that a change does not concern are written as they lie: the changed keys are a
bitmap of their hashes, and only rows of a hash in it meet the incoming rows. These are shuffled
once, to parts of buckets, by the key, of about ROWS_A_TASK rows each. A bucket is a file for each
of its parts and of the tasks that copy it, so neither a task nor a file grows with the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from cohortline.manifest import Manifests
from cohortline.operators.dedupe import latest_by_key
from cohortline.workspace import CODEC

BUCKETS = 64
BUCKET, PART = "_bucket", "_part"
ROWS_A_TASK = 50_000
# Parts to a task: of so many that hashing deals them out evenly.
PARTS_A_TASK = 4
CHANGED, BEFORE = "_changed_in", "_before"
# The hash whose rest is the bucket, as Spark's own bucketed tables have it; states that tell none are of the other.
HASHES = {"murmur3": F.hash, "xxhash64": F.xxhash64}
HASH, FORMER_HASH = "murmur3", "xxhash64"
# Bits of the bitmap for each changed key, and at most in all (32 MB); beyond, more rows are shuffled than need be.
BITS_A_KEY, MOST_BITS = 16, 1 << 28
# Bits in one row of the bitmap, as Spark's bitmap functions hold them.
CELL = 1 << 15
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _writers(spark: SparkSession, files: int) -> Iterator[None]:
    """A task keeps so many files open and need not sort its rows by file."""
    former = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(files))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, former)


class KeyedStore:
    """One table below ``folder``. ``tracked`` keeps which rows a merge changed, and what they were."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: str | Sequence[str],
        schema: StructType,
        buckets: int = BUCKETS,
        tracked: bool = False,
    ):
        self.spark, self.folder = spark, folder
        self.key = [key] if isinstance(key, str) else list(key)
        self.schema, self.buckets, self.tracked = schema, buckets, tracked
        self.manifests = Manifests(spark, f"{folder}/manifests")

    # Reading

    @property
    def version(self) -> int:
        versions = self.manifests.versions()
        return versions[-1] if versions else 0

    @property
    def progress(self) -> int:
        """How far the source has been taken in, -1 before the first change."""
        return self.manifests.newest()[1].get("progress", -1)

    def _stored(self, state: dict, only: set[int] | None = None) -> DataFrame:
        schema = self.schema
        if self.tracked:
            schema = StructType(list(schema)).add(CHANGED, LongType()).add(BEFORE, self.schema)
        paths = [f"{self.folder}/{path}" for bucket, path in state.get("files", {}).items() if only is None or int(bucket) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version or of a former one that has not been removed."""
        state = self.manifests.newest()[1] if version is None else self.manifests.read(version) if version else {}
        return self._stored(state).select(*self.schema.names)

    def changes(self, version: int) -> DataFrame:
        """Key, ``before`` and ``after`` (structs) of the rows that a version changed; before is null for a new key.

        Only the buckets which that version wrote are read.
        """
        state = self.manifests.read(version)
        own = {"files": {b: path for b, path in state["files"].items() if path.startswith(f"{state['data']}/")}}
        changed = self._stored(own).where(F.col(CHANGED) == version)
        return changed.select(*self.key, F.col(BEFORE).alias("before"), F.struct(*self.schema.names).alias("after"))

    # Writing

    def _bucket(self, buckets: int, named: str = HASH) -> Column:
        return F.pmod(HASHES[named](*self.key), F.lit(buckets)).cast("int")

    def _spread(self, frame: DataFrame, buckets: int, rows: int) -> DataFrame:
        """``frame``, of about so many rows, shuffled by bucket and part (columns)."""
        tasks = -(-rows // ROWS_A_TASK)
        parts = -(-tasks * PARTS_A_TASK // buckets) if tasks > 1 else 1
        # Of another hash than the bucket.
        part = F.pmod(F.shiftrightunsigned(F.xxhash64(*self.key), 32), F.lit(parts)).cast("int")
        return frame.withColumn(PART, part).repartition(max(1, tasks), BUCKET, PART)

    def _concerned(self, existing: DataFrame, keys: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        """Stored rows whose key may be one of these ``n`` keys, and those whose key is surely not."""
        bits = min(-(-max(1, n) * BITS_A_KEY // CELL) * CELL, MOST_BITS)
        place = F.pmod(F.xxhash64(*self.key), F.lit(bits))
        cell, bit = F.shiftright(place, 15).cast("int"), place.bitwiseAND(CELL - 1)
        marks = keys.select(cell.alias("_cell"), bit.alias("_bit"))
        bitmap = F.broadcast(marks.groupBy("_cell").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
        octet = F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
        hit = F.getbit(F.conv(F.hex(octet), 16, 10).cast("int"), bit.bitwiseAND(7).cast("int")) == 1
        screened = existing.withColumn("_cell", cell).join(bitmap, "_cell", "left").withColumn("_hit", F.coalesce(hit, F.lit(False)))
        return screened.where("_hit").select(*existing.columns), screened.where("not _hit").select(*existing.columns)

    def _copied(self, rows: DataFrame) -> DataFrame:
        """Rows without a former state: new ones, or those that a version does not change."""
        return rows.withColumn(BEFORE, F.lit(None).cast(self.schema)) if self.tracked else rows

    def _write(self, rows: DataFrame, data: str, buckets: int) -> dict[str, str]:
        """Write rows as they lie; the folder of each bucket."""
        with _writers(self.spark, min(buckets, BUCKETS)):
            rows.write.partitionBy(BUCKET).parquet(f"{self.folder}/{data}", compression=CODEC)
        names = self.manifests.folders(f"{self.folder}/{data}")
        return {name.removeprefix(f"{BUCKET}="): f"{data}/{name}" for name in names}

    def _rewrite(
        self,
        incoming: DataFrame,
        combine: Callable[[DataFrame | None, DataFrame, int, int, int, Column], DataFrame],
        progress: int | None,
        last: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Replace the buckets of ``incoming`` by what ``combine`` makes of their rows and it.

        ``combine`` gets the stored rows that may have one of the incoming keys, None where the
        buckets hold no rows; the other stored rows are copied. It is also told the new version,
        the number of buckets and that of the rows it is given, and the bucket of a row. ``last``
        leaves one row a key; it is called only where incoming keys, or hashes of theirs, repeat.
        """
        since, state = self.manifests.newest()
        buckets = state.get("buckets", self.buckets)
        named = state.get("hash", FORMER_HASH) if state else HASH
        bucket = self._bucket(buckets, named)
        dealt = incoming.withColumn(BUCKET, bucket)
        of_key = dealt.groupBy(BUCKET, F.xxhash64(*self.key)) if last else dealt.groupBy(BUCKET)
        counts = of_key.agg(F.count(F.lit(1)).alias("n")).groupBy(BUCKET)
        # At most as many rows as there are buckets come to the driver.
        touched = {r[BUCKET]: r for r in counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).collect()}
        files = {b: path for b, path in state.get("files", {}).items() if int(b) not in touched}
        data = f"data/{since + 1:012d}-{uuid.uuid4().hex[:8]}"
        if touched:
            if last and max(r["most"] for r in touched.values()) > 1:
                dealt = last(dealt)
            rows = whole = sum(r["rows"] for r in touched.values())
            if touched.keys().isdisjoint(int(b) for b in state.get("files", {})):
                result = combine(None, dealt, since + 1, buckets, rows, bucket)
            else:
                stored = self._stored(state, set(touched)).withColumn(BUCKET, bucket)
                concerned, others = self._concerned(stored, dealt, rows)
                rows, whole = rows + concerned.count(), whole + stored.count()
                result = combine(concerned, dealt, since + 1, buckets, rows, bucket).unionByName(self._copied(others))
            # A small change is few files.
            files |= self._write(result.coalesce(-(-whole // ROWS_A_TASK)), data, buckets)
        taken = state.get("progress", -1) if progress is None else progress
        content = {"buckets": buckets, "hash": named, "files": files, "data": data, "progress": taken}
        return self.manifests.commit(since, content)

    def merge(self, incoming: DataFrame, order: tuple[str, ...], progress: int | None = None) -> int:
        """Take in versions of records, the last in ``order`` winning, and incoming ones over stored
        ones of the same place; returns the new version."""
        kept = self.schema.names
        placed = Window.partitionBy(BUCKET, PART, *self.key).orderBy(*(F.col(c).desc() for c in order), F.col("_late").desc())

        def last(dealt: DataFrame) -> DataFrame:
            return latest_by_key(dealt.select(*kept, BUCKET), [BUCKET, *self.key], order)

        def combine(existing: DataFrame | None, dealt: DataFrame, version: int, buckets: int, rows: int, bucket: Column) -> DataFrame:
            if existing is None:
                new = dealt.select(*kept, BUCKET)
                return self._copied(new.withColumn(CHANGED, F.lit(version).cast("bigint"))) if self.tracked else new
            late = dealt.select(*kept, BUCKET).withColumn("_late", F.lit(True))
            both = self._spread(existing.withColumn("_late", F.lit(False)).unionByName(late, allowMissingColumns=True), buckets, rows)
            # Two rows a key at most: the stored and the last incoming one.
            ranked = both.withColumn("_former", F.lead(F.struct(*kept)).over(placed)).withColumn("_n", F.row_number().over(placed))
            won = ranked.where("_n = 1")
            if not self.tracked:
                return won.select(*kept, BUCKET)
            late = F.col("_late")
            return won.select(
                *kept,
                F.when(late, F.lit(version)).otherwise(F.col(CHANGED)).cast("bigint").alias(CHANGED),
                F.when(late, F.col("_former")).alias(BEFORE),
                BUCKET,
            )

        return self._rewrite(incoming, combine, progress, last)

    def replace(self, keys: DataFrame, rows: DataFrame, progress: int | None = None) -> int:
        """All rows of these keys (one row each) become ``rows``, which may be none or several a key.

        ``rows`` are written as they lie. They should lie by buckets, as what is read from another
        store of the same keys does: a task writes one file for each bucket that it has rows of.
        """
        kept = self.schema.names
        of_key = Window.partitionBy(BUCKET, PART, *self.key)

        def combine(existing: DataFrame | None, dealt: DataFrame, version: int, buckets: int, n: int, bucket: Column) -> DataFrame:
            new = rows.select(*kept).withColumn(BUCKET, bucket)
            if existing is None:
                return new
            marks = dealt.select(BUCKET, *self.key).withColumn("_goes", F.lit(True))
            both = self._spread(existing.withColumn("_goes", F.lit(False)).unionByName(marks, allowMissingColumns=True), buckets, n)
            known = reduce(and_, (F.col(name).isNotNull() for name in self.key))
            marked = both.withColumn("_gone", F.max("_goes").over(of_key) & known)
            left = marked.where(~F.col("_gone") & ~F.col("_goes")).select(*kept, BUCKET)
            return left.unionByName(new)

        return self._rewrite(keys.select(*self.key), combine, progress)

    def add(self, deltas: DataFrame, rows: str, progress: int | None = None) -> int:
        """Signed amounts are added to the stored ones of their key; a key of no ``rows`` any more goes."""
        amounts = [name for name in self.schema.names if name not in self.key]

        def combine(existing: DataFrame | None, dealt: DataFrame, version: int, buckets: int, n: int, bucket: Column) -> DataFrame:
            both = dealt.select(*self.schema.names, BUCKET)
            both = self._spread(both if existing is None else existing.unionByName(both), buckets, n)
            summed = both.groupBy(BUCKET, PART, *self.key).agg(*(F.sum(name).alias(name) for name in amounts))
            return summed.where(F.col(rows) != 0).select(*self.schema.names, BUCKET)

        return self._rewrite(deltas, combine, progress)

    def rebucket(self, buckets: int) -> int:
        """The same rows in another number of buckets, for a table that has grown."""
        since, state = self.manifests.newest()
        data = f"data/{since + 1:012d}-{uuid.uuid4().hex[:8]}"
        stored = self._stored(state)
        rows = self._spread(stored.withColumn(BUCKET, self._bucket(buckets)), buckets, stored.count())
        files = self._write(rows.drop(PART), data, buckets)
        return self.manifests.commit(since, {**state, "buckets": buckets, "hash": HASH, "files": files, "data": "data/none"})

    def vacuum(self, keep: int) -> None:
        """Remove all versions but the newest ``keep`` and what only they hold, also what a crash left.

        Folders of a version that is not published yet may belong to a running writer and stay.
        """
        versions = self.manifests.versions()
        kept = versions[-max(1, keep) :]
        used = {path.split("/")[1] for version in kept for path in self.manifests.read(version)["files"].values()}
        for version in versions[: -len(kept)]:
            self.manifests.forget(version)
        for name in self.manifests.folders(f"{self.folder}/data"):
            if name not in used and int(name.split("-")[0]) <= versions[-1]:
                self.manifests.delete(f"{self.folder}/data/{name}")
