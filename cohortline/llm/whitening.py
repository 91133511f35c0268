"""Whitening of embeddings by incremental eigendecomposition.

1. Entries become whole numbers, floor(64 c) + 1,000,000. The fit list holds each distinct
   vector once; its number and sums are exact.
2. Every partition of the fit list starts from nothing and takes its centred vectors one by one
   as rank-one updates of an eigendecomposition (``Spectrum.add``): components that the vector
   does not touch, and directions of equal eigenvalue but one, are deflated; the other
   eigenvalues are the roots of the secular equation, and the vectors follow from them.
3. Spectra are combined by adding one's eigenvectors to the other, again as rank-one updates,
   ``FAN`` at a time in as many rounds as the number of partitions takes.
4. Rayleigh-Ritz: the covariance is formed once more in the combined eigenvectors' basis, over
   all partitions, and its small eigenproblem turns them into the final ones.

State is one square of numbers for each partition, whatever the rows; the driver sees the last
one. A lost task repeats its own partition; fit list and combined states are stored.

Defined results: rows whose vector is null or holds a null or an entry that is not finite are
left out, also of the fit; of the others, those whose length is not the most frequent one
(the larger, of equally frequent ones), empty vectors too; entries beyond 2 ** 25 count as that;
a null id is kept; repeated rows each get their result, and count once in the fit; eigenvalues
that are zero but for rounding have no component, so equal vectors give no rows, as an empty
table does; a component's largest entry is positive; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortline.llm.store import Store

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**25
COMPONENTS = 16
# States that one task combines.
FAN = 16
STATE = "slot bigint, state binary"
RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

_EPS = np.finfo(np.float64).eps


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Differences pole - root of 1 + sum(squares / (poles - t)) = 0, one row for each root.

    ``poles`` ascend and differ, ``squares`` are positive. Root i lies above pole i and below the
    next one. Each is sought from its nearer pole, so that differences keep their digits, by
    interpolation with one pole on either side, and by halving where that leaves the bracket.
    """
    size = len(poles)
    above = np.append(poles[1:], poles[-1] + squares.sum())
    middle = (poles + above) / 2
    far = 1 + (squares / (poles - middle[:, None])).sum(1) < 0
    far[-1] = False
    origin = np.where(far, above, poles)
    shifted = poles - origin[:, None]
    low = np.where(far, middle - above, 0.0)
    high = np.where(far, 0.0, middle - poles)
    high[-1] = squares.sum()
    root = (low + high) / 2
    under = np.tri(size, dtype=bool)
    below, beyond = np.diagonal(shifted), above - origin
    todo = np.arange(size)
    for _ in range(80):
        now = root[todo]
        gaps = shifted[todo] - now[:, None]
        terms = squares / gaps
        slopes = terms / gaps
        psi, value = (terms * under[todo]).sum(1), 1 + terms.sum(1)
        low[todo] = np.where(value < 0, now, low[todo])
        high[todo] = np.where(value < 0, high[todo], now)
        floor, ceiling = low[todo], high[todo]
        done = (np.abs(value) <= 4 * _EPS * size * (1 + np.abs(psi) + np.abs(value - 1 - psi))) | (
            ceiling - floor <= 2 * _EPS * np.maximum(np.abs(floor), np.abs(ceiling))
        )
        slope, steep = slopes.sum(1), (slopes * under[todo]).sum(1)
        left, right = below[todo] - now, beyond[todo] - now
        flat = value - left * steep - right * (slope - steep)
        a = (left + right) * value - left * right * slope
        b = left * right * value
        with np.errstate(divide="ignore", invalid="ignore"):
            wide = np.sqrt(np.maximum(0, a * a - 4 * b * flat))
            step = np.where(a <= 0, (a - wide) / (2 * flat), 2 * b / (a + wide))
            # The last root has no pole above it.
            step = np.where(todo == size - 1, left + left**2 * steep / flat, step)
            moved = now + step
            inside = (moved > floor) & (moved < ceiling)
        root[todo] = np.where(done, now, np.where(inside, moved, (floor + ceiling) / 2))
        todo = todo[~done]
        if not len(todo):
            break
    return shifted - root[:, None]


@dataclass
class Spectrum:
    """Eigenvalues, ascending, and eigenvectors in columns, of a sum of outer products."""

    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(np.zeros(size), np.eye(size))

    def add(self, vector: np.ndarray, weight: float = 1.0) -> None:
        """Adds weight times the vector's outer product with itself."""
        turned = (vector @ self.vectors) * np.sqrt(weight)
        length = np.sqrt(turned @ turned)
        if length == 0:
            return
        small = 8 * _EPS * max(abs(self.values[0]), abs(self.values[-1]), length**2)
        turned[np.abs(turned) * length <= small] = 0
        live = np.flatnonzero(turned)
        if self._close(turned, live, small):
            live = self._turn_equal(turned, live, small)
        gaps = secular_roots(self.values[live], turned[live] ** 2)
        between = self.values[live] - self.values[live][:, None]
        np.fill_diagonal(between, 1)
        # The vector for which the roots found are exact; its eigenvectors are orthogonal.
        weights = np.exp((np.log(np.abs(gaps)).sum(0) - np.log(np.abs(between)).sum(0)) / 2)
        turn = np.copysign(weights, turned[live]) / gaps
        turn /= np.sqrt((turn * turn).sum(1, keepdims=True))
        nearest = np.argmin(np.abs(gaps), 1)
        self.values[live] = self.values[live][nearest] - gaps[np.arange(len(live)), nearest]
        self.vectors[:, live] = self.vectors[:, live] @ turn.T
        order = np.argsort(self.values, kind="stable")
        if (order[1:] < order[:-1]).any():
            self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _close(self, turned: np.ndarray, live: np.ndarray, small: float) -> bool:
        """Whether two neighbours are so close that a rotation takes one of them out."""
        one, two = turned[live[:-1]], turned[live[1:]]
        return bool((np.abs(np.diff(self.values[live]) * one * two) <= small * (one * one + two * two)).any())

    def _turn_equal(self, turned: np.ndarray, live: np.ndarray, small: float) -> np.ndarray:
        """Rotates directions of equal eigenvalue so that the vector touches one of them only."""
        kept = [int(live[0])]
        for two in live[1:].tolist():
            one = kept[-1]
            length = np.hypot(turned[one], turned[two])
            c, s = turned[two] / length, turned[one] / length
            gap = self.values[two] - self.values[one]
            if abs(gap * c * s) <= small:
                low, high = self.vectors[:, one].copy(), self.vectors[:, two].copy()
                self.vectors[:, one], self.vectors[:, two] = c * low - s * high, s * low + c * high
                self.values[one], self.values[two] = self.values[one] + s * s * gap, self.values[two] - s * s * gap
                turned[one], turned[two] = 0, length
                kept.pop()
            kept.append(two)
        return np.array(kept)

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.add(vector, float(value))

    def to_bytes(self) -> bytes:
        return self.values.tobytes() + self.vectors.tobytes()

    @classmethod
    def from_bytes(cls, state: bytes) -> Spectrum:
        numbers = np.frombuffer(state, np.float64)
        size = int((np.sqrt(4 * len(numbers) + 1) - 1) / 2 + 0.5)
        return cls(numbers[:size].copy(), numbers[size:].reshape(size, size).copy())


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), size)


def _states(start: Callable[[], object], take: Callable[[object, np.ndarray], object], pack: Callable[[object], bytes], size: int):
    """One state for each partition that has rows."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows = start(), 0
        for batch in batches:
            if len(batch):
                state, rows = take(state, matrix(batch.column("x"), size)), rows + len(batch)
        if rows:
            slot = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([pack(state)], pa.binary())], ["slot", "state"])

    return gather


def combined(states: DataFrame, merge: Callable[[list[bytes]], bytes], store: Store, fan: int = FAN) -> bytes:
    """The states of all partitions in one, ``fan`` at a time in one task."""

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        slot = table["slot"][0].as_py() // fan
        return pa.table({"slot": pa.array([slot], pa.int64()), "state": pa.array([merge(table["state"].to_pylist())], pa.binary())})

    current = store.write(states, "states")
    while current.count() > 1:
        current = store.write(current.groupBy(F.expr(f"slot div {fan}")).applyInArrow(join, STATE), "states")
    return current.first()["state"]


def _summed(dtype):
    return lambda states: np.sum([np.frombuffer(state, dtype) for state in states], 0, dtype=dtype).tobytes()


def _merged(states: list[bytes]) -> bytes:
    first = Spectrum.from_bytes(states[0])
    for state in states[1:]:
        first.merge(Spectrum.from_bytes(state))
    return first.to_bytes()


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: of ``n`` fitted vectors the sums, and the components' values and unit vectors (columns)."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squares of n x - sums, None where a long does not hold one."""
        off = self.n * x - self.sums
        if len(off) == 0 or float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0**62:
            return (off * off).sum(1).tolist()
        exact = [sum(v * v for v in row) for row in off.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, x of every row with a whole vector of finite entries."""
    entry = F.col("embedding")
    finite = F.forall(entry, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    kept = embeddings.where(entry.isNotNull() & (F.size(entry) > 0) & finite)
    bounded = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double")))
    return kept.select("vec_id", F.transform(entry, lambda c: F.floor(bounded(c) * SCALE) + SHIFT).alias("x"))


def fit(x: DataFrame, store: Store, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a column ``x`` of vectors of one length; None without any variance."""
    fitted = store.write(x.select("x").distinct(), "fit")
    first = fitted.first()
    if first is None:
        return None
    size = len(first["x"])

    def state(start, take, merge, pack=lambda s: s.tobytes()) -> bytes:
        return combined(fitted.mapInArrow(_states(start, take, pack, size), STATE), merge, store)

    def count(s: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return s + np.append(len(rows), rows.sum(0))

    totals = np.frombuffer(state(lambda: np.zeros(size + 1, np.int64), count, _summed(np.int64)), np.int64)
    base = Whitening(int(totals[0]), totals[1:], np.ones(size), np.eye(size), np.ones(size), 0.0)

    def update(s: Spectrum, rows: np.ndarray) -> Spectrum:
        for row in base.centred(rows):
            s.add(row)
        return s

    spectrum = Spectrum.from_bytes(state(lambda: Spectrum.empty(size), update, _merged, Spectrum.to_bytes))
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]

    def scatter(of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        def add(s: np.ndarray, rows: np.ndarray) -> np.ndarray:
            seen = of(rows)
            return s + seen.T @ seen

        total = np.frombuffer(state(lambda: np.zeros((width, width)), add, _summed(np.float64)))
        return total.reshape(width, width) / base.n

    values, turn = np.linalg.eigh(scatter(lambda rows: base.centred(rows) @ basis, size))
    vectors = basis @ turn
    kept = [k for k in range(size - 1, -1, -1) if values[k] > values[-1] * size * _EPS][:components]
    if not kept or values[-1] <= 0:
        return None
    chosen = vectors[:, kept]
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(0), np.arange(len(kept))])
    found = Whitening(base.n, base.sums, values[kept], chosen, values[kept] / values.sum(), 0.0)
    error = np.abs(scatter(found.apply, len(kept)) - np.eye(len(kept))).max()
    return Whitening(found.n, found.sums, found.values, found.vectors, found.explained, float(error))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every remaining row."""
    store = Store(embeddings, "whitening")
    session = embeddings.sparkSession
    rows = store.write(quantised(embeddings), "quantised")
    # One number comes to the driver.
    length = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if length is None:
        return session.createDataFrame([], RESULT)
    rows = rows.where(F.size("x") == length["size"])
    model = fit(rows, store, components)
    if model is None:
        return session.createDataFrame([], RESULT)
    shared, size = session.sparkContext.broadcast(model), length["size"]

    def transform(x: pa.Array) -> pa.Array:
        vectors = matrix(x, size)
        whitened = shared.value.apply(vectors)
        ends = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * whitened.shape[1])
        return pa.StructArray.from_arrays(
            [pa.array(shared.value.deviation(vectors), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(whitened.ravel()))],
            ["deviation", "whitened"],
        )

    told = rows.select("vec_id", arrow_udf(transform, "deviation bigint, whitened array<double>")("x").alias("t"))
    explained = F.array(*(F.lit(float(share)) for share in model.explained))
    return told.select("vec_id", "t.deviation", F.posexplode("t.whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("place")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
