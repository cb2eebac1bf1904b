"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, so that sums, means, the trace and each row's deviation are exact. The
covariance is never formed: a pass takes a block of directions ``Q`` to ``XᵀXQ / n``, where every
task centres its rows, multiplies them twice and gives one small matrix. A round of ``DEGREE`` passes
is the three-term recurrence of a Chebyshev polynomial that is small on the unwanted spectrum, from
zero to the least Ritz value of the block, and steep above it. Then the block is made orthonormal
(QR) and turned to the Ritz vectors of one more pass, whose residuals tell how far each is from an
eigenvector. Rounds go on until the residuals of all wanted vectors are below ``TOLERANCE`` of the
largest eigenvalue. Where rounds no longer lessen them, the block is doubled; one as wide as the
vectors gives the whole spectrum at once, so the work ends.

At scale: the whole numbers are written once; a pass reads them, sends the block to the tasks (32
numbers a dimension) and gets as much back from each, summed by cell with a shuffle. Nothing else
leaves the tasks, and the driver holds a few blocks. There are no keys, so no hot ones. A lost task
reads its rows again.

Vectors that are null or hold null, NaN or infinite entries are dropped, and so are those of another
length than most have (of equally many the longest), as nothing can be said of their missing entries.
Rows with equal ids or vectors are rows of their own; null ids stay null. Entries beyond 2^42 count as
2^42, and a deviation beyond 64 bits is null. Components are as many as asked for or as dimensions,
without those whose eigenvalue is below ``NO_VARIANCE`` of the largest: along these nothing varies, so
vectors that are all alike have no rows at all. So have empty tables. The sign of a component makes its
largest entry positive. Where eigenvalues are equal any turn of their vectors is as right. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.llm.cluster import prepare
from stardw.session import cut_lineage

COMPONENTS = 8
SCALE, SHIFT = 1024, 100000
# Directions beside the wanted ones, passes of a round.
GUARD = 24
DEGREE = 8
# Of the largest eigenvalue: residuals below the first are certified; residuals that rounds no longer
# lessen are taken if they are below the second, else the block is doubled.
TOLERANCE = 2e-14
STUCK = 1e-11
NO_VARIANCE = 1e-12
MOST = 1 << 42


@dataclass
class Centre:
    """Number of rows, and by dimension the sum as ``n * whole + rest``."""

    n: int
    whole: np.ndarray
    rest: list[int]
    trace: float

    @property
    def part(self) -> np.ndarray:
        return np.array([float(Fraction(r, self.n)) for r in self.rest])


def whole_numbers(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """``row_id`` and ``x``, the vectors as whole numbers, of the rows that have one."""
    number = F.col(vector)
    broken = F.exists(number, lambda c: c.isNull() | F.isnan(c.cast("double"))
                      | (F.abs(c.cast("double")) == float("inf")))
    return rows.filter(number.isNotNull()).filter(~broken).select(
        row_id, F.transform(number, lambda c: F.floor(F.greatest(F.least(
            SCALE * c.cast("double"), F.lit(float(MOST))), F.lit(float(-MOST))))
            .cast("long") + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.asarray(batch.column("x").flatten(), np.int64).reshape(-1, d)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length and dimension: rows, sum, and sum of squares of the numbers without the shift."""
    found: dict[int, list] = {}
    for batch in batches:
        lengths = np.asarray(batch.column("x").value_lengths())
        for d in np.unique(lengths[lengths > 0]).tolist():
            y = _matrix(batch.filter(pa.array(lengths == d)), d) - SHIFT
            if np.abs(y).max(initial=0) >= 1 << 24:
                y = y.astype(object)
            n, one, two = found.get(d, [0, [0] * d, [0] * d])
            found[d] = [n + len(y),
                        [a + int(b) for a, b in zip(one, y.sum(0))],
                        [a + int(b) for a, b in zip(two, (y * y).sum(0))]]
    rows = [(d, j, n, a, b) for d, (n, one, two) in found.items()
            for j, (a, b) in enumerate(zip(one, two))]
    wide = pa.decimal128(38, 0)
    kinds = (pa.int32(), pa.int32(), pa.int64(), wide, wide)
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
        names=["d", "j", "n", "s", "ss"])


def centre(x: DataFrame) -> Centre | None:
    """What the fit needs of the rows, exact; None without any."""
    sums = x.select("x").mapInArrow(
        _sums, "d int, j int, n long, s decimal(38,0), ss decimal(38,0)")
    sums = sums.groupBy("d", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])
    most = sums.groupBy("d").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    d, n = most
    rows = sorted(sums.filter(F.col("d") == d).collect(), key=lambda r: r.j)
    one, two = [int(r.s) for r in rows], [int(r.ss) for r in rows]
    trace = sum((Fraction(b, n) - Fraction(a, n) ** 2 for a, b in zip(one, two)), Fraction(0))
    whole = [round(Fraction(a, n)) for a in one]
    return Centre(n, np.array(whole, np.int64) + SHIFT, [a - n * w for a, w in zip(one, whole)],
                  float(trace))


def _centred(batch: pa.RecordBatch, at: Centre) -> np.ndarray:
    return (_matrix(batch, len(at.whole)) - at.whole) - at.part


def _multiplier(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = sent.value
        total = None
        for batch in batches:
            rows = _centred(batch, at)
            made = rows.T @ (rows @ block)
            total = made if total is None else total + made
        if total is not None:
            yield _cells(total)
    return run


def _cells(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(matrix.size), pa.int32()),
                                       pa.array(matrix.ravel())], names=["cell", "v"])


def _summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of the tasks' matrices; one of no task is zero."""
    sums = parts.groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape)
    out.flat[np.asarray(sums.column("cell"))] = np.asarray(sums.column("v"))
    return out


def product(x: DataFrame, at: Centre, block: np.ndarray) -> np.ndarray:
    """The covariance times ``block``, in one pass."""
    sent = x.sparkSession.sparkContext.broadcast((at, block))
    out = _summed(x.select("x").mapInArrow(_multiplier(sent), "cell int, v double"), block.shape)
    sent.unpersist()
    return out / at.n


def filtered(times, block: np.ndarray, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that stays small from 0 to ``cut``, at ``block``;
    scaled so that it is near 1 at ``top``."""
    half = cut / 2
    sigma = first = half / (top - half)
    before, now = block, (times(block) - half * block) * (first / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, ((times(now) - half * now) * (2 * following / half)
                            - sigma * following * before)
        sigma = following
    return now


def components(times, d: int, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors, of the covariance that
    ``times`` multiplies with."""
    wanted = min(wanted, d)
    width = min(d, wanted + GUARD)
    rng = np.random.default_rng(seed)
    block, last = rng.standard_normal((d, width)), np.inf
    while True:
        block = np.linalg.qr(block)[0]
        made = times(block)
        small = block.T @ made
        value, turn = np.linalg.eigh((small + small.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        block, made = block @ turn, made @ turn
        top = value[0]
        error = np.linalg.norm(made - block * value, axis=0)[:wanted].max(initial=0)
        if top <= 0 or width == d or error <= TOLERANCE * top:
            break
        if error > last / 2:
            if error <= STUCK * top:
                break
            width = min(d, 2 * width)
            block = np.hstack((block, rng.standard_normal((d, width - block.shape[1]))))
            last = np.inf
            continue
        last = error
        if value[-1] <= NO_VARIANCE * top:
            # Nothing to damp: one more product leaves only what varies.
            block = made + 1e-3 * top * rng.standard_normal(made.shape)
        else:
            block = filtered(times, block, value[-1], top)
    value, block = value[:wanted], block[:, :wanted]
    block = block * np.sign(block[np.abs(block).argmax(0), np.arange(block.shape[1])])
    kept = value > NO_VARIANCE * max(value[0], 0)
    return value[kept], block[:, kept]


def _deviations(u: np.ndarray, at: Centre) -> list:
    """Sums of (n·x − S)², from u = x − whole: n²Σu² − 2nΣur + Σr²."""
    r = max(map(abs, at.rest), default=0)
    largest = int(np.abs(u).max(initial=0))
    d = len(at.rest)
    if d * (at.n * largest + r) ** 2 < 1 << 62:
        z = at.n * u - np.array(at.rest, np.int64)
        return (z * z).sum(1).tolist()
    u = u.astype(object)
    rest = np.array(at.rest, object)
    every = at.n ** 2 * (u * u).sum(1) - 2 * at.n * (u * rest).sum(1) + int((rest * rest).sum())
    return [int(e) if e < 1 << 63 else None for e in every]


def _whitener(sent, outcome=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, scaled = sent.value
        total = None
        for batch in batches:
            made = _centred(batch, at) @ scaled
            if outcome is None:
                both = np.hstack((np.ones((len(made), 1)), made))
                both = both.T @ both
                total = both if total is None else total + both
                continue
            k = made.shape[1]
            u = _matrix(batch, len(at.whole)) - at.whole
            rows = np.repeat(np.arange(len(made)), k)
            each = [batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1), len(made)), pa.int32()),
                    pa.array(np.full(len(rows), at.n), pa.int64()),
                    pa.array(_deviations(u, at), pa.int64()).take(pa.array(rows)),
                    pa.array(made.ravel()),
                    pa.array(np.tile(outcome[0], len(made))),
                    pa.array(np.full(len(rows), outcome[1]))]
            yield pa.RecordBatch.from_arrays(each, names=[batch.schema.names[0], *RESULTS])
        if total is not None:
            yield _cells(total)
    return run


RESULTS = {"component": "int", "n": "long", "deviation": "long", "whitened": "double",
           "explained": "double", "identity_error": "double"}


def whiten(rows: DataFrame, *, k: int = COMPONENTS, vector: str = "embedding",
           row_id: str = "vec_id") -> DataFrame:
    """A row for each vector and component, with the columns of ``RESULTS`` behind ``row_id``."""
    spark = rows.sparkSession
    prepare(spark)
    x = cut_lineage(whole_numbers(rows, vector, row_id), "whole-numbers")
    schema = T.StructType([x.schema[row_id], *T.StructType.fromDDL(
        ", ".join(map(" ".join, RESULTS.items())))])
    at = centre(x)
    if at is None or not len(at.whole) or at.trace <= 0:
        return spark.createDataFrame([], schema)
    x = x.filter(F.size("x") == len(at.whole))
    value, block = components(lambda q: product(x, at, q), len(at.whole), k)
    sent = spark.sparkContext.broadcast((at, block / np.sqrt(value)))
    moments = _summed(x.select("x").mapInArrow(_whitener(sent), "cell int, v double"),
                      (len(value) + 1,) * 2) / at.n
    covariance = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    error = float(np.abs(covariance - np.eye(len(value))).max())
    return x.mapInArrow(_whitener(sent, (value / at.trace, error)), schema)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op11_whitening": op11_whitening}
