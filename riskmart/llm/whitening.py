"""Whitening of embeddings by a blockwise QR and a bidiagonal qd solver.

Components become whole numbers ``floor(SCALE c) + OFFSET``; their sums are exact.
Rows are centred before anything is multiplied, so no product of two large
numbers is ever subtracted from another.

1. Every task folds its centred rows, block by block, into one triangular factor
   (QR of the factor so far on top of the next block); the factors are stacked and
   factored again in groups of ``FAN`` until one is left.  Its size is the width of
   the vectors; the number of rows never enters a task or the driver.
2. ``spectrum.leading``: Householder bidiagonalisation, dqds, twisted factorisations.
3. A row's whitened values are its centred entries on each direction over the root
   of the direction's variance (divisor: the number of rows).

Cases: vectors that are null, or hold a null or non-finite entry, take no part;
shorter vectors count as padded with zeros (an empty one is all zeros); repeated
ids and vectors are rows each; a null id stays null; ties of variance leave the
choice of axes in their plane open; directions without variance (equal rows, a
single row, fewer rows than dimensions) have no whitened value and give no rows;
an empty table gives none; other columns are not read.  Entries beyond 2 ** 52 /
SCALE count as that border; a deviation beyond 64 bits as 2 ** 63 - 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table
from riskmart.llm.spectrum import leading

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows of a QR block, as a multiple of the width.
DEPTH = 4
#: Triangular factors that are stacked in one step.
FAN = 8
#: Largest whole number an entry becomes: sums of two stay exact in doubles.
LIMIT = 1 << 52
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """Rows fitted, exact sums of their whole-number entries, unit directions (one a row) and their variances."""
    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.variances]


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(column).isNotNull() & ~bad).select("vec_id", v.alias("v"))


def _whole(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows of whole numbers padded to ``width``, their lengths)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    whole = np.clip(np.floor(SCALE * np.clip(flat, -LIMIT, LIMIT)), -LIMIT, LIMIT).astype(np.int64) + OFFSET
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.full((len(lengths), width), OFFSET, np.int64)
    out[np.arange(width) < lengths[:, None]] = whole
    return out, lengths


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """(number of rows, exact sum of every entry's whole numbers); one partial row a task and entry."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals, counts = 0, [], []
        for batch in batches:
            whole, lengths = _whole(batch.column("v"))
            wide = whole.shape[1] - len(totals)
            totals += [0] * wide
            counts += [0] * wide
            n += len(whole)
            for j in range(whole.shape[1]):
                held = lengths > j
                high, low = whole[held, j] >> 32, whole[held, j] & 0xFFFFFFFF
                totals[j] += (int(high.sum()) << 32) + int(low.sum())
                counts[j] += int(held.sum())
        # The padding of shorter rows is added at the end, once the width is known.
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(totals))], pa.int32()), pa.array([n, *counts], pa.int64()),
             pa.array([Decimal(0), *map(Decimal, totals)], pa.decimal128(38, 0))], ["at", "held", "total"])

    found = rows.select("v").mapInArrow(partial, "at int, held long, total decimal(38,0)").groupBy("at").agg(
        F.sum("held").alias("held"), F.sum("total").alias("total")).orderBy("at").collect()
    n = int(found[0].held) if found else 0
    return n, [int(r.total) + OFFSET * (n - int(r.held)) for r in found[1:]] if n else []


def _from_mean(whole: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """n * x - S, exactly: 64-bit integers where they suffice, else Python's."""
    largest = max(int(np.abs(whole).max(initial=0)), 1)
    if n * largest + max(map(abs, totals), default=0) <= LONG:
        return whole * np.int64(n) - np.array(totals, np.int64)
    return whole.astype(object) * n - np.array(totals, object)


def _factor(rows: np.ndarray) -> np.ndarray:
    """Triangular factor of a QR, of at most as many rows as columns."""
    return np.linalg.qr(rows, mode="r")


def triangle(rows: DataFrame, n: int, totals: list[int], depth: int = DEPTH, fan: int = FAN) -> np.ndarray:
    """R of the centred rows, square (filled up with zero rows)."""
    width = len(totals)
    schema = "part long, r binary"

    def packed(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())],
                                          ["part", "r"])

    def unpacked(cell: bytes) -> np.ndarray:
        return np.frombuffer(cell, float).reshape(-1, width)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            step = max(depth * width, 1)
            for at in range(0, len(batch), step):
                whole, _ = _whole(batch.column("v").slice(at, step), width)
                r = _factor(np.vstack([r, _from_mean(whole, n, totals).astype(float) / n]))
        if len(r):
            yield packed(TaskContext.get().partitionId(), r)

    def stack(key, pdf):
        import pandas as pd
        r = _factor(np.vstack([unpacked(cell) for cell in pdf.sort_values("part")["r"]]))
        return pd.DataFrame({"part": [key[0]], "r": [np.ascontiguousarray(r).tobytes()]})

    factors = stored(rows.select("v").mapInArrow(fold, schema), "whitening-factors")
    last = factors.agg(F.max("part")).first()[0]
    while last:
        last //= fan
        factors = stored(factors.groupBy(F.floor(F.col("part") / fan).alias("team")).applyInPandas(stack, schema), "whitening-factors")
    found = factors.collect()  # one factor
    out = np.zeros((width, width))
    for row in found:
        r = unpacked(bytes(row.r))
        out[:len(r)] = r
    return out


def fit(rows: DataFrame, components: int = COMPONENTS, depth: int = DEPTH, fan: int = FAN) -> Whitening:
    """The ``components`` leading whitening directions of ``rows`` (v)."""
    n, totals = sums(rows)
    if not n or not totals:
        return Whitening(n, totals, np.zeros((0, len(totals))), np.zeros(0), 0.0)
    r = triangle(rows, n, totals, depth, fan)
    values, directions = leading(r, components)
    return Whitening(n, totals, directions, values ** 2 / n, float((r ** 2).sum() / n))


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, w): the exact deviation of every row and its whitened values, one a direction."""
    n, totals, width = model.n, model.sums, len(model.sums)
    scaled = (model.directions / np.sqrt(model.variances)[:, None]).T if len(model.variances) else np.zeros((width, 0))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, _ = _whole(batch.column("v"), width)
            off = _from_mean(whole, n, totals)
            if off.dtype == object or (width and int(np.abs(off).max(initial=0)) ** 2 * width > LONG):
                deviation = [min(sum(int(x) ** 2 for x in row), LONG) for row in off]
            else:
                deviation = (off * off).sum(axis=1)
            w = (off.astype(float) / n) @ scaled
            lists = pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], w.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").cast(pa.int64()), pa.array(deviation, pa.int64()), lists],
                                             ["vec_id", "deviation", "w"])

    return rows.mapInArrow(apply, "vec_id long, deviation long, w array<double>")


def identity_error(rows: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity."""
    if not components:
        return 0.0
    w = [F.col("w")[i] for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = rows.agg(*[F.covar_pop(w[i], w[j]) for i, j in pairs]).first()
    return max((abs(c - (i == j)) for (i, j), c in zip(pairs, found) if c is not None), default=0.0)


def op12_whitening(spark, sf_dir) -> DataFrame:
    """Every vector of ``embeddings`` on the 8 leading whitening directions of all of them."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    model = fit(rows)
    out = stored(whitened(rows, model), "whitening-values")
    error = identity_error(out, len(model.variances))
    share = F.array(*[F.lit(x) for x in model.explained]) if model.explained else F.array().cast("array<double>")
    return out.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
