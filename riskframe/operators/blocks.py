"""Blocks of sums that every task makes of its rows, merged by tree; and the co-moments of many columns from one block."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import qcol

#: Blocks of one key that meet in one task; beyond that they are merged in two steps.
MERGE_AT_ONCE = 512
#: Columns of a co-moment block at most (four squares of it go from every task to its merge), and numbers held at once.
MAX_COLUMNS, CELLS = 1_000, 4_000_000


def summed_blocks(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]],
                  merge: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add) -> dict[int, np.ndarray]:
    """By key: the blocks (numpy doubles) that ``make`` gives for the rows of each task, merged pair by pair.

    Tasks are four times the cores, however many files the table has, so blocks are few; they are merged key by key, in
    two steps where many meet. The driver gets one block a key.
    """
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    schema = "key int, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, x in make(batches).items():
            yield pa.RecordBatch.from_pydict({"key": pa.array([k], pa.int32()), "block": pa.array([np.ascontiguousarray(x, float).tobytes()], pa.binary())})

    def join(t: pa.Table) -> pa.Table:
        total = None
        for x in t["block"]:
            own = np.frombuffer(x.as_buffer(), float)
            total = own if total is None else merge(total, own)
        return pa.table({"key": t["key"].slice(0, 1), "block": pa.array([total.tobytes()], pa.binary())})
    made = df.coalesce(tasks).mapInArrow(run, schema)
    if tasks > MERGE_AT_ONCE:
        part = F.pmod(F.spark_partition_id(), F.lit(max(2, round(tasks ** 0.5))))
        made = made.withColumn("part", part).groupBy("key", "part").applyInArrow(join, schema)
    return {r["key"]: np.frombuffer(r["block"], float) for r in made.groupBy("key").applyInArrow(join, schema).collect()}


@dataclass
class CoMoments:
    """Of k columns, pair by pair over the rows where both are present: n[i, j]; mean[i, j] of column i; square[i, j], the
    sum of its squared deviations; both[i, j], that of the products of deviations."""
    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    both: np.ndarray

    def correlations(self) -> np.ndarray:
        """Pearson's r; NaN where fewer than two rows or no variance are left."""
        with np.errstate(invalid="ignore", divide="ignore"):
            scale = np.sqrt(self.square * self.square.T)
            return np.where((self.n > 1) & (scale > 0), self.both / scale, np.nan)


def _of(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """The block of some rows; deviations are taken from the rows' own means, so that sums don't cancel."""
    held = present.sum(axis=0)
    centre = np.where(present, x, 0).sum(axis=0) / np.maximum(held, 1)
    d, m = np.where(present, x - centre, 0.0), present.astype(float)
    n, s = m.T @ m, d.T @ m
    per = s / np.maximum(n, 1)
    return np.stack([n, np.where(n > 0, centre[:, None] + per, 0.0), (d * d).T @ m - s * per, d.T @ d - s * per.T])


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (v.reshape(4, k, k) for v in (a, b) for k in [round((v.size / 4) ** 0.5)])
    n = a[0] + b[0]
    apart, share = b[1] - a[1], b[0] / np.maximum(n, 1)
    weight = a[0] * share
    mean = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + apart * share))
    return np.stack([n, mean, a[2] + b[2] + apart * apart * weight, a[3] + b[3] + apart * apart.T * weight])


def co_moments(df: DataFrame, columns: Sequence[str] = (), vector: str | None = None) -> CoMoments:
    """Co-moments of numeric ``columns`` (nulls left out pair by pair) or of the slots of a ``vector`` column: one pass,
    a few matrix products a batch, one block a task."""
    if vector:
        from pyspark.ml.functions import vector_to_array
        first = df.where(F.col(vector).isNotNull()).select(F.size(vector_to_array(F.col(vector)))).first()
        k, src = first[0] if first else 0, df.where(F.col(vector).isNotNull()).select(vector_to_array(F.col(vector)).alias("v"))
    else:
        k, src = len(columns), df.select(*[qcol(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    if k > MAX_COLUMNS:
        raise ValueError(f"{k} columns: co-moments take {MAX_COLUMNS}")

    def make(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        total = np.zeros((4, k, k))
        for batch in batches:
            for at in range(0, len(batch), max(1, CELLS // max(1, k))):
                part = batch.slice(at, max(1, CELLS // max(1, k)))
                if vector:
                    x = part.column(0).flatten().to_numpy().reshape(len(part), k)
                    present = np.ones(x.shape, bool)
                else:
                    x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
                    present = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
                total = _merged(total, _of(x, present))
        return {0: total}
    found = summed_blocks(src, make, lambda a, b: _merged(a, b).ravel()).get(0, np.zeros(4 * k * k)).reshape(4, k, k)
    return CoMoments(*found)
