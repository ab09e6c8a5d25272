"""Exact nearest neighbours of all rows of a table among themselves, without an all-pairs step.

Rows belong to the cell of their nearest pivot (rows chosen by hash). A row first meets its own cell, which gives a
distance that holds ``k`` others; by the triangle inequality a cell can hold a nearer row only if its pivot is no farther
than that distance and the cell's radius, so the row goes to these cells alone. Cells meet their visitors in chunks of
bounded size on both sides, however dense they are; each chunk hands on its ``k`` nearest, and the best ``k`` stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import qcol
from riskframe.session import cut_lineage

#: Pivots at most (they go to all tasks), rows of a cell and visitors of it that meet in one task, about.
MAX_PIVOTS, CHUNK, VISITORS = 1_024, 2_000, 20_000


def _vectors(column: pa.Array) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy().reshape(len(column), -1)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x from all rows of y, column by column (no cancelling products)."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        out += np.subtract.outer(x[:, j], y[:, j]) ** 2
    return out


def _meet(visits: DataFrame, members: DataFrame, sizes: dict[int, int], k: int, key: str) -> DataFrame:
    """(k, d, other, y) of each of ``visits`` (k, x, cell): the nearest of every chunk of the cell it visits."""
    spark = visits.sparkSession
    counts = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}                     # a row a pivot
    cells = spark.createDataFrame([(c, -(-n // CHUNK), -(-counts.get(c, 0) // VISITORS)) for c, n in sizes.items()], "cell int, chunks int, salts int")
    cells = F.broadcast(cells.where("salts > 0"))
    left = visits.join(cells, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .withColumn("salt", F.pmod(F.xxhash64("k"), F.col("salts")).cast("int")).select("cell", "chunk", "salt", "k", "x")
    right = members.join(cells, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))) \
        .withColumn("chunk", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int")).select(*[F.col(c).alias(f"{c}_") for c in ("cell", "chunk", "salt")], F.col("k").alias("other"), F.col("x").alias("y"))

    def near(a: pa.Table, b: pa.Table) -> pa.Table:
        who, d, at = [], [], []
        if len(a) and len(b):
            x, y = _vectors(a["x"]), _vectors(b["y"])
            own, others = np.array(a["k"].to_pylist(), object), np.array(b["other"].to_pylist(), object)
            for i in range(0, len(x), 500):
                apart = _apart(x[i:i + 500], y)
                apart[own[i:i + 500, None] == others[None]] = np.inf
                for j, row in enumerate(apart):
                    bar = np.partition(row, k - 1)[k - 1] if len(row) >= k else np.inf
                    mine = np.flatnonzero((row <= bar) & np.isfinite(row))
                    for t in sorted(mine.tolist(), key=lambda t, row=row: (row[t], others[t]))[:k]:
                        who.append(i + j)
                        d.append(row[t])
                        at.append(t)
        w, o = pa.array(who, pa.int64()), pa.array(at, pa.int64())
        return pa.table({"k": a["k"].take(w), "d": pa.array(d, pa.float64()), "other": b["other"].take(o), "y": b["y"].take(o)})
    return left.groupBy("cell", "chunk", "salt").cogroup(right.groupBy("cell_", "chunk_", "salt_")).applyInArrow(near, f"k {key}, d double, other {key}, y array<double>")


def nearest(points: DataFrame, key: str, vector: str, k: int, pivots: int | None = None, seed: int = 42) -> DataFrame:
    """(key, near: array of (d, k, y)): for each of ``points`` its ``k`` nearest others by squared distance ``d``, ties by
    key; fewer where there are fewer. Keys are distinct and not null; ``vector`` is an array of doubles of one length."""
    from riskframe.operators.select import first_by_hash
    kind = points.schema[key].dataType.simpleString()
    src = points.select(qcol(key).alias("k"), qcol(vector).alias("x"))
    n = src.count()
    m = pivots or max(1, min(MAX_PIVOTS, math.isqrt(n) // 2 + 1))
    rows = [r["x"] for r in first_by_hash(src, "k", f"pivot{seed}", m).select("x").collect()]
    if not rows:
        return src.select("k", F.array().cast(f"array<struct<d:double,k:{kind},y:array<double>>>").alias("near")).withColumnRenamed("k", key)
    at = np.array(rows, float).reshape(len(rows), -1)
    sent = src.sparkSession.sparkContext.broadcast(at)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = _apart(_vectors(batch.column("x")), sent.value)
            cell = apart.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("x"), pa.array(cell, pa.int32()), pa.array(np.sqrt(apart[np.arange(len(cell)), cell]))], ["k", "x", "cell", "r"])
    members = cut_lineage(src.mapInArrow(assign, f"k {kind}, x array<double>, cell int, r double"))
    held = {r["cell"]: (r["n"], r["r"]) for r in members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r")).collect()}      # a row a pivot
    sizes = {c: n for c, (n, _) in held.items()}
    radius = np.array([held.get(c, (0, -np.inf))[1] for c in range(len(at))])
    size = np.array([sizes.get(c, 0) for c in range(len(at))])
    own = cut_lineage(_meet(members.select("k", "x", "cell"), members, sizes, k, kind))
    reach = own.groupBy("k").agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.element_at(F.array_sort(F.collect_list("d")), k))).alias("reach"))     # chunks x k

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart, home = np.sqrt(_apart(_vectors(batch.column("x")), sent.value)), batch.column("cell").to_numpy()
            far = batch.column("reach").to_numpy(zero_copy_only=False).astype(float)
            for i in np.flatnonzero(np.isnan(far)):                    # too few at home: cells that hold k + 1 rows together
                order = np.argsort(apart[i] + radius)
                enough = np.searchsorted(np.cumsum(size[order]), k + 1)
                far[i] = (apart[i] + radius)[order[enough]] if enough < len(order) else np.inf
            go = (apart - radius <= (far * (1 + 1e-9) + 1e-12)[:, None]) & (size > 0)
            go[np.arange(len(home)), home] = False
            row, cell = np.nonzero(go)
            took = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("k").take(took), batch.column("x").take(took), pa.array(cell, pa.int32())], ["k", "x", "cell"])
    visits = cut_lineage(members.join(reach, "k", "left").select("k", "x", "cell", "reach").mapInArrow(visit, f"k {kind}, x array<double>, cell int"))
    found = own.unionByName(_meet(visits, members, sizes, k, kind))
    near = found.groupBy("k").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", F.col("other").alias("k"), "y"))), 1, k).alias("near"))     # cells visited x k
    return src.select("k").join(near, "k", "left").select(F.col("k").alias(key), F.coalesce("near", F.array().cast(f"array<struct<d:double,k:{kind},y:array<double>>>")).alias("near"))
