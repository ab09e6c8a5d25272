"""Exact, distributed quantiles and modes.

A position is bracketed by two values and narrowed until its neighbours are known. Each round is one aggregate over all
columns and positions: a mergeable digest proposes values on either side of a position, a count of the rows below, at,
between and above them says exactly where the position lies. Once few rows lie between, their values are counted and
picked from. No task holds a column's values, whatever they are; digest errors cost rounds, never exactness.

Quantiles within groups reduce each column to a value histogram (partial aggregation, so a hot value costs one row per
map task) and find positions by distributed running counts. Result = linear interpolation, identical to pandas
``quantile`` / SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import qcol
from riskframe.operators.ordered import running_sums


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), value_type: str = "double") -> DataFrame:
    """Wide numeric columns -> rows ``(by..., column, v)``; nulls dropped."""
    by = list(by)
    packed = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), qcol(c).cast(value_type).alias("v"))
                                 for c in cols])).alias("_kv")
    return df.select(*[F.col(b) for b in by], packed).select(*by, "_kv.column", "_kv.v").where(F.col("v").isNotNull())


def value_histogram(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return long_values(df, cols, by).groupBy(*by, "column", "v").agg(F.count(F.lit(1)).alias("cnt"))


# Relative error of the digests; rows between two bracketing values, or distinct values of a column, that are counted value
# by value and come to the driver.
DIGEST_ACCURACY, FEW_ROWS, FEW_VALUES = 10_000, 100_000, 50_000


class _Position:
    """The value at rank ``rank`` (from 0) of a column: known to lie strictly between ``a`` and ``b`` (None: open), with
    ``below`` rows up to and with ``a`` and ``rows`` rows between."""

    def __init__(self, column: int, rank: int, rows: int):
        self.column, self.rank, self.rows = column, rank, rows
        self.a, self.b, self.below, self.value, self.at = None, None, 0, None, None

    def inside(self, x):
        out = x.isNotNull()
        if self.a is not None:
            out &= x > F.lit(self.a)
        return out if self.b is None else out & (x < F.lit(self.b))

    def narrow(self, lo: float, hi: float, under: int, at_lo: int, between: int, at_hi: int) -> None:
        """``lo`` <= ``hi`` are values inside: so many rows inside lie under, at, between and at the latter."""
        r = self.rank - self.below
        if r < under:
            self.b, self.rows = lo, under
        elif r < under + at_lo:
            self.value = lo
        elif r < under + at_lo + between:
            self.a, self.b, self.below, self.rows = lo, hi, self.below + under + at_lo, between
        elif r < under + at_lo + between + at_hi:
            self.value = hi
        else:
            done = under + at_lo + between + at_hi
            self.a, self.below, self.rows = hi, self.below + done, self.rows - done


def _refined(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> list[tuple]:
    """(column, prob, value) by refinement; NaN counts as the greatest value."""
    nan = float("nan")
    src = df.select(*[qcol(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    x = [F.when(~F.isnan(f"c{i}"), F.col(f"c{i}")) for i in range(len(cols))]
    sizes = src.agg(*[F.count(f"c{i}") for i in range(len(cols))], *[F.count(v) for v in x], *[F.approx_count_distinct(v) for v in x]).first()
    n, real, values = (sizes[k * len(cols):(k + 1) * len(cols)] for k in range(3))
    wanted: dict[tuple[int, int], _Position] = {}
    for i in range(len(cols)):
        for p in probs:
            h = (n[i] - 1) * p
            for rank in {math.floor(h), math.ceil(h)} if n[i] else ():
                if (i, rank) not in wanted:
                    wanted[i, rank] = at = _Position(i, rank, real[i])
                    at.value = nan if rank >= real[i] else None
    while todo := [p for p in wanted.values() if p.value is None and p.rows > FEW_ROWS and values[p.column] > FEW_VALUES]:
        digests = []
        for p in todo:
            share, slack = (p.rank - p.below) / max(1, p.rows - 1), 3.0 / DIGEST_ACCURACY
            digests.append(F.percentile_approx(F.when(p.inside(x[p.column]), x[p.column]),
                                               [max(0.0, share - slack), min(1.0, share + slack)], DIGEST_ACCURACY))
        ends = [sorted(e) for e in src.agg(*[d.alias(f"d{k}") for k, d in enumerate(digests)]).first()]
        counts = []
        for p, (lo, hi) in zip(todo, ends, strict=True):
            v, ok = x[p.column], p.inside(x[p.column])
            counts += [F.count_if(ok & (v < F.lit(lo))), F.count_if(ok & (v == F.lit(lo))),
                       F.count_if(ok & (v > F.lit(lo)) & (v < F.lit(hi))), F.count_if(ok & (v == F.lit(hi)) & F.lit(hi > lo))]
        found = src.agg(*[c.alias(f"n{k}") for k, c in enumerate(counts)]).first()
        for k, (p, (lo, hi)) in enumerate(zip(todo, ends, strict=True)):
            p.narrow(lo, hi, *found[4 * k:4 * k + 4])
    left = [p for p in wanted.values() if p.value is None]
    spans = sorted({(p.column, p.a, p.b) for p in left}, key=repr)
    if left:
        of = {s: k for k, s in enumerate(spans)}
        first = {(p.column, p.a, p.b): p for p in left}
        some = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("span"), F.when(first[s].inside(x[s[0]]), x[s[0]]).alias("v")) for k, s in enumerate(spans)]),
                                  lambda e: e["v"].isNotNull())).alias("e")
        hist = src.select(some).groupBy("e.span", "e.v").agg(F.count(F.lit(1)).alias("cnt")).toPandas()      # FEW_ROWS or FEW_VALUES a span
        for k, g in hist.sort_values(["span", "v"]).groupby("span"):
            v, upto = g["v"].to_numpy(), g["cnt"].cumsum().to_numpy()
            for p in left:
                if of[p.column, p.a, p.b] == k:
                    p.value = float(v[(upto > p.rank - p.below).argmax()])
    rows = []
    for i, c in enumerate(cols):
        for p in probs:
            if n[i]:
                h = (n[i] - 1) * p
                lo, hi = (wanted[i, r].value for r in (math.floor(h), math.ceil(h)))
                rows.append((c, float(p), lo + (h - math.floor(h)) * (hi - lo) if hi != lo else lo))
    return rows


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              hist: DataFrame | None = None, method: str = "auto") -> DataFrame:
    """Rows ``(by..., column, prob, value)`` with exact linear-interpolated quantiles; a column without values gives none.

    Without groups the positions are refined (jobs run when this is called; the result is as many rows as asked for).
    With ``by``, a given ``hist`` or ``method="distributed"``: histogram + split running counts, for any number of groups.
    """
    by = list(by)
    keys = by + ["column"]
    if not by and hist is None and method != "distributed":
        return df.sparkSession.createDataFrame(_refined(df, cols, probs) if cols else [], "column string, prob double, value double")
    h = hist if hist is not None else value_histogram(df, cols, by)
    cum = running_sums(h, ["v"], {"cum": "cnt"}, keys=keys)
    totals = h.groupBy(*keys).agg(F.sum("cnt").alias("n"))
    # one row per (group, prob): #groups x #probs, both set by the caller
    pos = totals.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))) \
        .withColumn("h", (F.col("n") - 1) * F.col("prob")) \
        .withColumn("lo", F.floor("h")).withColumn("hi", F.ceil("h"))

    def pick(idx: str, name: str) -> DataFrame:
        c = cum.alias("c")
        p = pos.alias("p")
        cond = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
        cond += [F.col("c.cum") - F.col("c.cnt") <= F.col(f"p.{idx}"), F.col(f"p.{idx}") < F.col("c.cum")]
        j = c.join(p, cond) if by else c.join(F.broadcast(p), cond)
        return j.select(*[F.col(f"p.{k}").alias(k) for k in keys], F.col("p.prob").alias("prob"),
                        F.col("p.h").alias("h"), F.col("p.lo").alias("lo"), F.col("c.v").alias(name))

    lo = pick("lo", "v_lo")
    hi = pick("hi", "v_hi").drop("h", "lo")
    out = lo.join(hi, keys + ["prob"])
    val = F.col("v_lo") + (F.col("h") - F.col("lo")) * (F.col("v_hi") - F.col("v_lo"))
    return out.select(*keys, "prob", val.alias("value"))


def quantiles_wide(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Same as :func:`quantiles` with one column per probability (``names``)."""
    q = quantiles(df, cols, probs, by)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n) for p, n in zip(probs, names)]
    return q.groupBy(*by, "column").agg(*aggs)


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), hist: DataFrame | None = None) -> DataFrame:
    """Smallest most-frequent value per column (pandas ``mode()[0]``): ``(by..., column, mode, mode_count)``."""
    by = list(by)
    keys = by + ["column"]
    h = hist if hist is not None else value_histogram(df, cols, by)
    top = h.groupBy(*keys).agg(F.max("cnt").alias("mode_count"))
    return h.join(top, keys).where(F.col("cnt") == F.col("mode_count")) \
        .groupBy(*keys).agg(F.min("v").alias("mode"), F.first("mode_count").alias("mode_count"))
