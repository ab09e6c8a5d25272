"""Many penalised logistic models fitted together (L2, V5-V8).

The models differ in the rows they are fitted on (a fold, a bootstrap replicate, a fraction), in C or in the penalty. A
*design* is an integer column that says how often a row counts; all designs of a table are written once beside its
vectors. Every step of Newton's method is one pass over that table for all unfinished models: a task sums losses,
gradients and Hessians of its rows, the sums are merged per model, and the driver solves the small systems (soft
thresholds for an L1 penalty) and halves a step that did not improve. So a hundred models take as many passes as one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import qcol
from riskframe.operators.blocks import summed_blocks
from riskframe.operators.metrics import grouped_metrics
from riskframe.session import cut_lineage

#: Features of a batched fit at most: a model's Hessian (half of the square) goes from every task to the driver.
MAX_FEATURES = 1_000
#: Numbers that a task holds at once in products of features, and models that it works on together.
CELLS, MODELS_AT_ONCE = 4_000_000, 128


def _rows(batch: pa.RecordBatch, d: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(``d`` features and 1, labels, weights, multiplicities) of slices of a batch of which ``k`` numbers a row are made."""
    for at in range(0, len(batch), max(1, CELLS // max(1, k))):
        part = batch.slice(at, max(1, CELLS // max(1, k)))
        x = np.ones((len(part), d + 1))
        x[:, :-1] = part.column("x").flatten().to_numpy().reshape(len(part), -1)
        yield x, part.column("y").to_numpy(), part.column("w").to_numpy(), part.column("m").flatten().to_numpy().reshape(len(part), -1)


@dataclass
class Fit:
    """One model: what it is fitted on and how, and the outcome (coefficients, the intercept last)."""
    design: str
    C: float = 1.0
    penalty: str = "l2"
    beta: np.ndarray = field(default=None, repr=False)
    steps: int = 0
    residual: float = float("inf")               # of the optimality conditions, per unit of weight

    @property
    def coefficients(self) -> np.ndarray:
        return self.beta[:-1]

    @property
    def intercept(self) -> float:
        return float(self.beta[-1])


class Batch:
    """A model table with its designs, written once to the shared folder."""

    def __init__(self, df: DataFrame, designs: Mapping[str, Column] | Sequence[str], features: str = "features", label: str = "target",
                 weight: str | None = "weight", threshold: float = 0.5, counts: Column | None = None):
        """``designs``: by name the column of each, or the names alone beside ``counts``, an array column of all."""
        self.names, self.label, self.threshold = list(designs), label, threshold
        counts = F.array(*[F.coalesce(c, F.lit(0)).cast("tinyint") for c in designs.values()]) if counts is None else counts.cast("array<tinyint>")
        self.at = {n: i for i, n in enumerate(self.names)}
        first = df.select(F.size(vector_to_array(F.col(features)))).first()
        self.n_features = first[0] if first else 0
        if self.n_features > MAX_FEATURES:
            raise ValueError(f"{self.n_features} features: batched fits take {MAX_FEATURES}; fit models one by one instead")
        self.table = cut_lineage(df.select(
            (qcol(label) == 1).cast("double").alias("y"), (qcol(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
            vector_to_array(F.col(features)).alias("x"), counts.alias("m")))

    # -- one pass

    def _sums(self, fits: Sequence[Fit]) -> dict[int, np.ndarray]:
        """Weight, loss, gradient and Hessian (upper half) of each model at its ``beta``."""
        d = self.n_features + 1
        upper = np.triu_indices(d)
        beta, design = np.stack([f.beta for f in fits], axis=1), np.array([self.at[f.design] for f in fits])
        sent = self.table.sparkSession.sparkContext.broadcast((beta, design))        # models x features
        features = self.n_features

        def make(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
            beta, design = sent.value
            out = np.zeros((len(design), 2 + d + len(upper[0])))
            for batch in batches:
                for x, y, w, m in _rows(batch, features, len(upper[0]) + MODELS_AT_ONCE):
                    pairs = x[:, upper[0]] * x[:, upper[1]]
                    for a in range(0, len(design), MODELS_AT_ONCE):
                        some = slice(a, a + MODELS_AT_ONCE)
                        z, own = x @ beta[:, some], w[:, None] * m[:, design[some]]
                        p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                        out[some, 0] += own.sum(axis=0)
                        out[some, 1] += (own * (np.logaddexp(0, z) - y[:, None] * z)).sum(axis=0)
                        out[some, 2:2 + d] += (own * (p - y[:, None])).T @ x
                        out[some, 2 + d:] += (own * p * (1 - p)).T @ pairs
            return dict(enumerate(out))
        return summed_blocks(self.table, make)                                       # models x features^2 / 2

    # -- the fits

    def fit(self, fits: Sequence[Fit], tol: float = 1e-9, max_steps: int = 60) -> list[Fit]:
        """The fits with their coefficients: minima of sum(w * loss) + |b|^2 / 2C or |b|_1 / C (intercepts free)."""
        d = self.n_features + 1
        upper = np.triu_indices(d)
        free = np.append(np.ones(d - 1), 0.0)
        best: dict[int, tuple] = {}
        todo = list(range(len(fits)))
        for f in fits:
            f.beta, f.steps = np.zeros(d), 0
        while todo:
            sums = self._sums([fits[i] for i in todo])
            still = []
            for k, i in enumerate(todo):
                f = fits[i]
                if k not in sums or sums[k][0] <= 0:
                    raise ValueError(f"no rows with a positive weight to fit {f.design} on")
                weight, loss, g, lam = sums[k][0], sums[k][1], sums[k][2:2 + d], 1.0 / f.C
                b, l1 = f.beta, f.penalty == "l1"
                loss += lam * (np.abs(b[:-1]).sum() if l1 else 0.5 * (b[:-1] ** 2).sum())
                f.steps += 1
                if i in best and loss > best[i][0] + 1e-12 * abs(best[i][0]):
                    if f.steps < max_steps and np.abs(b - best[i][1]).max() > 1e-15:
                        f.beta = (b + best[i][1]) / 2
                        still.append(i)
                    else:
                        f.beta = best[i][1]
                    continue
                h = np.zeros((d, d))
                h[upper] = sums[k][2 + d:]
                h = h + np.triu(h, 1).T
                best[i] = (loss, b)
                if l1:
                    off = np.where(b != 0, np.abs(g + lam * np.sign(b)), np.maximum(np.abs(g) - lam, 0))
                    off[-1] = abs(g[-1])
                else:
                    off = np.abs(g + lam * free * b)
                f.residual = float(off.max() / weight)
                if f.residual < tol or f.steps >= max_steps:
                    continue
                f.beta = b + (_lasso_step(g, h, b, lam) if l1 else _solved(h + np.diag(lam * free), -(g + lam * free * b)))
                still.append(i)
            todo = still
        return list(fits)

    # -- scores

    def score(self, fits: Sequence[Fit], on: Sequence[str]) -> DataFrame:
        """(model, label, score): each model on the rows of its design in ``on``; ``model``: the place in ``fits``."""
        beta = np.stack([f.beta for f in fits], axis=1)
        sent = self.table.sparkSession.sparkContext.broadcast((beta, np.array([self.at[n] for n in on])))
        features = self.n_features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            beta, test = sent.value
            for batch in batches:
                for x, y, _, m in _rows(batch, features, features + 3 * beta.shape[1]):
                    which, model = np.nonzero(m[:, test])
                    p = 1 / (1 + np.exp(-np.clip(x @ beta, -700, 700)))
                    yield pa.RecordBatch.from_pydict({"model": pa.array(model, pa.int32()), "label": pa.array(y[which].astype(np.int32)), "score": p[which, model]})
        return self.table.select("y", "w", "x", "m").mapInArrow(run, "model int, label int, score double")

    def metrics(self, fits: Sequence[Fit], on: Sequence[str]) -> list[dict]:
        """The CV metrics of each model on its design of ``on``, all from one grouped curve; a row a model."""
        scored = cut_lineage(self.score(fits, on))
        by = {r["model"]: r.asDict() for r in grouped_metrics(scored, ["model"], threshold=self.threshold).collect()}
        return [by.get(i, {}) for i in range(len(fits))]


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:                                  # separable or collinear and nearly unpenalised
        return np.linalg.lstsq(a, b, rcond=None)[0]


def _lasso_step(g: np.ndarray, h: np.ndarray, b: np.ndarray, lam: float, sweeps: int = 30) -> np.ndarray:
    """The minimum of g.s + s.H.s / 2 + lam |b + s|_1 (the last coefficient free): some sweeps by coordinates, which find most
    of the zeros, then exact minima over the others, one zero more or less at a time. Coordinates alone hardly move along a
    flat direction (a column that is the sum of two others), where the penalty decides."""
    s, slope = np.zeros(len(b)), g.copy()
    scale = max(np.abs(b).max(), 1.0)
    for _ in range(sweeps):
        most = 0.0
        for j in range(len(b)):
            hj = h[j, j]
            if hj <= 0:
                continue
            now, u = b[j] + s[j], b[j] + s[j] - slope[j] / hj
            new = u if j == len(b) - 1 else np.sign(u) * max(abs(u) - lam / hj, 0.0)
            if new != now:
                s[j] += new - now
                slope += h[:, j] * (new - now)
                most = max(most, abs(new - now))
        if most < 1e-13 * scale:
            break
    return _exact_lasso(g - h @ b, h, b + s, lam) - b


def _exact_lasso(q: np.ndarray, h: np.ndarray, u: np.ndarray, lam: float) -> np.ndarray:
    """The minimum of q.u + u.H.u / 2 + lam |u|_1 (the last coefficient free), from ``u`` on: with the signs kept, a step to the
    minimum over the coefficients that aren't zero or, along a flat slope, as far as it goes, at most to the first that
    becomes zero; at a minimum the zero whose condition is violated most is let go. No step makes the sum larger."""
    d, u = len(u), u.copy()
    pen, sign, held = np.append(np.full(d - 1, lam), 0.0), np.append(np.sign(u[:-1]), 0.0), np.append(u[:-1] != 0, True)
    for _ in range(20 * d):
        at = np.flatnonzero(held)
        noise = 1e-13 * max(np.abs(q).max(), np.abs(h).max() * max(1.0, np.abs(u).max()))
        value, vector = np.linalg.eigh(h[np.ix_(at, at)])
        part = vector.T @ ((q + h @ u)[at] + (pen * sign)[at])
        flat = value <= 1e-12 * max(value[-1], 0.0)
        sloped = flat & (np.abs(part) > noise)
        move = -vector @ (np.where(sloped, part, 0.0) if sloped.any() else np.where(flat, 0.0, part / np.where(flat, 1.0, value)))
        towards = sign[at] * move < 0
        reach = np.where(towards, -u[at] / np.where(towards, move, 1.0), np.inf)
        far = np.inf if sloped.any() else 1.0
        step = min(far, reach.min())
        if not np.isfinite(step):                                  # a slope without end: rounding, nothing to gain
            break
        u[at] += step * move
        if step < far:
            k = at[reach.argmin()]
            u[k], sign[k], held[k] = 0.0, 0.0, False
            continue
        slope = q + h @ u
        over = np.where(held, 0.0, np.abs(slope) - pen)
        k = int(over.argmax())
        if over[k] <= noise:
            break
        sign[k], held[k] = -np.sign(slope[k]), True
    return u


def optimality(batch: Batch, fits: Sequence[Fit]) -> DataFrame:
    """(model, residual): the largest violation of the conditions of each fit's minimum, per unit of weight, from gradients
    that are summed afresh by relational aggregates (0: the exact minimum)."""
    spark, d = batch.table.sparkSession, batch.n_features
    known = spark.createDataFrame([(k, batch.at[f.design], f.penalty == "l1", 1.0 / f.C, f.beta.tolist()) for k, f in enumerate(fits)],
                                  "model int, design int, l1 boolean, lam double, b array<double>")      # models x features
    one = F.concat("x", F.array(F.lit(1.0)))
    z = F.aggregate(F.zip_with(one, "b", lambda u, v: u * v), F.lit(0.0), lambda u, v: u + v)
    t = batch.table.join(F.broadcast(known)).withColumn("own", F.col("w") * F.element_at("m", F.col("design") + 1)).where("own > 0")
    t = t.select("model", "own", (F.col("own") * (1 / (1 + F.exp(-z)) - F.col("y"))).alias("r"), "x")
    sums = t.groupBy("model").agg(F.sum("own").alias("weight"), F.array(*[F.sum(F.col("r") * F.col("x")[j]) for j in range(d)], F.sum("r")).alias("g"))
    held = sums.join(known, "model")
    slope, lam = F.col("e.g"), F.col("lam")
    free = F.col("e.j") == d
    off = F.when(free, F.abs(slope)).when(~F.col("l1"), F.abs(slope + lam * F.col("e.b"))) \
        .when(F.col("e.b") != 0, F.abs(slope + lam * F.signum("e.b"))).otherwise(F.greatest(F.abs(slope) - lam, F.lit(0.0)))
    each = F.explode(F.zip_with(F.sequence(F.lit(0), F.lit(d)), F.arrays_zip("g", "b"), lambda j, gb: F.struct(j.alias("j"), gb["g"].alias("g"), gb["b"].alias("b")))).alias("e")
    return held.select("model", "weight", "l1", "lam", each).groupBy("model").agg((F.max(off / F.col("weight"))).alias("residual"))


# -- protocols: every fit of a protocol in one batch, every metric of it from one curve

#: The metrics of the CV protocols, as in validate.CV_METRICS.
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def _folds(k: int, fold: str) -> dict[str, Column]:
    return {f"train{i}": (qcol(fold) != i).cast("int") for i in range(k)} | {f"test{i}": (qcol(fold) == i).cast("int") for i in range(k)}


def _number(x) -> float | None:
    return None if x is None else float(x)


def search_logistic(df: DataFrame, grid: Sequence[Mapping], folds: int = 5, label: str = "target", fold: str = "fold",
                    weight: str | None = "weight") -> DataFrame:
    """L2: a row per candidate (settings C and penalty) with AUC of every fold, means, stds and rank, like
    ``models.search_cv``; the times are the batch's, shared out evenly."""
    import json
    import time

    from riskframe.operators.models import _mean, _std, search_ranks
    batch = Batch(df, _folds(folds, fold), label=label, weight=weight)
    fits = [Fit(f"train{i}", p["C"], p["penalty"]) for p in grid for i in range(folds)]
    t0 = time.time()
    batch.fit(fits)
    t1 = time.time()
    test = [_number(m.get("roc_auc")) for m in batch.metrics(fits, [f"test{i}" for _ in grid for i in range(folds)])]
    each_fit, each_score = (t1 - t0) / len(fits), (time.time() - t1) / len(fits)
    train = [_number(m.get("roc_auc")) for m in batch.metrics(fits, [f.design for f in fits])]
    rows = []
    for c, p in enumerate(grid):
        a, b = test[c * folds:(c + 1) * folds], train[c * folds:(c + 1) * folds]
        rows.append((c, json.dumps(dict(p), sort_keys=True), each_fit, 0.0, each_score, 0.0, a, _mean(a), _std(a), b, _mean(b), _std(b)))
    return search_ranks(df.sparkSession, rows)


def nested_logistic(df: DataFrame, grid: Sequence[Mapping], outer: int = 3, inner: int = 3, label: str = "target", fold: str = "fold",
                    key: str = "encounter_id", seed: int = 7, weight: str | None = "weight") -> DataFrame:
    """V5: rows (outer_fold, best_params, inner_auc, outer_auc): the candidate with the best mean inner AUC (the first of
    equals) on every outer training part, refitted and graded on the outer test part. Two batches of fits in all."""
    import json

    from riskframe.operators.features import stratified_fold_sets
    parts = [F.when(qcol(fold) != o, 1).otherwise(0) for o in range(outer)]
    t, designs = stratified_fold_sets(df, label, key, inner, range(seed, seed + outer), "_in", parts), {}
    for o in range(outer):
        inside = qcol(fold) != o
        designs |= {f"outer{o}": inside.cast("int"), f"left{o}": (~inside).cast("int")}
        for i in range(inner):
            designs |= {f"train{o}.{i}": (inside & (F.col("_in")[o] != i)).cast("int"), f"test{o}.{i}": (inside & (F.col("_in")[o] == i)).cast("int")}
    batch = Batch(t, designs, label=label, weight=weight)
    fits = [Fit(f"train{o}.{i}", p["C"], p["penalty"]) for o in range(outer) for p in grid for i in range(inner)]
    aucs = [m.get("roc_auc") or 0.0 for m in batch.metrics(batch.fit(fits), [f.design.replace("train", "test") for f in fits])]
    means = [[sum(aucs[(o * len(grid) + g) * inner:(o * len(grid) + g + 1) * inner]) / inner for g in range(len(grid))] for o in range(outer)]
    best = [m.index(max(m)) for m in means]
    again = batch.fit([Fit(f"outer{o}", grid[g]["C"], grid[g]["penalty"]) for o, g in enumerate(best)])
    graded = batch.metrics(again, [f"left{o}" for o in range(outer)])
    rows = [(o, json.dumps(dict(grid[g]), sort_keys=True), float(means[o][g]), _number(graded[o].get("roc_auc"))) for o, g in enumerate(best)]
    return df.sparkSession.createDataFrame(rows, "outer_fold int, best_params string, inner_auc double, outer_auc double")


def bootstrap_logistic(df: DataFrame, replicates: int = 100, key: str = "encounter_id", label: str = "target", seed: int = 42,
                       C: float = 1.0, penalty: str = "l2", weight: str | None = "weight") -> DataFrame:
    """V6: rows (replicate, accuracy, precision, recall, f1, roc_auc): fitted with Poisson(1) counts of the rows, graded on
    the rows that were not drawn; the draws are those of ``validate.bootstrap_weights``."""
    from riskframe.functions.core import poisson1, uniform
    drawn = F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), lambda b: poisson1(uniform(F.concat(F.lit(f"{seed}:"), b.cast("string")), qcol(key))))
    both = F.concat("_drawn", F.transform("_drawn", lambda n: (n == 0).cast("int")))
    names = [f"in{b}" for b in range(replicates)] + [f"out{b}" for b in range(replicates)]
    batch = Batch(df.withColumn("_drawn", drawn), names, label=label, weight=weight, counts=both)
    fits = batch.fit([Fit(f"in{b}", C, penalty) for b in range(replicates)])
    graded = batch.metrics(fits, [f"out{b}" for b in range(replicates)])
    return df.sparkSession.createDataFrame([(b, *[_number(g.get(c)) for c in METRICS]) for b, g in enumerate(graded)],
                                           "replicate int, " + ", ".join(f"{c} double" for c in METRICS))


def learning_curve_logistic(df: DataFrame, fractions: Sequence[float], folds: int = 5, key: str = "encounter_id", label: str = "target",
                            fold: str = "fold", seed: int = 42, C: float = 1.0, penalty: str = "l2", weight: str | None = "weight") -> DataFrame:
    """V7: per (fraction, metric) mean and std over the folds on the rows trained on and on those left out, and their gap."""
    from riskframe.functions.core import uniform
    u = uniform(f"lc{seed}", qcol(key))
    designs = _folds(folds, fold) | {f"part{f}.{i}": ((qcol(fold) != i) & (u <= f)).cast("int") for f in fractions for i in range(folds)}
    batch = Batch(df, designs, label=label, weight=weight)
    jobs = [(f, i) for f in fractions for i in range(folds)]
    fits = batch.fit([Fit(f"part{f}.{i}", C, penalty) for f, i in jobs])
    train, val = batch.metrics(fits, [x.design for x in fits]), batch.metrics(fits, [f"test{i}" for _, i in jobs])
    rows = [(float(f), i, c, _number(a.get(c)), _number(b.get(c))) for (f, i), a, b in zip(jobs, train, val, strict=True) for c in METRICS]
    res = df.sparkSession.createDataFrame(rows, "fraction double, fold int, metric string, train double, val double")
    return res.groupBy("fraction", "metric").agg(F.avg("train").alias("train_mean"), F.stddev_pop("train").alias("train_std"),
                                                 F.avg("val").alias("val_mean"), F.stddev_pop("val").alias("val_std")) \
        .withColumn("gap", F.col("train_mean") - F.col("val_mean"))


def stability_logistic(df: DataFrame, runs: int = 20, folds: int = 5, key: str = "encounter_id", label: str = "target",
                       C: float = 1.0, penalty: str = "l2", weight: str | None = "weight") -> tuple[DataFrame, list[np.ndarray]]:
    """V8: AUC per (run, fold) of ``runs`` reseeded CVs, and the coefficients of every fit in the same order."""
    from riskframe.operators.features import stratified_fold_sets
    t, designs = stratified_fold_sets(df, label, key, folds, range(1000, 1000 + runs), "_f"), {}
    for r in range(runs):
        designs |= {f"train{r}.{i}": (F.col("_f")[r] != i).cast("int") for i in range(folds)}
        designs |= {f"test{r}.{i}": (F.col("_f")[r] == i).cast("int") for i in range(folds)}
    batch = Batch(t, designs, label=label, weight=weight)
    jobs = [(r, i) for r in range(runs) for i in range(folds)]
    fits = batch.fit([Fit(f"train{r}.{i}", C, penalty) for r, i in jobs])
    graded = batch.metrics(fits, [f"test{r}.{i}" for r, i in jobs])
    scores = df.sparkSession.createDataFrame([(r, i, _number(g.get("roc_auc"))) for (r, i), g in zip(jobs, graded, strict=True)],
                                             "run int, fold int, roc_auc double")
    return scores, [f.coefficients for f in fits]
