"""Many random forests of a search grown together (L4).

Candidates that differ in the number of trees, the depth or ``min_samples_split`` alone are cuts of the same trees: the first
trees, their upper levels, without the splits of small nodes. Those that differ in ``min_samples_leaf`` share a tree as long
as the best split of a node suits all of them. So a search grows one forest per fold for each number of features tried at a
node and reads every candidate off it. The choices of a tree hang on its number and the path to a node alone, so a candidate
scores the same whatever it is searched with.

The trees are those of ``pyspark.ml``: Poisson(1) bags, up to 32 bins a column by weighted quantiles, Gini gain, the class
weights of a leaf as its probability. Columns of 0 and 1 that never meet in a row (one-hot levels) are held as one, and rows
of the same bins in all columns go down a tree as one, with the number of times they were drawn.

Rows are held by a task that grows trees, up to ``CELLS``; larger tables are fitted one by one by Spark.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import qcol
from riskframe.operators.blocks import MAX_COLUMNS, summed_blocks

#: Rows x columns that a task holds at most (about 20 bytes each).
CELLS = 16_000_000
#: Bins of a column, and one-hot levels held as one column at most.
BINS, LEVELS = 32, 250
#: Numbers of a group's histograms, and nodes of a group at most (their children are counted by 16 bits).
GROUP_CELLS, GROUP_NODES = 1_000_000, 8_000
#: Gains at most this are rounding.
NO_GAIN = 1e-13
#: Rows of a batch of scores.
OUT = 100_000


@dataclass
class Rows:
    """Rows in an order of their own: labels, weights, folds, numeric columns and codes of the one-hot columns; ``numeric``
    and ``levels``: the features of each."""
    y: np.ndarray
    w: np.ndarray
    fold: np.ndarray
    x: np.ndarray
    code: np.ndarray
    numeric: list[int]
    levels: list[list[int]]

    @property
    def n_features(self) -> int:
        return len(self.numeric) + sum(map(len, self.levels))


def _layout(both: np.ndarray, other: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """(numeric features, groups of 0/1 features that never meet): ``both`` counts rows where two features aren't 0,
    ``other`` values besides 0 and 1."""
    numeric, groups = [], []
    for j in range(len(other)):
        if other[j]:
            numeric.append(j)
        elif (g := next((g for g in groups if len(g) < LEVELS and not both[j, g].any()), None)) is not None:
            g.append(j)
        else:
            groups.append([j])
    return numeric, groups


def held_rows(df: DataFrame, features: str, label: str, weight: str | None, fold: str) -> Rows | None:
    """The rows of a table, None where they are too many for a task: a pass tells the columns apart, one writes the rows small."""
    src = df.select((qcol(label) == 1).cast("double").alias("y"), (qcol(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                    qcol(fold).cast("double").alias("k"), vector_to_array(F.col(features)).alias("x"))
    first = src.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to search on")
    d = first[0]
    if d > MAX_COLUMNS:
        return None

    def values(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("x").flatten().to_numpy().reshape(len(batch), d)

    def make(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        total = np.zeros((d + 2, d))
        for batch in batches:
            x = values(batch)
            there = (x != 0).astype(float)
            total[:d] += there.T @ there
            total[d] += ((x != 0) & (x != 1)).sum(axis=0)
            total[d + 1] += len(x)
        return {0: total}
    total = summed_blocks(src, make)[0].reshape(d + 2, d)                # features x features
    numeric, levels = _layout(total[:d], total[d])
    if total[d + 1, 0] * (len(numeric) + len(levels)) > CELLS:
        return None
    digit = np.zeros(d, np.uint8)
    for some in levels:
        digit[some] = np.arange(1, len(some) + 1)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = values(batch)
            code = np.zeros((len(x), len(levels)), np.uint8)
            for g, some in enumerate(levels):
                code[:, g] = ((x[:, some] != 0) * digit[some]).sum(axis=1)
            kept = [np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in "ywk"], axis=1), np.ascontiguousarray(x[:, numeric]), code]
            yield pa.RecordBatch.from_pydict({c: pa.array([v.tobytes()], pa.binary()) for c, v in zip("hxc", kept)})
    got = src.mapInArrow(small, "h binary, x binary, c binary").collect()        # at most CELLS
    head, x, code = (np.concatenate([np.frombuffer(r[c], t).reshape(-1, n) for r in got])
                     for c, t, n in (("h", float, 3), ("x", float, max(1, len(numeric))), ("c", np.uint8, max(1, len(levels)))))
    x, code = x.reshape(len(head), len(numeric)), code.reshape(len(head), len(levels))
    order = np.lexsort([*code.T, *x.T, *head.T])                                 # the same rows in the same order, wherever they lay
    return Rows(head[order, 0].astype(np.int8), head[order, 1], head[order, 2].astype(np.int32), x[order], code[order], numeric, levels)


def thresholds(v: np.ndarray, w: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Where Spark's trees cut a column: between all its values if they are few, else by strides of the weight."""
    values, at = np.unique(v, return_inverse=True)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    run = np.cumsum(np.bincount(at, weights=w))
    stride, cuts = run[-1] / bins, []
    target = stride
    for i in range(1, len(values)):
        if abs(run[i - 1] - target) < abs(run[i] - target):
            cuts.append(middle[i - 1])
            target += stride
    return np.array(cuts)


@dataclass
class Binned:
    """``cells``: the bins of the columns, rows alike in all of them once; ``of``: where each row is among them; ``start``: the
    number of a column's first bin among all. A split sends right what lies in ``span`` + 1 bins of its column from ``lo`` on."""
    cells: np.ndarray
    of: np.ndarray
    y: np.ndarray
    w: np.ndarray
    scale: np.ndarray | None           # the weight of each class where rows of a class weigh the same
    start: np.ndarray                  # and the number of all bins
    feature: np.ndarray
    column: np.ndarray
    lo: np.ndarray
    span: np.ndarray
    n_features: int

    def sums(self, drawn: np.ndarray) -> np.ndarray:
        """sums x cells x classes: how often their rows were drawn and, where the class doesn't say it, with what weight."""
        at = self.of * 2 + self.y
        return np.stack([np.bincount(at, v, 2 * len(self.cells)).reshape(-1, 2) for v in ([drawn] if self.scale is not None else [drawn, drawn * self.w])])


def binned(rows: Rows, train: np.ndarray) -> Binned:
    """The rows under the bins of the ``train`` rows."""
    columns, splits, start = [], [], [0]
    for c, f in enumerate(rows.numeric):
        cuts = thresholds(rows.x[train, c], rows.w[train])
        columns.append(np.searchsorted(cuts, rows.x[:, c], side="left"))
        splits += [(f, c, j + 1, len(cuts) - j - 1) for j in range(len(cuts))]
        start.append(start[-1] + len(cuts) + 1)
    for g, some in enumerate(rows.levels):
        columns.append(rows.code[:, g])
        splits += [(f, len(rows.numeric) + g, j, 0) for j, f in enumerate(some, 1)]
        start.append(start[-1] + len(some) + 1)
    feature, column, lo, span = np.array(splits, np.int64).reshape(-1, 4).T
    cells = np.ascontiguousarray(np.stack(columns, axis=1).astype(np.uint8))
    _, at, of = np.unique(cells.view(np.dtype((np.void, cells.shape[1]))).ravel(), return_index=True, return_inverse=True)
    weights = [np.unique(rows.w[train][rows.y[train] == c]) for c in (0, 1)]
    scale = np.array([v[0] if len(v) else 0.0 for v in weights]) if all(len(v) < 2 for v in weights) else None
    return Binned(cells[at], of, rows.y.astype(np.int64), rows.w, scale, np.array(start), feature, column, lo.astype(np.uint8),
                  span.astype(np.uint8), rows.n_features)


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64: evenly spread 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Tree:
    """Nodes by number, a parent before its children; for each ``min_leaf`` the children (``left``, ``left`` + 1; -1: a leaf) and
    the leaf of each of the cells."""
    parent: np.ndarray
    depth: np.ndarray
    count: np.ndarray
    value: np.ndarray
    left: np.ndarray
    leaf: np.ndarray

    def cut(self, i: int, depths: np.ndarray, least: np.ndarray) -> np.ndarray:
        """nodes x cuts of the tree of the ``min_leaf`` at ``i``: what a row that comes to a node gets where it ends at a depth and splits no node of fewer than
        ``least`` rows. As in Spark, two leaves of a node that predict the same class are one, before small splits go."""
        levels = np.split(np.argsort(self.depth, kind="stable"), np.cumsum(np.bincount(self.depth))[:-1])
        one, left = self.value > 0.5, self.left[i]
        ends = np.empty((len(self.depth), len(depths)), bool)
        for d in set(depths.tolist()):
            ended = (left < 0) | (self.depth >= d)
            for some in levels[:min(d, len(levels))][::-1]:
                some = some[~ended[some]]
                a = left[some]
                ended[some] = ended[a] & ended[a + 1] & (one[a] == one[a + 1])
            ends[:, depths == d] = ended[:, None]
        ends |= self.count[:, None] < least
        out = np.repeat(self.value[:, None], len(depths), axis=1)
        for some in levels[1:]:
            up = self.parent[some]
            out[some] = np.where(ends[up], out[up], out[some])
            ends[some] |= ends[up]
        return out


def grow(b: Binned, sums: np.ndarray, tried: int, min_leaf: Sequence[int], max_depth: int, seed: int) -> Tree:
    """Trees on the ``sums`` of drawn rows, one for each of ``min_leaf`` (rows of a child at least, in rising order), with
    ``tried`` features a node. A node is shared by those (``who``, as bits) that came to it by the same splits. Cells of which
    no row was drawn are only sent down.

    Groups of nodes are split together. A group holds the histograms of its nodes; of two children the smaller one's is
    counted, the other's is what is left. Groups grow depth first, so few of them are held at a time."""
    flat, n_bins, size = b.cells.ravel(), int(b.start[-1]), len(b.cells)
    from_bin = b.start[b.column] + b.lo
    to_bin = from_bin + b.span + 1
    scale = np.ones(2) if b.scale is None else b.scale
    width, k_columns = 2 * n_bins, b.cells.shape[1]
    there = sums[0] > 0

    def counted(rows: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
        out = np.empty((len(sums), k, 2, n_bins))
        for c in (0, 1):
            some = there[:, c].take(rows)
            own = rows[some]
            at = (node[some] * n_bins)[:, None] + b.start[:-1]
            at += b.cells.take(own, axis=0)
            at = at.ravel()
            for v, x in enumerate(sums):
                out[v, :, c] = np.bincount(at, np.repeat(x[:, c].take(own), k_columns), k * n_bins).reshape(k, n_bins)
        return out

    sorts, bits = len(min_leaf), np.uint8(1) << np.arange(len(min_leaf), dtype=np.uint8)
    most = 2 * size * sorts + 1
    parent, depth, left = np.zeros(most, np.int64), np.zeros(most, np.int64), np.full((sorts, most), -1, np.int64)
    count, value = np.zeros(most), np.zeros(most)
    leaf = np.zeros((sorts, size), np.int64)
    nodes = 1
    salt = _mixed(np.arange(b.n_features, dtype=np.uint64))
    group = max(1, min(GROUP_NODES, GROUP_CELLS // (width * len(sums))))
    stack = [(np.arange(size), np.array([size]), counted(np.arange(size), np.zeros(size, np.int64), 1), np.zeros(1, np.int64),
              _mixed(np.array([seed], np.uint64)), bits.sum(keepdims=True, dtype=np.uint8), 0)]
    while stack:
        rows, sizes, hist, ids, path, who, level = stack.pop()
        total = hist[..., :b.start[1]].sum(axis=-1)                 # sums x nodes x classes
        n, s = total[0].sum(axis=1), total[-1] * scale
        weight = s.sum(axis=1)
        count[ids], depth[ids] = n, level
        value[ids] = np.divide(s[:, 1], weight, out=np.zeros(len(ids)), where=weight > 0)
        mine = (who[:, None] & bits) > 0
        split = mine & (n[:, None] >= 2 * np.array(min_leaf)) & ((s > 0).all(axis=1) & (level < max_depth))[:, None]
        pick = np.full(split.shape, -1)
        at = np.flatnonzero(split.any(axis=1))
        if len(b.lo) and len(at):
            run = np.zeros((len(sums), len(at), 2, n_bins + 1))
            np.cumsum(hist[:, at], axis=-1, out=run[..., 1:])
            right = run[..., to_bin] - run[..., from_bin]           # sums x nodes x classes x splits
            held = right[0, :, 0] + right[0, :, 1]
            one = right[-1, :, 1] * scale[1]
            both = right[-1, :, 0] * scale[0] + one
            all_of = weight[at, None]
            apart = s[at, 1:] * both - one * all_of
            spread = both * (all_of - both)
            gain = np.divide(2 * apart * apart, spread * all_of * all_of, out=np.full(spread.shape, -1.0), where=spread > 0)
            if tried < b.n_features:
                lot = _mixed(path[at, None] ^ salt)
                gain[~(lot <= np.partition(lot, tried - 1, axis=1)[:, tried - 1:tried])[:, b.feature]] = -1.0
            fewer, every = np.minimum(held, n[at, None] - held), np.arange(len(at))
            best, todo = np.zeros(len(at), np.int64), every
            for i, m in enumerate(min_leaf):                        # the best split suits the next as well unless its children are too few
                if i:
                    todo = np.flatnonzero(fewer[every, best] < m)
                best[todo] = np.where(fewer[todo] >= m, gain[todo], -1.0).argmax(axis=1)
                good = split[at, i] & (fewer[every, best] >= m) & (gain[every, best] > NO_GAIN)
                pick[at[good], i] = best[good]
        for i in range(sorts):
            ends = mine[:, i] & (pick[:, i] < 0)
            if ends.any():
                leaf[i, rows[np.repeat(ends, sizes)]] = np.repeat(ids[ends], sizes[ends])
        node, sort = np.nonzero(pick >= 0)
        if not len(node):
            continue
        splits, which = np.unique(node * len(b.lo) + pick[node, sort], return_inverse=True)
        node_of, best = np.divmod(splits, len(b.lo))                # a node comes once for each of its splits
        k = len(splits)
        first, sizes_of = np.cumsum(sizes) - sizes, sizes[node_of]
        rows = rows.take(np.repeat(first[node_of] - (np.cumsum(sizes_of) - sizes_of), sizes_of) + np.arange(sizes_of.sum()))
        sizes = sizes_of
        cell = flat.take(rows * k_columns + np.repeat(b.column[best], sizes))
        cell -= np.repeat(b.lo[best], sizes)                        # what lies under lo becomes large
        child = np.repeat(np.arange(0, 2 * k, 2, dtype=np.uint16), sizes)
        child += cell <= np.repeat(b.span[best], sizes)
        order = np.argsort(child, kind="stable")
        rows, child = rows.take(order), child.take(order)
        sizes = np.bincount(child, minlength=2 * k)
        small = 2 * np.arange(k) + (sizes[1::2] < sizes[::2])
        large = small ^ 1
        fewer = np.zeros(2 * k, bool)
        fewer[small] = True
        some = fewer[child]
        made = np.empty((len(sums), 2 * k, 2, n_bins))
        made[:, small] = counted(rows[some], (child[some] >> 1).astype(np.int64), k)
        made[:, large] = hist[:, node_of] - made[:, small]
        new = nodes + np.arange(2 * k)
        nodes += 2 * k
        left[sort, ids[node]] = new[2 * which]
        shared = np.zeros(k, np.uint8)
        for i in range(sorts):
            shared[which[sort == i]] |= bits[i]
        parent[new], who = np.repeat(ids[node_of], 2), np.repeat(shared, 2)
        path = _mixed(np.repeat(path[node_of], 2) * np.uint64(2) + np.tile(np.array([0, 1], np.uint64), k))
        ends = np.cumsum(sizes)
        for a in range(0, 2 * k, group):
            z = min(a + group, 2 * k)
            stack.append((rows[ends[a] - sizes[a]:ends[z - 1]], sizes[a:z], made[:, a:z], new[a:z], path[a:z], who[a:z], level + 1))
    return Tree(parent[:nodes], depth[:nodes], count[:nodes], value[:nodes], left[:, :nodes], leaf)


def tried_features(strategy: str, d: int) -> int | None:
    """Features tried at a node, as Spark counts them; None: a strategy that is not known here."""
    return {"sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(max(1, d)))), "all": d}.get(strategy)


def together(estimators: Sequence) -> bool:
    """Forests alike in all but the settings of the search."""
    from riskframe.operators.models import Forest
    searched = {"numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy"}
    if not all(type(e) is Forest and tried_features(e.settings["featureSubsetStrategy"], 1) for e in estimators):
        return False
    common = [{k: v for k, v in e.settings.items() if k not in searched} for e in estimators]
    usual = {k: v for k, v in Forest().settings.items() if k not in searched}
    return bool(common) and all(c == common[0] for c in common) and \
        all(common[0].get(k) == usual[k] for k in usual if k not in ("featuresCol", "labelCol", "weightCol", "seed")) and \
        set(common[0]) <= set(usual)


def scored_folds(df: DataFrame, estimators: Sequence, folds: int, fold: str) -> DataFrame | None:
    """Rows (candidate, fold, _test, label, score, alike, fit_s, score_s): every candidate fitted without every fold, on all
    rows (``alike``: so many rows of the same bins); the seconds are those of its trees, shared out evenly among the
    candidates read off them. None: too large to grow together."""
    settings = estimators[0].settings
    rows = held_rows(df, settings["featuresCol"], settings["labelCol"], settings.get("weightCol"), fold)
    if rows is None:
        return None
    cores = df.sparkSession.sparkContext.defaultParallelism
    tried = [tried_features(e.settings["featureSubsetStrategy"], rows.n_features) for e in estimators]
    leaves = [e.settings["minInstancesPerNode"] for e in estimators]
    shared = len(set(tried)) * folds >= cores                      # with more cores each ``min_leaf`` grows its own trees, the same ones
    families: dict[tuple, list[int]] = {}
    for c in range(len(estimators)):
        families.setdefault((tried[c], 0 if shared else leaves[c]), []).append(c)
    cuts = [(e.settings["numTrees"], e.settings["maxDepth"], e.min_split, m) for e, m in zip(estimators, leaves)]
    jobs = [(k, *f) for f in sorted(families, reverse=True) for k in range(folds)]          # many features take longest: first
    sent, seed = df.sparkSession.sparkContext.broadcast(rows), settings["seed"]           # at most CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from _scored(sent.value, *jobs[i][:2], {c: cuts[c] for c in families[jobs[i][1:]]}, seed)
    return df.sparkSession.range(0, len(jobs), 1, len(jobs)).mapInArrow(
        run, "candidate int, fold int, _test boolean, label int, score double, alike double, fit_s double, score_s double")


def _scored(rows: Rows, k: int, tried: int, cuts: dict[int, tuple[int, int, int, int]], seed: int) -> Iterator[pa.RecordBatch]:
    """The scores of candidates by number: (trees, depth, least rows of a split, of a leaf) of forests without fold ``k``."""
    t0, scoring = time.time(), 0.0
    train = np.flatnonzero(rows.fold != k)
    if not len(train):
        raise ValueError(f"no rows to fit on without fold {k}")
    b = binned(rows, train)
    trees, depths, least, leaves = (np.array(v) for v in zip(*cuts.values()))
    min_leaf = sorted(set(leaves.tolist()))
    of_leaf = [np.flatnonzero(leaves == m) for m in min_leaf]
    score = np.zeros((len(b.cells), len(cuts)))
    drawn = np.zeros(len(rows.y))
    for t in range(trees.max()):
        g = np.random.default_rng([seed, t])
        drawn[train] = g.poisson(1.0, len(train))
        tree = grow(b, b.sums(drawn), tried, min_leaf, int(depths.max()), int(g.integers(1 << 62)))
        t1 = time.time()
        for i, some in enumerate(of_leaf):
            some = some[trees[some] > t]
            if len(some):
                score[:, some] += tree.cut(i, depths[some], least[some])[tree.leaf[i]]
        scoring += time.time() - t1
    fitting = time.time() - t0 - scoring
    score /= trees
    kinds = np.bincount((b.of * 2 + b.y) * 2 + (rows.fold == k), minlength=4 * len(b.cells))
    at = np.flatnonzero(kinds)
    label, test, alike = ((at >> 1) & 1).astype(np.int32), (at & 1).astype(bool), kinds[at].astype(float)
    for j, c in enumerate(cuts):
        for a in range(0, len(at), OUT):
            some = slice(a, a + OUT)
            n = len(at[some])
            yield pa.RecordBatch.from_pydict({
                "candidate": pa.array(np.full(n, c, np.int32)), "fold": pa.array(np.full(n, k, np.int32)), "_test": pa.array(test[some]),
                "label": pa.array(label[some]), "score": pa.array(score[at[some] >> 2, j]), "alike": pa.array(alike[some]),
                "fit_s": pa.array(np.full(n, fitting / len(cuts))), "score_s": pa.array(np.full(n, scoring / len(cuts)))})
