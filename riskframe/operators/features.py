"""Feature preparation (F1-F10) and fold assignment (V1).

SQL-checkable column forms (named 0/1 dummies, explicit scaling arithmetic)
sit beside the pyspark.ml vector path used for model fitting. Randomness is
a hash of (seed, key): splits and folds are reproducible in any engine and on
any partitioning, and re-running a task after an executor loss gives the
same assignment.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import hash_order, is_numeric_type, qcol, uniform
from riskframe.operators.lookup import bounded_broadcast
from riskframe.operators.ordered import rank_by_hash, rank_within
from riskframe.session import cut_lineage

# --- fixed values --------------------------------------------------------------
TEST_SIZE = 0.2
SEED = 42
DRIFT_WARN = 0.5
SMOTE_NEIGHBOURS = 5
FEW_ROWS = 20_000             # rows around the quotas that the driver sees when a split is found
MAX_LEVELS = 10_000           # levels of a column that become named columns; beyond: vector_pipeline, or group them
MAX_CLASSES = 10_000          # class tables up to this size are broadcast (checked), larger ones are joined
# --------------------------------------------------------------------------------


# F1 -------------------------------------------------------------------------------
def category_levels(df: DataFrame, column: str, max_levels: int | None = MAX_LEVELS) -> list:
    """Sorted distinct non-null values; more than ``max_levels`` are an error (None: no bound)."""
    found = df.select(qcol(column)).where(qcol(column).isNotNull()).distinct()
    if max_levels is not None and found.limit(max_levels + 1).count() > max_levels:
        raise ValueError(f"{column}: more than {max_levels} levels; use vector_pipeline (sparse, any number) or group rare values first (max_categories)")
    return sorted(r[0] for r in found.collect())


def category_levels_many(df: DataFrame, columns: Sequence[str], max_levels: int | None = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct non-null values of several string columns in one job; ``max_levels`` as above."""
    from riskframe.operators.explore import long_categories
    pairs = long_categories(df, columns).where(F.col("value").isNotNull()).distinct()
    if max_levels is not None:
        big = [r["column"] for r in pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_levels).collect()]
        if big:
            raise ValueError(f"{big}: more than {max_levels} levels; use vector_pipeline (sparse, any number) or group rare values first (max_categories)")
    out: dict[str, list] = {c: [] for c in columns}
    for r in pairs.collect():
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot(df: DataFrame, columns: Sequence[str], levels: dict[str, list] | None = None, drop_first: bool = True,
            keep_source: bool = False, max_categories: int | None = None) -> DataFrame:
    """Named 0/1 dummies ``<col>_<value>``; levels sorted ascending, first level dropped; null -> all zeros.

    ``levels`` may be given explicitly (no discovery job); values unseen at fit
    time get all zeros, like an encoder with ``handle_unknown='ignore'``. With ``max_categories`` the values beyond
    each column's most frequent so many are grouped as one level first. Named columns suit hundreds of levels; for any
    number of them see the sparse :func:`vector_pipeline`.
    """
    levels = dict(levels or {})
    if max_categories is not None:
        from riskframe.operators.clean import group_top_n
        for c in columns:
            df = group_top_n(df, c, max_categories)
    from riskframe.functions.core import is_string_type
    missing = [c for c in columns if c not in levels and is_string_type(df.schema[c].dataType)]
    if len(missing) > 1:
        levels.update(category_levels_many(df, missing))
    out = df
    for c in columns:
        lv = levels.get(c) or category_levels(df, c)
        use = lv[1:] if drop_first else lv
        out = out.withColumns({f"{c}_{v}": F.coalesce(qcol(c) == F.lit(v), F.lit(False)).cast("int") for v in use})
        if not keep_source:
            out = out.drop(c)
    return out


def dummy_counts(encoded: DataFrame, prefix_columns: Sequence[str]) -> DataFrame:
    """Rows ``(feature, ones)`` over the dummy columns of the listed sources (one aggregate)."""
    dummies = [c for c in encoded.columns if any(c.startswith(p + "_") for p in prefix_columns)]
    agg = encoded.agg(*[F.sum(qcol(c)).cast("bigint").alias(f"_{i}") for i, c in enumerate(dummies)])
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("ones")) for i, c in enumerate(dummies)])
    return agg.select(F.explode(arr).alias("_s")).select("_s.*")


# F3 -------------------------------------------------------------------------------
def _quota_bounds(df: DataFrame, label: str, key: str, share: float, seed: int) -> DataFrame:
    """(label, _hb, _kb): per class the (hash, key) of its ceil(share * n)-th row in that order, found without an order:
    rows are counted by hash prefix, then by longer prefixes inside the one that holds the quota, until few rows are left.
    Null keys hash to -1, before all others."""
    digits, width = 8, 32
    src = df.select(qcol(label).alias("y"), F.coalesce(hash_order(seed, qcol(key)), F.lit(-1).cast("long")).alias("h"), qcol(key).alias("k")) \
        .where("y is not null")
    counts: dict = {}
    for r in src.groupBy("y", F.shiftright("h", width - digits).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r["y"], []).append((r["b"], r["n"]))
        if len(counts) > MAX_CLASSES:
            raise ValueError(f"{label}: more than {MAX_CLASSES} classes")
    few, state = max(16, FEW_ROWS // max(1, len(counts))), {}

    def find(bins, quota):
        """(bin, quota inside it, rows of it)."""
        for b, n in sorted(bins):
            if quota <= n:
                return b, quota, n
            quota -= n
        raise ValueError("rows changed while they were counted")
    for y, bins in counts.items():
        quota = math.ceil(sum(n for _, n in bins) * share)
        if quota:
            state[y] = (*find(bins, quota), width - digits)
    kind = df.schema[label].dataType.simpleString()
    spark = df.sparkSession

    def inside(classes):
        """Rows of ``src`` whose hash begins with their class's prefix."""
        t = spark.createDataFrame([(y, int(state[y][0]), state[y][3]) for y in classes], f"y {kind}, b long, shift int")   # a row a class
        return src.join(F.broadcast(t), "y").where(F.expr("shiftright(h, shift) = b"))
    while todo := [y for y, (_, _, n, shift) in state.items() if n > few and shift > 0]:
        more: dict = {}
        for r in inside(todo).groupBy("y", F.expr(f"shiftright(h, shift - {digits})").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            more.setdefault(r["y"], []).append((r["b"], r["n"]))
        for y in todo:
            state[y] = (*find(more[y], state[y][1]), state[y][3] - digits)
    last: dict = {}
    if state:
        for r in inside(list(state)).groupBy("y", "h", "k").agg(F.count(F.lit(1)).alias("n")).collect():      # FEW_ROWS rows, or those of equal hashes
            last.setdefault(r["y"], []).append(((r["h"], r["k"] is not None, r["k"]), r["n"]))
    rows = [(y, *(lambda at: (at[0], at[2]))(find(last[y], state[y][1])[0])) for y in state]
    return spark.createDataFrame(rows, f"`{label}` {kind}, _hb long, _kb {df.schema[key].dataType.simpleString()}")


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = TEST_SIZE, seed: int = SEED,
                     method: str = "exact", name: str = "split") -> DataFrame:
    """Add ``split`` in {'train','test'}; rows without a label are left out.

    exact: the first ceil(test_size * n_class) rows of a class by (md5(seed:key), key) go to test, by comparing each row with
    the last of them, which counts of hash prefixes find: no row is sorted or shuffled, whatever the classes' sizes. Rows
    with equal keys go to the same side.
    hash: test iff u(seed, key) < test_size -- no pass over the data at all, proportions exact only in expectation.
    """
    if method == "hash":
        return df.withColumn(name, F.when(uniform(seed, qcol(key)) < test_size, "test").otherwise("train"))
    h = df.withColumn("_h", F.coalesce(hash_order(seed, qcol(key)), F.lit(-1).cast("long")))
    r = h.join(F.broadcast(_quota_bounds(df, label, key, test_size, seed)), label)                             # MAX_CLASSES rows
    last = (F.col("_h") == F.col("_hb")) & (qcol(key).isNull() | (qcol(key) <= F.col("_kb")))
    return r.withColumn(name, F.when((F.col("_h") < F.col("_hb")) | last, "test").otherwise("train")).drop("_h", "_hb", "_kb")


def split_balance(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Per split: rows and class-1 share, plus the largest share gap (stratification check)."""
    g = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(qcol(label)).alias("rate"))
    gap = g.agg(F.max("rate") - F.min("rate")).scalar()
    return g.select(split, "n", F.round("rate", 6).alias("rate"), F.round(gap, 6).alias("max_gap"))


# V1 -------------------------------------------------------------------------------
def stratified_folds(df: DataFrame, label: str | Sequence[str], key: str, k: int = 5, seed: int = SEED, name: str = "fold"
                     ) -> DataFrame:
    """Class-balanced folds: (rank inside class by md5(seed:key)) mod k; sizes differ by at most 1 per class. ``label``
    may be several columns: each combination is a class. Classes are dealt over the tasks by ranges of the hash."""
    h = df.withColumn("_h", hash_order(seed, qcol(key)))
    r = rank_by_hash(h, label, "_h", key, "_rk")
    return r.withColumn(name, (F.col("_rk") % k).cast("int")).drop("_h", "_rk")


def stratified_fold_sets(df: DataFrame, label: str, key: str, k: int, seeds: Sequence[int], name: str = "folds",
                         parts: Sequence[Column] | None = None) -> DataFrame:
    """The folds of :func:`stratified_folds` for every seed, as an array column in the order of ``seeds``; ``parts``: for each
    seed a number that divides the classes further.

    Ranks are taken over narrow rows (row number, class, key and hash), one a seed, all at once; the folds of a row meet
    again as digits of whole numbers, and the wide rows move once."""
    t = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    sets = F.explode(F.array(*[F.struct(F.lit(i).alias("_set"), (parts[i] if parts else F.lit(0)).cast("int").alias("_part"), hash_order(s, qcol(key)).alias("_h"))
                             for i, s in enumerate(seeds)]))
    r = rank_by_hash(t.select("_row", label, key, sets.alias("_s")).select("_row", label, key, "_s.*"), [label, "_set", "_part"], "_h", key, "_rk")
    held = max(1, int(62 / math.log2(max(2, k))))                                       # digits to base k in a long
    powers = F.element_at(F.array(*[F.lit(k ** i).cast("long") for i in range(held)]), (F.col("_set") % held + 1).cast("int"))
    digits = r.select("_row", F.floor(F.col("_set") / held).alias("_at"), (F.col("_rk") % k * powers).alias("_d"))
    sums = digits.groupBy("_row").agg(*[F.sum(F.when(F.col("_at") == a, F.col("_d"))).alias(f"_d{a}") for a in range(-(-len(seeds) // held))])
    fold = [F.expr(f"CAST((_d{i // held} DIV {k ** (i % held)}L) % {k} AS INT)") for i in range(len(seeds))]
    return t.join(sums.select("_row", F.array(*fold).alias(name)), "_row").drop("_row")


# F4 / F5 --------------------------------------------------------------------------
def scalable_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns with more than 2 distinct values: some value is neither the least nor the greatest."""
    cols = list(columns) if columns else [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
    ends = df.agg(*[f(qcol(c)) for c in cols for f in (F.min, F.max)]).first()
    inside = df.agg(*[F.count_if((qcol(c) != F.lit(ends[2 * i])) & (qcol(c) != F.lit(ends[2 * i + 1]))) for i, c in enumerate(cols)]).first()
    return [c for c, n in zip(cols, inside) if n]


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column from the training rows; std 0 -> divisor 1."""
    row = train.agg(*[F.avg(qcol(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(columns)],
                    *[F.stddev_pop(qcol(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(columns)]).first()
    out = {}
    for i, c in enumerate(columns):
        s = row[f"_s{i}"]
        out[c] = (row[f"_m{i}"], s if s and s > 0 else 1.0)
    return out


def scaling_exprs(stats: dict[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: (qcol(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scaler statistics as a frame (column, mean, std) -- for reports and persistence."""
    st = fit_scaler(train, columns)
    return train.sparkSession.createDataFrame([(c, m, s) for c, (m, s) in st.items()],
                                              "column string, mean double, std double")


def standard_scale(df: DataFrame, columns: Sequence[str], split: str = "split", fit_on: str = "train") -> DataFrame:
    """Scale ``columns`` with statistics fitted on rows where ``split == fit_on`` and applied to all rows."""
    stats = fit_scaler(df.where(qcol(split) == fit_on), columns)
    return df.withColumns(scaling_exprs(stats))


def scaling_drift(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Per column: train/test mean and population std of (scaled) values, mean gap, warning flag."""
    aggs = []
    for i, c in enumerate(columns):
        x = qcol(c).cast("double")
        for s in ("train", "test"):
            v = F.when(qcol(split) == s, x)
            aggs += [F.avg(v).alias(f"_{s}_m{i}"), F.stddev_pop(v).alias(f"_{s}_s{i}")]
    a = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_train_m{i}").alias("train_mean"),
                             F.col(f"_test_m{i}").alias("test_mean"), F.col(f"_train_s{i}").alias("train_std"),
                             F.col(f"_test_s{i}").alias("test_std")) for i, c in enumerate(columns)])
    out = a.select(F.explode(arr).alias("_s")).select("_s.*")
    gap = F.abs(F.col("train_mean") - F.col("test_mean"))
    return out.withColumn("mean_gap", gap).withColumn("warn", gap > DRIFT_WARN)


# F8 -------------------------------------------------------------------------------
def balanced_weights(df: DataFrame, label: str, name: str = "weight", split: str | None = None) -> DataFrame:
    """w_c = n / (k * n_c) for k classes (sklearn 'balanced'), joined per row by class (<= k rows); with ``split`` n and
    n_c are counted over its 'train' rows alone."""
    src = df if split is None else df.where(qcol(split) == "train")
    g = src.groupBy(qcol(label).alias(label)).agg(F.count(F.lit(1)).alias("_nc"))
    n = g.agg(F.sum("_nc").cast("double")).scalar()
    k = g.agg(F.count(F.lit(1)).cast("double")).scalar()
    w = g.select(label, (n / (k * F.col("_nc"))).alias(name))
    return df.join(bounded_broadcast(w, MAX_CLASSES), label)


# F2 / F6 / F7 -----------------------------------------------------------------------
class VectorPipeline(Estimator):
    """Sparse feature vectors: numerics (standardised by mean and population std where ``scale``; null: the mean, or 0
    unscaled), then 0/1 slots for all levels but the first of each categorical; null, the first level and levels unseen
    at the fit are all zeros. Any number of levels."""

    def __init__(self, categorical: Sequence[str], numeric: Sequence[str], scale: bool = True, output: str = "features"):
        super().__init__()
        self.categorical, self.numeric, self.scale, self.output = list(categorical), list(numeric), scale, output

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        stages, hot = [], []
        if self.categorical:
            seen = StringIndexer(inputCols=self.categorical, outputCols=[f"{c}__i" for c in self.categorical],
                                 handleInvalid="skip", stringOrderType="alphabetAsc").fit(dataset).labelsArray
            # the indexer keeps what it doesn't know in a last slot, which the encoder drops: so it isn't told the first level
            kept = [(c, list(lv[1:])) for c, lv in zip(self.categorical, seen) if len(lv) > 1]
            if kept:
                index, hot = [f"{c}__index" for c, _ in kept], [f"{c}__hot" for c, _ in kept]
                levels = PipelineModel([StringIndexerModel.from_labels(lv, c, i, handleInvalid="keep")
                                        for (c, lv), i in zip(kept, index)])
                encode = OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)
                stages += [levels, encode.fit(levels.transform(dataset.limit(1)))]
        if self.scale:
            stats = fit_scaler(dataset, self.numeric)
            terms = [f"coalesce((CAST(`{c}` AS DOUBLE) - ({(m or 0.0)!r}D)) / {s!r}D, 0.0D) AS `{c}__z`"
                     for c, (m, s) in stats.items()]
        else:
            terms = [f"coalesce(CAST(`{c}` AS DOUBLE), 0.0D) AS `{c}__z`" for c in self.numeric]
        if terms:
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__"))
        stages.append(VectorAssembler(inputCols=[f"{c}__z" for c in self.numeric] + hot, outputCol=self.output))
        return PipelineModel(stages)


def vector_pipeline(categorical: Sequence[str], numeric: Sequence[str], scale: bool = True, output: str = "features"
                    ) -> VectorPipeline:
    return VectorPipeline(categorical, numeric, scale, output)


# F9 -------------------------------------------------------------------------------
def oversample(df: DataFrame, columns: Sequence[str], label: str, key: str, neighbours: int = SMOTE_NEIGHBOURS,
               seed: int = SEED) -> DataFrame:
    """Minority oversampling: rows (label, ``columns`` as double, synthetic) with as many rows of the smaller class of a
    0/1 label as of the larger; a synthetic row lies between a minority row and one of its ``neighbours`` nearest.

    Nearest by the standardised columns among all minority rows, exactly (``neighbours.nearest``: pivot cells, no pairs of
    a class); keys are distinct. Each minority row makes n // m or n // m + 1 synthetic rows (n missing rows, m minority rows), the extra ones by
    hash. Null values count as the column's mean. A class of fewer than two rows, or none missing: no synthetic rows.
    """
    cols = list(columns)
    real = df.select(qcol(label).alias(label), *[qcol(c).cast("double").alias(c) for c in cols], F.lit(False).alias("synthetic"))
    sizes = df.where(qcol(label).isNotNull()).groupBy(qcol(label).alias("c")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("n", "c").limit(3).collect()
    if len(sizes) > 2:
        raise ValueError("oversample takes two classes")
    if len(sizes) < 2 or sizes[0]["n"] < 2 or sizes[0]["n"] == sizes[1]["n"]:
        return real
    small, (m, missing) = sizes[0]["c"], (sizes[0]["n"], sizes[1]["n"] - sizes[0]["n"])
    minority = df.where(qcol(label) == small)
    stats = fit_scaler(minority, cols)
    x = F.array(*[F.coalesce((qcol(c).cast("double") - F.lit(mean or 0.0)) / F.lit(sd), F.lit(0.0)) for c, (mean, sd) in stats.items()])
    points = minority.select(qcol(key).alias("_k"), x.alias("_x"), hash_order(seed, qcol(key)).alias("_h"))
    from riskframe.operators.neighbours import nearest
    points = cut_lineage(points)
    found = points.join(nearest(points, "_k", "_x", neighbours, seed=seed).withColumnRenamed("near", "_near"), "_k")
    ranked = rank_within(found, [], ["_h", "_k"], "_r")
    copies = F.lit(missing // m) + (F.col("_r") < missing % m).cast("int")
    made = ranked.where(copies > 0).select("_k", "_x", "_near", F.explode(F.sequence(F.lit(1), copies)).alias("_i"))
    draw = F.concat_ws(":", F.col("_k").cast("string"), F.col("_i").cast("string"))
    pick = F.col("_near")[(uniform(f"{seed}:n", draw) * F.size("_near")).cast("int")]["y"]
    step = uniform(f"{seed}:u", draw)
    made = made.select(pick.alias("_y"), step.alias("_u"), "_x")
    value = [((F.col("_x")[i] + F.col("_u") * (F.col("_y")[i] - F.col("_x")[i])) * F.lit(sd) + F.lit(mean or 0.0)).alias(c)
             for i, (c, (mean, sd)) in enumerate(stats.items())]
    return real.unionByName(made.select(F.lit(small).cast(df.schema[label].dataType).alias(label), *value, F.lit(True).alias("synthetic")))


# F10 ------------------------------------------------------------------------------
def processing_report(before: DataFrame, after: DataFrame, high_cardinality: DataFrame) -> DataFrame:
    """Metric rows measured on the two tables: columns before and after, encoded source columns (those gone), columns
    flagged in ``high_cardinality`` (rows (column, ..., high_cardinality) of the column partition), rows."""
    gone = [c for c in before.columns if c not in after.columns]
    rows = [("columns_before", float(len(before.columns))), ("columns_after", float(len(after.columns))),
            ("encoded_columns", float(len(gone)))]
    meta = before.sparkSession.createDataFrame(rows, "metric string, value double")
    high = high_cardinality.agg(F.count_if("high_cardinality").cast("double").alias("value")) \
        .select(F.lit("high_cardinality_columns").alias("metric"), "value")
    cnt = after.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("rows").alias("metric"), "value")
    return meta.unionByName(high).unionByName(cnt)
