"""Order-dependent operators that stay correct and balanced under key skew.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task: if one entity holds a third of the table, one task sorts a third of the
table. Where some key holds more rows than an average partition, the table is
range-partitioned on (keys, order) and written to the shared folder with the
number of its range, so that a hot key is spread over as many ranges as its
share asks for, whatever the type of its order columns, and every later use
sees the same ranges.

Windows then run per ``(key, range)``. Ranges follow one another in (key,
order), so at most one key of a range goes on in the next: the
table of what such keys bring along (counts, sums, next rows) has fewer than
two rows a partition, and is broadcast. Where no key is hot the plan is
the ordinary window.

Order columns are ascending; give a total order (unique tie-break) whenever
the result depends on it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.lookup import bounded_broadcast
from riskframe.session import scratch_path

_SUB = "_rf_sub"

# a 32-bit hash is cut into ranges of about so many rows, at most 2 ** RANGE_BITS of them
RANGE_ROWS, RANGE_BITS = 2_000, 16

# smallest group size ever split (tests lower it to exercise the split path)
MIN_HOT_ROWS = 1_000_000


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _has_hot_key(df: DataFrame, keys: list[str], min_hot_rows: int | None) -> bool:
    """Whether one key (without keys: the table) holds more rows than an average partition and than the floor."""
    floor_rows = MIN_HOT_ROWS if min_hot_rows is None else min_hot_rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not keys:
        return parts > 1 and df.count() > floor_rows
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    return (most or 0) > max(floor_rows, math.ceil((total or 0) / parts))


def _bucketed(df: DataFrame, keys: list[str], order: list[str], min_hot_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_rf_sub``, the number of the row's range in (keys, order); returns (frame, whether there are several)."""
    if not _has_hot_key(df, keys, min_hot_rows):
        return df.withColumn(_SUB, F.lit(0)), False
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(dict.fromkeys(keys + order))
    ranged = df.repartitionByRange(parts, *[F.col(f"`{c}`") for c in by]).withColumn(_SUB, F.spark_partition_id())
    path = scratch_path(spark, "ordered-ranges")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path), True


def _carried(summary: DataFrame, keys: list[str]) -> DataFrame:
    """The summary of the keys that lie in several ranges: fewer than two rows a range."""
    w = Window.partitionBy(*keys)
    return summary.withColumn("_ranges", F.count(F.lit(1)).over(w)).where("_ranges > 1").drop("_ranges")


def _join_keys(keys: list[str]) -> list[str]:
    return keys + [_SUB]


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                    broadcast: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where null matches null (a null entity is a group like any other)."""
    r = right.select(*[F.col(k).alias(f"_rk_{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_rk_{i}")) for i, k in enumerate(keys)]
    j = left.join(F.broadcast(r) if broadcast else r, cond, how)
    return j.drop(*[f"_rk_{i}" for i in range(len(keys))])


def rank_within(df: DataFrame, keys, order, name: str = "rank0", min_hot_rows: int | None = None) -> DataFrame:
    """0-based position of each row inside its key group, by ``order`` (cumcount)."""
    keys, order = _names(keys), _names(order)
    b, split = _bucketed(df, keys, order, min_hot_rows)
    w = Window.partitionBy(*keys, _SUB).orderBy(*order)
    r = b.withColumn("_local", F.row_number().over(w) - 1)
    if not split:
        return r.withColumn(name, F.col("_local").cast("bigint")).drop("_local", _SUB)
    tot = _carried(b.groupBy(*keys, _SUB).agg(F.count(F.lit(1)).alias("_c")), keys)
    wk = Window.partitionBy(*keys).orderBy(_SUB).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("_off", F.coalesce(F.sum("_c").over(wk), F.lit(0))).drop("_c")
    r = _join_null_safe(r, tot, _join_keys(keys), broadcast=True)
    return r.withColumn(name, (F.col("_local") + F.coalesce(F.col("_off"), F.lit(0))).cast("bigint")) \
        .drop("_local", "_off", _SUB)


def rank_by_hash(df: DataFrame, keys, hashed: str, key: str, name: str = "rank0") -> DataFrame:
    """:func:`rank_within` by (``hashed``, ``key``), where ``hashed`` is a 32-bit hash (null: first): its leading bits cut every
    group into ranges of about equal size, so that rows are dealt evenly over the tasks, however few groups there are. The
    counts of the ranges say how many rows precede each."""
    keys = _names(keys)
    bits = min(RANGE_BITS, max(0, math.ceil(math.log2(max(1, df.count()) / RANGE_ROWS))))
    if not bits:
        return rank_within(df, keys, [hashed, key], name)
    b = df.withColumn(_SUB, F.shiftright(F.col(hashed), 32 - bits))
    before = Window.partitionBy(*keys).orderBy(_SUB).rowsBetween(Window.unboundedPreceding, -1)      # a row a range
    off = b.groupBy(*keys, _SUB).agg(F.count(F.lit(1)).alias("_c")).withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    local = F.row_number().over(Window.partitionBy(*keys, _SUB).orderBy(hashed, key)) - 1
    r = _join_null_safe(b.withColumn("_local", local), bounded_broadcast(off.drop("_c")), _join_keys(keys))
    return r.withColumn(name, (F.col("_local") + F.col("_off")).cast("bigint")).drop("_local", "_off", _SUB)


def running_sums(df: DataFrame, order, sums: dict[str, str], keys=(), count_name: str | None = None,
                 min_hot_rows: int | None = None) -> DataFrame:
    """Inclusive running sums (ROWS frame) of ``sums`` {out_name: column} by ``order``.

    With ``keys`` the sums restart per key. Without keys the whole table is one
    group, split into ordered buckets once it is large.
    """
    keys, order = _names(keys), _names(order)
    b, split = _bucketed(df, keys, order, min_hot_rows)
    w = Window.partitionBy(*keys, _SUB).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = b
    for out, c in sums.items():
        r = r.withColumn(out, F.sum(F.col(c)).over(w))
    if count_name:
        r = r.withColumn(count_name, F.count(F.lit(1)).over(w).cast("bigint"))
    if not split:
        return r.drop(_SUB)
    src = list(dict.fromkeys(sums.values()))
    tot = _carried(b.groupBy(*keys, _SUB).agg(F.count(F.lit(1)).alias("_c"), *[F.sum(F.col(c)).alias(f"_s{i}")
                                                                               for i, c in enumerate(src)]), keys)
    wk = Window.partitionBy(*keys).orderBy(_SUB).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, _SUB, F.coalesce(F.sum("_c").over(wk), F.lit(0)).alias("_oc"),
                     *[F.sum(f"_s{i}").over(wk).alias(f"_o{i}") for i in range(len(src))])
    r = _join_null_safe(r, tot, _join_keys(keys), broadcast=True)
    for out, c in sums.items():
        i = src.index(c)
        r = r.withColumn(out, F.col(out) + F.coalesce(F.col(f"_o{i}"), F.lit(0)))
    if count_name:
        r = r.withColumn(count_name, (F.col(count_name) + F.coalesce(F.col("_oc"), F.lit(0))).cast("bigint"))
    return r.drop("_oc", *[f"_o{i}" for i in range(len(src))], _SUB)


def next_within(df: DataFrame, keys, order, value: str, name: str, min_hot_rows: int | None = None) -> DataFrame:
    """``lead(value)`` inside each key group by ``order`` (null for the last row)."""
    keys, order = _names(keys), _names(order)
    b, split = _bucketed(df, keys, order, min_hot_rows)
    w = Window.partitionBy(*keys, _SUB).orderBy(*order)
    r = b.withColumn("_nxt", F.lead(F.col(value)).over(w))
    if not split:
        return r.withColumnRenamed("_nxt", name).drop(_SUB)
    r = r.withColumn("_has", F.lead(F.lit(True)).over(w).isNotNull())
    heads = b.groupBy(*keys, _SUB).agg(F.min(F.struct(*[F.col(o) for o in order], F.col(value).alias("_v")))
                                       .alias("_h"))
    heads = _carried(heads, keys).select(*keys, _SUB, F.lead("_h").over(Window.partitionBy(*keys).orderBy(_SUB)).alias("_nh"))
    r = _join_null_safe(r, heads, _join_keys(keys), broadcast=True)
    return r.withColumn(name, F.when(F.col("_has"), F.col("_nxt")).otherwise(F.col("_nh._v"))) \
        .drop("_nxt", "_has", "_nh", _SUB)


def first_per_key(df: DataFrame, keys, order, keep: str = "first") -> DataFrame:
    """Keep one row per key: the smallest (``first``) or largest (``last``) by ``order``.

    An aggregate, not a window: partial aggregation collapses a hot key to one
    row per map task before the shuffle.
    """
    keys, order = _names(keys), _names(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    names = order + rest
    packed = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(names)])
    agg = F.min(packed) if keep == "first" else F.max(packed)
    return df.groupBy(*keys).agg(agg.alias("_r")) \
        .select(*keys, *[F.col(f"_r.f{i}").alias(c) for i, c in enumerate(names)]).select(
            *[F.col(f"`{c}`") for c in df.columns])
