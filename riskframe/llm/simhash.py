"""Operator 3: SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most ``max_bits`` bits are linked. The bits are grouped into partitions of correlated
bits; each partition i gets a threshold t_i with sum(t_i + 1) = max_bits + 1 (t_i = -1 leaves it out), so that two linked
fingerprints differ in at most t_i bits of some partition. Thresholds come from dynamic programming over estimated
candidate counts. Each fingerprint probes the t_i-ball of its bits in partition i; candidates are verified on all 64.

Work is done on distinct fingerprints. Dense groups first shrink: members of an equal partition (or two) are linked
with the group's smallest member where that verifies, and only candidates of different components so far are joined;
a link that is left out so connects what is connected already, and no component changes.

Defined results: a null, empty or blank text has the fingerprint zero and is linked like any other; fewer words than the
shingle length make one shingle; repeated rows share all values; rows with a null key are linked and keep the null;
an empty table gives an empty result. Columns other than key and text are not read. The whole text counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common, components

SEED = 42
#: Distinct fingerprints from which bit correlation and candidate counts are estimated; a choice of speed only.
SAMPLE = 2_000
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int) -> int:
    """The signed 64-bit SimHash of one text."""
    words = text.encode().lower().split()                  # bytes: only A-Z change, only ASCII white space cuts
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        start = np.concatenate([[0], stop[:-shingle]])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(start.tolist(), (stop[shingle - 1:] - 1).tolist(), strict=True)]
    columns = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp long) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py() or "", shingle) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])
        common.give_back()
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def correlated_partitions(bits: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bit places in ``m`` groups of nearly equal size: each takes the free bits that correlate most with it."""
    spread = bits - bits.mean(axis=0) if len(bits) else np.zeros((1, 64))
    scale = np.sqrt((spread ** 2).sum(axis=0))
    scale[scale == 0] = 1
    like = np.abs(spread.T @ spread) / np.outer(scale, scale)
    np.fill_diagonal(like, 0)
    free, out = set(range(64)), []
    for k in range(m):
        size = 64 // m + (k < 64 % m)
        group = [max(sorted(free), key=lambda b: like[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < size:
            group.append(max(sorted(free), key=lambda b: like[b, group].sum()))
            free.discard(group[-1])
        out.append(sorted(group))
    return out


def ball(places: list[int], radius: int) -> list[int]:
    """Masks of at most ``radius`` of the places, as signed 64-bit numbers."""
    sums = [sum(1 << p for p in some) for r in range(radius + 1) for some in combinations(places, r)]
    return [x - (1 << 64) if x >> 63 else x for x in sums]


def thresholds(bits: np.ndarray, groups: list[list[int]], n: int, max_bits: int) -> list[int]:
    """The cheapest t_i with sum(t_i + 1) = max_bits + 1; the cost of (i, t) is the probes plus the pairs expected within t."""
    from math import comb
    cost = []
    pairs = np.triu_indices(len(bits), 1)
    for g in groups:
        x = bits[:, g].astype(np.float32)
        apart = (x.sum(1)[:, None] + x.sum(1)[None, :] - 2 * x @ x.T).round().astype(np.int8)[pairs]
        row = {-1: 0.0}
        for t in range(max_bits + 1):
            probes = sum(comb(len(g), r) for r in range(t + 1))
            share = max(float((apart <= t).mean()) if len(apart) else 0.0, probes / 2.0 ** len(g))
            row[t] = n * probes + share * n * n / 2
        cost.append(row)
    best = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t, more in row.items():
                key = used + t + 1
                if key <= max_bits + 1 and (key not in nxt or c + more < nxt[key][0]):
                    nxt[key] = (c + more, [*ts, t])
        best = nxt
    return best[max_bits + 1][1]


def _mask(places: list[int]) -> int:
    x = sum(1 << p for p in places)
    return x - (1 << 64) if x >> 63 else x


def _keys(fp: Column, parts: list[tuple[int, int, list[int]]]) -> Column:
    """One row for each (part number, mask, xors): the masked fingerprint, moved by each xor."""
    return F.explode(F.array(*[F.struct(F.lit(k).cast("byte").alias("part"), fp.bitwiseAND(F.lit(m)).bitwiseXOR(F.lit(e)).alias("key"))
                               for k, m, es in parts for e in es]))


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def link(fps: DataFrame, max_bits: int = 4, partitions: int = 3) -> DataFrame:
    """(fp, root): for every distinct fp its component's smallest fp.

    ``partitions``: fewer make wider keys, with more probes and fewer candidates: 3 for up to about 1e9 distinct
    fingerprints, 2 beyond. The result is the same.
    """
    fps = common.saved(common.fewer(fps.select("fp").where("fp is not null").distinct()), "fingerprints")
    n = fps.count()
    sample = np.array([r[0] for r in common.first_by(fps, F.xxhash64("fp"), SAMPLE).collect()], "<i8")
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    groups = correlated_partitions(bits, partitions)
    radius = thresholds(bits, groups, n, max_bits)

    # members of one equal partition, or of two, with the smallest of them
    narrow = [(k, _mask(sum(some, [])), [0]) for k, some in enumerate([[g] for g in groups] + [list(p) for p in combinations(groups, 2)])]
    member = fps.select("fp", _keys(F.col("fp"), narrow).alias("k")).select("fp", "k.part", "k.key")
    first = member.groupBy("part", "key").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    close = member.join(first, ["part", "key"]).where((F.col("fp") != F.col("least")) & _near("fp", "least", max_bits))
    dense = components.stars(close.select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct())
    known = common.saved(common.fewer(fps.join(dense.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))), "dense")

    used = [(k, _mask(g), t, g) for k, (g, t) in enumerate(zip(groups, radius, strict=True)) if t >= 0]
    index = known.select("fp", "root", _keys(F.col("fp"), [(k, m, [0]) for k, m, _, _ in used]).alias("k")).select("k.part", "k.key", F.col("fp").alias("b"), F.col("root").alias("rb"))
    probe = known.select("fp", "root", _keys(F.col("fp"), [(k, m, ball(g, t)) for k, m, t, g in used]).alias("k")).select("k.part", "k.key", F.col("fp").alias("a"), F.col("root").alias("ra"))
    on = [probe.part == index.part, probe.key == index.key, F.col("a") < F.col("b"), F.col("ra") != F.col("rb"), _near("a", "b", max_bits)]
    cross = probe.join(index, on).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    roots = components.stars(cross.distinct())
    return known.join(roots.withColumnRenamed("node", "r").withColumnRenamed("root", "top"), known.root == F.col("r"), "left") \
        .select("fp", F.coalesce("top", known.root).alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, partitions: int = 3) -> DataFrame:
    """(doc_id, fingerprint: 16 hex digits, component_id: the smallest doc_id reachable) of each row."""
    own = common.saved(fingerprints(docs, shingle), "document-fingerprints")
    root = link(own, max_bits, partitions)
    first = own.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labelled = common.saved(common.fewer(root.join(first, "fp")), "labelled")
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = labelled.join(least, "root").select("fp", "component_id")
    return own.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
