"""Operator 9: removal of repeated byte strings by a distributed sort of sparse suffixes that shares known prefixes.

A string of ``length`` bytes that starts anywhere else too is removed wherever it stands, overlaps included. Sorting all
suffixes isn't needed for that: every such string holds an anchor, the leftmost smallest hash of all its ``CORE``-byte
substrings, and equal strings hold it in the same place. So only suffixes at anchors are kept (about one in 150 bytes).

1. The scan finds the anchors and, for each, the run of string starts that it serves and the text these strings cover.
2. Equal covered texts are one class; a class met twice is repeated as a whole, whatever else is there.
3. Classes that share the core with another class are sorted: every task sorts its suffixes and hands them on as
   front-coded runs, a loser tree merges the runs and compares characters only behind the prefixes known to be common.
   The common prefix lengths of neighbours, with names of the left contexts, tell which strings two classes share.
   The classes of a core with more than ``HOT_CLASSES`` go to no single task: their starts are halved by distance from
   the anchor until what surrounds them is equal or met once, by grouped counts (``split``).
4. Repeated starts are joined back to all places, and each document drops the bytes they cover.

Defined results: a null or empty text has no bytes and loses none; texts shorter than ``length`` lose none; repeated rows
are places of their own, so long texts in them go whole; rows with a null key too; an empty table gives an empty result.
Matches never cross documents. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common

LENGTH, CORE = 400, 100
SLICE = 1_000_000
#: Classes of one core that are merged in one task, at most, and classes whose starts are compared at once, about.
HOT_CLASSES, AT_ONCE = 20_000, 5_000
#: Cells of the filters that spare documents without matches a shuffle of their text; a fixed size.
CELLS = 1 << 22
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 30) - 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_KEY = ["core", "cover", "off", "width"]


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        back = np.uint64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            have = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, SLICE + 200_000), b, np.uint64)])) for b in (base, back))
        _POWERS[int(base)] = have
    return have


class _Substrings:
    """Hashes of any substrings of a buffer."""

    def __init__(self, raw: np.ndarray, base: np.uint64):
        self.back = _powers(base, len(raw) + 1)[1]
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(base, len(raw) + 1)[0][:len(raw)])])

    def at(self, first: np.ndarray | slice, stop: np.ndarray | slice, count: int | None = None) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (self.sums[stop] - self.sums[first]) * (self.back[first] if count is None else self.back[:count])
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return x ^ (x >> np.uint64(29))


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w neighbours: of a block's end and the next block's beginning."""
    n = len(x) - w + 1
    blocks = -(-len(x) // w)
    grid = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    grid[:len(x)] = x
    grid = grid.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchors_of(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH, core: int = CORE):
    """Of texts one after the other (``ends``: where each stops): (text, start in it, core, cover, off, width) of each
    anchor: the first string start that it serves, hashes of core and covered text, anchor - start, further starts."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, none, none
    cores = _Substrings(raw, _P1)
    n = len(raw) - core + 1
    h = cores.at(slice(0, n), slice(core, core + n), n)
    least = _sliding_least((h & ~_PLACE) | np.arange(n, dtype=np.uint64), length - core + 1)
    place = (least & _PLACE).astype(np.int64)                                # the anchor of the string that starts here
    text = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    starts = np.flatnonzero(np.arange(len(place)) + length <= ends[text[:len(place)]])
    if not len(starts):
        return none, none, none, none, none, none
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(place[starts]) != 0) | (np.diff(starts) != 1)]))
    lo, hi = starts[cut], starts[np.append(cut[1:], len(starts)) - 1]
    a = place[lo]
    cover = _Substrings(raw, _P2).at(lo, hi + length)
    first = np.concatenate([[0], ends[:-1]])[text[lo]]
    return text[lo], lo - first, h[a].view(np.int64), cover.view(np.int64), a - lo, hi - lo


def _slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[bytes]]]:
    at, some, size = 0, [], 0
    for k, x in enumerate(batch.column(column)):
        some.append(x.as_py().encode())
        size += len(some[-1])
        if size >= SLICE or k + 1 == len(batch):
            yield at, some
            at, some, size = k + 1, [], 0


def anchors(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """(row, lo, core, cover, off, width) of all anchors of ``docs`` (row, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for at, some in _slices(batch):
                text, lo, c, cover, off, width = anchors_of(np.frombuffer(b"".join(some), np.uint8), np.cumsum([len(x) for x in some]), length, core)
                yield pa.RecordBatch.from_arrays([pa.array(rows[at + text]), pa.array(lo.astype(np.int32)), pa.array(c.astype(np.int64)), pa.array(cover.astype(np.int64)),
                                                  pa.array(off.astype(np.int16)), pa.array(width.astype(np.int16))], ["row", "lo", *_KEY])
    return docs.select("row", "text").mapInArrow(run, "row long, lo int, core long, cover long, off short, width short")


# -- front-coded runs and their merge

Entry = tuple[bytes, bytes, int, int, int]                       # suffix, left context, class number, off, width


def front_code(entries: list[Entry]) -> bytes:
    """A sorted run: each suffix without the prefix that it shares with the one before."""
    shared, sizes, rest, last = [], [], [], b""
    for s, left, *_ in entries:
        k = common_prefix(last, s, 0)
        shared.append(k)
        sizes.append(len(s) - k)
        rest += [s[k:], left]
        last = s
    _, lefts, number, off, width = zip(*entries, strict=True)
    head = [np.array(x, "<u2").tobytes() for x in (shared, sizes, [len(x) for x in lefts], off, width)] + [np.array(number, "<i8").tobytes()]
    return len(entries).to_bytes(4, "little") + b"".join(head) + b"".join(rest)


def unfolded(run: bytes) -> Iterator[tuple[bytes, int, bytes, int, int, int]]:
    """(suffix, prefix shared with the one before, left context, class number, off, width) of a run, in order."""
    n = int.from_bytes(run[:4], "little")
    shared, sizes, lefts, off, width = (np.frombuffer(run, "<u2", n, 4 + 2 * n * k).tolist() for k in range(5))
    number, at, last = np.frombuffer(run, "<i8", n, 4 + 10 * n).tolist(), 4 + 18 * n, b""
    for k, size, left, *rest in zip(shared, sizes, lefts, number, off, width, strict=True):
        last = last[:k] + run[at:at + size]
        yield last, k, run[at + size:at + size + left], *rest
        at += size + left


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix, of which ``known`` bytes are known; by halves, as slices compare fast."""
    lo, hi = known, min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class LoserTree:
    """Merges sorted runs. Every node keeps its match's loser and the loser's common prefix with the last winner; two
    candidates with different such prefixes are in order already, equal ones are compared behind it only."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.n = runs, 1 << max(0, (len(runs) - 1).bit_length())
        self.head = [next(r, None) for r in runs] + [None] * (self.n - len(runs))
        self.lcp = [0] * self.n                                    # of each run's head with the last winner
        self.loser = [0] * self.n
        self.top = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        win, self.loser[node] = self._match(self._build(2 * node), self._build(2 * node + 1))
        return win

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix is then that with the winner."""
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        p, q = self.lcp[a], self.lcp[b]
        if p != q:
            return (a, b) if p > q else (b, a)                     # the smaller prefix is also the one they share
        k = common_prefix(x[0], y[0], p)
        if x[0][k:k + 1] <= y[0][k:k + 1]:
            self.lcp[b] = k
            return a, b
        self.lcp[a] = k
        return b, a

    def __iter__(self) -> Iterator[tuple]:
        """The entries of all runs in order, their second value the prefix shared with the one before."""
        while (out := self.head[self.top]) is not None:
            yield out[0], self.lcp[self.top], *out[2:]
            run = self.top
            self.head[run] = nxt = next(self.runs[run], None)
            self.lcp[run] = nxt[1] if nxt else 0
            node = (run + self.n) // 2
            while node:
                run, self.loser[node] = self._match(run, self.loser[node])
                node //= 2
            self.top = run


def shared_starts(merged: list[tuple], length: int, core: int) -> np.ndarray:
    """For sorted classes: which of their string starts another class has too (rows: classes, columns: starts).

    Strings that begin d bytes before the anchor are equal if the right parts lie in one run of neighbours with common
    prefixes of length - d or more, and the d bytes before the anchor have one name (a 64-bit hash, d fixed).
    """
    n, span = len(merged), length - core + 1
    lcp, off, width = (np.array([m[k] for m in merged], np.int64) for k in (1, 4, 5))
    before = np.zeros((n, span), np.uint8)
    for i, m in enumerate(merged):
        before[i, :len(m[2])] = np.frombuffer(m[2], np.uint8)              # reversed: nearest to the anchor first
    out, name = np.zeros((n, span), bool), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for d in range(span):
            if d:
                name = (name ^ (before[:, d - 1].astype(np.uint64) + np.uint64(1))) * _P1
                name ^= name >> np.uint64(29)
            own = np.flatnonzero((off >= d) & (off - d <= width))
            if len(own) > 1:
                run = np.cumsum(lcp < length - d)[own].astype(np.uint64)
                _, which, times = np.unique((run * _P2) ^ name[own], return_inverse=True, return_counts=True)
                hit = own[times[which] > 1]
                out[hit, off[hit] - d] = True
    return out


def _intervals(marks: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return [{"a": int(a), "b": int(b) - 1} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


# -- the operator

def _cell(row: Column) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(CELLS)).cast("int")


def _filter(docs: DataFrame, rows: DataFrame) -> tuple[Column, object]:
    """A condition that holds for all documents whose row is in ``rows`` and few others."""
    cells = rows.select(_cell(F.col("row")).alias("c")).distinct().toPandas()["c"].to_numpy()       # CELLS numbers at most
    bits = np.zeros(CELLS, bool)
    bits[cells] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    @F.pandas_udf("boolean")
    def may(c):
        import pandas as pd
        x = c.to_numpy()
        return pd.Series((sent.value[x >> 3] >> (7 - (x & 7))) & 1 == 1)
    return may(_cell(F.col("row")))


def _asked(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(text, asked): the documents that show ``classes`` (row, lo, off, width, number, target), with these."""
    wanted = classes.groupBy("row").agg(F.collect_list(F.struct("lo", "off", "width", "number", "target")).alias("asked"))
    return docs.where(_filter(docs, wanted)).join(wanted, "row").select("text", "asked")


def _surroundings(raw: bytes, x: dict, length: int) -> tuple[bytes, bytes]:
    """The suffix at the anchor and the left context, reversed: nearest to the anchor first."""
    a = x["lo"] + x["off"]
    return raw[a:min(a + length, x["lo"] + x["width"] + length)], raw[x["lo"]:a][::-1]


def _contexts(docs: DataFrame, classes: DataFrame, length: int, targets: int) -> DataFrame:
    """(target, run): front-coded sorted runs of the suffixes of ``classes`` (row, lo, off, width, number, target)."""
    ready = _asked(docs, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        n = 0

        def flush():
            keys = sorted(held)
            made = [front_code(sorted(held[t])) for t in keys]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(made, pa.binary())], ["target", "run"])
        for batch in batches:
            for text, asked in zip(*batch.columns, strict=True):
                raw = text.as_py().encode()
                for x in asked.as_py():
                    held.setdefault(x["target"], []).append((*_surroundings(raw, x, length), x["number"], x["off"], x["width"]))
                    n += 1
            if n > 60_000:
                yield flush()
                n = 0
        if held:
            yield flush()
    return ready.mapInArrow(run, "target int, run binary")


def _batches(merged: Iterator[tuple], core: int) -> Iterator[list[tuple]]:
    """Sorted classes in lists that end where a core ends."""
    some: list[tuple] = []
    for m in merged:
        if m[1] < core and len(some) >= AT_ONCE:
            yield some
            some = []
        some.append(m)
    if some:
        yield some


def split(docs: DataFrame, classes: DataFrame, length: int, core: int) -> DataFrame:
    """(number, starts): which string starts of ``classes`` (row, lo, off, width, number, target) another class has too.

    All strings that begin p to q bytes before the anchor hold the p bytes before it and the length - q from it on:
    classes that differ there share none of them. Classes with equal q bytes before and length - p from the anchor on
    share all; one goes on for them. Where several go on that don't differ in the former, p to q is halved.
    """
    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, asked in zip(*batch.columns, strict=True):
                raw = text.as_py().encode()
                found = [(x["number"], x["target"], x["off"], x["width"], *_surroundings(raw, x, length)) for x in asked.as_py()]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                                                 ["number", "core", "off", "width", "suffix", "before"])

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] + [pa.int32()] * 4 + [pa.binary()] * 2
        for batch in batches:
            out: list[tuple] = []
            for x in batch.to_pylist():
                for n in x["nodes"]:
                    p, q = n["p"], n["q"]
                    first, last = max(p, x["off"] - x["width"]), min(q, x["off"])            # those that the class serves
                    if first <= last:
                        all_ = xxhash.xxh3_128_digest(b"%d %d %d %d %d %d " % (x["core"], p, q, first, last, len(x["before"][:last])) + x["before"][:last] + x["suffix"][:length - first])
                        any_ = xxhash.xxh3_128_digest(b"%d %d %d " % (x["core"], p, q) + x["before"][:p] + x["suffix"][:length - q])
                        out.append((x["number"], p, q, x["off"] - last, x["off"] - first, all_, any_))
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["number", "p", "q", "a", "b", "all", "any"])
    ready = _asked(docs, classes)
    shown = common.saved(ready.mapInArrow(show, "number long, core long, off int, width int, suffix binary, before binary"), "hot-contexts")
    node = lambda p, q: F.struct(p.cast("int").alias("p"), q.cast("int").alias("q"))
    todo = shown.select("number", F.array(node(F.lit(0), F.lit(length - core))).alias("nodes"))
    marks = []
    while True:                                                                 # as often as length - core can be halved
        level = common.saved(shown.join(todo, "number").mapInArrow(names, "number long, p int, q int, a int, b int, all binary, any binary"), "hot-names")
        alike = common.saved(level.groupBy("all").agg(F.count("*").alias("n"), F.min(F.struct("number", "p", "q", "any")).alias("one")), "hot-alike")
        marks.append(level.join(alike.where("n > 1").select("all"), "all", "left_semi").select("number", "a", "b"))
        ones = alike.select("one.*").where("p < q")
        several = ones.groupBy("any").agg(F.count("*").alias("n")).where("n > 1").select("any")
        middle = F.floor((F.col("p") + F.col("q")) / 2)
        halves = ones.join(several, "any", "left_semi").select("number", F.array(node(F.col("p"), middle), node(middle + 1, F.col("q"))).alias("nodes"))
        todo = common.saved(halves.groupBy("number").agg(F.flatten(F.collect_list("nodes")).alias("nodes")), "hot-nodes")   # length - core + 1 at most
        if todo.isEmpty():
            return reduce(DataFrame.unionAll, marks).groupBy("number").agg(F.collect_list(F.struct("a", "b")).alias("starts"))


def repeated(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """(row, spans): for each of ``docs`` (row, text) with repeated strings the runs a..b of their starts."""
    found = common.saved(anchors(docs, length, core), "anchors")
    kinds = common.saved(found.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min(F.struct("row", "lo")).alias("one")), "suffix-kinds")
    several = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1")     # classes, not places, share a core
    classes = kinds.join(several, "core", "left").where("n > 1 or kinds > 1").withColumn("number", F.monotonically_increasing_id())
    classes = common.saved(classes, "suffix-classes")
    targets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = lambda which, target: classes.where(which).select("one.row", "one.lo", "off", "width", "number", target.alias("target"))
    open_ = asked((F.col("kinds") > 1) & (F.col("kinds") <= HOT_CLASSES), F.pmod("core", F.lit(targets)).cast("int"))
    hot = asked(F.col("kinds") > HOT_CLASSES, F.col("core"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [unfolded(x) for batch in batches for x in batch.column("run").to_pylist()]
        for merged in _batches(LoserTree(runs), core) if runs else ():
            marks = shared_starts(merged, length, core)
            hit = np.flatnonzero(marks.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array([merged[i][3] for i in hit], pa.int64()), pa.array([_intervals(marks[i]) for i in hit], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                                             ["number", "starts"])
    sorted_ = _contexts(docs, open_, length, targets).repartition(targets, "target").mapInArrow(merge, "number long, starts array<struct<a: int, b: int>>")
    if not hot.isEmpty():
        sorted_ = sorted_.unionByName(split(docs, hot, length, core))
    shared = common.saved(sorted_, "shared-starts")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("width").cast("int").alias("b")))
    marked = (classes.join(shared, "number", "left")
              .select(*_KEY, F.when(F.col("n") > 1, whole).otherwise(F.col("starts")).alias("starts")).where("starts is not null"))
    return (found.join(marked, _KEY).select("row", F.transform("starts", lambda s: F.struct((F.col("lo") + s["a"]).alias("a"), (F.col("lo") + s["b"]).alias("b"))).alias("s"))
            .groupBy("row").agg(F.flatten(F.collect_list("s")).alias("spans")))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove(docs: DataFrame, length: int = LENGTH, core: int = CORE, passage: tuple[int, int, int] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each of ``docs`` (doc_id, text).

    ``passage`` (bytes, core, words): also n_passages, the maximal runs covered by repeated strings of so many bytes that
    hold more than so many whole words. Nothing is removed for them: they show what repeats below ``length``.
    """
    docs = common.numbered(docs.select("doc_id", "text"), "row")
    spans = repeated(docs, length, core)
    if passage:
        shorter = repeated(docs, *passage[:2]).withColumnRenamed("spans", "shorter")          # a longer repeat holds shorter ones
        spans = shorter.join(spans, "row", "left")
    else:
        spans = spans.withColumn("shorter", F.lit(None).cast("array<struct<a: int, b: int>>"))
    spans = common.saved(spans.select("row", "spans", "shorter"), "repeated-spans")
    marked = docs.withColumn("may", _filter(docs, spans))
    hit = marked.where("may").join(spans, "row", "left").select("doc_id", "text", "spans", "shorter")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "n_passages", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, spans, shorter in zip(*batch.columns, strict=True):
                raw = text.as_py().encode()
                cut = _joined(sorted((s["a"], s["b"] + length) for s in spans.as_py() or []))
                edge = [0, *[x for ab in cut for x in ab], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True))
                passages = 0
                for a, b in _joined(sorted((s["a"], s["b"] + passage[0]) for s in shorter.as_py() or [])) if passage else ():
                    n = len(raw[a:b].split())                               # whole words: not those that the run cuts
                    n -= a > 0 and bool(raw[a:a + 1].strip()) and bool(raw[a - 1:a].strip())
                    n -= b < len(raw) and bool(raw[b:b + 1].strip()) and bool(raw[b - 1:b].strip())
                    passages += n > passage[2]
                rows.append((doc.as_py(), len(raw), sum(b - a for a, b in cut), len(cut), passages, hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
    changed = hit.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, n_passages long, kept_sha256 string")
    zero = F.lit(0).cast("long")
    same = marked.where(~F.col("may")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                                              zero.alias("n_passages"), F.sha2("text", 256).alias("kept_sha256"))
    out = changed.unionByName(same)
    return out if passage else out.drop("n_passages")
