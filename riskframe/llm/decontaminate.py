"""Operator 4: benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

The corpus is scanned once for the n-grams of the test items (a filter of fixed size first, then the exact table). Every
distinct n-gram of an item is a seed, however many documents hold it. Where a document holds two distinct seeds of an item
within two item lengths (one, if the item has at most ``SHORT`` words), the stretch around them is aligned with the item; a
local alignment that reaches ``least`` of the item's full score, or the score of ``passage`` words copied word for word
however long the item, is a hit, whether the passage is a copy, an edited or a paraphrased one. Seeds are paired and aligned in the scan, so no text and no hit is dealt out; the items go to all tasks,
and items of more than ``PASS_WORDS`` words in all take further scans.

Words are lower-cased (A-Z) and cut at white space and ASCII punctuation. Defined results: null and empty texts hold no
passage; items of fewer than ``n`` words are matched by no document; repeated rows each get their hits; rows with a null
key too; an empty table on either side gives an empty result. Other columns are not read. Whole texts are scanned.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common

N, SHORT = 3, 12
LEAST, PASSAGE = 0.5, 13
MATCH, MISS, GAP = 2, -1, 1
#: Bits of the scan's filter (2 MB), and words of the items that one scan looks for.
FILTER_BITS, PASS_WORDS = 24, 2_000_000
#: Seeds of a document that are paired at once, and pairs that are aligned at once.
SEEDS_AT_ONCE, JOBS_AT_ONCE = 4_000_000, 4096
_CUT = bytes.maketrans(string.ascii_uppercase.encode() + string.punctuation.encode(), string.ascii_lowercase.encode() + b" " * len(string.punctuation))
_P = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Words to 64-bit hashes; bounded, as it starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(text: str, memo: _Hashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, text.encode().translate(_CUT).split()), np.uint64)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - n + 1].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out = out * _P + words[k:len(words) - n + 1 + k]
        return (out ^ (out >> np.uint64(29))) * _P


class Table:
    """The n-grams of some items, sorted, each with the items that hold it."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], n: int):
        self.ids, self.words = [i for i, _ in items], [w for _, w in items]
        self.size = np.array([len(w) for w in self.words], np.int64)
        held = [np.unique(grams(w, n)) for w in self.words]
        gram, item = np.concatenate(held), np.repeat(np.arange(len(items)), list(map(len, held)))
        order = np.lexsort((item, gram))
        self.grams, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.items = item[order].astype(np.int32)
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.bits = np.packbits(bits)

    def stretches(self, g: np.ndarray, passes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, stretch) of a document of n-grams ``g``: stretches of two item lengths that hold a seed with another
        distinct seed of the item, here or in a stretch beside it, within two item lengths."""
        at = np.flatnonzero(passes[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        exact = self.grams[k] == g[at]
        at, k = at[exact], k[exact]
        found = [np.zeros((0, 2), np.int64)]
        for part in self._parts(at, k):
            found.append(np.unique(np.stack(self._paired(at[part], k[part]), axis=1), axis=0))
        both = np.unique(np.concatenate(found), axis=0) if len(found) > 2 else found[-1]
        return both[:, 0], both[:, 1]

    def _parts(self, at: np.ndarray, k: np.ndarray) -> Iterator[slice]:
        """Slices of the seeds; each begins as far before the end of the last one as seeds can be paired."""
        far, upto, lo = 2 * int(self.size.max()), np.cumsum(self.count[k]), 0
        while lo < len(at):
            hi = max(np.searchsorted(upto, upto[lo] + SEEDS_AT_ONCE), np.searchsorted(at, at[lo] + 2 * far + 1))
            yield slice(lo, hi)
            lo = len(at) if hi >= len(at) else int(np.searchsorted(at, at[hi] - far))

    def _paired(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.count[k]
        item = self.items[np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())].astype(np.int64)
        place, gram = np.repeat(at, n), np.repeat(k, n)
        order = np.lexsort((place, item))
        item, place, gram = item[order], place[order], gram[order]
        good = self.size[item] <= SHORT                                      # neighbours in place: any two seeds of a
        near = (item[1:] == item[:-1]) & (gram[1:] != gram[:-1]) & (place[1:] - place[:-1] <= 2 * self.size[item[1:]])
        good[1:] |= near                                                     # stretch that differ have such between them
        good[:-1] |= near
        return item[good], place[good] // (2 * self.size[item[good]])


def tables(items: DataFrame, n: int = N) -> Iterator[Table]:
    """The items (item_id, text) of at least ``n`` words, as tables of up to ``PASS_WORDS`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Hashes()
        for batch in batches:
            words = [word_hashes(t, memo) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.tobytes() for w in words], pa.binary())], ["item_id", "words"])
    some: list = []
    total = 0
    for item, raw in items.mapInArrow(run, "item_id long, words binary").toLocalIterator():
        words = np.frombuffer(raw, np.uint64)
        if len(words) < n:
            continue
        if some and total + len(words) > PASS_WORDS:
            yield Table(some, n)
            some, total = [], 0
        some.append((item, words))
        total += len(words)
    if some:
        yield Table(some, n)


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """The best local alignment score of each item with its window of words, all pairs row by row together."""
    a, b = max(map(len, items)), max(map(len, windows))
    x, y = np.zeros((len(items), a), np.uint64), np.zeros((len(items), b), np.uint64)
    has_x, has_y = np.zeros(x.shape, bool), np.zeros(y.shape, bool)
    for i, (p, q) in enumerate(zip(items, windows, strict=True)):
        x[i, :len(p)], y[i, :len(q)] = p, q
        has_x[i, :len(p)], has_y[i, :len(q)] = True, True
    slope = (GAP * np.arange(b + 1)).astype(np.int32)
    above, best = np.zeros((len(items), b + 1), np.int32), np.zeros(len(items), np.int32)
    for k in range(a):
        same = (x[:, k, None] == y) & has_y & has_x[:, k, None]
        now = np.zeros_like(above)
        np.maximum(above[:, :-1] + np.where(same, MATCH, MISS), above[:, 1:] - GAP, out=now[:, 1:])
        np.maximum(now, 0, out=now)
        above = np.maximum.accumulate(now + slope, axis=1) - slope           # gaps in the item, any length
        best = np.maximum(best, above.max(axis=1))
    return best


def scan(docs: DataFrame, table: Table, n: int, least: float, passage: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, memo = sent.value, _Hashes()
        passes = np.unpackbits(t.bits).view(bool)
        jobs: list[tuple] = []                                               # (row, doc_id, item, window)
        best: dict[tuple, int] = {}

        def work() -> None:
            jobs.sort(key=lambda j: len(j[3]))
            i = 0
            while i < len(jobs):
                some = jobs[i:i + max(1, min(64, 1_000_000 // len(jobs[min(i + 63, len(jobs) - 1)][3])))]
                for (*key, _), s in zip(some, align([t.words[j[2]] for j in some], [j[3] for j in some]).tolist(), strict=True):
                    best[tuple(key)] = max(best.get(tuple(key), 0), s)
                i += len(some)
            jobs.clear()

        def done() -> pa.RecordBatch:
            work()
            full = {key: MATCH * int(t.size[key[2]]) for key in best}
            keep = [key for key in sorted(best, key=lambda x: (x[0], x[2])) if best[key] >= min(least * full[key], MATCH * passage)]
            out = pa.RecordBatch.from_arrays([pa.array([d for _, d, _ in keep], pa.int64()), pa.array([t.ids[i] for _, _, i in keep], pa.int64()),
                                              pa.array([round(best[key] / full[key], 6) for key in keep], pa.float64())], ["doc_id", "item_id", "score"])
            best.clear()
            return out
        row = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row += 1
                words = word_hashes(text.as_py(), memo)
                for i, s in zip(*(x.tolist() for x in t.stretches(grams(words, n), passes)), strict=True):
                    size = len(t.words[i])
                    jobs.append((row, doc, i, words[max(0, (2 * s - 2) * size):(2 * s + 4) * size]))
                    if len(jobs) >= 16 * JOBS_AT_ONCE:                       # within a document: align, but go on
                        work()
                if len(jobs) + len(best) >= JOBS_AT_ONCE:
                    yield done()
        yield done()
        memo.clear()
        common.give_back()
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, score double")


def find(docs: DataFrame, items: DataFrame, n: int = N, least: float = LEAST, passage: int = PASSAGE) -> DataFrame:
    """(doc_id, item_id, score): hits, score the share of the item's full alignment score; ``docs`` (doc_id, text),
    ``items`` (item_id, text)."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = [scan(docs, t, n, least, passage) for t in tables(items, n)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double")
