"""Operator 12: the highest-scoring documents for each item, by NRA over impact-sorted lists.

The scan turns blocks of documents into postings of the items' terms (which document holds a term how often) and writes
them; weights come from exact counts over all blocks. A task then reads each block's lists from the highest impact down,
all of an item's lists to the same depth, and keeps for every document a lower score (what was read) and an upper score
(that and the next unread impact of each list where the document wasn't met). Once documents that can't reach the k-th
lower score are out, reading goes on among the others, until no score, tie or membership is open. Tasks hand on k
documents an item, of which the best k are ranked.

Items are taken in blocks of ``TERMS_AT_ONCE`` terms, one scan each, so what is broadcast has a bound. Defined results: a
null or empty text has no terms; an item without known terms gets no rows; a document counts as often as it is repeated;
null doc_ids come after all others; items with equal ids are ranked each; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import common, pieces

#: Terms of the items that one scan looks for, about; bytes and documents of a block; postings of a list read first.
TERMS_AT_ONCE, BLOCK, BLOCK_DOCS, FIRST = 500_000, 4_000_000, 8_192, 64
#: A term is a run of letters, digits and whatever lies beyond ASCII; of the capitals only A-Z are lowered.
_IS_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
BLOCKS = "doc_id array<long>, n array<long>, doc array<int>, term array<int>, tf array<int>"


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order (binary), and the text that each stands in."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    inside = _IS_TERM[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = at[:-1][at[:-1] < len(raw)]
    first[starts] = inside[starts]                                   # a term ends with its text
    place = np.flatnonzero(first)
    offsets = np.append((np.cumsum(inside) - 1)[place], inside.sum()).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside]])])
    return found, np.searchsorted(at, place, "right") - 1


def index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """A row for each block of ``docs`` (doc_id, text): ids and numbers of terms of its documents, and the postings
    (document in the block, term in ``vocabulary``, occurrences) of the terms asked for."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)            # TERMS_AT_ONCE terms, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.large_binary())
        for batch in batches:
            for at, some in pieces.slices(batch.column("text"), BLOCK):
                for k in range(0, len(some), BLOCK_DOCS):
                    part = some.slice(k, BLOCK_DOCS)
                    words, doc = terms(part)
                    code = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)
                    key, tf = np.unique(doc[code >= 0] * max(1, len(known)) + code[code >= 0], return_counts=True)
                    columns = [batch.column("doc_id").slice(at + k, len(part)), pa.array(np.bincount(doc, minlength=len(part)), pa.int64()),
                               *[pa.array(x, pa.int32()) for x in (key // max(1, len(known)), key % max(1, len(known)), tf)]]
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], ["doc_id", "n", "doc", "term", "tf"])
    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def statistics(blocks: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the documents that hold each term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(n_terms + 1, np.int64), 0
        for batch in batches:
            n = batch.column("n").flatten().to_numpy()
            held[n_terms] += np.count_nonzero(n)
            total += int(n.sum())
            held[:n_terms] += np.bincount(batch.column("term").flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(some, -1), pa.int64()), "n": pa.array(np.append(held[some], total), pa.int64())})
    found = blocks.select("n", "term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    of = {r["term"]: r["n"] for r in found}                                # TERMS_AT_ONCE rows, about
    return of.get(n_terms, 0), of.get(-1, 0), np.array([of.get(t, 0) for t in range(n_terms)], np.int64)


def impacts(n: np.ndarray, doc: np.ndarray, tf: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each posting adds to a score; 64-bit integers."""
    m = 10 + (90 * n.astype(np.int64) * np.int64(n_docs)) // max(1, n_terms)
    return weight * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 8 * m[doc]))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, least: float = 1) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k highest sums of impacts, ties with the k-th included, of at least ``least``.

    ``lists``: documents (below ``size``) and impacts of a term, highest impact first. Sums stay below 2^53.
    """
    lists, depth, at = list(lists), FIRST, [0] * len(lists)
    lower, ahead = np.zeros(size), np.zeros(len(lists))
    docs, term = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        new: list[tuple] = []
        for t, (d, x) in enumerate(lists):
            stop = min(len(d), depth)
            if at[t] < stop:
                new.append((d[at[t]:stop], x[at[t]:stop], t))
                at[t] = stop
            ahead[t] = x[stop] if stop < len(d) else 0
        if new:
            some = np.concatenate([d for d, _, _ in new])
            lower += np.bincount(some, np.concatenate([x for _, x, _ in new]), size)
            docs, term = np.append(docs, some), np.append(term, np.repeat([t for _, _, t in new], [len(d) for d, _, _ in new]))
        rest = ahead.sum()
        upper = lower + rest - np.bincount(docs, ahead[term], size)
        bar = max(least, np.partition(lower, size - k)[size - k] if size >= k else 0)
        open_ = upper >= bar
        if not (open_ & (upper > lower)).any():
            hit = np.flatnonzero(lower >= bar)
            return hit, lower[hit]
        depth *= 4
        if rest < bar:                                                # no unread document comes in: only those open matter
            for t, (d, x) in enumerate(lists):
                keep = open_[d[at[t]:]]
                lists[t], at[t] = (d[at[t]:][keep], x[at[t]:][keep]), 0
            depth = FIRST


def _best(scores: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, list]:
    """The k highest, equal scores by id, null ids last."""
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))[:k]
    return scores[order], [ids[i] for i in order]


def search_block(blocks: DataFrame, wanted: list[tuple[int, list[int]]], n_docs: int, n_terms: int, weight: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): k documents of each task for each of ``wanted`` (item, its terms)."""
    sent = blocks.sparkSession.sparkContext.broadcast((wanted, weight))        # TERMS_AT_ONCE terms, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        best = [(np.zeros(0), [])] * len(items)
        for batch in batches:
            for row in range(len(batch)):
                ids, n, doc, term, tf = (batch.column(c)[row].values for c in ("doc_id", "n", "doc", "term", "tf"))
                n, doc, term, tf = (x.to_numpy() for x in (n, doc, term, tf))
                x = impacts(n, doc, tf, weights[term], n_docs, n_terms)
                order = np.lexsort((-x, term))
                doc, x = doc[order].astype(np.int64), x[order].astype(float)
                bounds = np.searchsorted(term[order], np.arange(len(weights) + 1)).tolist()
                for i, (_, own) in enumerate(items):
                    lists = [(doc[bounds[t]:bounds[t + 1]], x[bounds[t]:bounds[t + 1]]) for t in own if bounds[t] < bounds[t + 1]]
                    have = best[i]
                    hit, score = nra(lists, len(n), k, max(1, have[0][-1] if len(have[0]) == k else 1)) if lists else ((), ())
                    if len(hit):
                        best[i] = _best(np.append(have[0], score), have[1] + ids.take(pa.array(hit)).to_pylist(), k)
        found = [(items[i][0], d, int(s)) for i, (scores, ids) in enumerate(best) for s, d in zip(scores, ids, strict=True)]
        columns = zip(*found, strict=True) if found else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])
    return blocks.mapInArrow(run, "item long, doc_id long, score long")


def item_blocks(items: DataFrame, limit: int = TERMS_AT_ONCE) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(row, distinct terms) of the items (row, text) with terms, in lists of about ``limit`` terms."""
    some: list[tuple[int, list[bytes]]] = []
    held = 0
    for r in items.select("row", "text").toLocalIterator():
        own = sorted(set(terms(pa.array([r["text"] or ""]))[0].to_pylist()))
        if own:
            some.append((r["row"], own))
            held += len(own)
        if held >= limit:
            yield some
            some, held = [], 0
    if some:
        yield some


def search(docs: DataFrame, items: DataFrame, k: int = 10, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring of ``docs`` (doc_id, text) for each of ``items``."""
    spark = docs.sparkSession
    asked = common.saved(common.numbered(items.select("item_id", F.col("text").cast("string").alias("text")), "row"), "items")
    found = []
    for block in item_blocks(asked, terms_at_once):
        vocabulary = sorted({t for _, own in block for t in own})
        code = {t: i for i, t in enumerate(vocabulary)}
        blocks = common.saved(index(docs, vocabulary), "impact-blocks")
        n_docs, n_terms, df = statistics(blocks, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        wanted = [(row, [code[t] for t in own]) for row, own in block]
        found.append(common.saved(search_block(blocks, wanted, n_docs, n_terms, weight, k), "found"))
    if not found:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.join(asked.select(F.col("row").alias("item"), "item_id"), "item").select("item_id", "rank", "doc_id", "score")
