"""Operator 13: collocations by Toivonen mining: a sample proposes phrases, a full pass settles them and their border.

1. Words are counted exactly; the frequent ones go into a filter of fixed size. Level by level, longer phrases that are
   frequent in a sample of runs of words (at a lowered threshold) follow.
2. One pass over all texts counts every phrase whose first and last words but one are both in the filter: the proposed
   phrases and their negative border alike. They are counted by hashes, which can only add to a count.
3. Every frequent hash that the filter lacks is a border failure. If there are any, they go into the filter and a further
   pass counts each phrase left out so far whose first and last words but one are frequent, or left out so far
   themselves: so the phrases around a failure are followed to their full length at once, and the pass closes the
   search. No frequent phrase stays uncounted: its parts are frequent, hence, from two words on, in the filter or
   counted with it. The filter's false hits add counted phrases, never lose any.
4. A last pass counts the phrases with frequent hashes by their words. They are scored by their weakest cut, those inside
   an equally frequent longer one go, the rest is ranked.

Defined results: a null text is the empty text, a null language is ``und``; repeated rows count each; ties in score and
count go by the phrase's bytes; a language without frequent phrases gives no rows, as does an empty table. Words have any
length. Other columns are not read. The sample changes the number of passes, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import common, pieces

#: Words of the longest phrase; one run of so many words in so many is in the sample; its threshold is so many times lower.
LONGEST, RUN, SAMPLE, LOWERED = 5, 64, 8, 6
SLICE, CELL_BITS, HASH_BITS, SALTS = 2_000_000, 24, 40, 64
_FIRST = np.uint64((1 << 64) - (1 << 64 - HASH_BITS))
_IS_BREAK = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_IS_WORD = ~(_IS_BREAK | np.isin(np.arange(256), list(b" \t")))
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_POWER = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))


class Words:
    """The words of some texts in order: the text's ``lang`` in ``langs``, the ``piece`` they stand in (equal numbers: the
    same piece), a ``hash`` of word and language, and ``code``, the word's place in ``known``."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]] if len(texts) else np.zeros(0, np.uint8)
        at = at - at[0]
        inside = _IS_WORD[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = at[:-1][at[:-1] < len(raw)]
        first[starts] = inside[starts]
        place = np.flatnonzero(first)
        offsets = np.append((np.cumsum(inside, dtype=np.int32) - 1)[place], inside.sum()).astype(np.int64)
        kept = _LOWER[raw[inside]]
        self.words = pa.Array.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        of = langs.dictionary_encode()
        text = np.searchsorted(at, place, "right") - 1
        self.langs, self.lang = of.dictionary, of.indices.to_numpy().astype(np.int64)[text]
        self.piece = np.cumsum(_IS_BREAK[raw], dtype=np.int32)[place] + text
        self.hash = hashes(kept, offsets, self.langs, self.lang)

    @cached_property
    def coded(self) -> tuple[pa.Array, np.ndarray]:
        of = self.words.dictionary_encode()
        return of.dictionary.cast(pa.large_string()), of.indices.to_numpy().astype(np.int64)

    def phrases(self, begin: np.ndarray, k: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Languages, phrases and counts of the k words that begin at ``begin``, told apart by the words themselves."""
        known, code = self.coded
        columns = [(self.lang[begin], len(self.langs))] + [(code[begin + j], len(known)) for j in range(k)]
        key, span = columns[0]
        for x, n in columns[1:]:
            if span * n >= 1 << 62:                                   # numbered anew, so that the product fits
                seen, key = np.unique(key, return_inverse=True)
                span = len(seen)
            key, span = key * n + x, span * n
        _, one, n = np.unique(key, return_index=True, return_counts=True)
        at = begin[one]
        parts = [known.take(pa.array(code[at + j])) for j in range(k)]
        return self.langs.take(pa.array(self.lang[at])), pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k > 1 else parts[0], n


def hashes(text: np.ndarray, offsets: np.ndarray, langs: pa.Array, lang: np.ndarray) -> np.ndarray:
    """A hash of each word (none empty), which ``offsets`` cut from ``text``, and of its language."""
    salt = np.fromiter((xxhash.xxh3_64_intdigest(w, 1) for w in langs.to_pylist()), np.uint64, len(langs))
    if len(offsets) < 2:
        return np.zeros(0, np.uint64)
    place = np.arange(len(text)) - np.repeat(offsets[:-1], np.diff(offsets))
    with np.errstate(over="ignore"):
        own = np.add.reduceat((text + np.uint64(1)) * _POWER[place & 0xFFFF], offsets[:-1])
        return _mixed(_mixed(own) + salt[lang])


def longer(hash_: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word, from that of the phrase and that of the word."""
    with np.errstate(over="ignore"):
        return _mixed(hash_ * _P + last)


def cells(hash_: np.ndarray) -> np.ndarray:
    return (hash_ >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def held(bits: np.ndarray, hash_: np.ndarray) -> np.ndarray:
    c = cells(hash_)
    return (bits[c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1


def levels(words: Words, bits: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places from which on k words are a phrase whose first and last k - 1 words the filter holds, and so on for
    theirs; their hashes)."""
    at, h = np.arange(len(words.hash)), words.hash
    for k in range(2, longest + 1):
        known = held(bits, h)
        at, h = at[known], h[known]
        if len(at) < 2:
            return
        both = (np.diff(at) == 1) & (words.piece[np.minimum(at[:-1] + k - 1, len(words.piece) - 1)] == words.piece[at[:-1]])
        at, h = at[:-1][both], h[:-1][both]
        h = longer(h, words.hash[at + k - 1])
        yield k, at, h


def further(words: Words, before: np.ndarray, bits: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, hashes) of the phrases that ``before`` did not let through and whose first and last k - 1 words are in
    ``bits`` or not let through by ``before`` themselves."""
    counted = {k: at for k, at, _ in levels(words, before, longest)}
    at, h = np.arange(len(words.hash)), words.hash
    open_ = held(bits, h)
    for k in range(2, longest + 1):
        at, h = at[open_], h[open_]
        if len(at) < 2:
            return
        both = (np.diff(at) == 1) & (words.piece[np.minimum(at[:-1] + k - 1, len(words.piece) - 1)] == words.piece[at[:-1]])
        at, h = at[:-1][both], h[:-1][both]
        h = longer(h, words.hash[at + k - 1])
        new = ~np.isin(at, counted.get(k, at[:0]), assume_unique=True)
        yield k, at[new], h[new]
        open_ = new | held(bits, h)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for at, part in pieces.slices(batch.column("text"), SLICE):
            yield Words(batch.column("lang").slice(at, len(part)), part)


def _filter(found: DataFrame) -> np.ndarray:
    """The bits of the cells in ``found`` (cell): a table of 2^18 numbers at most."""
    rows = found.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 AS int))")).alias("bits")).collect()
    out = np.zeros(1 << (CELL_BITS - 6), np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out.view(np.uint8)


def _sample(docs: DataFrame) -> DataFrame:
    """(lang, text): one run of ``RUN`` words in ``SAMPLE``, drawn by a generator that the slice's size seeds, so that the
    phrases of one long text, of one long line or of a group of copies are met like others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in pieces.slices(batch.column("text"), SLICE):
                drawn, rows, of = np.random.default_rng([len(part), part.nbytes]), [], []
                for i, text in enumerate(part.to_pylist()):
                    words = text.split(" ")
                    for j in np.flatnonzero(drawn.random(-(-len(words) // RUN)) < 1 / SAMPLE).tolist():
                        rows.append(" ".join(words[j * RUN:(j + 1) * RUN]))
                        of.append(i)
                langs = batch.column("lang").slice(at, len(part)).take(pa.array(of, pa.int64()))
                yield pa.RecordBatch.from_arrays([langs, pa.array(rows, pa.string())], ["lang", "text"])
    return docs.select("lang", "text").mapInArrow(run, "lang string, text string")


def _row(k: int, langs: pa.Array, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs.cast(pa.string()), pa.array(np.full(len(n), k), pa.int32()), phrases.cast(pa.string()), pa.array(n, pa.int64())],
                                      ["lang", "k", "phrase", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, k, phrase, n) of all words, and of all word occurrences of a language together (k = 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _slices(batches):
            yield _row(1, *words.phrases(np.arange(len(words.hash)), 1))
            yield _row(0, words.langs, pa.array([""] * len(words.langs)), np.bincount(words.lang, minlength=len(words.langs)))
    return docs.select("lang", "text").mapInArrow(run, "lang string, k int, phrase string, n long").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def hash_counts(docs: DataFrame, bits: np.ndarray, before: np.ndarray | None, level: tuple[int, int]) -> DataFrame:
    """(h, n) of the phrases of ``level`` (least, most words) that the filter lets through; with ``before``, of those that
    it adds (see ``further``). ``h``: the first ``HASH_BITS`` bits of the hash, and the number of words in the last three."""
    sent = docs.sparkSession.sparkContext.broadcast((bits, before))            # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old = sent.value
        for words in _slices(batches):
            for k, _, h in levels(words, new, level[1]) if old is None else further(words, old, new, level[1]):
                if k >= level[0] and len(h):
                    key, n = np.unique((h & _FIRST) | np.uint64(k), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])
    return docs.select("lang", "text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _cell(h: str) -> Column:
    return F.shiftrightunsigned(h, 64 - CELL_BITS).alias("cell")


def propose(docs: DataFrame, bits: np.ndarray, least: int, longest: int = LONGEST) -> np.ndarray:
    """The filter ``bits`` of frequent words with the longer phrases that are frequent in the sample."""
    sample = common.saved(_sample(docs), "phrase-sample")
    enough = max(1, least // (SAMPLE * LOWERED))
    for k in range(2, longest):
        bits = bits | _filter(hash_counts(sample, bits, None, (k, k)).where(F.col("n") >= enough).select(_cell("h")))
    return bits


def phrase_counts(docs: DataFrame, bits: np.ndarray, wanted: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(lang, k, phrase, n): by their words, the phrases that ``bits`` lets through and whose own cell is in ``wanted``."""
    sent = docs.sparkSession.sparkContext.broadcast((bits, wanted))            # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        through, mine = sent.value
        for words in _slices(batches):
            for k, at, h in levels(words, through, longest):
                begin = at[held(mine, h)]
                if len(begin):
                    yield _row(k, *words.phrases(begin, k))
    return docs.select("lang", "text").mapInArrow(run, "lang string, k int, phrase string, n long").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def _cells_of(frequent: DataFrame) -> DataFrame:
    """(cell) of each phrase (lang, phrase)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, of = pc.split_pattern(batch.column("phrase").cast(pa.large_binary()), b" "), batch.column("lang").dictionary_encode()
            words = pc.list_flatten(phrases)
            at, lang = np.concatenate([[0], np.cumsum(pc.list_value_length(phrases).to_numpy())]).astype(np.int64), of.indices.to_numpy().astype(np.int64)
            n = np.diff(at)
            cut = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
            text = np.frombuffer(words.buffers()[2] or b"", np.uint8)[cut[0]:cut[-1]] if len(words) else np.zeros(0, np.uint8)
            h = hashes(text, cut - cut[0], of.dictionary, np.repeat(lang, n))
            out = h[at[:-1]]
            for j in range(1, int(n.max(initial=1))):
                more = n > j
                out[more] = longer(out[more], h[at[:-1][more] + j])
            yield pa.RecordBatch.from_pydict({"cell": cells(out)})
    return frequent.select("lang", "phrase").mapInArrow(run, "cell long")


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = LONGEST, bits: np.ndarray | None = None) -> DataFrame:
    """(lang, k, phrase, n): all phrases of ``docs`` (lang, text) of up to ``longest`` words that occur ``least`` times, and
    all word occurrences of each language (k = 0). ``bits``: another filter than that of the sample to begin with."""
    words = common.saved(word_counts(docs).where((F.col("n") >= least) | (F.col("k") == 0)), "word-counts")
    own = _filter(_cells_of(words.where("k = 1")))
    bits = own | (propose(docs, own, least, longest) if bits is None else bits)
    found = common.saved(hash_counts(docs, bits, None, (2, longest)).where(F.col("n") >= least), "frequent-hashes")
    wider = bits | _filter(found.where(F.col("h").bitwiseAND(7) < longest).select(_cell("h")))
    if (wider != bits).any():                                         # the border failed
        more = hash_counts(docs, wider, bits, (2, longest)).where(F.col("n") >= least)
        found = found.unionAll(common.saved(more, "frequent-hashes"))
    wanted = _filter(found.select(_cell("h")))
    bits = own | wanted
    return words.unionAll(phrase_counts(docs, bits, wanted, longest).where(F.col("n") >= least))


def _ranked(rows: DataFrame, by: list[str], order: list, name: str, limit: int) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= limit)


def collocations(docs: DataFrame, least: int = 100, limit: int = 2000, share: int = 100, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``limit`` phrases of 2 to ``longest`` words. Phrases
    go that lie inside a longer one with at least ``share`` per cent of their occurrences."""
    docs = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = common.saved(frequent_phrases(docs, least, longest), "frequent-phrases")
    totals = found.where("k = 0").select(F.col("lang").alias("of"), F.col("n").alias("total"))
    candidates = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    words = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    parts = candidates.select("lang", "phrase", "a", "k", "w", cut).select("lang", "phrase", "a", "cut", words(F.lit(1), F.col("cut")).alias("left"),
                                                                          words(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    part = found.where("k > 0")
    parts = parts.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]) \
        .join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]) \
        .join(totals, F.col("lang").eqNullSafe(F.col("of"))).drop("of")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    exact = parts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * (whole("a") * whole("total")).cast("decimal(34,0)")).withColumn("below", whole("l") * whole("r"))
    least_ = exact.withColumn("score", F.expr("above div below")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", F.col("total").alias("n"))).alias("x"))
    inside = candidates.where("k > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1))) \
        .groupBy("lang", words(F.col("i"), F.col("m")).alias("phrase")).agg(F.max("a").alias("around"))
    kept = least_.select("lang", "phrase", "x.*").join(inside, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = _ranked(kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), ["lang", "salt"], order, "rank", limit)
    return _ranked(some, ["lang"], order, "rank", limit).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
