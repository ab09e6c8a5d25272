"""Operator 7: quality rules as a short-circuit cascade, ordered by rejection per cost.

Base counts are made for every text. The further rules run as a cascade: a documented sample of the rows measures what
each rule costs and how many rows it rejects, the rules are put in order of rejection per cost, and a row that a rule
rejects meets no later rule. The order changes the time, never the verdict: a row is kept if no rule rejects it.

Defined results: a null or empty text has no words and fails the base rule; repeated rows are judged each alike; an
empty table gives an empty result (the order is then as listed). Columns other than key and text are not read.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common

#: Fixed values of the base counts.
SYMBOLS, MIN_WORDS, WINDOW = b"#*$%&|<>", 50, 3
#: Rows that measure cost and selectivity, chosen by hash of the key.
SAMPLE_ROWS = 400
_NOT_START = bytes(range(0x80, 0xC0))
_SPACE = b"\t\n\x0b\x0c\r "


@dataclass
class Text:
    """One text with what the base counts have made of it."""
    raw: bytes
    words: list[bytes]
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


@dataclass
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that are found twice or more in the text, the first included."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    window = ids[:-2]
    for later in (ids[1:-1], ids[2:]):                    # pairs are numbered anew, so that products stay small
        window = np.unique(window * len(number) + later, return_inverse=True)[1]
    again = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k:len(again) + k] |= again
    return int(covered.sum())


def dup_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def measure(text: str) -> Text:
    raw = text.encode()
    words = raw.split()
    chars = len(text) - (len(raw) - len(raw.translate(None, _SPACE)))
    return Text(raw, words, chars, len(raw) - len(raw.translate(None, SYMBOLS)), dup_lines(raw), repeat_words(words))


def base_failed(t: Text) -> bool:
    return len(t.words) < MIN_WORDS or 100 * t.n_repeat_words > 50 * len(t.words)


_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def _few_lettered(t: Text) -> bool:
    return 5 * sum(1 for w in t.words if _LETTER.search(w)) < 3 * len(t.words)


def _one_word_rules(t: Text) -> bool:
    """Over a third of a text's words are one word."""
    count: dict[bytes, int] = {}
    for w in t.words:
        count[w] = count.get(w, 0) + 1
    return 3 * max(count.values()) > len(t.words)


#: The cascade's rules; thresholds are wide, so that only texts far from prose go.
RULES = [
    Rule("symbols", lambda t: 5 * t.n_symbols > len(t.words)),
    Rule("word_length", lambda t: not 2 * len(t.words) <= t.word_chars <= 20 * len(t.words)),
    Rule("dup_lines", lambda t: 2 * t.n_dup_lines > 1 + sum(1 for x in t.raw.split(b"\n") if x and not x.isspace())),
    Rule("lettered", _few_lettered),
    Rule("one_word", _one_word_rules),
]


def cascade_order(docs: DataFrame, rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[dict]:
    """(rule, cost in microseconds a row, share rejected) by rejection per cost, best first; a sample of ``rows`` rows."""
    sample = common.first_by(docs.select("doc_id", "text"), F.xxhash64("doc_id", "text"), rows)
    schema = "rule string, cost double, rejected long"

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [m for x in batch.column("text").to_pylist() if not base_failed(m := measure(x or ""))]
            for rule in rules:
                began = time.perf_counter()
                n = sum(map(rule.rejects, texts))
                yield pa.RecordBatch.from_pydict({"rule": [rule.name], "cost": [1e6 * (time.perf_counter() - began) / max(1, len(texts))],
                                                  "rejected": pa.array([n], pa.int64())})
    found = sample.mapInArrow(timed, schema).groupBy("rule").agg(F.avg("cost").alias("cost"), F.sum("rejected").alias("n")).collect()
    by = {r["rule"]: r for r in found}
    made = [{"rule": r.name, "cost": by[r.name]["cost"] if r.name in by else 0.0, "rejected": by[r.name]["n"] if r.name in by else 0} for r in rules]
    return sorted(made, key=lambda m: -m["rejected"] / max(m["cost"], 1e-3))


def judge(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, and the rule that rejected it (null: none).

    ``rejected_by`` names the first rejecting rule in the order measured, so it may differ between runs; ``kept`` may not.
    """
    by = {r.name: r for r in rules}
    ordered = [by[m["rule"]] for m in cascade_order(docs, rules)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                t = measure(text.as_py() or "")
                failed = base_failed(t)
                why = "base" if failed else next((r.name for r in ordered if r.rejects(t)), None)
                rows.append((len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, why is None, why))
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", *names])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                                    "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")
