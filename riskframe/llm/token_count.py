"""Operator 11: token counts of whole texts, most parts answered by the list of strings that are one token alone.

Once, on the driver, every string of the vocabulary is put through the pre-tokeniser and the merges: those that stay one
part and end as the one id that names them are whole tokens (a vocabulary string need not be: other merges may win).
Workers cut texts into distinct parts, split these into pre-tokens, count 1 for each pre-token that is a whole token, and
merge only the rest, many at a time: a step joins the pair of lowest rank in every unfinished pre-token.

Defined results: a null text is the empty text of 0 bytes and tokens; the strings of special tokens inside a text are one
token, as in the library; repeated rows are counted each; an empty table gives an empty result; other columns are not
read. Texts are counted whole, whatever their length.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskframe.llm import bpe, merges, pieces

#: Bytes of texts that are cut at once, and of remembered parts in a worker.
SLICE, MEMO_BYTES = 4_000_000, 96_000_000


def whole_tokens(vocabulary: bpe.Vocabulary) -> list[str]:
    """The strings that are encoded as one token: the special ones and the vocabulary's that its own merges reach."""
    found = list(vocabulary.special)
    for i, raw in enumerate(vocabulary.bytes):
        try:
            text = raw.decode()
        except UnicodeDecodeError:                                    # part of a character: never a pre-token
            continue
        if text and text not in vocabulary.special and pieces.PATTERN.findall(text) == [text] and vocabulary.merged(raw) == [i]:
            found.append(text)
    return found


class PartCounter:
    """Numbers of tokens of whole texts; remembers those of the parts it met, up to ``memo`` bytes of them."""

    def __init__(self, vocabulary: bpe.Vocabulary, whole: list[str], memo: int = MEMO_BYTES):
        self.specials, self.whole, self.merger, self.limit = list(vocabulary.special), frozenset(whole), merges.Merger(vocabulary.single, vocabulary.merge), memo
        self.memo, self.held = {}, 0

    def __call__(self, texts: pa.Array) -> np.ndarray:
        keys, parts = pieces.cut(texts, self.specials)
        if not len(keys):
            return np.zeros(len(texts), np.int64)
        coded = keys.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        own = list(map(self.memo.get, distinct))
        new = [i for i, n in enumerate(own) if n is None]
        for i, n in zip(new, self._count([distinct[i] for i in new]), strict=True):
            own[i] = n
        if self.held > self.limit:                                        # costs time later, changes nothing
            self.memo, self.held = {}, 0
        self.memo.update((distinct[i], own[i]) for i in new)
        self.held += sum(100 + len(distinct[i]) for i in new)             # 100: a string and an entry in the dictionary
        ends = np.concatenate([[0], np.cumsum(np.array(own, np.int64)[coded.indices.to_numpy()])])
        stops = np.cumsum(parts)
        return ends[stops] - ends[stops - parts]

    def _count(self, keys: list[str]) -> list[int]:
        """The number of tokens of each part: of its pre-tokens one each, unless they have to be merged."""
        out, rest, where = [], {}, []
        for k, key in enumerate(keys):
            found = pieces.pieces(pieces.part_of(key), self.specials)
            out.append(len(found))
            for p in found:
                if p and p not in self.whole:
                    where.append((k, rest.setdefault(p, len(rest))))
                elif not p:
                    out[k] -= 1
        if rest:
            more = (self.merger.counts([p.encode() for p in rest]) - 1).tolist()
            for k, i in where:
                out[k] += more[i]
        return out


def count(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of ``docs`` (doc_id, text) for a byte-level BPE file of the tokenizers library."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()
    whole = whole_tokens(bpe.Vocabulary(vocabulary))
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, whole))        # a vocabulary and its strings: a few MB
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counter = pieces.shared(name, lambda: PartCounter(bpe.Vocabulary(sent.value[0]), sent.value[1]))
            for at, part in pieces.slices(batch.column("text"), SLICE):
                n = counter(part)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), pc.cast(pc.binary_length(part), pa.int64()), pa.array(n), pa.array(n > limit)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
