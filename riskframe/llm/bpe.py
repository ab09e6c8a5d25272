"""Operator 10: byte-level BPE encoding through a memory-mapped lexicon of frequent words, and decoding.

The most frequent parts of the corpus, counted over all of it, are compiled into a minimal acyclic automaton: equal
suffixes share their states, and the words skipped on the way to a word give its number, which names its ids. Workers
map the file; a part that it holds is answered by walking the arcs (for all new parts of a slice at once), any other
part is cut by the pre-tokeniser and merged exactly, pair by pair in rank order.

Defined results: a null text is the empty text with no ids; repeated rows are encoded each; an empty table gives an
empty result and a lexicon without words. The whole text counts; special tokens in a text get their own ids, as in the
library. The lexicon's size changes the time, never a result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import common, merges, pieces

#: Words in the lexicon: bounds what the driver collects and the mapped file (about 2 MB at this size).
LEXICON_WORDS = 65_536
#: Bytes of texts that are encoded or counted at once, and of counted parts that a task holds before it hands them on.
SLICE, COUNT_SLICE, COUNT_BYTES = 2_000_000, 1_000_000, 16_000_000


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


class Vocabulary:
    """Exact merges and token bytes of a byte-level BPE file."""

    def __init__(self, tokenizer_json: str):
        d = json.loads(tokenizer_json)
        ids, letter = d["model"]["vocab"], byte_alphabet()
        merges = [m if isinstance(m, list) else m.split(" ") for m in d["model"]["merges"]]
        self.single = [ids[letter[b]] for b in range(256)]
        self.merge = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.special = {x["content"]: x["id"] for x in d.get("added_tokens", [])}
        of = {c: b for b, c in letter.items()}
        self.bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes[i] = bytes(of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one pre-tokenised part: always the pair of lowest rank first, from the left."""
        word, get = [self.single[b] for b in piece], self.merge.get
        found = list(map(get, zip(word, word[1:])))                       # what each neighbouring pair merges to
        while True:
            best = min(filter(None, found), default=None)
            if best is None:
                return word
            token, i = best[1], found.index(best)
            if len(word) > 300:                                          # anew, in one pass, instead of shifting the rest each time
                out, k = word[:i], i
                while k < len(word):
                    same = k < len(found) and found[k] == best
                    out.append(token if same else word[k])
                    k += 1 + same
                word, found = out, list(map(get, zip(out, out[1:])))
                continue
            while True:                                                  # every such pair, from the left
                word[i:i + 2] = [token]
                found[i:i + 1] = []
                if i:
                    found[i - 1] = get((word[i - 1], token))
                if i < len(found):
                    found[i] = get((token, word[i + 1]))
                try:
                    i = found.index(best, i)
                except ValueError:
                    break

    def encode(self, part: str) -> list[int]:
        out: list[int] = []
        for p in pieces.pieces(part, list(self.special)):
            out += [self.special[p]] if p in self.special else self.merged(p.encode())
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


class Lexicon:
    """A minimal acyclic automaton over the bytes of words, each word with its ids; one flat buffer.

    Arcs are sorted by 256 * state + byte. ``skip`` is the number of words that come before those behind the arc, so
    the skips on a word's path, and the ends passed on it, add up to its number in the sorted list of words.
    """

    PARTS = ("arcs", "target", "skip", "final", "first", "ids")

    def __init__(self, parts: dict[str, np.ndarray]):
        self.__dict__.update(parts)

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        order = sorted(words)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []

        def settled(node: list) -> int:
            """The number of the state equal to an open node [final, [(byte, number or open node)]]; its last arc first."""
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        path: list[list] = [[False, []]]
        last = b""
        for word in [*order, b""]:
            common_ = 0
            while common_ < min(len(word), len(last)) and word[common_] == last[common_]:
                common_ += 1
            for depth in range(len(last), common_, -1):
                node = path.pop()
                path[-1][1].append((last[depth - 1], settled(node)))
            for _ in word[common_:]:
                path.append([False, []])
            if word:
                path[-1][0] = True
            last = word
        root = settled([b"" in words, path[0][1]])
        n = [0] * len(states)
        arcs, target, skip = [], [], []
        for s, (final, out) in enumerate(states):                # a state comes after those that it leads to
            n[s] = int(final)
            for byte, t in out:
                arcs.append(256 * s + byte)
                target.append(t)
                skip.append(n[s])
                n[s] += n[t]
        sizes = [len(words[w]) for w in order]
        return cls({"arcs": np.array(arcs, "<i8"), "target": np.array(target, "<i4"), "skip": np.array(skip, "<i4"),
                    "final": np.array([f for f, _ in states], "u1"), "first": np.array([root, 0, *np.cumsum(sizes)], "<i4"),
                    "ids": np.array([i for w in order for i in words[w]], "<u4")})

    def dump(self) -> bytes:
        head = json.dumps([[k, len(x := getattr(self, k)), x.dtype.str] for k in self.PARTS]).encode()
        return len(head).to_bytes(8, "little") + head + b"".join(getattr(self, k).tobytes() for k in self.PARTS)

    @classmethod
    def load(cls, buffer) -> Lexicon:
        n = int.from_bytes(buffer[:8], "little")
        at, parts = 8 + n, {}
        for name, size, kind in json.loads(bytes(buffer[8:at])):
            parts[name] = np.frombuffer(buffer, kind, size, at)
            at += parts[name].nbytes
        return cls(parts)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls.load(np.memmap(path, "u1", "r"))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that are not held; all words walk one byte at a time."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), "u1")
        start = np.cumsum(n) - n
        state = np.full(len(words), int(self.first[0]), np.int64)
        out, live, depth = np.zeros(len(words), np.int64), np.arange(len(words)), 0
        lost = np.zeros(len(words), bool)
        while len(live):
            live = live[n[live] > depth]
            key = 256 * state[live] + text[start[live] + depth]
            i = np.searchsorted(self.arcs, key)
            i[i == len(self.arcs)] = 0
            hit = self.arcs[i] == key if len(self.arcs) else np.zeros(len(live), bool)
            lost[live[~hit]] = True
            live, i = live[hit], i[hit]
            out[live] += self.skip[i]
            state[live] = self.target[i]
            depth += 1
        return np.where(lost | (self.final[state] == 0), -1, out)

    def encode(self, words: list[bytes]) -> list[bytes | None]:
        off = self.first[1:]
        return [None if k < 0 else self.ids[off[k]:off[k + 1]].tobytes() for k in self.numbers(words).tolist()]


class Encoder:
    """What a worker holds to encode: the vocabulary, the lexicon, the merges and the memory of parts."""

    def __init__(self, tokenizer_json: str, lexicon: Lexicon):
        self.vocabulary, self.lexicon = Vocabulary(tokenizer_json), lexicon
        self.merger, self.specials = merges.Merger(self.vocabulary.single, self.vocabulary.merge), list(self.vocabulary.special)
        self.texts = pieces.PartEncoder(self.parts, self.specials)

    def parts(self, new: list[str]) -> list[bytes]:
        """The ids of some parts: from the lexicon, else cut and merged, each pre-token once."""
        found = self.lexicon.encode([p.encode() for p in new])
        own: dict[str, int] = {}
        cut = [(i, [p if p in self.vocabulary.special else own.setdefault(p, len(own)) for p in pieces.pieces(new[i], self.specials) if p])
               for i, ids in enumerate(found) if ids is None]
        merged = self.merger.encode([p.encode() for p in own])
        for i, some in cut:
            found[i] = b"".join([merged[p] if isinstance(p, int) else self.vocabulary.special[p].to_bytes(4, "little") for p in some])
        return found


def count_parts(docs: DataFrame, specials: list[str]) -> DataFrame:
    """(part, n): how often each part occurs in all texts; counted in the tasks first, then summed by part."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            t = pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("n", "sum")])
            return pa.table({"key": t["key"], "n": t["n_sum"]})
        for batch in batches:
            for _, part in pieces.slices(batch.column("text"), COUNT_SLICE):
                c = pc.value_counts(pieces.cut(part, specials)[0])
                held.append(pa.table({"key": c.field(0).cast(pa.string()), "n": c.field(1).cast(pa.int64())}))
                if sum(t.nbytes for t in held) > COUNT_BYTES:
                    held = [summed()]
                    if held[0].nbytes > COUNT_BYTES // 2:                 # mostly distinct: summed by the shuffle
                        yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from summed().combine_chunks().to_batches()
        held.clear()
        common.give_back()
    spaced = F.when(F.col("key").startswith("\x01"), F.expr("substr(key, 2)")).when(F.col("key").startswith("\n"), F.col("key")).otherwise(F.concat(F.lit(" "), "key"))
    return docs.select("text").mapInArrow(count, "key string, n long").groupBy(spaced.alias("part")).agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, tokenizer_json: str, words: int = LEXICON_WORDS) -> bytes:
    """The lexicon of the most frequent parts: all from the lowest count class (a sixteenth of a power of two) with
    which they are at most ``words``. A part that occurs once is not frequent."""
    vocabulary = Vocabulary(tokenizer_json)
    counted = common.saved(count_parts(docs, list(vocabulary.special)).where("n > 1")
                           .withColumn("class", F.floor(16 * F.log2("n")).cast("int")), "part-counts")
    least, held = None, 0
    for r in sorted(counted.groupBy("class").count().collect(), reverse=True):         # under a thousand classes
        held += r["count"]
        if held > words:
            break
        least = r["class"]
    top = counted.where(F.col("class") >= least).select("part").collect() if least is not None else []
    return Lexicon.build({r["part"].encode(): vocabulary.encode(r["part"]) for r in top}).dump()


def encode(docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS, decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, as the tokenizers library gives them without added special tokens.

    With ``decoded`` also text, decoded from the ids by the same task (one Python worker a task instead of two).
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()
    sent = spark.sparkContext.broadcast(vocabulary)                   # a vocabulary file: a few MB
    path = common.shared_dir(spark, "lexicon")
    fs, folder = common.store(path)
    fs.create_dir(folder)
    name = folder.rpartition("/")[2] + ".bin"
    with fs.open_output_stream(f"{folder}/{name}") as out:
        out.write(compile_lexicon(docs, vocabulary, lexicon_words))
    spark.sparkContext.addFile(f"{path}/{name}")                      # every executor gets its copy, also a new one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pieces.shared(name, lambda: Encoder(sent.value, Lexicon.mapped(SparkFiles.get(name))))
            for at, part in pieces.slices(batch.column("text"), SLICE):
                ids, n = own.texts(part)
                ends = np.concatenate([[0], np.cumsum(n)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                texts = [own.vocabulary.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)] if decoded else []
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), lists] + [pa.array(texts, pa.string())] * decoded,
                                                 ["doc_id", "ids", "text"][:2 + decoded])
        common.give_back()
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>" + ", text string" * decoded)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids, text): the text of each row's ids, special tokens included; a null list is the empty text."""
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(sent.value)
        for batch in batches:
            lists = batch.column("ids")
            for i in range(0, len(lists), 500):
                part = lists.slice(i, 500)
                texts = [own.decode(x.values.to_numpy().tolist()) if x.is_valid else "" for x in part]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 500), part, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
