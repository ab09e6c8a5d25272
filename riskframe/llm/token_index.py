"""Operator 1: documents as shards of raw token ids, with a minimal perfect hash index from document key to offset.

A shard holds the ids of its documents one after the other (16 bits each if the vocabulary allows, else 32), their
keys and offsets, and the index: a cascade of bit arrays gives every distinct key its own slot, the slot holds the
key's first row and a 32-bit fingerprint that turns absent keys away. Shards follow each other in key order.

Defined results: a null text is the empty text (its document holds the end id alone); documents with a null key come
first and are read by scans, not by key; rows with equal keys lie side by side and a lookup returns each of them;
an empty table gives no shard. Columns other than key and text are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import common, pieces

MANIFEST = "file string, first_key long, last_key long, n_docs long, n_tokens long"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + _MIX[0] * np.uint64(seed + 1)
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Slots 0..n-1 for n distinct keys. Level k keeps the keys that alone hit a bit of its array; others go on."""

    LEVELS, SPACE = 40, 2

    def __init__(self, levels: list[np.ndarray], left: np.ndarray):
        self.levels, self.left = levels, left
        self.before = []
        n = 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(n + np.cumsum(ones) - ones)
            n += int(ones.sum())
        self.n_levelled = n

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys.astype(np.uint64)
        while len(left) and len(levels) < cls.LEVELS:
            size = max(1, -(-cls.SPACE * len(left) // 64)) * 64
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        todo, k = np.arange(len(keys)), keys.astype(np.uint64)
        for level, words in enumerate(self.levels):
            at = mixed(k[todo], level) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.before[level][word] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        if len(todo) and len(self.left):
            i = np.minimum(np.searchsorted(self.left, k[todo]), len(self.left) - 1)
            out[todo] = np.where(self.left[i] == k[todo], self.n_levelled + i, -1)
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class _ShardWriter:
    def __init__(self, root: str, width: int):
        self.fs, folder = common.store(root)
        self.fs.create_dir(folder)
        self.name = f"shard-{uuid.uuid4().hex}.ids"
        self.out = self.fs.open_output_stream(f"{folder}/{self.name}")
        self.width, self.keys, self.valid, self.sizes = width, [], [], []

    def add(self, keys: np.ndarray, valid: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.keys.append(keys)
        self.valid.append(valid)
        self.sizes.append(n)

    def close(self) -> dict:
        keys, valid = np.concatenate(self.keys), np.concatenate(self.valid)
        sizes = np.concatenate(self.sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        rows = np.flatnonzero(valid)
        distinct, first = np.unique(keys[rows], return_index=True)
        index = PerfectHash.build(distinct.view(np.uint64))
        row_of, prints = np.zeros(len(distinct), "<i8"), np.zeros(len(distinct), "<u4")
        slot = index.slots(distinct.view(np.uint64))
        row_of[slot], prints[slot] = rows[first], fingerprints(distinct.view(np.uint64))
        at, parts = int(offsets[-1]) * self.width, {}
        arrays = {"keys": keys.astype("<i8"), "valid": valid.astype("u1"), "offsets": offsets.astype("<i8"), "rows": row_of,
                  "prints": prints, "left": index.left.astype("<u8")} | {f"level{i}": x for i, x in enumerate(index.levels)}
        for name, x in arrays.items():
            parts[name] = [at, len(x), x.dtype.str]
            self.out.write(x.tobytes())
            at += x.nbytes
        foot = json.dumps({"width": self.width, "parts": parts}).encode()
        self.out.write(foot + len(foot).to_bytes(8, "little"))
        self.out.close()
        known = keys[rows]
        return {"file": [self.name], "first_key": [int(known.min()) if len(known) else None],
                "last_key": [int(known.max()) if len(known) else None], "n_docs": [len(keys)], "n_tokens": [int(offsets[-1])]}


class Shard:
    """One shard opened for reading; only what is asked for is read."""

    def __init__(self, root: str, name: str):
        fs, folder = common.store(root)
        self.file = fs.open_input_file(f"{folder}/{name}")
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.meta = json.loads(self.file.read_at(n, size - 8 - n))
        self.keys, self.valid, self.offsets = self.part("keys"), self.part("valid").astype(bool), self.part("offsets")
        self.index = None

    def part(self, name: str) -> np.ndarray:
        at, n, kind = self.meta["parts"][name]
        return np.frombuffer(self.file.read_at(n * np.dtype(kind).itemsize, at), kind)

    def first_rows(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, -1 for keys that the shard does not hold."""
        if self.index is None:
            levels = [self.part(f"level{i}") for i in range(sum(p.startswith("level") for p in self.meta["parts"]))]
            self.index = PerfectHash(levels, self.part("left"))
            self.rows, self.prints = self.part("rows"), self.part("prints")
        slot = self.index.slots(keys.view(np.uint64))
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == fingerprints(keys.view(np.uint64)[ok])
        row = np.full(len(keys), -1, np.int64)
        row[ok] = self.rows[slot[ok]]
        ok[ok] = self.keys[row[ok]] == keys[ok]
        return np.where(ok, row, -1)

    def ids(self, first: int, stop: int) -> np.ndarray:
        w = self.meta["width"]
        return np.frombuffer(self.file.read_at(w * (stop - first), w * first), f"<u{w}")


def tokenizer_parts(tokenizer_json: str):
    """(encode(parts) -> bytes, special strings): the tokenizers library over a vocabulary file's content."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(tokenizer_json)
    t.no_truncation()
    t.no_padding()
    specials = [x["content"] for x in json.loads(tokenizer_json).get("added_tokens", [])]
    return lambda parts: [array("I", e.ids).tobytes() for e in t.encode_batch_fast(parts, add_special_tokens=False)], specials


def write(docs: DataFrame, root: str, tokenizer_path: str, end_id: int | None = 0) -> list[dict]:
    """Writes the shards of ``docs`` (doc_id, text) under ``root``; the manifest, one entry a shard in key order.

    Ties on the key are put in order by text hash and by row, so a key with very many rows spreads over shards.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)       # a vocabulary file: a few MB
    width = 2 if max(json.loads(vocabulary)["model"]["vocab"].values()) < 1 << 16 else 4

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = None, None
        for batch in batches:
            if encoder is None:
                encoder, out = pieces.shared(root, lambda: pieces.PartEncoder(*tokenizer_parts(sent.value))), _ShardWriter(root, width)
            keys = batch.column("doc_id")
            valid = keys.is_valid().to_numpy(zero_copy_only=False)
            number = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, part in pieces.slices(batch.column("text")):
                ids, n = encoder(part)
                if end_id is not None:
                    ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
                out.add(number[at:at + len(part)], valid[at:at + len(part)], ids, n)
        if out is not None:
            yield pa.RecordBatch.from_pydict(out.close())

    rows = (docs.withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
            .repartitionByRange("doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "_row")
            .select("doc_id", "text"))
    found = rows.mapInArrow(shard, MANIFEST).withColumn("part", F.spark_partition_id()).collect()
    out, start = [], 0
    for r in sorted(found, key=lambda r: r["part"]):             # one row a shard: bounded by the partition count
        out.append({"root": root, "file": r["file"], "first_key": r["first_key"], "last_key": r["last_key"], "start": start})
        start += r["n_tokens"]
    return out


def shards(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    return spark.createDataFrame([(m["root"], m["file"], m["start"]) for m in manifest], "root string, file string, start long")


def documents(spark: SparkSession, manifest: list[dict], chunk: int = 4_000_000) -> DataFrame:
    """Per stored document, read back by key through each shard's index: (doc_id, start, n_tokens, ids_crc32)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                shard = Shard(m["root"], m["file"])
                keys, valid, off = shard.keys, shard.valid, shard.offsets
                row = np.arange(len(keys))
                again = np.concatenate([[False], (keys[1:] == keys[:-1]) & valid[1:] & valid[:-1]])
                asked = np.flatnonzero(valid & ~again)                   # each key once; its further rows follow
                row[asked] = shard.first_rows(keys[asked])
                if (row != np.arange(len(keys))).any():
                    raise ValueError(f"the index of {m['file']} misses keys")
                at = 0
                while at < len(keys):
                    stop = max(at + 1, int(np.searchsorted(off, off[at] + chunk, "right")) - 1)
                    ids = shard.ids(int(off[at]), int(off[stop])).astype("<u4").tobytes()
                    base = int(off[at])
                    sums = [zlib.crc32(ids[4 * (a - base):4 * (b - base)])
                            for a, b in zip(off[at:stop].tolist(), off[at + 1:stop + 1].tolist(), strict=True)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(keys[at:stop], pa.int64(), mask=~valid[at:stop]), "start": m["start"] + off[at:stop],
                        "n_tokens": np.diff(off[at:stop + 1]), "ids_crc32": pa.array(sums, pa.int64())})
                    at = stop
    return shards(spark, manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(keys: DataFrame, manifest: list[dict], key: str = "doc_id") -> DataFrame:
    """(key, ids) of every stored document whose key is asked for; absent keys give no row.

    Keys go to the shards whose range holds them (bounds: two numbers a shard), one task opens a shard once a batch.
    """
    held = [m for m in manifest if m["first_key"] is not None]
    lo = np.array([m["first_key"] for m in held], np.int64)
    hi = np.array([m["last_key"] for m in held], np.int64)
    files = [(m["root"], m["file"]) for m in held]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            first, stop = np.searchsorted(hi, k, "left"), np.searchsorted(lo, k, "right")
            n = np.maximum(stop - first, 0)
            yield pa.RecordBatch.from_pydict({"key": np.repeat(k, n), "shard": pieces.spread(first, n)})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[int, Shard | None] = (-1, None)
        for batch in batches:
            k, where = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for s in np.unique(where):
                if opened[0] != s:
                    opened = (s, Shard(*files[s]))
                shard, mine = opened[1], np.unique(k[where == s])
                for key_, row in zip(mine.tolist(), shard.first_rows(mine).tolist(), strict=True):
                    while 0 <= row < len(shard.keys) and shard.valid[row] and shard.keys[row] == key_:
                        ids = shard.ids(int(shard.offsets[row]), int(shard.offsets[row + 1])).astype(np.int32)
                        yield pa.RecordBatch.from_pydict({"key": pa.array([key_], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32()))})
                        row += 1
    asked = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").distinct()
    return (asked.mapInArrow(route, "key long, shard long").repartition("shard").sortWithinPartitions("shard", "key")
            .mapInArrow(probe, "key long, ids array<int>").withColumnRenamed("key", key))
