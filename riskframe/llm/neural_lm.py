"""Operator 8: scores of texts under a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

Token counts come from all training texts. The model predicts the next class from the two before: the context's vectors,
weighted by place, give a vector whose product with each class's vector is its score. Half of the classes are the most
frequent tokens, one each, and the end; the others hold all remaining tokens by how they end (a hash of the last two
characters), so every token has a class that says something of it, unseen ones too. The number of classes grows with the
cube root of the distinct training tokens. Every partition of the training texts trains from the same start, one pass
over all of its tokens; the parameters are averaged by tokens. Batched matrix products over all contexts, a job of their
own, give the normalisers, so token probabilities sum to one; a token shares its class's probability by its count.

Defined results: a null or empty text has the end token alone; the unseen tokens of a class share one part of a token's
weight (0.5);
rows with a null key are training rows; repeated rows count and score each; with no training row N and V are 0 and all
tokens are unseen; an empty table gives an empty result. Other columns are not read. Whole texts count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import common

LEAST_CLASSES, GROWTH, DIM, NOISE, BATCH, RATE = 512, 8, 16, 64, 2048, 0.08
#: Words sent to all tasks with their counts, at most (about 25 MB); all others meet their counts in a join.
SENT_WORDS = 150_000
COUNT_AT_ONCE = 500_000
_MADE: dict[str, object] = {}


def n_classes(distinct: int) -> int:
    return max(LEAST_CLASSES, int(GROWTH * distinct ** (1 / 3)))


def ending(word: bytes, kinds: int) -> int:
    """The class, from 1 on, of a word that has none of its own; ``_ending`` is the same of a column."""
    return 1 + zlib.crc32(word.decode()[-2:].encode()) % kinds


def _ending(word: str, kinds: int) -> Column:
    return (1 + F.crc32(F.expr(f"right({word}, 2)")) % kinds).cast("int")


class _Numbers(dict):
    """Words that are sent with their counts to their numbers; any other word to -3 - its class."""
    kinds = 1

    def __missing__(self, word: bytes) -> int:
        return -3 - ending(word, self.kinds)


def held_out(key: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()               # bytes: A-Z only, ASCII white space only


def count_tokens(docs: DataFrame) -> DataFrame:
    """(word, c) of all words; the end token is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()).cast(pa.string()), pa.array(seen.values(), pa.int64())], ["word", "c"])
            seen.clear()
            return out
        for batch in batches:
            for text in batch.column("text"):
                seen.update(tokens(text.as_py()))
                if len(seen) > COUNT_AT_ONCE:
                    yield rows()
            seen[b""] += len(batch)
        if seen:
            yield rows()
    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The words of the highest count classes (sixteenths of powers of two), ``most`` at most; by count, then word."""
    classed = counts.where("word <> ''").withColumn("class", F.floor(16 * F.log2("c")).cast("int"))
    least, held = None, 0
    for r in sorted(classed.groupBy("class").count().collect(), reverse=True):           # under a thousand classes
        held += r["count"]
        if held > most:
            break
        least = r["class"]
    rows = classed.where(F.col("class") >= least).select("word", "c").collect() if least is not None else []
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))


class Model:
    """Class vectors in (R) and out (Q), place weights (C) and biases of a log-bilinear model over two tokens before."""

    def __init__(self, flat: np.ndarray, k: int, d: int):
        self.k, self.d = k, d
        self.R, self.Q = flat[:k * d].reshape(k, d), flat[k * d:2 * k * d].reshape(k, d)
        self.C, self.b = flat[2 * k * d:2 * k * d + 2 * d].reshape(2, d), flat[2 * k * d + 2 * d:]

    @classmethod
    def start(cls, share: np.ndarray, d: int) -> Model:
        k, g = len(share), np.random.default_rng(7)
        return cls(np.concatenate([g.normal(0, 0.1, k * d), g.normal(0, 0.1, k * d), np.ones(2 * d), np.log(share)]), k, d)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.R, self.Q, self.C, self.b)])

    def train(self, two: np.ndarray, one: np.ndarray, target: np.ndarray, share: np.ndarray, g: np.random.Generator, squares: np.ndarray) -> None:
        """One pass of noise-contrastive estimation; the noise of a batch is shared by its tokens. ``squares``: of gradients, by group."""
        k, d, log_noise = self.k, self.d, np.log(NOISE * share)
        cut = np.cumsum(share)
        for i in range(0, len(target), BATCH):
            a, b, t = two[i:i + BATCH], one[i:i + BATCH], target[i:i + BATCH]
            n = np.minimum(np.searchsorted(cut, g.random(NOISE)), k - 1)
            ra, rb = self.R[a], self.R[b]
            h = ra * self.C[0] + rb * self.C[1]
            up = 1 / (1 + np.exp((h * self.Q[t]).sum(1) + self.b[t] - log_noise[t]))            # 1 - P(from the data)
            down = -1 / (1 + np.exp(-(h @ self.Q[n].T + self.b[n] - log_noise[n])))             # - P(from the data), noise
            gh = up[:, None] * self.Q[t] + down @ self.Q[n]
            gq = _sums(t, up[:, None] * h, k) + _sums(n, down.T @ h, k)
            gb = np.bincount(t, up, k) + np.bincount(n, down.sum(0), k)
            gr = _sums(a, gh * self.C[0], k) + _sums(b, gh * self.C[1], k)
            gc = np.stack([(gh * ra).sum(0), (gh * rb).sum(0)])
            for p, x, s in ((self.Q, gq, 0), (self.b, gb, 1), (self.R, gr, 2), (self.C, gc, 3)):
                own = x / len(t)
                squares[s] = 0.99 * squares[s] + 0.01 * float((own ** 2).mean() + 1e-12)
                p += RATE / 10 * np.clip(own / np.sqrt(squares[s]), -10, 10)

    def normalisers(self, two: np.ndarray) -> np.ndarray:
        """log of the summed exponentials after the given classes two before, for every class one before."""
        out = np.empty((len(two), self.k), np.float32)
        q, b = self.Q.T.astype(np.float32), self.b.astype(np.float32)
        near = (self.R * self.C[1]).astype(np.float32)
        for i, a in enumerate(two.tolist()):
            x = (near + (self.R[a] * self.C[0]).astype(np.float32)) @ q + b
            top = x.max(1)
            out[i] = top + np.log(np.exp(x - top[:, None]).sum(1))
        return out


def normalisers(spark: SparkSession, model: Model) -> np.ndarray:
    """Those of all contexts, computed by tasks: classes x classes numbers on the driver (1 MB for 512, 16 MB for 2048)."""
    sent = spark.sparkContext.broadcast((model.flat(), model.k, model.d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            z = m.normalisers(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in z], pa.binary())], ["id", "z"])
    tasks = max(1, min(4 * spark.sparkContext.defaultParallelism, model.k // 16))
    rows = spark.range(0, model.k, 1, tasks).mapInArrow(run, "id long, z binary").collect()
    return np.stack([np.frombuffer(r["z"], np.float32) for r in sorted(rows, key=lambda r: r["id"])])


def _sums(at: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows of x summed by at: a sparse sum as one sort and one reduction."""
    order = np.argsort(at, kind="stable")
    where = at[order]
    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
    out = np.zeros((k, x.shape[1]))
    out[where[first]] = np.add.reduceat(x[order], first, axis=0)
    return out


def _sequence(number: _Numbers, own: np.ndarray, texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts; the number of each token (end: -2, not sent: -3 - class); its class; the tokens of each text.
    ``own``: the classes of the words that are sent."""
    words = [tokens(x) for x in texts]
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1
    get = number.__getitem__
    ids = np.fromiter((i for w in words for i in (*map(get, w), -2)), np.int64, int(n.sum()))
    sent = ids >= 0
    cls = np.where(ids == -2, 0, -3 - ids)
    cls[sent] = own[ids[sent]]
    return words, ids, cls, n


def _before(cls: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes two and one before each token; before a text stand ends."""
    start = np.cumsum(n) - n
    one = np.concatenate([[0], cls[:-1]])
    two = np.concatenate([[0, 0], cls[:-2]])[:len(cls)]
    one[start] = 0
    two[start] = 0
    second = start[n > 1] + 1
    two[second] = 0
    return two, one


def _slices(batch: pa.RecordBatch, chars: int = 1_500_000) -> Iterator[tuple[int, list[str]]]:
    at, some, size = 0, [], 0
    for k, x in enumerate(batch.column("text")):
        some.append(x.as_py())
        size += len(some[-1])
        if size >= chars or k + 1 == len(batch):
            yield at, some
            at, some, size = k + 1, [], 0


def train(docs: DataFrame, number, own: np.ndarray, share: np.ndarray) -> Model:
    """The model after one pass over all training texts; averaged over the partitions, weighted by tokens."""
    k = len(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, g, seen, squares = Model.start(share, DIM), np.random.default_rng(11), 0, np.full(4, 1e-4)
        for batch in batches:
            for _, some in _slices(batch):
                _, _, cls, n = _sequence(number.value, own, some)
                two, one = _before(cls, n)
                order = g.permutation(len(cls))
                model.train(two[order], one[order], cls[order], share, g, squares)
                seen += len(cls)
        if seen:
            flat = model.flat()
            yield pa.RecordBatch.from_pydict({"place": np.arange(len(flat)), "value": flat * seen, "weight": np.full(len(flat), float(seen))})
    found = (docs.select("text").mapInArrow(run, "place long, value double, weight double").groupBy("place")
             .agg((F.sum("value") / F.sum("weight")).alias("value")).toPandas())              # as many rows as parameters
    start = Model.start(share, DIM).flat()
    start[found["place"]] = found["value"]
    return Model(start, k, DIM)


def score(docs: DataFrame, fold: int = 1, classes: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each of ``docs`` (doc_id, text);
    ``classes``: another number of classes than the growing one."""
    spark = docs.sparkSession
    learning = docs.where(~held_out(fold=fold))
    counts = common.saved(count_tokens(learning), "token-counts")
    total, distinct = (int(x or 0) for x in counts.agg(F.sum("c"), F.count("*")).first())
    sent = frequent(counts, SENT_WORDS)
    ends = int((counts.where("word = ''").agg(F.sum("c")).first()[0]) or 0)
    k = classes or n_classes(distinct)
    kinds = k // 2                                                       # classes of words by their ending
    mine = sent[:k - 1 - kinds]
    held, differ = np.zeros(1 + kinds), np.ones(1 + kinds)               # of these: tokens, and words with one part for all unseen
    for r in counts.where("word <> ''").groupBy(_ending("word", kinds).alias("e")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        held[r["e"]] += r["c"]
        differ[r["e"]] += r["n"]
    for w, c in mine:
        held[ending(w.encode(), kinds)] -= c
        differ[ending(w.encode(), kinds)] -= 1
    weight = held + 0.5 * differ
    weight[0] = ends + 0.5
    share = np.concatenate([weight, [c for _, c in mine]]).astype(float)
    share /= share.sum()
    k = len(share)
    own = np.array([1 + kinds + i if i < len(mine) else ending(w.encode(), kinds) for i, (w, _) in enumerate(sent)], np.int64)
    numbers = _Numbers({w.encode(): i for i, (w, _) in enumerate(sent)})
    numbers.kinds = kinds
    number = spark.sparkContext.broadcast(numbers)
    model = train(learning, number, own, share)
    flat = spark.sparkContext.broadcast((model.flat(), normalisers(spark, model)))
    norms = np.log10(weight)
    norms[0] = 0.0
    c_sent = spark.sparkContext.broadcast(np.log10(np.array([*(c for _, c in sent), 0, ends], float) + 0.5))
    name = common.shared_dir(spark, "model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MADE:
            _MADE.clear()
            _MADE[name] = (Model(flat.value[0], k, DIM), flat.value[1])
        m, log_z = _MADE[name]
        rq, logs, where = m.Q.astype(np.float32), c_sent.value, number.value
        near, far, bias = ((m.R * m.C[i]).astype(np.float32) for i in (1, 0)), None, m.b.astype(np.float32)
        near, far = near
        for batch in batches:
            for at, some in _slices(batch):
                words, ids, cls, n = _sequence(where, own, some)
                two, one = _before(cls, n)
                first = np.cumsum(n) - n
                p = np.einsum("ij,ij->i", near[one] + far[two], rq[cls]) + bias[cls] - log_z[two, one]
                known, logc = ids > -3, logs[np.where(ids == -2, len(logs) - 1, np.maximum(ids, 0))]
                logc = np.where(known, logc, 0.0)
                other = (cls > 0) & (cls <= kinds)
                within = np.where(other, norms[np.minimum(cls, kinds)], 0.0)
                sums = lambda x: np.add.reduceat(x.astype(np.float64), first)  # noqa: E731, B023
                rare_words, rare_n = [], []
                for w, i, j in zip(words, first, n, strict=True):
                    c = Counter(w[x] for x in np.flatnonzero(~known[i:i + j]).tolist())
                    rare_words.append([x.decode() for x in c])
                    rare_n.append(list(c.values()))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(some)), pa.array(n), pa.array(sums(known & (ids > -2) | ((ids == -2) & (ends > 0))).astype(np.int64)),
                    pa.array(sums(logc)), pa.array(sums(np.where(other, logc, 0.0))), pa.array(sums(within)), pa.array(sums(p) / np.log(10)),
                    pa.array(rare_words, pa.list_(pa.string())), pa.array(rare_n, pa.list_(pa.int32()))],
                    ["doc_id", "n_tokens", "n_sent", "logs", "other_logs", "other_norms", "class_logs", "rare", "rare_n"])
    made = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_sent long, logs double, other_logs double, other_norms double, "
                                                    "class_logs double, rare array<string>, rare_n array<int>")
    rows = common.saved(made.withColumn("row", F.monotonically_increasing_id()), "token-scores")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("m"))
    c = F.coalesce("c", F.lit(0))
    met = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.col("m") * F.log10(c + 0.5)).alias("rare_logs"), F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("n_rare"))
    zero = lambda x: F.coalesce(x, F.lit(0))
    norm = float(np.log10(total + 0.5 * (distinct + 1)))
    return (rows.drop("rare", "rare_n").join(met, "row", "left")
            .select("doc_id", held_out(fold=fold).alias("held_out"), "n_tokens", (F.col("n_sent") + zero("n_rare")).alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"), (F.col("logs") + zero("rare_logs") - F.col("n_tokens") * norm).alias("base_score"),
                    (F.col("class_logs") + F.col("other_logs") + zero("rare_logs") - F.col("other_norms")).alias("score")))
