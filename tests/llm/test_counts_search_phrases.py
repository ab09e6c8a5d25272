"""Token counts, ranked search and phrase mining against brute force, and their edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import bpe, common, merges, phrases, pieces, ranked_search, token_count
from tests.llm.test_operators import EDGE, SCHEMA, prose

BPE = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "B ", "\n", " ", "  ", "\t", " ", "\x85", "<|endoftext|>", "'s", "12", "½", "é", "中", "\x1c", "　", "-_", "🙂", "\r\n", "\x01", "aaaa", "eee"]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, "en", "src", 1, "x", 5, "y") for i, t in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(BPE, encoding="utf-8").read())


def test_merged_counts(vocabulary):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghtionre é中🙂") for _ in range(r.randint(1, 30))).encode() for _ in range(2000)]
    words += [b"a" * k for k in range(1, 40)] + [b"ab" * 3000, "".join(r.choice("abcd") for _ in range(5000)).encode()]
    merger, want = merges.Merger(vocabulary.single, vocabulary.merge), [vocabulary.merged(w) for w in words]
    assert merger.counts(words).tolist() == list(map(len, want))
    assert [np.frombuffer(x, "<u4").tolist() for x in merger.encode(words)] == want
    assert merger.counts([]).tolist() == [] == merger.encode([])


def test_part_counter(vocabulary):
    r, t = random.Random(2), Tokenizer.from_file(BPE)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 12))) for _ in range(4000)] + ["x" * 50_000, prose(20_000, 9)]
    counter = token_count.PartCounter(vocabulary, token_count.whole_tokens(vocabulary), memo=2000)
    found = np.concatenate([counter(part) for _, part in pieces.slices(pa.array(texts), 500)])
    assert found.tolist() == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_whole_tokens_are_one_token(vocabulary):
    t = Tokenizer.from_file(BPE)
    whole = token_count.whole_tokens(vocabulary)
    assert len(whole) > 45_000 and "<|endoftext|>" in whole
    assert all(len(e.ids) == 1 for e in t.encode_batch(whole, add_special_tokens=False))


def test_token_counts(edge, none):
    t = Tokenizer.from_file(BPE)
    found = token_count.count(common.texts(edge), BPE, limit=100)
    want = [(i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 100) for i, x in EDGE]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert token_count.count(common.texts(none), BPE).count() == 0


def terms_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(docs, items, k):
    of = [(i, terms_of(t)) for i, t in docs]
    n_docs, total = sum(1 for _, w in of if w), sum(len(w) for _, w in of)
    df = Counter(t for _, w in of for t in set(w))
    out = []
    for item, text in items:
        found = []
        for i, w in of:
            m = 100 - 90 + (90 * len(w) * n_docs) // max(1, total)
            tf = Counter(w)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in set(terms_of(text)))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def test_terms():
    texts = ["Ab,cD é中\x00x", "", "tail", "Zed 9-9", "É_É"]
    words, text = ranked_search.terms(pa.array(texts).slice(0))
    assert [w.decode() for w in words.to_pylist()] == [w for t in texts for w in terms_of(t)]
    assert text.tolist() == [i for i, t in enumerate(texts) for _ in terms_of(t)]
    assert ranked_search.terms(pa.array(texts).slice(2, 2))[1].tolist() == [0, 1, 1, 1]


def test_nra(monkeypatch):
    monkeypatch.setattr(ranked_search, "FIRST", 2)
    g = np.random.default_rng(3)
    for _ in range(300):
        size, n = int(g.integers(1, 60)), int(g.integers(1, 8))
        lists, score = [], np.zeros(size)
        for _ in range(n):
            docs = np.flatnonzero(g.random(size) < g.random())
            x = np.sort(g.integers(1, int(g.integers(2, 50)), len(docs)))[::-1].astype(float)
            docs = g.permutation(docs)
            score[docs] += x
            lists.append((docs, x))
        hit, found = ranked_search.nra(lists, size, 5)
        bar = max(1, np.sort(score)[::-1][min(4, size - 1)] if size >= 5 else 1)
        assert hit.tolist() == np.flatnonzero(score >= bar).tolist() and found.tolist() == score[hit].tolist()


def test_search(spark, edge, none, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 7)
    r = random.Random(4)
    docs = [(i % 90, prose(r.randint(0, 60), i % 70)) for i in range(200)] + EDGE
    items = [(1, prose(30, 500)), (2, None), (3, "zzz"), (3, prose(3, 7)), (4, docs[5][1]), (None, "one " * 3)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, score int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    for at_once in (10, 10**6):
        found = ranked_search.search(common.texts(frame), asked, k=5, terms_at_once=at_once)
        assert sorted(map(tuple, found.collect()), key=repr) == ranked(docs, items, 5)
    assert ranked_search.search(common.texts(none), asked).count() == 0
    assert ranked_search.search(common.texts(edge), asked.where("false")).count() == 0


def mined(docs, least, limit, share):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        score, cut = min((1000 * a * n[lang] // (f[lang, w[:c]] * f[lang, w[c:]]), c) for c in range(1, len(w)))
        inside = any(len(v) > len(w) and b >= least and 100 * b >= share * a and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))
                     for (of, v), b in f.items() if of == lang and len(v) > len(w) and b >= least)
        if not inside:
            found.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:cut]], f[lang, w[cut:]], n[lang]))
    out = []
    for lang in n:
        mine = sorted(x for x in found if x[0] == lang)[:limit]
        out += [(lang, i + 1, x[3].decode(), -x[2], x[4], x[5], x[6], -x[1]) for i, x in enumerate(mine)]
    return sorted(out)


def chatter(n, seed):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), r.choice([" ", "\t", "  ", ""]) + "".join(
        r.choice(["red Fox jumps over it", "big red fox", "é中", "x", "to be or not to be", "so", "a a a"]) + r.choice([" ", ", ", "  ", "\n", ". ", "\t", " so "])
        for _ in range(r.randint(0, 12)))) for _ in range(n)]


@pytest.mark.parametrize("share", [100, 60])
def test_collocations(spark, share):
    docs = chatter(400, 8) + [("a", None), (None, ""), ("c", "only here"), ("a", " \t\n")]
    frame = spark.createDataFrame([(i, lang, t, 3, "x") for i, (lang, t) in enumerate(docs)], "doc_id long, lang string, text string, n long, phrase string")
    found = phrases.collocations(frame, least=12, limit=25, share=share)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == mined(docs, 12, 25, share)


def test_border_failures(spark, monkeypatch):
    """An empty first filter: every longer phrase is found by further passes."""
    docs = chatter(200, 9)
    frame = spark.createDataFrame([(lang or "und", t) for lang, t in docs], "lang string, text string")
    nothing = np.zeros(1 << (phrases.CELL_BITS - 3), np.uint8)
    found = phrases.frequent_phrases(frame, 20, bits=nothing).where("k > 0").select("lang", "phrase", "n").collect()
    f = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.lower()):
            w = piece.split()
            f.update((lang or "und", " ".join(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    assert sorted(map(tuple, found)) == sorted((lang, p, n) for (lang, p), n in f.items() if n >= 20)
    full = np.full_like(nothing, 255)                                     # a saturated filter lets everything through
    again = phrases.frequent_phrases(frame, 20, bits=full).where("k > 0").select("lang", "phrase", "n").collect()
    assert sorted(again) == sorted(found)


def test_no_phrases(spark, none, edge):
    assert phrases.collocations(none).count() == 0
    found = phrases.collocations(edge, least=2).collect()
    assert found and {r["lang"] for r in found} == {"en"}
