"""The training-data operators against brute force, exact round trips and held-out figures, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import (bpe, common, components, decontaminate, langid, neural_lm, pieces, quality, secrets, simhash,
                           suffix_dedup, token_index, warc)

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, row long, tie string"
WORDS = "the of and river stone quiet morning letter gather under bright window seven harbour lantern copper meadow signal".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 30)) * (r.random() < 0.4) for _ in range(n))


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(200, 1)), (6, prose(200, 1)), (6, prose(200, 1)), (None, prose(80, 2)),
        (None, None), (7, prose(30000, 3)), (8, prose(200, 1) + " tail"), (9, "x" * 3000), (10, "é中🙂 <|endoftext|> a b  c\r\n\r\nd\x01e "),
        (11, "password = hunter2secret and AKIA" + "A1" * 10 + " " + "0f" * 20), (12, "token=ab token: abcdefgh\n" * 3)]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "src", 1, "x", 5, "y") for i, t in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *by):
    return sorted((tuple(r) for r in df.select(*by).collect()), key=repr)


def ids(text):
    return Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids


def test_parts_encode_as_whole_texts():
    t = Tokenizer.from_file(BPE)
    r = random.Random(1)
    bits = ["a", "B ", "\n", " ", "  ", "\t", " ", "\x85", "<|endoftext|>", "'s", "12", "½", "é", "中", "́", "\x1c", "　", "-_", "🙂", "\r\n", "\x01"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 9))) for _ in range(3000)]
    encoder = pieces.PartEncoder(token_index.tokenizer_parts(open(BPE).read())[0], ["<|endoftext|>"], memo=50)
    found = []
    for _, some in pieces.slices(pa.array(texts), 500):
        flat, n = encoder(some)
        found += [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]
    assert found == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    keys = np.unique(keys)
    assert sorted(token_index.PerfectHash.build(keys).slots(keys).tolist()) == list(range(len(keys)))
    assert len(token_index.PerfectHash.build(keys[:0]).slots(keys[:3])) == 3


def test_token_index(spark, edge, none):
    docs = common.texts(edge)
    manifest = token_index.write(docs, common.shared_dir(spark, "t1"), BPE)
    found = token_index.documents(spark, manifest).toPandas().sort_values("start")
    assert found["start"].tolist() == [0, *np.cumsum(found["n_tokens"])[:-1]]
    want = sorted(((i, len(x := [*ids(t), 0]), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in EDGE), key=repr)
    assert sorted(((None if pd.isna(r.doc_id) else int(r.doc_id), r.n_tokens, r.ids_crc32) for r in found.itertuples()), key=repr) == want
    known = found["doc_id"].dropna().tolist()
    assert known == sorted(known)
    asked = spark.createDataFrame([(i,) for i in (6, 10, 404, -1, None)], "doc_id long")
    assert rows(token_index.lookup(asked, manifest), "doc_id", "ids") == sorted(((i, [*ids(t), 0]) for i, t in EDGE if i in (6, 10)), key=repr)
    assert token_index.write(common.texts(none), common.shared_dir(spark, "t1"), BPE) == []
    assert token_index.documents(spark, []).count() == 0


def test_bpe(edge, none):
    done = bpe.encode(common.texts(edge), BPE, lexicon_words=300, decoded=True)
    t = Tokenizer.from_file(BPE)
    want = sorted(((i, ids(x), t.decode(ids(x), skip_special_tokens=False)) for i, x in EDGE), key=repr)
    assert rows(done, "doc_id", "ids", "text") == want
    assert rows(bpe.decode(done.select("doc_id", "ids"), BPE), "doc_id", "ids", "text") == want
    assert bpe.encode(common.texts(none), BPE, decoded=True).count() == 0


def test_lexicon(tmp_path):
    words = {w.encode(): [k, k + 1] for k, w in enumerate(["", "a", "walked", "talked", "walking", "talking", "é", "\x00"])}
    (tmp_path / "x").write_bytes(bpe.Lexicon.build(words).dump())
    lexicon = bpe.Lexicon.mapped(str(tmp_path / "x"))
    asked = [*words, b"walk", b"walkedx", b"zz"]
    assert [None if x is None else np.frombuffer(x, "<u4").tolist() for x in lexicon.encode(asked)] == [*words.values(), None, None, None]
    assert len(lexicon.final) < sum(map(len, words))                       # suffixes are shared
    assert bpe.Lexicon.load(np.frombuffer(bpe.Lexicon.build({}).dump(), "u1")).encode([b"", b"a"]) == [None, None]


def test_simhash(spark, edge, none):
    found = simhash.near_duplicates(common.texts(edge)).collect()
    by = {}
    for i, x in EDGE:
        w = re.findall(common.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        s = [" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(y.encode(), 42) for y in s]
        by.setdefault(i, []).append(sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)))
    assert sorted(r["fingerprint"] for r in found) == sorted(f"{f:016x}" for fs in by.values() for f in fs)
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in found if r["doc_id"] in (5, 6)} == {5}
    assert simhash.near_duplicates(common.texts(none)).count() == 0


@pytest.mark.parametrize("partitions", [2, 3])
def test_simhash_links_all(spark, partitions):
    r = random.Random(partitions)
    fps = [r.getrandbits(64) for _ in range(30)]
    for _ in range(150):
        fps.append(r.choice(fps) ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    fps = list(dict.fromkeys(fps))
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = dict(simhash.link(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, partitions).collect())
    groups, want = {}, {}
    for k, f in enumerate(signed):
        groups.setdefault(found[f], set()).add(f)
        want.setdefault(find(k), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(90, 91), (91, 90), (95, 95)], "a long, b long")
    assert dict(components.stars(links).collect()) == {k: 0 for k in range(1, 41)} | {91: 90}


def test_secrets(spark, edge, none):
    ledger = common.shared_dir(spark, "t5")
    found = secrets.scan(edge, ledger, ["doc_id"])
    for r in found.collect():
        want = []
        for text in {t or "" for i, t in EDGE if i == r["doc_id"] and hashlib.sha256((t or "").encode()).hexdigest() == r["blob"]}:
            for place, (kind, pattern, group, least) in enumerate([("assign", secrets.RULES[0].pattern, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]):
                want += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        assert [tuple(s) for s in r["spans"]] == sorted(want)
    assert found.count() == len(EDGE)
    scanned = spark.read.parquet(ledger).count()
    assert scanned == 3 * len({t or "" for _, t in EDGE})
    again = secrets.scan(edge.union(edge.limit(1).withColumn("text", F.lit("secret: longvalue"))), ledger, ["doc_id"])
    assert again.count() == len(EDGE) + 1 and spark.read.parquet(ledger).count() == scanned + 3
    newer = [secrets.Rule("assign", r"pin=(\d+)", 1, 4, version=2), *secrets.RULES[1:]]
    secrets.scan(edge, ledger, ["doc_id"], rules=newer)
    assert spark.read.parquet(ledger).where("version = 2").count() == scanned // 3
    assert secrets.scan(none, common.shared_dir(spark, "t5"), ["doc_id"]).count() == 0


def test_warc(spark, none):
    long = "<html>" + "z" * 200 + "é</html>"
    pages = [(5, "http://a.example/x?y=1", long), (3, None, long), (3, "u", long), (9, "bad\r\nuri", "short"), (10, "v", "short"), (None, "w", None), (None, "w", long)]
    df = spark.createDataFrame([(*p, "q", 1) for p in pages], "page_id long, url string, html string, digest string, row int")
    files = warc.write(df, common.shared_dir(spark, "t2"))
    records = warc.read(files, with_payload=True)
    assert Counter(r["type"] for r in records.collect()) == {"request": 7, "metadata": 7, "response": 4, "revisit": 3}
    found = warc.resolved(common.saved(warc.captures(records), "t2"))
    got = rows(found, F.col("metadata.fields")["page-id"], "response.type", F.coalesce("original.payload_digest", "response.payload_digest"), F.col("original.page_id"))
    digest = {h: hashlib.sha256((h or "").encode()).hexdigest() for *_, h in pages}
    assert got == sorted([("3", "response", digest[long], None), ("3", "revisit", digest[long], "3"), ("5", "revisit", digest[long], "3"), ("", "revisit", digest[long], "3"),
                          ("9", "response", digest["short"], None), ("10", "response", digest["short"], None), ("", "response", digest[None], None)], key=repr)
    assert records.where("type = 'response' and payload_bytes > 100").first()["payload"] == long.encode()
    assert all(r["request"]["http"].startswith("GET ") for r in found.select("request").collect())
    assert warc.write(none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("lang").alias("html")), common.shared_dir(spark, "t2")).count() == 0


def test_quality(edge, none):
    found = {(r["doc_id"], r["n_words"]): r for r in quality.judge(common.texts(edge)).collect()}
    assert found[(None, 0)]["base_failed"] and found[(5, 200)]["kept"] and not found[(9, 1)]["kept"]
    assert quality.repeat_words("a b c x a b c".split()) == 6 and quality.repeat_words(["a"] * 4) == 4
    assert quality.dup_lines(b"a\n\nb\na\n \n \n") == 1
    costs = quality.cascade_order(common.texts(edge))
    assert {m["rule"] for m in costs} == {r.name for r in quality.RULES}
    assert quality.judge(common.texts(none)).count() == 0


def test_language(spark, edge, none):
    de, en = "der und die nicht werden schon über " * 20, "the and of which would about there " * 20
    many = [(k, de if k % 2 else en, ("de" if k % 2 else "en"), "a.x.org", 0) for k in range(60)] + [(100, de, "en", "b.x.org", 0), (101, "12 34", "en", "h", 0), (102, None, None, None, 0), (103, en, None, None, 0)]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string, source string, ll int")
    found = {r["doc_id"]: r for r in langid.identify(langid.of_documents(df)).collect()}
    assert all(found[k]["lang"] == ("de" if k % 2 else "en") and found[k]["kept"] for k in range(60))
    assert found[100]["text_lang"] == "de" and found[103]["lang"] == "en"
    assert not found[101]["kept"] and not found[102]["kept"] and found[102]["lang"] is None
    assert langid.identify(langid.of_documents(edge)).count() == len(EDGE)
    assert langid.identify(langid.of_documents(none)).count() == 0
    page = spark.createDataFrame([(1, "https://www.x.example.de:80/a", "<html lang='de'><script>x</script><p>und</p></html>")], "page_id long, url string, html string")
    assert tuple(langid.of_pages(page).select("declared", "suffix", "host").first()) == ("de", "de", "www.x.example.de")


def test_decontamination(spark, edge, none):
    items = [(k, prose(40, 100 + k)) for k in range(5)] + [(9, "two words"), (10, None)]
    edited = " ".join(w if k % 7 else "changed" for k, w in enumerate(items[1][1].split()))
    docs = [(1, prose(300, 7) + " " + items[0][1].upper() + " " + prose(3000, 8)), (2, prose(5, 9) + "\n" + edited), (3, prose(500, 10)), (3, items[2][1]), (3, items[2][1]), (None, items[3][1]), (4, None)]
    d = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, tie int")
    b = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, size int")
    found = rows(decontaminate.find(common.texts(d), b), "doc_id", "item_id")
    assert found == sorted([(1, 0), (2, 1), (3, 2), (3, 2), (None, 3)], key=repr)
    assert decontaminate.find(common.texts(none), b).count() == 0
    assert decontaminate.find(common.texts(edge), b.limit(0)).count() == 0
    x, y = np.array([1, 2, 3, 4], np.uint64), np.array([9, 1, 2, 8, 3, 4], np.uint64)
    assert decontaminate.align([x, x], [y, y[:1]]).tolist() == [7, 0]


def test_decontamination_of_a_much_copied_edit(spark, monkeypatch):
    """Against brute-force alignment: an edited version in far more documents than the verbatim one; seeds of few words."""
    words = [f"w{k}" for k in range(40)]
    edited = " ".join("changed" if k % 5 == 4 else w for k, w in enumerate(words))
    texts = [(0, prose(50, 1) + " " + " ".join(words) + " " + prose(50, 2))]
    texts += [(k, f"{prose(k % 7 * 60, k)} {edited} {prose(40, 900 + k)}") for k in range(1, 120)]
    texts += [(200 + k, prose(90, 500 + k)) for k in range(20)] + [(300, "p q r x"), (301, "s p q r"), (302, " ".join(words[:3]) + " " + prose(20, 3) + " " + " ".join(words[20:23]))]
    items = [(0, " ".join(words)), (1, "p q r s"), (2, prose(40, 77)), (3, "p q")]
    memo = decontaminate._Hashes()
    want = []
    for d, t in texts:
        for i, x in items[:3]:
            a = decontaminate.word_hashes(x, memo)
            s = int(decontaminate.align([a], [decontaminate.word_hashes(t, memo)])[0])
            if s >= decontaminate.LEAST * 2 * len(a):
                want.append((d, i, round(s / (2 * len(a)), 6)))
    assert len(want) == 122
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontaminate.find(docs, bench), "doc_id", "item_id", "score") == sorted(want, key=repr)
    monkeypatch.setattr(decontaminate, "PASS_WORDS", 44)                     # several scans
    assert rows(decontaminate.find(docs, bench), "doc_id", "item_id", "score") == sorted(want, key=repr)


def test_decontamination_of_a_long_item(spark):
    """Less than half of an item: 240 of 500 words, 28 of 59, the same with edits; 12 words are too few, 13 are not."""
    long, short = [f"a{k}" for k in range(500)], [f"b{k}" for k in range(59)]
    passages = [long[100:340], ["changed" if k % 7 == 6 else w for k, w in enumerate(long[100:340])], short[20:48], long[:13], long[:12], short[-12:], []]
    docs = [(k, f"{prose(60, k)} {' '.join(p)} {prose(700, 50 + k)}") for k, p in enumerate(passages)]
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short))], "item_id long, text string"))
    assert rows(found, "doc_id", "item_id", "score") == [(0, 1, 0.48), (1, 1, round((206 * 2 - 34) / 1000, 6)), (2, 2, round(56 / 118, 6)), (3, 1, 0.026)]


def test_decontamination_seeds_in_parts(monkeypatch):
    r = np.random.default_rng(3)
    t = decontaminate.Table([(k, r.integers(0, 9, int(r.integers(3, 40))).astype(np.uint64)) for k in range(30)], 3)
    g, passes = decontaminate.grams(r.integers(0, 9, 3000).astype(np.uint64), 3), np.ones(1 << 24, bool)
    whole = [x.tolist() for x in t.stretches(g, passes)]
    monkeypatch.setattr(decontaminate, "SEEDS_AT_ONCE", 50)
    assert len(whole[0]) > 100 and [x.tolist() for x in t.stretches(g, passes)] == whole


def test_lm(spark, edge, none):
    r = random.Random(5)
    texts = [(k, " ".join(["red fox", "blue sky"][(k + j) % 2] for j in range(r.randint(20, 60)))) for k in range(300)] + [x for x in EDGE if x[0] != 7]
    df = spark.createDataFrame([(*x, 0) for x in texts], "doc_id long, text string, c int")
    found = neural_lm.score(common.texts(df), classes=8).toPandas()
    out = [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1 if i is not None else False for i, _ in texts]
    token = [re.findall(common.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""] for _, t in texts]
    c = Counter(w for t, o in zip(token, out, strict=True) if not o for w in t)
    n, v = sum(c.values()), len(c)
    base = sorted(round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in t), 6) for t in token)
    assert np.allclose(sorted(found["base_score"]), base, atol=1e-5) and set(found["train_tokens"]) == {n}
    assert sorted(found["n_known"]) == sorted(sum(c[w] > 0 for w in t) for t in token)
    held = found[found["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()                    # order is learned, counts alone don't know it
    assert neural_lm.score(common.texts(none)).count() == 0
    m = neural_lm.Model.start(np.full(6, 1 / 6), 4)
    logits = (m.R[:, None] * m.C[0] + m.R[None] * m.C[1]) @ m.Q.T + m.b
    assert np.allclose(np.exp(logits - m.normalisers(np.arange(6))[:, :, None]).sum(2), 1, atol=1e-4)


def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                mark[s:s + length] = b"\1" * length
        out.append((len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(bytes(x for x, m in zip(b, mark, strict=True) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("length,core", [(400, 100), (60, 16)])
def test_suffix_dedup(spark, edge, none, length, core):
    shared = [prose(120, 50 + k) for k in range(4)]
    r = random.Random(length)
    texts = [t for _, t in EDGE] + [prose(r.randint(0, 60), 60 + k) + r.choice(shared)[r.randint(0, 300):] + prose(r.randint(0, 40), 90 + k) for k in range(40)] + ["ab" * 700]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, row int").repartition(5)
    found = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove(common.texts(df), length, core).collect()}
    assert [found[k] for k in range(len(texts))] == removed(texts, length)
    assert suffix_dedup.remove(common.texts(edge), length, core).count() == len(EDGE)
    assert suffix_dedup.remove(common.texts(none), length, core).count() == 0


def test_suffix_dedup_of_a_hot_core(spark, monkeypatch):
    """One footer in many documents with different text around it, edited and cut ones too: no task gets all its classes."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    own = lambda n: " ".join(word() for _ in range(n))
    footer, head = own(30), [own(8), own(9)]
    texts = [own(12) + r.choice(head)[r.randint(0, 30):] + footer[:r.choice([60, 120, 179])] + own(12) for _ in range(80)]
    texts += [own(6) + footer[r.randint(0, 60):] + own(2) for _ in range(40)] + texts[:3]
    given, contexts = [], suffix_dedup._contexts
    monkeypatch.setattr(suffix_dedup, "HOT_CLASSES", 6, raising=False)
    monkeypatch.setattr(suffix_dedup, "_contexts", lambda docs, classes, *a: given.append(classes) or contexts(docs, classes, *a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffix_dedup.remove(docs, length=60, core=20)
    assert rows(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(removed(texts, 60), key=repr)
    classes = given[0].join(docs.select(F.col("doc_id"), "text").withColumn("row", F.monotonically_increasing_id()), "row")
    cores = classes.select(F.expr("substring(text, lo + off + 1, 20)").alias("core")).groupBy("core").count()
    assert all(c["count"] <= 6 for c in cores.collect())
    merged = [(b"", k, b"", i, 0, 0) for i, k in enumerate([0, 25, 3, 30, 30, 2])]
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 2)
    assert [[m[3] for m in x] for x in suffix_dedup._batches(iter(merged), 20)] == [[0, 1], [2, 3, 4], [5]]


def test_loser_tree():
    r = random.Random(3)
    entries = [(bytes(r.choices(b"ab", k=r.randint(0, 12))), b"", k, 0, 0) for k in range(500)]
    runs = [sorted(entries[k::7]) for k in range(7)]
    merged = list(suffix_dedup.LoserTree([suffix_dedup.unfolded(suffix_dedup.front_code(x)) for x in runs]))
    assert [m[0] for m in merged] == sorted(e[0] for e in entries)
    assert [m[1] for m in merged[1:]] == [suffix_dedup.common_prefix(a[0], b[0], 0) for a, b in zip(merged, merged[1:])]


def test_passages(spark, none):
    """Runs of repeated strings shorter than those removed, by their whole words; the rest of the result stays."""
    shared = [prose(40, 150 + k) for k in range(4)]
    r = random.Random(12)
    texts = [prose(r.randint(0, 60), 160 + k) + r.choice([" ", ""]) + r.choice(shared)[r.randint(0, 200):] + prose(r.randint(0, 40), 190 + k) for k in range(40)]
    texts += [texts[3], None, "", "ab " * 70]
    docs = common.texts(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    found = {x["doc_id"]: x for x in suffix_dedup.remove(docs, 400, 100, passage=(60, 20, 9)).collect()}
    assert [tuple(found[k])[1:4] + (found[k]["kept_sha256"],) for k in range(len(texts))] == removed(texts, 400)
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for x in raw:
        for i in range(len(x) - 59):
            seen[x[i:i + 60]] = seen.get(x[i:i + 60], 0) + 1
    for k, x in enumerate(raw):
        covered = [False] * len(x)
        for i in range(len(x) - 59):
            if seen[x[i:i + 60]] > 1:
                covered[i:i + 60] = [True] * 60
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", x)]
        runs, i = [], 0
        while i < len(x):
            j = i
            while j < len(x) and covered[j]:
                j += 1
            if j > i:
                runs.append((i, j))
            i = j + 1
        assert found[k]["n_passages"] == sum(sum(a <= s and e <= b for s, e in words) > 9 for a, b in runs), k
    assert suffix_dedup.remove(common.texts(none), passage=(240, 60, 50)).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "n_passages", "kept_sha256"]


def test_many_declared_languages(spark, monkeypatch):
    """More declarations than the model takes: the most frequent are languages, the others one value of evidence."""
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = [(k, prose(60, k), "en", "a") for k in range(20)] + [(100 + k, "ñandú çaðö " * (3 + k), "xx", "b") for k in range(10)]
    rows += [(200 + k, prose(60, 300 + k), f"junk{k}", "a") for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r["lang"] for r in langid.identify(langid.of_documents(df)).collect()}
    assert {found[k] for k in range(20)} == {"en"} == {found[200 + k] for k in range(8)} and {found[100 + k] for k in range(10)} == {"xx"}


def test_first_by_hash(spark):
    df = spark.range(50_000).selectExpr("id", "concat('t', id) AS text")
    h = F.xxhash64("id", "text")
    assert [r[0] for r in common.first_by(df, h, 40).collect()] == [r[0] for r in df.orderBy(h).limit(40).collect()]
    assert common.first_by(df.where("id < 7"), h, 40).count() == 7 and common.first_by(df.where("false"), h, 40).count() == 0


def test_lm_score_by_hand(spark, monkeypatch):
    """With a given model: every token's class, the exact normaliser and its share in its class, token by token."""
    r = random.Random(9)
    words = ["red", "fox", "blue", "sky", "ran", "run", "é", "ñu", "café", "x"]
    texts = [(k, " ".join(r.choice(words) for _ in range(r.randint(0, 9)))) for k in range(120)] + [(500, "never seen words here")]
    given = []

    def fixed(docs, number, own, share):
        m = neural_lm.Model.start(share, neural_lm.DIM)
        m.C[:] = np.random.default_rng(3).normal(0, 1, m.C.shape)
        given.append((m, dict(number.value), number.value.kinds, own, share))
        return m
    monkeypatch.setattr(neural_lm, "train", fixed)
    found = {x["doc_id"]: x["score"] for x in neural_lm.score(common.texts(spark.createDataFrame(texts, "doc_id long, text string")), classes=9).collect()}
    m, number, kinds, own, share = given[0]
    learned = Counter(w for k, t in texts if zlib.crc32(str(k).encode()) % 5 != 1 for w in [*t.split(), ""])
    assert len(share) == 9 and kinds == 4 and abs(share.sum() - 1) < 1e-12

    def cls(w):
        return 0 if w == "" else int(own[number[w.encode()]]) if w.encode() in number else neural_lm.ending(w.encode(), kinds)
    members = {}
    for w in learned:
        members.setdefault(cls(w), []).append(w)
    for k, t in texts:
        two = one = 0
        want = 0.0
        for w in [*t.split(), ""]:
            logits = (m.R[two] * m.C[0] + m.R[one] * m.C[1]) @ m.Q.T + m.b
            want += (logits[cls(w)] - np.logaddexp.reduce(logits)) / math.log(10)
            if 1 <= cls(w) <= kinds:
                of = members.get(cls(w), [])
                want += math.log10((learned[w] + .5) / (sum(learned[x] for x in of) + .5 * (len(of) + 1)))
            two, one = one, cls(w)
        assert abs(found[k] - want) < 1e-4, (k, t)


def test_lm_grows_with_its_corpus():
    assert [neural_lm.n_classes(n) for n in (10, 300_000, 2_000_000, 10**9)] == [512, 535, 1007, 7999]
