"""Queries of the training-data operators over the driver's tables, by name, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, common, decontaminate, langid, neural_lm, phrases, quality, ranked_search, secrets, simhash, suffix_dedup, token_count, token_index, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BYTE_BPE = "byte_bpe_50k.json"


def query(f):
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.texts(common.table(spark, sf_dir, "documents"))


@query
def op1_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_index.write(documents(spark, sf_dir), common.shared_dir(spark, "token-index"),
                                 public_tokenizers.path(BYTE_BPE), end_id=0)
    return token_index.documents(spark, manifest)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    done = bpe.encode(documents(spark, sf_dir), path, decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).drop("rejected_by")


#: Words and lines by pattern and split, windows by position; the cascade's rules as one condition.
ORACLES["op7_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
p AS (SELECT rid, generate_subscripts(ws, 1) AS i, unnest(ws) AS a, ws FROM w),
g AS (SELECT rid, i, a, ws[i + 1] AS b, ws[i + 2] AS c FROM p WHERE i + 2 <= len(ws)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
top AS (SELECT rid, max(n) AS most FROM (SELECT rid, a, count(*) AS n FROM p GROUP BY rid, a) GROUP BY rid),
s AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, len([x FOR x IN ws IF regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) AS lettered, coalesce(top.most, 0) AS most
      FROM w LEFT JOIN cov USING (rid) LEFT JOIN top USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 5 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > 1 + n_lines OR 5 * lettered < 3 * n_words OR 3 * most > n_words) AS kept FROM b
"""


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(common.table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long")),
                         common.shared_dir(spark, "secret-ledger"), keys=["doc_id"])
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *[F.size(F.filter(F.col("spans.kind"), F.lit(r.name).eqNullSafe)).cast("long").alias(f"n_{r.name}") for r in secrets.RULES],
                        F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


#: Positions as the lengths of all matches and gaps before; the patterns in RE2's syntax.
_KIND = r"""SELECT rid, '{kind}' AS kind, {place} AS place, s, s + len(m[i]) AS e, len(g[i]) AS gl FROM (
  SELECT rid, i, m, g, list_sum([len(x) FOR x IN p[1:i]]) + coalesce(list_sum([len(x) FOR x IN m[1:i - 1]]), 0) AS s FROM (
    SELECT rid, unnest(range(1, len(m) + 1)) AS i, m, g, p FROM (
      SELECT rid, regexp_extract_all(text, '{re}') AS m, regexp_extract_all(text, '{re}', {group}) AS g, regexp_split_to_array(text, '{re}') AS p
      FROM d WHERE regexp_matches(text, '{re}')))) WHERE len(g[i]) >= {least}"""
ORACLES["op5_secret_scan"] = ("WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),\nf AS ("
                              + " UNION ALL ".join(_KIND.format(kind=r.name, place=i, re=r.pattern.replace("'", "''"), group=r.group, least=r.least)
                                                   for i, r in enumerate(secrets.RULES)) + """),
a AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, place) AS spans FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)""")


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(common.table(spark, sf_dir, "pages"), common.shared_dir(spark, "warc"), least=100)
    found = warc.resolved(common.saved(warc.captures(warc.read(files)), "captures"))
    digest = F.coalesce("original.payload_digest", "response.payload_digest")
    return found.select(F.col("metadata.fields")["page-id"].try_cast("long").alias("page_id"),
                        F.coalesce("original.payload_bytes", "response.payload_bytes").alias("payload_bytes"),
                        digest.alias("payload_digest"), F.col("response.type").alias("record_type"),
                        F.col("original.page_id").try_cast("long").alias("refers_to"))


ORACLES["op2_warc"] = """
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT rid, page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, rid) AS k,
             first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, rid) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN first_id END AS refers_to FROM r
"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(langid.of_documents(common.table(spark, sf_dir, "documents")))


@query
def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(langid.of_pages(common.table(spark, sf_dir, "pages"))).withColumnRenamed("doc_id", "page_id")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neural_lm.score(documents(spark, sf_dir))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(documents(spark, sf_dir), length=400, passage=(240, 60, 50))


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"), k=10)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLES["op12_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents),
t AS (SELECT count(*) FILTER (len(ws) > 0) AS N, coalesce(sum(len(ws)), 0)::BIGINT AS L FROM d),
i AS (SELECT DISTINCT iid, item_id, unnest(ws) AS w FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS ws FROM benchmark)),
p AS (SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM i) GROUP BY rid, w),
wt AS (SELECT w, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM (SELECT w, count(*) AS df FROM p GROUP BY w), t),
x AS (SELECT p.rid, p.w, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ws) * N) // L))) AS impact
      FROM p JOIN wt USING (w) JOIN d USING (rid), t),
s AS (SELECT iid, item_id, rid, sum(impact)::BIGINT AS score FROM i JOIN x USING (w) GROUP BY iid, item_id, rid),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
      FROM s JOIN d USING (rid) WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(common.table(spark, sf_dir, "documents"), least=100, limit=2000, share=100)


ORACLES["op13_phrases"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT cut.lang, cut.phrase, a, x.n AS l, y.n AS r, t.n, cut, ((1000::HUGEINT * a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:cut], ' ')
               JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') JOIN t ON t.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS around
           FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
      FROM b LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a)
SELECT * FROM o WHERE rank <= 2000
"""
