"""Operator 5: secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text. The ledger keeps, for each blob and rule version
scanned so far, the spans found. A run scans one copy of each blob, and of the rules only those whose version the ledger
doesn't hold for it; the findings of all blobs, old and new, are joined back to all paths.

Spans count code points, the end is exclusive. Defined results: a null text is the empty text; rows with equal keys are
versions of their own and each get their findings; rows with null keys too; an empty table gives an empty result and
leaves the ledger as it is. Columns other than the keys and text are not read, so extra columns can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LEDGER = "blob string, rule string, version int, spans array<struct<start: int, place: int, kind: string, end: int>>"
_SPANS = "array<struct<start: int, place: int, kind: string, end: int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters or more."""
    name: str
    pattern: str
    group: int
    least: int
    version: int = 1


#: The base kinds, in the order in which spans that start together are listed.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),       # a run of fewer has no shorter match that counts
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]


def spans(text: str, rule: Rule, place: int) -> Column:
    """The rule's spans in a text column: lengths of matches and of what lies between them, added up."""
    col, pattern = F.col(text), F.lit(rule.pattern)
    found = F.zip_with(F.regexp_extract_all(col, pattern, F.lit(0)), F.regexp_extract_all(col, pattern, F.lit(rule.group)),
                       lambda m, g: F.struct(F.char_length(m).alias("n"), F.char_length(g).alias("g")))
    steps = F.zip_with(F.split(col, rule.pattern, -1), found, lambda gap, m: F.struct(F.char_length(gap).alias("gap"), m["n"].alias("n"), m["g"].alias("g")))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        one = F.array(F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(rule.name).alias("kind"), (start + x["n"]).alias("end")))
        return F.struct((start + F.coalesce(x["n"], F.lit(0))).alias("at"),
                        F.when(x["g"] >= rule.least, F.concat(s["out"], one)).otherwise(s["out"]).alias("out"))
    none = F.array().cast(_SPANS)
    every = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    return F.when(col.rlike(rule.pattern), every).otherwise(none)


def _ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def scan(versions: DataFrame, ledger: str, keys: list[str], text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(keys, blob, spans) of every row; new blobs and rule versions are scanned and added to the ledger at ``ledger``.

    The ledger is appended to in one committed write; what a broken run has left out, the next run scans.
    """
    spark = versions.sparkSession
    rows = versions.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    names = [f"k{i}" for i in range(len(keys))]
    asked = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
    one_path = rows.groupBy("blob").agg(F.min(F.struct(*names)).alias("one"))
    done = _ledger(spark, ledger).select("blob", "rule", "version")
    todo = (one_path.select("blob", "one", asked.alias("r")).select("blob", "one", "r.rule", "r.version")
            .join(done, ["blob", "rule", "version"], "left_anti").groupBy("blob").agg(F.min("one").alias("one"), F.collect_set("rule").alias("todo")))
    # the one copy to scan is found by its keys, which deal hot blobs out; an equal row scanned again changes nothing
    same = [F.col("one")[n].eqNullSafe(F.col(n)) for n in names]
    text_of = rows.join(todo.withColumnRenamed("blob", "b"), [F.col("b") == F.col("blob"), *same]).select("blob", "todo", "text")
    every = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                               F.when(F.array_contains("todo", r.name), spans("text", r, i)).alias("spans")) for i, r in enumerate(rules)])
    (text_of.select("blob", F.explode(F.filter(every, lambda x: x["spans"].isNotNull())).alias("r"))
     .select("blob", "r.rule", "r.version", "r.spans").write.mode("append").parquet(ledger))

    current = F.concat_ws("@", "rule", "version").isin([f"{r.name}@{r.version}" for r in rules])
    found = (_ledger(spark, ledger).where(current & (F.size("spans") > 0)).dropDuplicates(["blob", "rule", "version"])
             .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
    return (rows.drop("text").join(found, "blob", "left")
            .select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")))
