import pytest
from pyspark.sql import functions as F

from riskframe.functions.codes import categorize_code
from riskframe.operators import clean, lookup, profile


def test_target_trim_and_null(spark):
    df = spark.createDataFrame([(" <30 ",), ("<30",), (">30",), ("NO",), (None,)], "r string")
    got = [r[0] for r in clean.derive_target(df, "r").select("target").collect()]
    assert got == [1, 1, 0, 0, 0]
    untrimmed = [r[0] for r in clean.derive_target(df, "r", trim=False).select("target").collect()]
    assert untrimmed == [0, 1, 0, 0, 0]


def test_exclusion_keeps_null_codes(spark):
    df = spark.createDataFrame([(11,), (3,), (1,), (None,)], "d int")
    kept = clean.exclude_codes(df, "d", {"expired": [11], "transfer": [3]})
    assert sorted([r[0] for r in kept.collect()], key=lambda x: (x is None, x)) == [1, None]
    c = clean.exclusion_counts(df, "d", {"expired": [11], "transfer": [3]}).first()
    assert (c["rows_before"], c["removed_expired"], c["removed_transfer"], c["rows_after"]) == (4, 1, 1, 2)


def test_sentinel_replacement_per_column(spark):
    df = spark.createDataFrame([("?", " ? ", "?", 1)], "a string, b string, c string, n int")
    r = clean.replace_sentinel(df, {"a": "missing"}).first()
    assert (r["a"], r["b"], r["c"], r["n"]) == ("missing", " ? ", "unknown", 1)


def test_group_top_n_null_to_others(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), ("y",), ("z",), (None,)], "c string")
    got = sorted(r[0] for r in clean.group_top_n(df, "c", 2).collect())
    assert got == ["Others", "Others", "x", "x", "y", "y"]


def test_full_row_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "a int, b string")
    assert clean.full_row_duplicates(df).first()[0] == 2


def test_negative_repair_median_of_nonnegatives(spark):
    df = spark.createDataFrame([(-1,), (1,), (2,), (4,), (7,)], "x long")
    got = sorted(r[0] for r in clean.repair_negatives(df, ["x"]).collect())
    assert got == [1.0, 2.0, 3.0, 4.0, 7.0]


@pytest.mark.parametrize("code,label", [
    (None, "Unknown"), ("unknown", "Unknown"), ("?", "Unknown"), ("V27", "V-Codes (Suplementar)"),
    ("E909", "E-Codes (Externa)"), ("250.83", "Endócrinas/Metabólicas"), ("0", "Outros"), ("1000", "Outros"),
    ("abc", "Unknown"), (" 428 ", "Circulatórias"), (".5", "Unknown"), ("139.9", "Infecciosas/Parasitárias"),
    ("999", "Lesões/Envenenamentos")])
def test_code_categories(spark, code, label):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(categorize_code(F.col("c"))).first()[0] == label


def test_lookup_unknown_for_missing_and_null_description(spark):
    dim = spark.createDataFrame([("m", 1, "one"), ("m", 2, None)], "mapping string, id int, description string")
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "m_id int")
    got = sorted((r[0] if r[0] is not None else -1, r[1]) for r in lookup.apply_lookup(df, "m_id", dim, "m").collect())
    assert got == [(-1, "Unknown"), (1, "one"), (2, "Unknown"), (3, "Unknown")]
    hits = lookup.lookup_hit_counts(df, "m_id", dim, "m").first()
    assert (hits["rows"], hits["mapped"]) == (4, 2)
    cov = lookup.coverage(df, "m_id", dim, "m").first()
    assert (cov["distinct_ids"], cov["matched"], cov["coverage"]) == (3, 2, pytest.approx(2 / 3, abs=1e-6))


def test_profile_empty_table(spark):
    df = spark.createDataFrame([], "a string, b long")
    p = {r["column"]: r for r in profile.missing_profile(df).collect()}
    assert p["a"]["total"] == 0 and p["a"]["missing_pct"] is None


def test_iqr_linear_quartiles(spark):
    import numpy as np
    vals = [1, 2, 2, 3, 4, 7, 9, 30, -5]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    r = profile.iqr_outliers(df, ["x"]).first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (r["q1"], r["q3"]) == (pytest.approx(q1), pytest.approx(q3))
    assert r["outliers"] == sum(1 for v in vals if v < lo or v > hi)


def test_configured_pipeline_order_and_switches(spark):
    rows = [(1, 100, "<30", 11, "?", 3, 5), (2, 100, "NO", 1, "a", -1, 2), (3, 100, ">30", 2, "b", 4, 1),
            (4, 200, "<30", 2, "?", 2, 2), (5, 200, "NO", None, "c", 6, 3)]
    df = spark.createDataFrame(rows, "enc long, ent long, label string, code int, cat string, lab long, med long")
    dim = spark.createDataFrame([("code", 1, "one"), ("code", 2, None)], "mapping string, id int, description string")
    out = clean.clean_pipeline(df, entity="ent", order="enc", label_source="label", code_column="code",
                               code_lists={"expired": [11]}, sentinel_labels={"cat": "missing"},
                               negative_columns=["lab"], lookups={"code": (dim, "code")})
    got = {r["ent"]: (r["enc"], r["target"], r["cat"], r["lab"], r["code_desc"], r["num_previous_admissions"])
           for r in out.collect()}
    # entity 100 loses encounter 1 (expired code), keeps encounter 2 (first remaining); lab -1 -> median of {4, 2, 6}
    assert got == {100: (2, 0, "a", 4.0, "one", 0), 200: (4, 1, "missing", 2.0, "Unknown", 0)}
    no_dedupe = clean.clean_pipeline(df, entity="ent", order="enc", label_source="label", code_column="code",
                                     code_lists={"expired": [11]}, steps=("target", "exclude"))
    assert no_dedupe.count() == 4 and "num_previous_admissions" not in no_dedupe.columns
