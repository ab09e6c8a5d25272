import pytest

from riskframe.operators import profile


@pytest.fixture()
def raw(spark):
    rows = [(1, 10, "?", "a", 1), (2, 10, "x", None, 0), (3, 11, " ? ", "b", 1), (3, 12, "y", "b", None),
            (5, 13, "NULL", "c", 0)]
    return spark.createDataFrame(rows, "id long, ent long, cat string, other string, target int")


def test_missing_profile_counts_nulls_and_sentinels(spark, raw):
    p = {r["column"]: r for r in profile.missing_profile(raw).collect()}
    assert (p["cat"]["null_count"], p["cat"]["sentinel_count"], p["cat"]["missing_pct"]) == (0, 1, 20.0)
    assert (p["other"]["null_count"], p["other"]["missing_pct"]) == (1, 20.0)
    assert p["id"]["dtype"] == "numeric" and p["id"]["sentinel_count"] == 0


def test_quality_score_uses_rounded_pcts_and_duplicates(spark, raw):
    q = profile.quality_score(raw, "id").first()
    pcts = [0.0, 0.0, 20.0, 20.0, 20.0]          # id, ent, cat, other, target
    assert q["mean_missing_pct"] == pytest.approx(sum(pcts) / 5)
    assert q["duplicate_pct"] == pytest.approx(20.0)
    assert q["quality_score"] == pytest.approx(100 - 12.0 - 20.0)


def test_table_rules(spark, raw):
    r = {x["rule"]: x for x in profile.table_rules(raw, "target", "id").collect()}
    assert r["min_rows"]["passed"] is False            # 5 rows < 100
    assert r["binary_target"]["value"] == 1.0          # the null target is not in {0, 1}
    assert r["unique_key"]["passed"] is False


def test_domain_violations_multi_column(spark, raw):
    got = sorted((r["column"], r["value"], r["n"]) for r in
                 profile.domain_violations(raw, {"other": ["a", "b"], "target": [0, 1]}).collect())
    assert got == [("other", "c", 1)]


def test_special_tokens_and_patterns(spark, raw):
    toks = {(r["column"], r["token"]): r["n"] for r in profile.special_token_census(raw).collect()}
    assert toks[("cat", "?")] == 1 and toks[("cat", "NULL")] == 1 and ("cat", " ? ") not in toks
    pats = profile.missing_patterns(raw, ["other", "target"]).collect()
    assert pats[0]["n"] == 3 and (pats[0]["null_other"], pats[0]["null_target"]) == (0, 0)


def test_describe_sample_std(spark, raw):
    import numpy as np
    d = profile.describe(raw, ["ent"]).first()
    vals = [10, 10, 11, 12, 13]
    assert d["std"] == pytest.approx(np.std(vals, ddof=1)) and d["q50"] == pytest.approx(11.0)
