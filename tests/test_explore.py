import math

import numpy as np
import pytest

from riskframe.operators import explore


@pytest.fixture()
def small(spark):
    rows = [("a", "x", 1, 5.0), ("a", "y", 0, 7.0), ("a", "x", 1, 9.0), ("b", "x", 0, 1.0), ("b", "y", 0, 3.0),
            ("b", None, 1, 11.0), (None, "x", 1, 2.0), ("c", "y", 0, 4.0)]
    return spark.createDataFrame(rows, "g string, h string, target int, v double")


def test_rate_by_drops_null_keys_and_shares_all_rows(spark, small):
    got = {r["g"]: (r["n"], r["rate"], r["share"]) for r in explore.rate_by(small, "g").collect()}
    assert got == {"a": (3, pytest.approx(2 / 3, abs=1e-6), 3 / 8), "b": (3, pytest.approx(1 / 3, abs=1e-6), 3 / 8),
                   "c": (1, 0.0, 1 / 8)}
    assert None in {r["g"] for r in explore.rate_by(small, "g", dropna=False).collect()}


def test_crosstab_margins(spark, small):
    got = {(r["g"], r["h"]): r["n"] for r in explore.crosstab_margins(small, "g", "h").collect()}
    assert got[("All", "All")] == 6 and got[("a", "All")] == 3 and got[("All", "y")] == 3 and got[("a", "x")] == 2


def test_pivot_absent_cells_null(spark, small):
    got = {r["g"]: (r["x"], r["y"]) for r in explore.rate_pivot(small, "g", "h", ["x", "y"]).collect()}
    assert got["c"] == (None, 0.0) and got["a"] == (1.0, 0.0)


def test_t_test_matches_pooled_formula(spark, small):
    r = explore.t_test(small, ["v"]).first()
    a = [v for _, _, t, v in small.collect() if t == 0]
    b = [v for _, _, t, v in small.collect() if t == 1]
    sp2 = ((len(a) - 1) * np.var(a, ddof=1) + (len(b) - 1) * np.var(b, ddof=1)) / (len(a) + len(b) - 2)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(sp2 * (1 / len(a) + 1 / len(b)))
    assert r["t_stat"] == pytest.approx(t) and r["dof"] == 6 and 0 < r["p_value"] < 1


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10]], "x double")
    got = {r["bin"]: r["n"] for r in explore.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 4: 1}


def test_box_stats_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 100]
    df = spark.createDataFrame([(1, float(v)) for v in vals], "k int, x double")
    r = explore.box_stats(df, "x", "k").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r["q1"], r["q3"]) == (pytest.approx(q1), pytest.approx(q3))
    assert r["whisker_hi"] == 6.0 and r["whisker_lo"] == 1.0 and r["fliers"] == 1


def test_argmax_ties_smallest_key(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "k string, rate double")
    assert explore.argmax_group(df, "k").first()["k"] == "a"


def test_group_gap_requires_both_positive(spark):
    rows = [("s1", "F", 1), ("s1", "O", 0), ("s2", "F", 1), ("s2", "O", 1), ("s2", "O", 0)]
    df = spark.createDataFrame(rows, "s string, gender string, target int")
    got = {r["s"]: (r["gap"], r["higher"]) for r in explore.group_gap(df, "s", "gender", "F", "O").collect()}
    assert got == {"s2": (0.5, "F")}
