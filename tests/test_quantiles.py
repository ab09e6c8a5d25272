import random

import numpy as np
import pytest

from riskframe.operators import quantiles as Q


@pytest.mark.parametrize("method", ["auto", "distributed"])
def test_exact_linear_quantiles(spark, method):
    rnd = random.Random(7)
    vals = [round(rnd.random() * 100, 3) for _ in range(1500)] + [5.0] * 50      # ties
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, g int")
    got = {r["prob"]: r["value"] for r in Q.quantiles(df, ["x"], [0.0, 0.1, 0.5, 0.975, 1.0], method=method).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(vals, p), abs=1e-9)
    by = {r["g"]: r["value"] for r in Q.quantiles(df, ["x"], [0.25], by=["g"], method=method).collect()}
    for g, v in by.items():
        assert v == pytest.approx(np.quantile([x for i, x in enumerate(vals) if i % 3 == g], 0.25), abs=1e-9)


def test_smallest_mode(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,), (None,)], "x long")
    r = Q.modes(df, ["x"]).first()
    assert (r["mode"], r["mode_count"]) == (1.0, 2)


def test_distributed_quantiles_spread_a_large_histogram(spark, monkeypatch):
    """A histogram of many distinct values is spread over the ranges, without and with a group column."""
    from riskframe.operators import ordered
    monkeypatch.setattr(ordered, "MIN_HOT_ROWS", 100)
    vals = [float((i * 7919) % 5003) for i in range(5003)]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, g int")
    hist = Q.value_histogram(df, ["x"])
    ranged, split = ordered._bucketed(hist, ["column"], ["v"])
    sizes = [r["count"] for r in ranged.groupBy(ordered._SUB).count().collect()]
    assert split and len(sizes) >= 4 and max(sizes) < 5003 / 2
    got = {r["prob"]: r["value"] for r in Q.quantiles(df, ["x"], [0.25, 0.5, 0.999], method="distributed").collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(vals, p), abs=1e-9)
    by = {r["g"]: r["value"] for r in Q.quantiles(df, ["x"], [0.3], by=["g"], method="distributed").collect()}
    for g, v in by.items():
        assert v == pytest.approx(np.quantile(vals[g::2], 0.3), abs=1e-9)


def test_refined_positions(spark, monkeypatch):
    """With few rows counted on the driver: skewed, tied, infinite and missing values, and a coarse digest."""
    monkeypatch.setattr(Q, "FEW_ROWS", 5)
    monkeypatch.setattr(Q, "FEW_VALUES", 0)
    monkeypatch.setattr(Q, "DIGEST_ACCURACY", 30)
    rnd = random.Random(3)
    cols = {"skew": [rnd.random() ** 9 * 1e12 for _ in range(800)], "ties": [float(rnd.randint(0, 3)) for _ in range(800)],
            "one": [4.5] * 800, "few": [1.0, None, 7.5] + [None] * 797, "none": [None] * 800,
            "ends": [float("inf") if i < 9 else float("-inf") if i < 20 else float(i) for i in range(800)],
            "nan": [float("nan") if i % 4 == 0 else float(i) for i in range(800)]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    probs = [0.0, 0.013, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in Q.quantiles(df, list(cols), probs).collect()}
    for c, vals in cols.items():
        held = sorted((v for v in vals if v is not None), key=lambda v: (v != v, v))
        assert {p for k, p in got if k == c} == (set(probs) if held else set())
        for p in probs if held else ():
            h = (len(held) - 1) * p
            lo, hi = held[int(h)], held[-int(-h // 1)]
            want = lo if lo == hi else lo + (h - int(h)) * (hi - lo)
            assert got[c, p] == pytest.approx(want, rel=1e-12, abs=1e-9, nan_ok=True), (c, p)
    assert Q.quantiles(df, [], probs).count() == 0


def test_no_task_holds_a_column(spark, monkeypatch):
    """Rounds of digests and counts: what comes back to the driver stays small however many values there are."""
    monkeypatch.setattr(Q, "FEW_ROWS", 100)
    df = spark.range(200_000).selectExpr("cast(hash(id) as double) as x")
    hists = []
    real = Q._refined

    def watched(frame, cols, probs):
        out = real(frame, cols, probs)
        hists.append(len(out))
        return out
    monkeypatch.setattr(Q, "_refined", watched)
    got = {r["prob"]: r["value"] for r in Q.quantiles(df, ["x"], [0.1, 0.5]).collect()}
    vals = np.sort(np.array([r[0] for r in df.collect()]))
    assert hists == [2] and all(got[p] == pytest.approx(np.quantile(vals, p), abs=1e-6) for p in got)
