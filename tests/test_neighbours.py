"""Exact nearest neighbours against all pairs, with cells split on both sides."""

import numpy as np
import pytest

from riskframe.operators import neighbours


def by_all_pairs(x, k):
    out = {}
    for i, a in x.items():
        d = sorted((sum((p - q) ** 2 for p, q in zip(a, b)), j) for j, b in x.items() if j != i)[:k]
        out[i] = d
    return out


@pytest.mark.parametrize(("pivots", "chunk", "visitors"), [(None, 2_000, 20_000), (9, 13, 17), (1, 2_000, 20_000)])
def test_equal_to_all_pairs(spark, monkeypatch, pivots, chunk, visitors):
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    monkeypatch.setattr(neighbours, "VISITORS", visitors)
    g = np.random.default_rng(4)
    n = 2_000 if pivots is None else 300
    dense = g.normal(size=(n // 2, 3)) * 0.01
    x = np.concatenate([dense, g.normal(size=(n - len(dense) - 10, 3)), np.full((10, 3), 5.0)])
    rows = {i: tuple(map(float, r)) for i, r in enumerate(x)}
    df = spark.createDataFrame([(i, list(r)) for i, r in rows.items()], "id long, v array<double>")
    got = {r["id"]: [(e["d"], e["k"]) for e in r["near"]] for r in neighbours.nearest(df, "id", "v", 5, pivots).collect()}
    want = by_all_pairs(rows, 5)
    assert set(got) == set(want)
    for i in want:
        assert [k for _, k in got[i]] == [k for _, k in want[i]] and np.allclose([d for d, _ in got[i]], [d for d, _ in want[i]])


def test_few_rows(spark):
    df = spark.createDataFrame([("a", [0.0]), ("b", [1.0]), ("c", [5.0])], "id string, v array<double>")
    got = {r["id"]: [e["k"] for e in r["near"]] for r in neighbours.nearest(df, "id", "v", 5).collect()}
    assert got == {"a": ["b", "c"], "b": ["a", "c"], "c": ["b", "a"]}
    assert [r["near"] for r in neighbours.nearest(df.limit(1), "id", "v", 5).collect()] == [[]]
    assert neighbours.nearest(df.where("false"), "id", "v", 5).count() == 0
