import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riskframe.functions.stats import t_two_sided_p
from riskframe.operators import features as FE
from riskframe.sources import sections

LOOKUP_FIXTURE = """kind_a_id,description
1,Alpha
2, Beta with space
3,NULL
,
kind_b_id,description
10,"Quoted, with comma"
7,Seven
x9,bad id dropped

12,Twelve
"""


def test_section_reader(spark):
    d = tempfile.mkdtemp(prefix="rf-sec-")
    p = os.path.join(d, "lookup.csv")
    with open(p, "w") as fh:
        fh.write(LOOKUP_FIXTURE)
    got = sorted((r["mapping"], r["id"], r["description"]) for r in sections.read_sections(spark, p).collect())
    assert got == [("kind_a", 1, "Alpha"), ("kind_a", 2, "Beta with space"), ("kind_a", 3, None),
                   ("kind_b", 7, "Seven"), ("kind_b", 10, "Quoted, with comma"), ("kind_b", 12, "Twelve")]


def _labels(spark, n=203):
    return spark.createDataFrame([(i, 1 if i % 7 == 0 else 0) for i in range(n)], "key long, y int")


def test_split_disjoint_exhaustive_and_quota(spark):
    s = FE.stratified_split(_labels(spark), "y", "key").cache()
    assert s.count() == 203
    test = s.where("split = 'test'")
    by = {r["y"]: r["count"] for r in test.groupBy("y").count().collect()}
    import math
    n1 = len([i for i in range(203) if i % 7 == 0])
    assert by == {1: math.ceil(n1 * 0.2), 0: math.ceil((203 - n1) * 0.2)}
    assert s.groupBy("key").count().where("count > 1").count() == 0


def test_split_independent_of_partitioning(spark):
    a = FE.stratified_split(_labels(spark), "y", "key").where("split = 'test'").select("key")
    b = FE.stratified_split(_labels(spark).repartition(7), "y", "key").where("split = 'test'").select("key")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_folds_balanced(spark):
    f = FE.stratified_folds(_labels(spark), "y", "key", 5)
    sizes = [r["count"] for r in f.groupBy("y", "fold").count().collect()]
    per = {}
    for r in f.groupBy("y", "fold").count().collect():
        per.setdefault(r["y"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in per.values()) and sum(sizes) == 203


def test_one_hot_drop_first_null_zero_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "c string")
    enc = FE.one_hot(df, ["c"])
    assert enc.columns == ["c_b", "c_c"]
    rows = [tuple(r) for r in enc.collect()]
    assert rows == [(1, 0), (0, 0), (0, 0), (0, 1)]
    unseen = FE.one_hot(spark.createDataFrame([("z",)], "c string"), ["c"], levels={"c": ["a", "b", "c"]})
    assert tuple(unseen.first()) == (0, 0)


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([("train", 1.0, 5.0), ("train", 3.0, 5.0), ("test", 5.0, 5.0)],
                               "split string, x double, k double")
    out = {r["x"] if False else r["split"] + str(i): r for i, r in enumerate(FE.standard_scale(df, ["x", "k"]).collect())}
    vals = sorted(r["x"] for r in out.values())
    assert vals == [pytest.approx(-1.0), pytest.approx(1.0), pytest.approx(3.0)]
    assert all(r["k"] == 0.0 for r in out.values())


def test_t_p_value_reference_points():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.07338803, abs=1e-6)
    assert t_two_sided_p(0.0, 5) == pytest.approx(1.0)


def test_balanced_weights(spark):
    w = FE.balanced_weights(_labels(spark, 10), "y")
    got = {r["y"]: r["weight"] for r in w.select("y", "weight").distinct().collect()}
    n1 = 2
    assert got[1] == pytest.approx(10 / (2 * n1)) and got[0] == pytest.approx(10 / (2 * 8))


def test_section_writer_chunks_reparse(spark):
    from riskframe.session import scratch_path
    body = spark.createDataFrame([(s, i, f"{i},\"name {s}-{i}, x\"") for s in (0, 1) for i in range(1, 12)],
                                 "sec int, pos long, line string")
    heads = spark.createDataFrame([(0, "alpha_id,description"), (1, "beta_id,description")], "sec int, line string")
    path = scratch_path(spark, "sec-test")
    sections.write_sections(body, heads, path, chunk_rows=4)
    got = sorted((r["mapping"], r["id"], r["description"]) for r in sections.read_sections(spark, path).collect())
    exp = sorted((m, i, f"name {s}-{i}, x") for s, m in ((0, "alpha"), (1, "beta")) for i in range(1, 12))
    assert got == exp


def test_stream_scoring_idempotent_sink(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from riskframe.session import scratch_path
    from riskframe.streaming.scoring import score_stream
    df = spark.createDataFrame([(i, float(i % 7), 1 if i % 7 > 3 else 0) for i in range(60)], "k long, x double, y int")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(labelCol="y", maxIter=10)]).fit(df)
    src, sink, ck = (scratch_path(spark, n) for n in ("s-src", "s-sink", "s-ck"))
    df.repartition(3).write.parquet(src)
    score_stream(spark, model, src, df.schema, sink, ck, keep=["k"]).awaitTermination()
    score_stream(spark, model, src, df.schema, sink, ck, keep=["k"]).awaitTermination()   # restart: nothing new
    out = spark.read.parquet(sink)
    assert out.count() == 60 and out.select("k").distinct().count() == 60


def test_levels_of_several_columns_in_one_pass(spark):
    df = spark.createDataFrame([("b", "y"), ("a", None), (None, "x"), ("b", "z")], "c1 string, c2 string")
    assert FE.category_levels_many(df, ["c1", "c2"]) == {"c1": ["a", "b"], "c2": ["x", "y", "z"]}
    enc = FE.one_hot(df, ["c1", "c2"])
    assert enc.columns == ["c1_b", "c2_y", "c2_z"]
    with pytest.raises(ValueError):
        FE.category_levels_many(df, ["c1", "c2"], max_levels=2)


def test_vector_pipeline_drops_first_level_and_zeroes_null_and_unseen(spark):
    from pyspark.ml.functions import vector_to_array
    from riskframe.operators.models import feature_names
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("c", "x", None), (None, "x", 5.0)], "c string, one string, v double")
    fitted = FE.vector_pipeline(["c", "one"], ["v"]).fit(df)
    new = spark.createDataFrame([("a", "x", 3.0), ("c", "y", None), (None, None, 3.0), ("zz", "x", 3.0)], "c string, one string, v double")
    out = fitted.transform(new)
    rows = [[round(v, 9) for v in r[0]] for r in out.select(vector_to_array("features")).collect()]
    assert rows == [[0, 0, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]       # mean 3, one level: no slot
    assert feature_names(out) == ["v", "c_b", "c_c"]
    many = spark.range(1500).selectExpr("concat('l', id) AS c", "1.0D AS v")
    assert FE.vector_pipeline(["c"], ["v"]).fit(many).transform(many).first()["features"].size == 1500


def test_oversample_balances_between_minority_neighbours(spark):
    import random as _r
    rnd = _r.Random(3)
    rows = [(i, int(i % 7 == 0), rnd.random() * 10, rnd.random()) for i in range(210)]
    rows.append((500, 1, None, 0.5))
    df = spark.createDataFrame(rows, "k long, y int, a double, b double")
    out = FE.oversample(df, ["a", "b"], "y", "k").collect()
    made = [r for r in out if r["synthetic"]]
    n1 = sum(r[1] for r in rows)
    assert len(out) - len(made) == len(rows) and len(made) == len(rows) - 2 * n1 and all(r["y"] == 1 for r in made)
    real = [(r[2], r[3]) for r in rows if r[1]]
    mean = sum(a for a, _ in real if a is not None) / (n1 - 1)
    real = [(mean if a is None else a, b) for a, b in real]

    def on_a_segment(p):
        for (a1, b1) in real:
            for (a2, b2) in real:
                cross = (a2 - a1) * (p[1] - b1) - (b2 - b1) * (p[0] - a1)
                if abs(cross) < 1e-7 and min(a1, a2) - 1e-9 <= p[0] <= max(a1, a2) + 1e-9:
                    return True
    assert all(on_a_segment((r["a"], r["b"])) for r in made)
    assert sorted(map(str, FE.oversample(df, ["a", "b"], "y", "k").collect())) == sorted(map(str, out))
    one = spark.createDataFrame([(1, 1, 1.0), (2, 0, 2.0), (3, 0, 3.0)], "k long, y int, a double")
    assert FE.oversample(one, ["a"], "y", "k").count() == 3 and FE.oversample(one.limit(0), ["a"], "y", "k").count() == 0


def test_scalable_columns_and_distinct_counts(spark):
    from riskframe.operators.explore import distinct_counts
    df = spark.createDataFrame([(0.2, 1, None, "a"), (0.7, 1, None, None), (0.2, 2, None, "b"), (0.7, 3, None, "a")],
                               "two double, three int, none int, s string")
    assert FE.scalable_columns(df) == ["three"]
    assert {r["column"]: r["distinct"] for r in distinct_counts(df, df.columns).collect()} == {"two": 2, "three": 3, "none": 0, "s": 2}
