"""Benchmark: the headline stages at one scale factor; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Stages (seconds, wall clock, each ending in an action):
  clean      scan + encounter view + cleaning slice, written once as a table
  profile    fused missing-value profile (B6) + IQR outliers (B14) over the encounters
  rate       flagship: return rate per looked-up disposition among first visits (A1/J1)
  metrics    exact ROC AUC, average precision, best-F1 threshold and the 80-point threshold sweep
  lr_fit     feature pipeline + split/folds + one weighted logistic regression fit
  rf_fit     one forest fit (100 trees, depth 10, leaf 4, log2 -- the reference's best candidate)
  cv5        5-fold cross-validation of the logistic model (one fit per fold, all metrics)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from riskframe.session import build_session
    spark = build_session(f"local[{cpus}]", app="riskframe-bench", shuffle_partitions=max(8, 2 * cpus))
    # JVM / parquet-reader warm-up on the smallest table, not timed
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_regionkey").count().collect()

    from pyspark.sql import functions as F

    from riskframe.operators import explore, features, metrics, models, profile, validate
    from riskframe.plans import q_models
    from riskframe.plans.base import clean_enc, encounters, scored
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    timed("clean", lambda: clean_enc(spark, sf_dir).count())
    timed("profile", lambda: (profile.missing_profile(encounters(spark, sf_dir)).collect(),
                              profile.iqr_outliers(encounters(spark, sf_dir),
                                                   ["time_in_hospital", "num_lab", "num_med", "num_proc"]).collect()))
    timed("rate", lambda: explore.rate_by(clean_enc(spark, sf_dir), "disposition_desc").collect())

    def metric_stage():
        s = scored(spark, sf_dir)
        metrics.rank_summary(s, "label", "score").collect()        # AUC, AP and best-F1 threshold, one curve
        metrics.threshold_sweep(s, "label", "score").collect()
    timed("metrics", metric_stage)

    holder = {}

    def lr_stage():
        tr, te, _ = q_models._train_test(spark, sf_dir)
        holder.update(tr=tr, te=te)
        m = q_models._lr().fit(tr)
        models.predict(m, te, keep=["target"]).agg(F.avg("score")).collect()
    timed("lr_fit", lr_stage)

    def rf_stage():
        m = models.forest(numTrees=100, maxDepth=10, min_samples_split=15, min_samples_leaf=4,
                          featureSubsetStrategy="log2").fit(holder["tr"])
        models.predict(m, holder["te"], keep=["target"]).agg(F.avg("score")).collect()
    timed("rf_fit", rf_stage)
    timed("cv5", lambda: validate.summarize_cv(
        validate.cross_validate(features.stratified_folds(holder["tr"], "target", "encounter_id", 5), q_models._lr, 5)).collect())

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
