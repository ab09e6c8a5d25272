"""Scoring arriving rows with a fitted pipeline (L6 on a stream) and rule checks per micro-batch.

The reference scores new rows in batch; the same fitted ``PipelineModel``
transforms a streaming DataFrame unchanged. ``score_stream`` reads new parquet
files from a directory, scores them and appends to a parquet sink; each
micro-batch also appends its rule counts (B-rules) to a second table through
``foreachBatch``. ``availableNow`` processes everything present and stops, so
the same job serves as an incremental batch scorer. Checkpoints live under
the shared checkpoint folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def score_stream(spark: SparkSession, model, source_dir: str, schema, sink_dir: str, checkpoint_dir: str,
                 keep: Sequence[str], threshold: float = 0.5, rules_dir: str | None = None,
                 rule_columns: Sequence[str] = (), max_files_per_trigger: int = 100):
    """Start (and, with availableNow, finish) the scoring stream; returns the StreamingQuery."""
    from pyspark.ml.functions import vector_to_array
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    t = model.transform(src)
    s = vector_to_array(F.col("probability")).getItem(1)
    out = t.select(*[F.col(f"`{k}`") for k in keep], s.alias("score"), (s >= threshold).cast("int").alias("pred"))

    def sink(batch: DataFrame, epoch: int) -> None:
        # one folder per epoch written with overwrite: a replayed epoch replaces its own output (idempotent)
        batch.persist()
        batch.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch}")
        if rules_dir:
            aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("pred") == 1).alias("predicted_positive")]
            aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in rule_columns]
            batch.agg(*aggs).write.mode("overwrite").parquet(f"{rules_dir}/epoch={epoch}")
        batch.unpersist()

    return (out.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())
