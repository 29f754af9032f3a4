"""Scores of responses as they arrive: each micro-batch is scored and upserted by (model, task, item), the last response counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanquarry.operators import scoring
from vanquarry.sources.files import RESPONSE


def responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RESPONSE).json(path)


def score_stream(stream: DataFrame, path: str, checkpoint: str):
    """A query that appends scores by batch; a batch that is run again overwrites its own directory, so scores count once."""

    def save(batch: DataFrame, batch_id: int) -> None:
        scoring.score(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last score of each item."""
    rows = spark.read.parquet(path)
    return rows.groupBy("model", "task_id", "uid").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("model", "task_id", "uid")]), "batch").alias("s")).select("model", "task_id", "uid", "s.*")
