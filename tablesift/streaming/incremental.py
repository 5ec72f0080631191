"""Tables that arrive as files in a drop folder, gated batch by batch with the results of one batch over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def gate_drops(spark: SparkSession, folder: str, schema: str, gate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, trigger_once: bool = True) -> StreamingQuery:
    """Reads parquet drops, applies `gate` to each micro-batch and writes its rows below out, a folder for each batch.

    A table must arrive in one drop; its rows are then judged together. A batch that is run again after a failure
    overwrites its own folder, so each drop counts once.
    """
    drops = spark.readStream.schema(schema).parquet(folder)

    def write(batch: DataFrame, epoch: int) -> None:
        gate(batch).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    writer = drops.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="10 seconds")).start()


def gated(spark: SparkSession, out: str) -> DataFrame:
    """What all batches have written, one row for each table: the latest batch counts."""
    rows = spark.read.parquet(out)
    return rows.groupBy("table_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("table_id", "batch")]), "batch").alias("r")).select("table_id", "r.*")
