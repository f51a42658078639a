"""Dereplication of reads as they arrive: the batch operator's partial sums as a streaming aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def counts(reads: DataFrame) -> DataFrame:
    """sequence, sample_id, count, seq_id of a stream of reads; state is one row for each sequence and sample."""
    return reads.groupBy("sequence", "sample_id").agg(F.sum("size").cast("long").alias("count"), F.min("seq_id").alias("seq_id"))


def to_table(reads: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's sums beside the earlier ones, under its number: a batch that runs again replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        counts(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return reads.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table(spark, path: str) -> DataFrame:
    """The sums over all batches so far, as the batch operator gives them."""
    return spark.read.parquet(path).groupBy("sequence", "sample_id").agg(F.sum("count").alias("count"), F.min("seq_id").alias("seq_id"))


def windowed_totals(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """window_start, obs_id, count of a stream of (ts, obs_id); what comes later than the watermark is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "obs_id").agg(F.count("*").alias("count")).select(F.col("w.start").alias("window_start"), "obs_id", "count")
