"""Incremental forms of the hit counts and of the sequence cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_organism_counts(
    hits: DataFrame, ts: str = "ts", window: str = "1 hour", late: str = "1 hour"
) -> DataFrame:
    """Hits per organism and time window of an append-only feed.

    Rows later than the watermark are dropped, and with them the old state.
    """
    organism = F.coalesce("organism", F.lit("Unknown"))
    return (
        hits.withWatermark(ts, late)
        .groupBy(F.window(ts, window).alias("w"), organism.alias("organism"))
        .agg(F.count(F.lit(1)).alias("hits"))
        .select(F.col("w.start").alias("window_start"), "organism", "hits")
    )


def stream_dedup_sequences(seqs: DataFrame, ts: str = "ts", expiry: str = "30 days") -> DataFrame:
    """First arrival of each sequence; a key is forgotten after ``expiry``."""
    return (
        seqs.withColumn("seq_md5", F.md5("seq"))
        .withWatermark(ts, expiry)
        .dropDuplicatesWithinWatermark(["seq_md5"])
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived and stop; results go to Parquet files.

    ``mode="update"`` writes each batch's changed rows with its number, so the
    newest row of a key is the one with the highest ``batch``.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", path).start()
    else:
        def write(batch: DataFrame, number: int) -> None:
            # A batch run again after a failure replaces its own folder.
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

        query = writer.outputMode("update").foreachBatch(write).start()
    query.awaitTermination()
