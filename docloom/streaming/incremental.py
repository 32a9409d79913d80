"""Extension, not a parity item: the chunk index kept up to date from a folder of documents by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.functions import text as T
from docloom.operators.chunk import chunk_documents


def chunk_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, schema: str, key: str, text: str, **options) -> StreamingQuery:
    """New Parquet files in ``folder`` are chunked once; a micro-batch replaces its own partition, so a repeated one is harmless."""

    def each(batch: DataFrame, number: int) -> None:
        docs = batch.select(key, T.split_lines(text).alias("lines"))
        chunks = chunk_documents(docs, key, "lines", **options)
        chunks.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return spark.readStream.schema(schema).parquet(folder).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def windowed_counts(events: DataFrame, at: str, key: str, size: str, late: str) -> DataFrame:
    """Counts and sums by tumbling window and key; rows later than ``late`` are left out by the watermark."""
    return events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")
