"""Incremental ingestion of landed files with Structured Streaming.

Each micro-batch writes its own folder named by batch id and overwrites it on
a retry, so a restarted query never double-counts. Readers combine the folders
with the batch operators, which merge partial results exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leasegrid.functions.dates import quarter_last_month
from leasegrid.operators.ordering import top_per_key


def landed_files(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "csv", pattern: str | None = None, files_per_batch: int | None = None, **options) -> DataFrame:
    """Streaming scan of a landing folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        options = {"header": True, **options}
    if pattern:
        options["pathGlobFilter"] = pattern
    if files_per_batch:
        options["maxFilesPerTrigger"] = files_per_batch
    return reader.options(**options).load(folder)


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Process everything landed so far, then stop; the checkpoint is the resume point."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _batch_sink(path: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def ingest(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append newly landed rows to ``path`` and return the table so far."""
    run_available(stream, checkpoint, _batch_sink(path, lambda b: b))
    return stream.sparkSession.read.parquet(path).drop("batch")


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """Suppress repeats of ``keys`` that arrive within the watermark delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_per_key(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep-latest across batches: each batch stores its winners, the reader picks among them."""
    run_available(stream, checkpoint, _batch_sink(path, lambda b: top_per_key(b, keys, order)))
    return top_per_key(stream.sparkSession.read.parquet(path).drop("batch"), keys, order)


def quarterly_means(stream: DataFrame, path: str, checkpoint: str, event_time: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Quarterly mean per group from per-batch sums and counts."""

    def shape(batch: DataFrame) -> DataFrame:
        t = F.col(event_time)
        return batch.groupBy(*by, F.year(t).alias("year"), F.quarter(t).alias("quarter")).agg(
            F.sum(value).alias("total"), F.count(value).alias("n")
        )

    run_available(stream, checkpoint, _batch_sink(path, shape))
    parts = stream.sparkSession.read.parquet(path)
    out = parts.groupBy(*by, "year", "quarter").agg((F.sum("total") / F.sum("n")).alias(value), F.sum("n").alias("n"))
    return out.withColumn("date", quarter_last_month(F.col("year"), F.col("quarter")))
