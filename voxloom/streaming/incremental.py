"""Incremental runs: files and rows that have not been processed yet, by way of
Structured Streaming's checkpoint in place of hand-kept progress files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.sources.readers import name_of


def new_texts(spark: SparkSession, path: str, glob: str = "*_transcript.txt", files_per_batch: int = 10_000) -> DataFrame:
    """A stream of (path, name, text), a row for each new file."""
    files = (spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch)
             .text(path, wholetext=True))
    at = F.col("_metadata.file_path")
    return files.select(at.alias("path"), name_of(at).alias("name"), F.translate("value", "�", "").alias("text"))


def new_rows(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """A stream of the Parquet rows below path, with the schema they have now."""
    return spark.readStream.schema(spark.read.option("pathGlobFilter", glob).parquet(path).schema).option("pathGlobFilter", glob).parquet(path)


def window_counts(events: DataFrame, length: str = "1 hour", late: str = "2 hours", time_col: str = "ts", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """(window_start, keys, n, total): rows and value sums in tumbling windows.
    On a stream, rows later than the watermark are dropped; state is bounded
    by the windows within it."""
    events = events.withColumn(time_col, F.col(time_col).cast("timestamp"))
    by = [F.window(time_col, length).alias("w"), *map(F.col, keys)]
    counted = events.withWatermark(time_col, late).groupBy(*by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def run_new(stream: DataFrame, out: str, checkpoint: str, plan: Callable[[DataFrame], DataFrame] = lambda df: df, timeout: int | None = None) -> None:
    """Apply plan to what has come since the last run with this checkpoint and
    append it to the Parquet table out, exactly once; then stop."""
    query = plan(stream).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    try:
        query.awaitTermination(timeout)
    finally:
        query.stop()


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Batch form: rows whose key isn't among done; null keys remain."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
