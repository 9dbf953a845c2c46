"""Arriving files processed by the batch operators, keyed counts kept up to date, and the windows of event streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, schema, files_per_batch: int = 64, fmt: str = "parquet") -> DataFrame:
    """A stream of the files of a folder, so many at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(folder)


def each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator to every micro-batch and appends the result; a batch that is run again replaces its own part."""

    def write(df: DataFrame, batch: int) -> None:
        transform(df).withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_parquet(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream to a table and stops when what has arrived is done."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def check_saving(streaming: bool, path: str | None) -> None:
    """A tokenized set can't be saved while it streams."""
    if streaming and path:
        raise ValueError("a streamed data set can't be saved")


def from_position(df: DataFrame, position: str, consumed: int) -> DataFrame:
    """What is left of an ordered data set after ``consumed`` rows."""
    return df.where(F.col(position) >= consumed)


def take_skip(df: DataFrame, ordinal: str, n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows by ordinal, for validation, and the rest."""
    return df.where(F.col(ordinal) < n), df.where(F.col(ordinal) >= n)


def window_totals(events: DataFrame, time: str, key: str, value: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Count and sum of each key and event-time window, for batch or stream; rows later than ``late`` are dropped in a stream."""
    source = events.withWatermark(time, late) if events.isStreaming else events
    span = F.window(time, width, slide) if slide else F.window(time, width)
    return source.groupBy(span.alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str) -> DataFrame:
    """(key, start, end, n): runs of events of a key with no pause of ``gap``."""
    source = events.withWatermark(time, late) if events.isStreaming else events
    return source.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
