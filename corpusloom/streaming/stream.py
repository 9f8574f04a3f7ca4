"""The stateless stages over a stream, exact deduplication within a watermark, and windowed counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import DEFAULT, Config
from corpusloom.functions import text as X
from corpusloom.operators import stages


def read_parquet(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """A folder (or glob) of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clean(stream: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """Cleaning, filtering and deep cleaning: no state, so the batch stages run as they are."""
    return stages.deep_clean(stages.clean_and_filter(stream, c), c)


def dedup_exact(stream: DataFrame, text: str, time: str, delay: str = "1 day") -> DataFrame:
    """The first arrival of each canonical text within the delay; later copies are dropped, state is bounded by the delay."""
    return stream.withWatermark(time, delay).withColumn("exact_hash", F.sha2(X.canonical(text), 256)).dropDuplicatesWithinWatermark(["exact_hash"])


def reason_counts(stream: DataFrame, time: str, window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Rows by window of event time and drop reason (``kept`` for none)."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), F.coalesce("drop_reason", F.lit("kept")).alias("reason")).count().select(F.col("w.start").alias("window_start"), "reason", F.col("count").alias("n"))


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there now, batch by batch, and wait for its end."""
    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
