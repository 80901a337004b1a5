"""Documents as a stream: JSON lines that arrive in a folder, each document once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def lines(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """(line, seen) of the text files of a folder, as they come; seen is when the file was written."""
    rows = spark.readStream.option("maxFilesPerTrigger", per_batch).text(folder)
    return rows.select(T.strip(F.col("value")).alias("line"), F.col("_metadata.file_modification_time").alias("seen")).where("line <> ''")


def distinct(docs: DataFrame, key: str = "doc_key", seen: str | None = None, horizon: str = "7 days") -> DataFrame:
    """One document of each key. With `seen`, a key is remembered for at least the horizon after it, which bounds the state; without, for good."""
    return docs.withWatermark(seen, horizon).dropDuplicatesWithinWatermark([key]) if seen else docs.dropDuplicates([key])


def write(docs: DataFrame, out: str, checkpoint: str):
    """Takes all that is there and ends; another call goes on where this one ended."""
    return docs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
