"""Incremental input: new protein files are sliced as they arrive.

The established flow is finite; a stream of files with the same operators is the
Spark form of its next release, which starts from new proteins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import intervals


def protein_stream(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    reader = spark.readStream.schema(schemas.PROTEIN).option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def slice_stream(proteins: DataFrame, min_length: int = 100) -> DataFrame:
    """Slices of a stream of proteins; stateless, so append mode needs no watermark."""
    return intervals.unannotated_slices(proteins, min_length)


def run_slices(spark: SparkSession, folder: str, out: str, checkpoint: str, min_length: int = 100, available_now: bool = True) -> StreamingQuery:
    """Write slices of all files of ``folder``, once each, as Parquet."""
    writer = slice_stream(protein_stream(spark, folder), min_length).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).outputMode("append").start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Tumbling counts with a watermark: rows later than ``late`` are left out, and
    state of closed windows is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
