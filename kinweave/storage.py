"""Results that several later steps must see alike, in the folder all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS = 500_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``. Where that is unset, a session on one
    machine (master ``local``) gets a temporary folder; any other fails."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="kinweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/kinweave-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once and read back."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(df: DataFrame, rows: int | None = None) -> int:
    """So many tasks that one has about ``rows`` rows of ``df``, and no fewer than run at once."""
    return max(df.count() // (rows or ROWS) + 1, df.sparkSession.sparkContext.defaultParallelism)


def dealt(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` over tasks whose number grows with its rows, so that what a task
    sorts or gathers does not; the session's number of shuffle partitions is fixed."""
    return df.repartition(tasks(df, rows), *keys)
