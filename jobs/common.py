"""What the jobs share: configuration, logging, empty tables."""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("kinweave.jobs")


def packaged(job: str) -> dict:
    """The configuration that comes with a job."""
    return json.loads(Path(__file__).with_name(f"{job}.json").read_text(encoding="utf-8"))


def configured(spark: SparkSession, path: str) -> dict:
    """A configuration file, which may be on any store that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def ready(spark: SparkSession, path: str, schema: str, partitions: list[str]) -> None:
    """Make an empty partitioned table where there is none, so that it can be read."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partitions).parquet(path)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def arguments(doc: str, *names: str) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=doc, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in names:
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", required=True, help="configuration file (JSON)")
    return parser.parse_args()


def session(name: str) -> SparkSession:
    """The command line's own session; settings come from spark-submit."""
    logging.basicConfig(format="%(asctime)s %(name)s %(levelname)s %(message)s")
    log.setLevel(logging.INFO)
    return SparkSession.builder.appName(name).getOrCreate()
