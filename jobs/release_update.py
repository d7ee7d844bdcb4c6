"""Family annotations that follow new members: an incremental update of the serving tables.

New files of (family, protein) edges are taken once each, by a file stream with a
checkpoint. Edges that are new to their family are added to a ledger, their proteins'
metadata (biome lineage, domain architecture) is counted, and the annotations of
touched families are made anew from the counts: the biome tree, every count rolled up
to all prefixes of its lineage, and each family's most frequent architectures.

    <out>/edges/batch=N/bucket=B/      family, protein: distinct, each in one batch only
    <out>/counts/batch=N/bucket=B/     family, kind, label, n: what a batch added
    <out>/families/bucket=B/           family, kind, label, parent, n, rank: what is served;
                                       trees have rank 0, architectures no parent

A batch writes partitions of its own number (dynamic partition overwrite), compares itself with
earlier numbers only, and replaces the buckets of ``families`` that it touches. So a batch that
was stopped anywhere and runs again after a restart leaves the same tables, and a run
without new files changes nothing. A batch reads the ledger of the buckets that it touches,
and never the files that earlier batches took. Family and protein must be known: edges without
either are left out, as are proteins without metadata. A family may have any number of
members: nothing is gathered by family but counts.

    python -m jobs.release_update --edges E --metadata M --out O --checkpoint C --config jobs/release_update.json
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs import common
from kinweave.operators import architecture, rollup

EDGES = "family string, protein string, batch long, bucket int"
COUNTS = "family string, kind string, label string, n long, batch long, bucket int"
FAMILIES = "family string, kind string, label string, parent string, n long, rank int, bucket int"
TABLES = {"edges": (EDGES, ["batch", "bucket"]), "counts": (COUNTS, ["batch", "bucket"]), "families": (FAMILIES, ["bucket"])}


def bucket(family: str, buckets: int):
    """A family's partition: digits of its MD5, which any engine can compute."""
    return (F.conv(F.substring(F.md5(F.col(family).cast("binary")), 1, 6), 16, 10).cast("int") % buckets).alias("bucket")


def labels(edges: DataFrame, metadata: DataFrame) -> DataFrame:
    """(bucket, family, kind, label, n): lineages and architectures of the edges' proteins."""
    met = edges.join(metadata, "protein")
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(column).alias("label")) for kind, column in (("biome", "lineage"), ("architecture", "architecture"))])
    each = met.select("bucket", "family", F.explode(pairs).alias("x")).select("bucket", "family", "x.kind", "x.label").filter("label IS NOT NULL")
    return each.groupBy("bucket", "family", "kind", "label").agg(F.count("*").alias("n"))


def served(counts: DataFrame, most: int) -> DataFrame:
    """Biome trees and most frequent architectures of summed counts."""
    total = counts.groupBy("bucket", "family", "kind", "label").agg(F.sum("n").alias("n"))
    tree = rollup.roll_up(total.filter("kind = 'biome'"), ["bucket", "family"], "label", "n")
    tree = tree.select("family", F.lit("biome").alias("kind"), F.col("ids").alias("label"), F.col("parents").alias("parent"), F.col("counts").alias("n"), F.lit(0).alias("rank"), "bucket")
    most_frequent = architecture.ranked(total.filter("kind = 'architecture'").select("bucket", "family", F.col("label").alias("architecture"), F.col("n").alias("count")), most)
    most_frequent = most_frequent.select("family", F.lit("architecture").alias("kind"), F.col("architecture").alias("label"), F.lit("").alias("parent"), F.col("count").alias("n"), "rank", "bucket")
    return tree.unionByName(most_frequent)


def run(spark: SparkSession, edges: str, metadata: str, out: str, checkpoint: str, config: dict) -> list[dict]:
    """Take what is new in ``edges``; returns a row of counts for each batch."""
    out, done = out.rstrip("/"), []
    names = lambda table, columns: [F.expr(config[table][c]).alias(c) for c in columns]
    for table, (schema, partitions) in TABLES.items():
        common.ready(spark, f"{out}/{table}", schema, partitions)

    def write(df: DataFrame, table: str) -> None:
        schema, partitions = TABLES[table]
        # the rows of a partition in one file, but for large ones
        df.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(f"{out}/{table}")

    def take(batch: DataFrame, number: int) -> None:
        own, table = batch.sparkSession, lambda name: common.read(batch.sparkSession, f"{out}/{name}", TABLES[name][0])
        read, wrote = Observation(), Observation()
        new = batch.observe(read, F.count("*").alias("rows_read")).select(*names("edges", ("family", "protein"))).filter("family IS NOT NULL AND protein IS NOT NULL").distinct()
        new = new.withColumn("bucket", bucket("family", config["buckets"]))
        before = table("edges").filter(F.col("batch") < number).select("bucket", "family", "protein")
        added = new.join(before, ["bucket", "family", "protein"], "left_anti").withColumn("batch", F.lit(number).cast("long"))
        write(added.observe(wrote, F.count("*").alias("edges_added")), "edges")
        mine = table("edges").filter(F.col("batch") == number)
        touched = [r.bucket for r in mine.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        if touched:
            looked = own.read.parquet(metadata).select(*names("metadata", ("protein", "lineage", "architecture")))
            write(labels(mine, looked).withColumn("batch", F.lit(number).cast("long")), "counts")
            write(served(table("counts").filter((F.col("batch") <= number) & F.col("bucket").isin(touched)), config["architectures"]), "families")
        done.append({"batch": number, **read.get, **wrote.get, "buckets": len(touched)})
        common.log.info("batch %s: read %s rows of %s, added %s edges, wrote %s buckets of %s/families", number, done[-1]["rows_read"], edges, done[-1]["edges_added"], len(touched), out)

    reader = spark.readStream.schema(config["edges"]["schema"]).option("maxFilesPerTrigger", config["files_per_batch"])
    stream = reader.parquet(pattern(edges)).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
    if not done:
        common.log.info("nothing new in %s", edges)
    return done


def pattern(path: str) -> str:
    """A path as a pattern that matches it alone: file streams take a single file in that form only."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def output(spark: SparkSession, out: str) -> DataFrame:
    """The annotations of all families."""
    return common.read(spark, f"{out.rstrip('/')}/families", FAMILIES)


def main() -> None:
    given = common.arguments(__doc__, "edges", "metadata", "out", "checkpoint")
    spark = common.session("release_update")
    try:
        run(spark, given.edges, given.metadata, given.out, given.checkpoint, common.configured(spark, given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
