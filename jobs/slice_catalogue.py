"""Slice catalogue of a release: what clustering starts from.

Annotated regions are cut out of every protein, slices of ``min_length`` and more are
kept, equal slices become one row with the number of copies, and the catalogue is written
by release and length class with its quality statistics:

    <out>/slices/release=R/length_class=N/     id, seq, digest, length, copies
    <out>/stats/release=R/                     one row of statistics
    <out>/lengths/release=R/                   length_class, slices, copies, residues

A release's folders are replaced as a whole, so a rerun gives the same files' content, and other
releases stay as they are. Regions are reduced to the furthest end of each start before they are
gathered, so a protein never has more of them than residues, however often a region
is reported, and where a release has at most ``FEW`` proteins, regions of others go before any shuffle;
copies are counted by partial sums before their texts are shuffled.
Proteins without id or sequence, and regions without an end, are left out; ids may repeat.

    python -m jobs.slice_catalogue --proteins P --regions R --out O --config jobs/slice_catalogue.json
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs import common
from kinweave.operators import intervals, stats

FEW = 500_000
SLICES = "id string, seq string, digest string, length int, copies long, release string, length_class int"


def slices(proteins: DataFrame, regions: DataFrame, min_length: int) -> DataFrame:
    """(id, seq) of (protein_id, sequence) and (protein_id, start, stop)."""
    furthest = regions.filter("protein_id IS NOT NULL AND stop IS NOT NULL AND start IS NOT NULL").groupBy("protein_id", "start").agg(F.max("stop").alias("stop"))
    own = furthest.groupBy("protein_id").agg(F.collect_list(F.struct(F.col("start").cast("int").alias("a"), F.col("stop").cast("int").alias("b"))).alias("regions"))
    known = proteins.filter("protein_id IS NOT NULL AND sequence IS NOT NULL")
    typed = known.join(own, "protein_id", "left").select("protein_id", "sequence", F.col("regions").isNotNull().alias("has"), "regions")
    return intervals.slices_of(typed, min_length)


def regions_of(regions: DataFrame, proteins: DataFrame) -> DataFrame:
    """Regions of these proteins, where the proteins are few; else all, which slices match anyway."""
    known = proteins.filter("protein_id IS NOT NULL AND sequence IS NOT NULL").select("protein_id")
    return regions if known.count() > FEW else regions.join(F.broadcast(known.distinct()), "protein_id", "left_semi")


def catalogue(found: DataFrame, classes: list[int]) -> DataFrame:
    """One row for each distinct slice: its first id, how many have it, and its length class."""
    each = found.withColumn("digest", F.sha2(F.col("seq").cast("binary"), 256))
    one = each.groupBy("digest").agg(F.min(F.struct("id", "seq")).alias("first"), F.count("*").alias("copies"))
    length = F.length("first.seq")
    size_class = F.lit(classes[0])
    for low in classes[1:]:
        size_class = F.when(length >= low, low).otherwise(size_class)
    return one.select("first.id", "first.seq", "digest", length.alias("length"), "copies", size_class.alias("length_class"))


def run(spark: SparkSession, proteins: str, regions: str, out: str, config: dict) -> dict:
    """Make a release's catalogue; returns the counts that are logged."""
    names = lambda table: [F.expr(sql).alias(name) for name, sql in config[table].items()]
    read, wrote = Observation(), Observation()
    rows = spark.read.parquet(proteins).select(*names("proteins"))
    cut = regions_of(spark.read.parquet(regions).select(*names("regions")), rows)
    rows = rows.observe(read, F.count("*").alias("proteins"))
    found = catalogue(slices(rows, cut, config["min_length"]), sorted(config["length_classes"]))
    found = found.observe(wrote, F.count("*").alias("slices"), F.coalesce(F.sum("copies"), F.lit(0)).alias("copies"), F.coalesce(F.sum("length"), F.lit(0)).alias("residues"))
    place = lambda table: f"{out.rstrip('/')}/{table}/release={config['release']}"
    # even files: large classes are cut into several, small ones share a task
    found.hint("rebalance", "length_class").write.mode("overwrite").partitionBy("length_class").parquet(place("slices"))
    counts = {**read.get, **wrote.get}
    common.log.info("read %s proteins of %s, regions of %s", counts["proteins"], proteins, regions)
    common.log.info("wrote %s slices (%s with copies, %s residues) to %s", counts["slices"], counts["copies"], counts["residues"], place("slices"))
    kept = output(spark, out).filter(F.col("release") == config["release"])
    by_class = kept.groupBy("length_class").agg(F.count("*").alias("slices"), F.sum("copies").alias("copies"), F.sum("length").alias("residues"))
    for table, report in (("lengths", by_class), ("stats", stats.sequence_stats(kept.select("seq")))):
        report.coalesce(1).write.mode("overwrite").parquet(place(table))
        common.log.info("wrote %s", place(table))
    return counts


def output(spark: SparkSession, out: str) -> DataFrame:
    """The catalogue of all releases."""
    return common.read(spark, f"{out.rstrip('/')}/slices", SLICES)


def main() -> None:
    given = common.arguments(__doc__, "proteins", "regions", "out")
    spark = common.session("slice_catalogue")
    try:
        run(spark, given.proteins, given.regions, given.out, common.configured(spark, given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
