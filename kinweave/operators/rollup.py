"""Counts over a hierarchy of `a:b:c` paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar


def biome_counts(lookup: DataFrame, family: str = "family", ignore_pair_count: bool = True) -> DataFrame:
    """(family, id, n) from rows whose ``biomes`` is the text of a list of [id, count]
    pairs: each pair adds 1 (or its count)."""
    pairs = F.from_json("biomes", "array<array<bigint>>")
    each = lookup.filter("biomes IS NOT NULL").select(family, F.explode(pairs).alias("p"))
    add = F.lit(1) if ignore_pair_count else F.element_at("p", 2)
    return each.groupBy(family, F.element_at("p", 1).cast("string").alias("id")).agg(F.sum(add).cast("long").alias("n"))


def named(counts: DataFrame, names: DataFrame, strict: bool = True) -> DataFrame:
    """Counts with the path of their id. An id without a path fails (``strict``) or is dropped."""
    joined = counts.join(names.select("id", F.col("name").alias("path")), "id", "left")
    if strict:
        return joined.withColumn("path", F.coalesce("path", F.raise_error(F.concat(F.lit("no name of "), "id")).cast("string")))
    return joined.filter("path IS NOT NULL")


def roll_up(counts: DataFrame, keys: list[str], path: str = "path", n: str = "n") -> DataFrame:
    """(keys, ids, labels, parents, counts): every count added to all prefixes of its path."""
    each = counts.select(*keys, F.explode(scalar.path_prefixes(F.col(path))).alias("ids"), F.col(n).alias("_n"))
    total = each.groupBy(*keys, "ids").agg(F.sum("_n").alias("counts"))
    return total.select(*keys, "ids", scalar.path_label(F.col("ids")).alias("labels"), scalar.path_parent(F.col("ids")).alias("parents"), "counts")
