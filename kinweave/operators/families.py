"""Clustering of sequences; :mod:`growth` makes families of the clusters.

It follows the published linear-time scheme: each sequence keeps the
``m`` k-mers of lowest hash; sequences that share one are compared with the
longest of them only, so the work is linear; verified pairs are assigned
greedily, longest representative first, in rounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..storage import written
from .kernels import Kernels


def kmers(sequences: DataFrame, k: int = 8, lowest: int | None = None, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(id, n, h): distinct k-mer hashes of each sequence, the ``lowest`` ones if given."""
    at = F.when(F.length("seq") >= k, F.sequence(F.lit(1), F.length("seq") - (k - 1))).otherwise(F.array().cast("array<int>"))
    hashes = F.array_distinct(F.transform(at, lambda i: hashed(F.substr("seq", i, F.lit(k)))))
    if lowest:
        hashes = F.slice(F.array_sort(hashes), 1, lowest)
    return sequences.select("id", F.length("seq").alias("n"), F.explode(hashes).alias("h"))


def centre_pairs(sequences: DataFrame, coverage: float = 0.9, k: int = 8, lowest: int = 20, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(centre, id): each sequence with the longest of those that share one of its
    lowest k-mers (of equal lengths the last id), where the lengths allow the coverage.

    A k-mer that very many sequences share still gives one pair for each of them:
    the longest is found by a partial aggregation and joined by the k-mer, the rows of a k-mer of
    more than ``storage.ROWS`` in several tasks. Sequences are dealt before they are cut, so that no
    task sorts the k-mers of a whole file."""
    sequences = storage.dealt(sequences, "id", rows=storage.ROWS // (lowest or 100) + 1)
    each = kmers(sequences, k, lowest, hashed)
    found = each.groupBy("h").agg(F.max(F.struct("n", "id")).alias("c"), F.count("*").alias("rows"))
    centre = written(found.select("h", F.col("c.id").alias("centre"), F.col("c.n").alias("n_centre"), F.expr(f"CAST(rows DIV {storage.ROWS} + 1 AS int)").alias("parts"), "rows"))
    number = max((centre.agg(F.sum("rows")).first()[0] or 0) // storage.ROWS + 1, each.sparkSession.sparkContext.defaultParallelism)
    split = F.broadcast(centre.filter("parts > 1").select("h", "parts"))  # no more rows than tasks
    salted = each.join(split, "h", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    centre = centre.select("h", "centre", "n_centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    joined = salted.repartition(number, "h", "part").join(centre.repartition(number, "h", "part"), ["h", "part"])
    near = joined.filter("id <> centre AND n >= n_centre * " + str(float(coverage))).select("centre", "id")
    return near.repartition(number, "centre", "id").distinct()


def linear_clusters(sequences: DataFrame, identity: float = 0.5, coverage: float = 0.9, k: int = 8, lowest: int = 20, kernels: Kernels | None = None) -> DataFrame:
    """(representative, member): every sequence is in one cluster, itself included.
    Each member was compared with its representative and reaches both thresholds.

    Sequences whose centres all became members of other clusters, and that are no
    representative of others, are clustered again among themselves until no pair is left."""
    kernels = kernels or Kernels()
    left, parts = sequences.select("id", "seq"), []
    while True:
        good = written(_verified(left, identity, coverage, k, lowest, kernels))
        if good.isEmpty():
            break
        taken = assigned(good)
        parts += taken
        lost = good.select("id").distinct()
        for part in taken:
            lost = lost.join(part.select(F.col("member").alias("id")), "id", "left_anti").join(part.select(F.col("representative").alias("id")), "id", "left_anti")
        left = written(left.join(lost, "id", "left_semi"))
    alone = sequences.select(F.col("id").alias("member"))
    found = None
    for part in parts:
        alone = alone.join(part, "member", "left_anti")
        found = part if found is None else found.unionByName(part)
    single = alone.select("member", F.col("member").alias("representative"))
    return (single if found is None else found.unionByName(single)).select("representative", "member")


def _verified(sequences: DataFrame, identity: float, coverage: float, k: int, lowest: int, kernels: Kernels) -> DataFrame:
    """(centre, id, n_a): the centre pairs that reach both thresholds."""
    seq = lambda name, col: sequences.select(F.col("id").alias(name), F.col("seq").alias(col))
    full = centre_pairs(sequences, coverage, k, lowest).join(seq("centre", "a"), "centre").join(seq("id", "b"), "id")

    def verify(frames):
        for df in frames:
            ok = [(lambda r: r[0] >= identity and r[1] >= coverage and r[2] >= coverage)(kernels.identity(a, b)) for a, b in zip(df.a, df.b, strict=True)]
            yield df.loc[ok, ["centre", "id", "n_a"]]

    return full.withColumn("n_a", F.length("a")).mapInPandas(verify, "centre string, id string, n_a int")


def assigned(pairs: DataFrame) -> list[DataFrame]:
    """Greedy choice of representatives from verified pairs (centre, id, n_a), as parts
    (member, representative), each written once.

    A centre is longer than its members (or later by id), so pairs form no ring. In each
    round the centres that nothing covers are representatives and take their members; a
    member is no centre any more, which may uncover others. Only direct pairs count."""
    parts = []
    while not pairs.isEmpty():
        top = pairs.select("centre").distinct().join(pairs.select(F.col("id").alias("centre")), "centre", "left_anti")
        best = pairs.join(top, "centre", "left_semi").groupBy("id").agg(F.max(F.struct("n_a", "centre")).alias("m"))
        part = written(best.select(F.col("id").alias("member"), F.col("m.centre").alias("representative")))
        gone = part.select(F.col("member").alias("id"))
        pairs = written(pairs.join(gone, "id", "left_anti").join(gone.withColumnRenamed("id", "centre"), "centre", "left_anti"))
        parts.append(part)
    return parts
