"""Redundant families: colliding representatives, and hits of family models on
the representatives of families with nearly the same proteins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scalar
from ..storage import written
from . import edges


def rep_key(region: str = "region", whole_never_target: bool = True):
    """Search name of a representative: `rep/region`. A whole representative has
    region `-`; corrected, its key is its bare name."""
    full = F.concat_ws("/", "rep", region)
    return full if whole_never_target else F.when(F.col(region) == "-", F.col("rep")).otherwise(full)


def rep_winners(families: DataFrame) -> DataFrame:
    """(key, family, winner): of families with one representative key the largest
    wins; of equal sizes the first name. Only the winner of a key is gathered,
    so a common key sorts nothing."""
    largest = families.groupBy("key").agg(F.max("size").alias("top"))
    first = families.join(largest, "key").filter("size = top").groupBy("key").agg(F.min("family").alias("best"))
    return families.join(first, "key").select("key", "family", "size", (F.col("family") == F.col("best")).alias("winner"))


def sides(families: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is known of a hit's two ends: (query, size_a, lost a collision) and (target, b, size_b) of the targets that won
    theirs. Written, so that its size is known and a small one is not joined by shuffling all hits."""
    won = written(rep_winners(families))
    lost = won.filter(~F.col("winner")).select(F.col("family").alias("query"), F.lit(True).alias("lost")).distinct()
    size = lambda k, n: won.select(F.col("family").alias(k), F.col("size").alias(n))
    targets = won.filter("winner").select(F.col("key").alias("target"), F.col("family").alias("b")).join(size("b", "size_b"), "b", "left")
    return written(size("query", "size_a").join(lost, "query", "left")), written(targets.select("target", "b", "size_b"))


def worth(hits: DataFrame, length_threshold: float) -> DataFrame:
    """Hits between known ends (:func:`sides`) that are worth comparing: queries that lost no collision, no self
    hits, envelope over enough of the query."""
    long_enough = (F.col("env_to") - F.col("env_from") + 1) / F.col("qlen") >= length_threshold
    return hits.filter(~F.coalesce("lost", F.lit(False))).filter(long_enough & ~F.col("query").eqNullSafe(F.col("b")))


def hits(domtbl: DataFrame, families: DataFrame, length_threshold: float) -> DataFrame:
    """Hits (a: query, b: target family) :func:`worth` comparing, with their sizes. A hit on an
    unknown representative keeps a null target, as it equals nothing. A hit meets what is known of each end once."""
    queries, targets = sides(families)
    found = worth(domtbl.join(queries, "query", "left").join(targets, "target", "left"), length_threshold)
    return found.select(F.col("query").alias("a"), "b", "size_a", "size_b")


def judged(scored: DataFrame, redundant_score: float, similarity_score: float) -> tuple[DataFrame, DataFrame]:
    """(redundant names, similar pairs) of scored hits; each pair is judged alone."""
    high = scored.filter(F.col("score") >= redundant_score)
    name = (
        F.when(F.col("size_a") < F.col("size_b"), F.col("a")).when(F.col("size_a") > F.col("size_b"), F.col("b")).otherwise(F.greatest("a", "b"))
    )
    redundant = high.select(name.alias("family")).distinct()
    similar = scored.filter((F.col("score") < redundant_score) & (F.col("score") >= similarity_score)).select("a", "b", "score")
    return redundant, similar


def identify(domtbl: DataFrame, metadata: DataFrame, edge_list: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(redundant families, similar pairs). ``metadata``: family, size, rep, region;
    ``edge_list``: family, member."""
    families = metadata.select("family", "size", rep_key(whole_never_target=config.quirks.whole_rep_never_target).alias("key"))
    lost = rep_winners(families).filter(~F.col("winner")).select("family")
    candidates = hits(domtbl, families, config.redundant_length)
    scored = edges.pair_jaccard(candidates, edges.base_proteins(edge_list), at_least=min(config.redundant_score, config.similarity_score))
    redundant, similar = judged(scored, config.redundant_score, config.similarity_score)
    return lost.union(redundant).distinct(), similar


def similarity_rows(similar: DataFrame) -> DataFrame:
    """(row, family1, family2, score): similar pairs numbered from 1, by their names."""
    # written first: a range sort samples its input, which would make the scores twice
    named = written(similar.select(F.col("a").alias("family1"), F.col("b").alias("family2"), "score"))
    return edges.numbered(named, ["family1", "family2", "score"], "row").select("row", "family1", "family2", "score")


def survivor_ids(names: DataFrame, redundant: DataFrame, starting_id: int = 1) -> DataFrame:
    """(family, id): dense ids of the survivors in the byte order of their file names."""
    kept = names.select("family").distinct().join(redundant.select("family"), "family", "left_anti")
    ordered = edges.numbered(written(kept.withColumn("_name", F.concat("family", F.lit(".hmm")))), ["_name"], "_n")
    return ordered.select("family", (F.col("_n") - 1 + starting_id).cast("long").alias("id"))


def renumbered(table: DataFrame, ids: DataFrame, column: str = "family", strict: bool = True) -> DataFrame:
    """``table`` with family names replaced by ids: families without an id are
    dropped (``strict``), or keep their old name."""
    known = ids.select(F.col("family").alias("_f"), F.col("id").cast("string").alias("_id"))
    joined = table.join(known, table[column] == known["_f"], "inner" if strict else "left")
    new = F.coalesce("_id", F.col(column))
    return joined.select(*[new.alias(c) if c == column else F.col(f"`{c}`") for c in table.columns])


def running_numbers(clusters: DataFrame) -> DataFrame:
    """Number of each cluster within its chunk, advanced by successful ones only:
    a discarded cluster's number is the next one's too."""
    w = Window.partitionBy("chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return clusters.withColumn("iteration", (F.coalesce(F.sum(F.col("success").cast("int")).over(w), F.lit(0)) + 1).cast("int"))


def model_renamed(model: str, name: str):
    """Model text with its NAME line rewritten."""
    return F.regexp_replace(F.col(model), r"(?m)^NAME .*$", F.concat(F.lit("NAME  "), F.col(name)))
