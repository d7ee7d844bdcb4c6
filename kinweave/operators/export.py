"""Export tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalar
from ..sources.text import first_by


def families(metadata: DataFrame, scores: DataFrame, composition: DataFrame, topology: DataFrame | None = None) -> DataFrame:
    """The family table: left joins on id, absent columns empty, fixed order."""
    out = metadata.join(scores, "id", "left").join(composition, "id", "left")
    if topology is not None:
        out = out.join(topology, "id", "left")
    return out.select(*[F.col(c) if c in out.columns else F.lit("").alias(c) for c in schemas.FAMILY_HEADER])


def domain_hits(domtbl: DataFrame, threshold: float = 0.8, pfam: bool = True) -> DataFrame:
    """Hits whose envelope covers enough of the query model. Pfam hits have the
    query's accession without version and its name; others the query's name."""
    covered = domtbl.filter(F.col("env_to") - F.col("env_from") + 1 >= threshold * F.col("qlen"))
    coords = ["hmm_from", "hmm_to", "ali_from", "ali_to", "env_from", "env_to", "acc"]
    own = [scalar.accession(F.col("query_acc")).alias("pfam"), F.col("query").alias("name")] if pfam else [F.col("query").alias("funfam")]
    return covered.select(F.col("target").alias("id"), *own, "e_value", "score", *coords)


def folds(hits: DataFrame) -> DataFrame:
    return hits.select(F.col("query").alias("id"), F.col("target").alias("fold"), "aligned_length", "q_start", "q_end", "t_start", "t_end", "e_value")


def model_pfams(hits: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Profile-profile hits with the name and description of their accession, empty
    where there is none. The first description of an accession as written counts;
    of accessions that differ in version only, the last."""
    first = first_by(descriptions, ["id", "accession"], ["n"])
    known = first.groupBy("id", scalar.accession(F.col("accession")).alias("pfam")).agg(
        F.max_by("name", "n").alias("name"), F.max_by("description", "n").alias("description")
    )
    joined = hits.join(known, ["id", "pfam"], "left")
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return joined.select("id", "pfam", empty("name"), empty("description"), "prob", "e_value", "length", "query_hmm", "template_hmm")


def reported(hits: DataFrame, probability: float = 80.0, e_value: float = 0.001, most: int = 1000) -> DataFrame:
    """The search tool's own limits on ingested hits: probability, E-value, number per query."""
    kept = hits.filter((F.col("prob").try_cast("double") >= probability) & (F.col("e_value").try_cast("double") <= e_value))
    from pyspark.sql import Window

    return kept.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("n"))).filter(F.col("_r") <= most).drop("_r")


def truncated(sequences: DataFrame, residues: int = 1022) -> DataFrame:
    return sequences.withColumn("seq", F.substring("seq", 1, residues))
