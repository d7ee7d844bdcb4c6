"""The three modes as plans: proteins to families, serving database, its update.

Every function takes and returns DataFrames and runs no action of its own, but
for the barriers named: results that several later steps read are written to
``workdir`` and read back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import alignments, architecture, edges, export, families, growth, intervals, redundancy, rollup, stats, tracks, words
from ..operators.kernels import Kernels
from ..sources import sinks
from ..sources import text as sources


def barrier(df: DataFrame, workdir: str, name: str) -> DataFrame:
    """Write a result once and read it back."""
    path = f"{workdir.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def protein_sequences(spark: SparkSession, path: str, config: Config = Config()) -> DataFrame:
    """(id, seq) of the input: unannotated slices of a protein table, or FASTA records."""
    if config.fasta_input:
        return sources.fasta(spark, path).select("id", "seq")
    return intervals.unannotated_slices(sources.proteins(spark, path), config.min_sequence_length)


@dataclass
class Clusters:
    sequences: DataFrame
    stats: DataFrame
    distribution: DataFrame
    clusters: DataFrame
    representatives: DataFrame


def setup_clusters(spark: SparkSession, path: str, workdir: str, config: Config = Config(), kernels: Kernels | None = None) -> Clusters:
    seqs = barrier(protein_sequences(spark, path, config), workdir, "sequences")
    clusters = barrier(
        families.linear_clusters(seqs, config.cluster_identity, config.cluster_coverage, kernels=kernels), workdir, "clusters"
    )
    reps = edges.representatives(clusters, config.minimum_members)
    chunks = edges.chunked(reps, ["representative"], config.clusters_chunk_size)
    return Clusters(seqs, stats.sequence_stats(seqs), edges.size_distribution(clusters), edges.members_of(clusters, reps), chunks)


@dataclass
class Families:
    members: DataFrame
    metadata: DataFrame
    representatives: DataFrame
    alignments: DataFrame
    seeds: DataFrame
    models: DataFrame
    discarded: DataFrame
    similar: DataFrame
    ids: DataFrame


def profile_hits(seeds: DataFrame, reps: DataFrame, config: Config, kernels: Kernels) -> DataFrame:
    """Hits of the models of seed alignments (family, aligned) on representatives
    (query, target, qlen, env_from, env_to)."""
    found = growth.written(growth.models(seeds, config.gap_occupancy, kernels))
    reps = reps.select("id", "seq")
    pairs = words.candidates(growth.columns_of(found), reps)
    hits = growth.search(found, pairs, reps, reps.count(), kernels, config.search_e_value, 0.0)
    return hits.join(found.select("family", "length"), "family").select(F.col("family").alias("query"), F.col("id").alias("target"), F.col("length").alias("qlen"), "env_from", "env_to")


def nonredundant_families(setup: Clusters, workdir: str, config: Config = Config(), kernels: Kernels | None = None) -> Families:
    """Grow, compare, drop the redundant and renumber."""
    kernels = kernels or Kernels()
    got = growth.grown(setup.clusters, setup.sequences, config, kernels)
    results = barrier(got.results, workdir, "grown")
    numbered = redundancy.running_numbers(
        setup.representatives.select("chunk", F.col("representative").alias("position")).join(
            results.select(F.col("representative").alias("position"), (F.col("status") == "ok").alias("success")), "position"
        )
    )
    names = numbered.filter("success").select(F.col("position").alias("representative"), F.concat_ws("_", "chunk", "iteration").alias("family"))
    grown = results.filter("status = 'ok'").join(names, "representative")
    named = lambda rows: rows.join(names, "representative").select("family", "n", "name", "aligned")
    raw, seeds = named(got.rows), named(got.seeds)
    rows = barrier(alignments.renumbered(raw, setup.sequences, config.quirks.cut_renamed), workdir, "rows")
    members, meta, reps = alignments.family_tables(rows)
    size = grown.select("family", "size") if config.quirks.size_before_dedupe else rows.groupBy("family").agg(F.count("*").cast("int").alias("size"))
    meta = meta.join(size, "family").join(grown.select("family", "consensus", "converged"), "family")
    hits = barrier(profile_hits(seeds, reps, config, kernels), workdir, "hits")
    redundant, similar = redundancy.identify(hits, meta, members, config)
    redundant = barrier(redundant, workdir, "redundant")
    ids = barrier(redundancy.survivor_ids(meta, redundant, config.starting_id), workdir, "ids")
    strict = lambda df: redundancy.renumbered(df, ids)
    tolerant = redundancy.renumbered(redundancy.renumbered(similar, ids, "a", False), ids, "b", False)
    return Families(
        strict(members.withColumn("member", F.rtrim("member"))), strict(meta), redundancy.renumbered(reps, ids, "description"), strict(rows.drop("residues")),
        strict(seeds),
        strict(grown.select("family", "consensus", "rf")), growth.discarded(results), tolerant, ids,
    )


def structure_batches(reps: DataFrame, config: Config = Config(), retry: bool = False) -> DataFrame:
    """Representatives with the number of their batch for structure prediction; those
    that failed for their length are tried again in smaller ones."""
    return edges.chunked(reps, ["id"], config.structure_chunk_long if retry else config.structure_chunk)


def topology_input(reps: DataFrame, config: Config = Config()) -> DataFrame:
    """Representatives as the topology predictor takes them: no residue beyond its limit."""
    return export.truncated(reps, config.topology_max_residues)


def annotations(spark: SparkSession, folder: str, config: Config = Config()) -> dict[str, DataFrame]:
    """What prediction and search tools left in ``folder``, as tables."""
    preds = sources.secondary_structure(spark, f"{folder}/s4pred")
    out = {
        "composition": tracks.structure_composition(preds),
        "structure_features": tracks.structure_features(preds),
        "scores": sources.structure_scores(spark, f"{folder}/structure_scores"),
        "pfams": export.domain_hits(sources.domtbl(spark, f"{folder}/pfam"), config.query_hmm_length),
        "funfams": export.domain_hits(sources.domtbl(spark, f"{folder}/funfam"), config.query_hmm_length, pfam=False),
        "folds": export.folds(sources.fold_hits(spark, f"{folder}/folds").filter(F.col("e_value").try_cast("double") <= config.fold_e_value)),
        "model_pfams": export.model_pfams(
            export.reported(sources.hhr_hits(spark, f"{folder}/hhr"), config.hh_probability, config.hh_e_value, config.hh_reported[1]), sources.hhr_descriptions(spark, f"{folder}/hhr")
        ),
    }
    if not config.skip_topology:
        topology = sources.three_line(spark, f"{folder}/topology")
        out |= {"topology": tracks.topology_composition(topology), "topology_features": tracks.topology_features(topology)}
    return out


def export_tables(fams: Families, notes: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five export tables."""
    meta = fams.metadata.select(
        F.col("family").alias("id"), F.col("size").alias("full_size"), F.col("rep").alias("protein_rep"), F.col("region").alias("rep_region"), "rep_length",
        F.col("sequence").alias("rep_sequence"), "consensus", "converged",
    )
    return {
        "family": export.families(meta, notes["scores"], notes["composition"], notes.get("topology")),
        "family_pfams": notes["pfams"], "family_funfams": notes["funfams"], "family_folds": notes["folds"], "family_model_pfams": notes["model_pfams"],
    }


def init_db(tables: dict[str, DataFrame], path: str) -> None:
    """Write the serving tables: the family table and four child tables whose rows get ids."""
    sinks.import_serving({"family": tables["family"]}, path)
    for name in ("family_pfams", "family_funfams", "family_folds", "family_model_pfams"):
        sinks.child_rows(tables[name], name).write.mode("append").parquet(f"{path}/{name}")


def family_lookup(members: DataFrame, proteins: DataFrame) -> DataFrame:
    """(family, protein_id, biomes, domains): metadata of each family's distinct
    proteins; proteins without a row are dropped."""
    from ..functions import scalar

    own = members.select("family", scalar.protein_id(F.col("member")).alias("protein_id")).distinct()
    part = lambda k: F.get_json_object("metadata", f"$.{k}")
    return own.join(proteins.select("protein_id", part("b").alias("biomes"), part("p").alias("domains")), "protein_id")


def update_db(serving: DataFrame, members: DataFrame, proteins: DataFrame, biomes: DataFrame, domains: DataFrame, blobs: dict[str, DataFrame], config: Config = Config()) -> DataFrame:
    """The family table with new blobs: biome trees, domain architectures, and files."""
    look = family_lookup(members, proteins)
    tree = rollup.roll_up(rollup.named(rollup.biome_counts(look, ignore_pair_count=config.quirks.ignore_pair_count), biomes), ["family"])
    line = F.concat_ws(",", "ids", "labels", "parents", "counts")
    listed = tree.groupBy("family").agg(F.array_sort(F.collect_list(F.struct((-F.col("counts")).alias("o"), "ids", line.alias("l")))).alias("x"))
    text = F.concat(F.lit("ids,labels,parents,counts\n"), F.array_join(F.transform("x", lambda v: v["l"]), "\n"), F.lit("\n"))
    biome_blob = listed.select(F.col("family").try_cast("bigint").alias("id"), text.cast("binary").alias("biome_blob"))
    archs = architecture.architectures(members, look, config.quirks.architecture_by_model_start)
    docs = architecture.documents(architecture.top(archs), domains, config.id_prefix)
    domain_blob = docs.select(F.col("family").try_cast("bigint").alias("id"), F.col("json").cast("binary").alias("domain_blob"))
    return sinks.update_blobs(serving, {"biome_blob": biome_blob, "domain_blob": domain_blob, **blobs})
