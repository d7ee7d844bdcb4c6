"""Statistics of a sequence set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequence_stats(sequences: DataFrame, seq: str = "seq", gap_letters: str = ".-") -> DataFrame:
    """One row: num_seqs, sum_len, min_len, avg_len, max_len, Q1, Q2, Q3, sum_gap, N50, N50_num.

    N50: the length at which sequences, longest first, first hold half of all
    residues, and how many they are. It is found on counts per length, so the
    running sum is over distinct lengths, not over sequences."""
    lengths = sequences.select(
        F.length(seq).alias("len"), (F.length(seq) - F.length(F.translate(seq, gap_letters, ""))).alias("gaps")
    )
    base = lengths.agg(
        F.count("*").alias("num_seqs"), F.sum("len").alias("sum_len"), F.min("len").alias("min_len"), F.avg("len").alias("avg_len"), F.max("len").alias("max_len"),
        F.expr("percentile(len, 0.25)").alias("Q1"), F.expr("percentile(len, 0.5)").alias("Q2"), F.expr("percentile(len, 0.75)").alias("Q3"), F.sum("gaps").alias("sum_gap"),
    )
    by_length = lengths.groupBy("len").agg(F.count("*").alias("c"))
    w = Window.orderBy(F.desc("len")).rowsBetween(Window.unboundedPreceding, -1)
    total = by_length.agg(F.sum(F.col("len") * F.col("c")).alias("t"))
    run = by_length.select("len", "c", F.coalesce(F.sum(F.col("len") * F.col("c")).over(w), F.lit(0)).alias("before"), F.coalesce(F.sum("c").over(w), F.lit(0)).alias("n_before"))
    # one row joins each side
    half = run.crossJoin(F.broadcast(total)).filter((F.col("before") * 2 < F.col("t")) & (F.col("len") > 0))
    # the shortest length that still starts below half
    n50 = half.groupBy().agg(F.min_by(F.struct("len", F.col("n_before"), "before", "t"), "len").alias("h"))
    need = F.ceil((F.col("h.t") / 2 - F.col("h.before")) / F.col("h.len"))
    found = n50.select(F.col("h.len").alias("N50"), (F.col("h.n_before") + need).cast("long").alias("N50_num"))
    return base.crossJoin(F.broadcast(found))


def sequence_lengths(sequences: DataFrame, seq: str = "seq") -> DataFrame:
    return sequences.groupBy(F.length(seq).alias("len")).agg(F.count("*").alias("n"))
