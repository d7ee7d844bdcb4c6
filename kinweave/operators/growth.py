"""Growing clusters into families, all of them together, in rounds over tables.

A round makes a model of every family's seed, searches it, and turns the hits into the
next seed. Every step is a table that is written before the next one reads it, so a lost
executor costs tasks of one step, and a family is never held in one place:

* a model comes from counts of (column, residue), summed in part before they are shuffled;
* candidates come from :mod:`words`; a model meets its candidates in parts of ``PART`` sequences;
* each sequence is aligned to its model alone, and rows are spread to common columns by the
  widest insertion before each column;
* near-identical rows are dropped by the greedy choice, longest row first, in blocks: a block of
  ``PART`` rows is decided in one task, then all other rows are compared with what the
  block kept, in parts. That gives what the plain greedy choice gives.

Groups that are handed to Python hold ``PART`` sequences and a model, or one family's column counts.

The rules are those of the established loop: at most three rounds; a family has converged when
no protein is recruited that was not before (bare names count, not their envelopes); every
domain of a protein is recruited; the last search has no length limit. Rows stand by E-value and
name, so the first one, the representative, is the best hit.

Null ids and sequences are left out; of equal ids in ``sequences`` each is searched. A cluster
whose members have no sequence is discarded like one without hits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scalar
from ..storage import written
from . import alignments, edges, words
from .kernels import AMINO, MATCH, MISMATCH, Kernels, Profile, _global, alike, coded, compact, letters_of, spread, unlike

PART = 2000
ROUNDS = 3
# fixed values: the reasons of discarded clusters
NO_HITS, TOO_SMALL, TOO_LARGE, FEW = (
    "low complexity model - confounding cluster",
    "family representative length too small",
    "family representative length too large",
    "few seed sequences remained",
)

MODEL = "family string, length int, scores array<double>, consensus string, rf string"
ROW = "family string, e_value double, name string, aligned string"
HIT = "family string, id string, name string, e_value double, env_from int, env_to int, long boolean, residues string"


@dataclass
class Grown:
    """``results``: representative, status, value, converged, consensus, rf, size of every cluster;
    ``rows`` and ``seeds`` of the families that remain: representative, n (ascending), name, aligned."""

    results: DataFrame
    rows: DataFrame
    seeds: DataFrame


def in_parts(rows: DataFrame, size: int = PART) -> DataFrame:
    """``rows`` (family, name or id among others) with ``part``: a family's rows are dealt to parts of about ``size``."""
    key = "name" if "name" in rows.columns else "id"
    n = rows.groupBy("family").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("parts"))
    return rows.join(n, "family").withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")).cast("int")).drop("parts")


def for_parts(each: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of a family once for every part of it."""
    # columns of its own: the result meets ``parts`` again
    return each.join(parts.select(F.col("family").alias("family"), F.col("part").alias("part")).distinct(), "family")


def models(rows: DataFrame, occupancy: float, kernels: Kernels) -> DataFrame:
    """(MODEL) of alignment rows (family, aligned)."""
    counts = alignments.residue_counts(rows.select("family", "aligned"))
    n = rows.groupBy("family").agg(F.count("*").alias("rows"), F.max(F.length("aligned")).alias("width"))

    def build(df: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((int(df.width.iloc[0]), 21), np.int64)
        table[df.pos, df.residue] = df.filled
        p = kernels.profile_of(table, int(df.rows.iloc[0]), occupancy)
        return pd.DataFrame([{"family": df.family.iloc[0], "length": p.length, "scores": p.scores.ravel(), "consensus": p.consensus, "rf": p.rf}])

    return counts.join(n, "family").groupBy("family").applyInPandas(build, MODEL)


def columns_of(found: DataFrame) -> DataFrame:
    """The scores of models as (family, pos, residue, score), in whole half bits."""
    each = found.select("family", F.posexplode("scores").alias("at", "s")).withColumn("letter", F.pmod("at", F.lit(21)))
    letter = F.element_at(F.split(F.lit(AMINO), ""), F.col("letter") + 1)
    return each.filter("letter < 20").select("family", F.expr("CAST(at DIV 21 AS INT)").alias("pos"), letter.alias("residue"), F.round("s").cast("int").alias("score"))


def profile_from(r) -> Profile:
    return Profile(np.asarray(r["scores"], np.float64).reshape(-1, 21), r["consensus"], r["rf"])


def search(found: DataFrame, pairs: DataFrame, sequences: DataFrame, database: int, kernels: Kernels, e_value: float, fraction: float) -> DataFrame:
    """(HIT): all domains of the candidate pairs (family, id); ``long`` if one covers enough of the model."""
    table = written(in_parts(written(pairs)).join(sequences.select("id", "seq"), "id"))

    def run(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(model):
            p = profile_from(model.iloc[0])
            for name, seq in zip(part.id, part.seq, strict=True):
                for h in kernels.domains(p, seq, database, e_value):
                    size = h.env_to - h.env_from + 1
                    named = name if size == len(seq) else f"{name}/{h.env_from}_{h.env_to}"
                    out.append((model.family.iloc[0], name, named, h.e_value, h.env_from, h.env_to, bool(size >= fraction * p.length), seq[h.env_from - 1 : h.env_to]))
        return pd.DataFrame(out, columns=["family", "id", "name", "e_value", "env_from", "env_to", "long", "residues"])

    return table.groupBy("family", "part").cogroup(for_parts(found, table).groupBy("family", "part")).applyInPandas(run, HIT)


_COMPACT = "family string, e_value double, name string, own string, extra array<struct<at:int,text:string>>"


def _spread(compacts: DataFrame) -> DataFrame:
    """(ROW) of compact rows: each row padded to the widest insertion of its family."""
    compacts = written(compacts)
    widest = compacts.select("family", F.explode("extra").alias("x")).groupBy("family", "x.at").agg(F.max(F.length("x.text")).alias("w"))
    widths = widest.groupBy("family").agg(F.collect_list(F.struct("at", "w")).alias("widths"))  # a number for each column at most

    def run(frames):
        for df in frames:
            df["aligned"] = [
                spread(own, {x["at"]: x["text"] for x in extra}, {x["at"]: x["w"] for x in ([] if w is None else w)}) for own, extra, w in zip(df.own, df.extra, df.widths, strict=True)
            ]
            yield df[["family", "e_value", "name", "aligned"]]

    return compacts.join(widths, "family", "left").mapInPandas(run, ROW)


def _compacts(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(
        [(f, e, n, own, [{"at": at, "text": text} for at, text in extra]) for f, e, n, (own, extra) in rows], columns=["family", "e_value", "name", "own", "extra"]
    )


def aligned_to(found: DataFrame, hits: DataFrame) -> DataFrame:
    """(ROW): hits aligned to their family's model."""
    table = in_parts(hits.select("family", "e_value", "name", "residues"))

    def run(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(model):
            return _compacts([])
        p = profile_from(model.iloc[0])
        return _compacts([(f, e, n, compact(_global(p.scores[:, coded(s)]), s, p.length)) for f, e, n, s in zip(part.family, part.e_value, part.name, part.residues, strict=True)])

    table = written(table)
    return _spread(table.groupBy("family", "part").cogroup(for_parts(found, table).groupBy("family", "part")).applyInPandas(run, _COMPACT))


def star(members: DataFrame) -> DataFrame:
    """(ROW): members (family, id, seq) aligned to the longest of them (of equal ones the first id)."""
    centre = members.groupBy("family").agg(F.min(F.struct((-F.length("seq")).alias("n"), "id", "seq")).alias("c")).select("family", F.col("c.seq").alias("centre"))

    def run(frames):
        for df in frames:
            out = []
            for f, name, seq, mid in zip(df.family, df.id, df.seq, df.centre, strict=True):
                a, b = coded(mid), coded(seq)
                same = [(k, k) for k in range(len(a))] if seq == mid else _global(np.where(a[:, None] == b[None], MATCH, MISMATCH))
                out.append((f, 0.0, name, compact(same, seq, len(a))))
            yield _compacts(out)

    # dealt by row: a small file is one task, whose every row is an alignment
    return _spread(members.join(centre, "family").repartition("family", "id").mapInPandas(run, _COMPACT))


def first_rows(rows: DataFrame) -> DataFrame:
    """(family, residues): how many residues each family's first row has."""
    first = rows.groupBy("family").agg(F.min_by(F.length(scalar.strip_gaps(F.col("aligned"))), F.struct("e_value", "name")).alias("residues"))
    return first


def kept_rows(rows: DataFrame, limits: DataFrame, size: int = PART) -> DataFrame:
    """Rows (ROW) that the greedy choice keeps at their family's ``identity`` (limits: family, identity)."""
    gaps = F.length("aligned") - F.length(scalar.strip_gaps(F.col("aligned")))
    left = written(rows.join(limits, "family").withColumn("gaps", gaps))
    kept = []
    while True:
        order = Window.partitionBy("family").orderBy("gaps", "e_value", "name")
        block = left.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= size).drop("_r")

        def choose(df: pd.DataFrame) -> pd.DataFrame:
            df = df.sort_values(["gaps", "e_value", "name"]).reset_index(drop=True)
            return df.iloc[np.sort(unlike(letters_of(list(df.aligned)), np.arange(len(df)), df.identity.iloc[0]))]

        block = written(block)
        kept.append(written(block.groupBy("family").applyInPandas(choose, left.schema)))
        rest = left.join(block.select("family", "name"), ["family", "name"], "left_anti")
        parts = written(in_parts(rest, size))
        if parts.isEmpty():
            break

        def apart(part: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
            if not len(part):
                return part[names]
            against = letters_of(list(chosen.aligned))
            stays = [not (alike(against, row) >= part.identity.iloc[0]).any() for row in letters_of(list(part.aligned))]
            return part.loc[stays, names]

        names = left.columns
        left = written(parts.groupBy("family", "part").cogroup(for_parts(kept[-1], parts).groupBy("family", "part")).applyInPandas(apart, left.schema))
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out.select("family", "e_value", "name", "aligned")


def trimmed(rows: DataFrame, identity: float, most: int, size: int = PART) -> DataFrame:
    """Rows of which no two are ``identity`` or more alike, the longest first; a family that has more
    than ``most`` gets the highest lower identity (in hundredths) at which it has no more."""
    out = kept_rows(rows, rows.select("family", F.lit(float(identity)).alias("identity")).distinct(), size)
    out = written(out)
    counted = lambda df: df.groupBy("family").agg(F.count("*").alias("n"))
    over = written(counted(out).filter(F.col("n") > most).select("family", F.lit(0).alias("low"), F.lit(round(identity * 100)).alias("high")))
    if over.isEmpty():
        return out
    many = written(out.join(over.select("family"), "family", "left_semi"))
    middle = F.expr("(low + high) DIV 2")
    at = lambda df, c: df.select("family", (F.col(c) / 100).alias("identity"))
    while not over.filter("high - low > 1").isEmpty():
        state = over.withColumn("middle", middle)
        n = counted(kept_rows(many, at(state, "middle"), size))
        fits = F.col("n") <= most
        over = written(state.join(n, "family").select("family", F.when(fits, F.col("middle")).otherwise(F.col("low")).cast("int").alias("low"), F.when(fits, F.col("high")).otherwise(F.col("middle")).cast("int").alias("high")))
    return out.join(over.select("family"), "family", "left_anti").unionByName(kept_rows(many, at(over, "low"), size))


def clipped(rows: DataFrame, occupancy: float, exclusive_end: bool) -> DataFrame:
    """Rows without columns that none of them fills, cut to the first and last column over the occupancy."""
    share = written(alignments.occupancy(rows.withColumn("aligned", F.translate("aligned", ".~", "--"))).filter("occupancy > 0"))
    ends = share.groupBy("family").agg(
        F.coalesce(F.min(F.when(F.col("occupancy") > occupancy, F.col("pos"))), F.min("pos")).alias("a"), F.coalesce(F.max(F.when(F.col("occupancy") > occupancy, F.col("pos"))), F.max("pos")).alias("b")
    )
    inside = (F.col("pos") >= F.col("a")) & ((F.col("pos") < F.col("b")) if exclusive_end else (F.col("pos") <= F.col("b")))
    columns = share.join(ends, "family").filter(inside).groupBy("family").agg(F.array_sort(F.collect_list("pos")).alias("columns"))

    def run(frames):
        for df in frames:
            df["aligned"] = [letters_of([a])[0][np.asarray(c, int)].tobytes().decode() for a, c in zip(df.aligned, df["columns"], strict=True)]
            yield df[["family", "e_value", "name", "aligned"]]

    return rows.join(columns, "family").mapInPandas(run, ROW)


def _bad_length(residues: Column, config: Config) -> Column:
    return F.when(residues < config.min_rep_length, F.lit(TOO_SMALL)).when(residues > config.max_rep_length, F.lit(TOO_LARGE))


RESULT = "representative string, status string, value double, converged boolean, consensus string, rf string, size int"


def grown(clusters: DataFrame, sequences: DataFrame, config: Config = Config(), kernels: Kernels | None = None, size: int = PART, searched=None) -> Grown:
    """Every cluster (representative, member) as a family or with the reason why it is none.

    ``searched`` (models, sequences) gives the pairs that a search looks at, :func:`words.candidates` unless given."""
    kernels = kernels or Kernels()
    sequences = sequences.filter("id IS NOT NULL AND seq IS NOT NULL")
    searched = searched or (lambda found, seqs: words.candidates(columns_of(found), seqs))
    database = sequences.count()
    clusters = written(clusters.select(F.col("representative").alias("family"), F.col("member").alias("id")))
    seeds = written(star(clusters.join(sequences.select("id", "seq"), "id")))
    active, over, leaving, seen = written(clusters.select("family").distinct()), [], [], None

    def ended(families: DataFrame, status: Column, value: Column) -> None:
        over.append(written(families.select("family", status.alias("status"), value.cast("double").alias("value"))))

    def without(df: DataFrame, *gone: DataFrame) -> DataFrame:
        for g in gone:
            df = df.join(g.select("family"), "family", "left_anti")
        return df

    def hits_of(found: DataFrame) -> DataFrame:
        pairs = searched(found, sequences).select("family", "id").unionByName(clusters.join(found.select("family"), "family", "left_semi")).distinct()
        return written(search(found, pairs, sequences, database, kernels, config.recruit_e_value, config.recruit_length_fraction))

    for turn in range(1, ROUNDS + 1):
        if active.isEmpty():
            break
        found = written(models(seeds, config.gap_occupancy, kernels))
        hits = hits_of(found)
        recruits = hits.filter("long")
        some = recruits.select("family").distinct()
        ended(without(active, some), F.lit(NO_HITS), F.lit(0.0))
        names = written(recruits.select("family", F.col("id").alias("protein")).distinct())
        fresh = names if seen is None else names.join(seen, ["family", "protein"], "left_anti")
        growing = written(fresh.select("family").distinct())
        settled = written(without(some, growing))
        leaving.append((found, hits, seeds, settled, True))
        seen = written(names if seen is None else seen.unionByName(names).distinct())
        rows = written(aligned_to(found.join(growing, "family", "left_semi"), recruits.join(growing, "family", "left_semi")))
        bad = first_rows(rows).withColumn("status", _bad_length(F.col("residues"), config)).filter("status IS NOT NULL")
        bad = written(bad)
        ended(bad, F.col("status"), F.col("residues"))
        active = written(without(growing, bad))
        trim = written(trimmed(rows.join(active, "family", "left_semi"), config.max_seed_identity, config.max_seed_sequences, size))
        seeds = written(clipped(trim, config.gap_occupancy, config.quirks.exclusive_clip_end))
        if turn == ROUNDS:
            leaving.append((found, hits, seeds, active, False))
    results, all_rows, all_seeds = [], [], []
    for found, hits, own_seeds, families, converged in leaving:
        if families.isEmpty():
            continue
        own = own_seeds.join(families, "family", "left_semi")
        stored = written(models(own, config.gap_occupancy, kernels))
        if config.quirks.final_search_fast_model:
            last, hits = found.join(families, "family", "left_semi"), hits.join(families, "family", "left_semi")
        else:
            last, hits = stored, hits_of(stored)
        some = hits.select("family").distinct()
        ended(without(families, some), F.lit(NO_HITS), F.lit(0.0))
        base = clusters.join(some, "family", "left_semi").withColumn("protein", scalar.base_name(F.col("id")))
        had = hits.select("family", scalar.base_name(F.col("id")).alias("protein")).distinct()
        listed = base.groupBy("family").agg(F.count("*").alias("listed"))
        common = base.select("family", "protein").distinct().join(had, ["family", "protein"], "left_semi").groupBy("family").agg(F.count("*").alias("common"))
        share = written(listed.join(common, "family", "left").select("family", (F.coalesce("common", F.lit(0)) / F.col("listed")).alias("share")))
        few = share.filter(F.col("share") < config.min_starting_membership)
        ended(few, F.lit(FEW), F.col("share"))
        stay = share.filter(F.col("share") >= config.min_starting_membership)
        rows = written(aligned_to(last.join(stay, "family", "left_semi"), hits.join(stay, "family", "left_semi")))
        bad = written(first_rows(rows).withColumn("status", _bad_length(F.col("residues"), config)).filter("status IS NOT NULL"))
        ended(bad, F.col("status"), F.col("residues"))
        fine = without(stay, bad)
        count = rows.groupBy("family").agg(F.count("*").cast("int").alias("size"))
        results.append(fine.join(count, "family").join(stored, "family").select(F.col("family").alias("representative"), F.lit("ok").alias("status"), F.col("share").alias("value"), F.lit(converged).alias("converged"), "consensus", "rf", "size"))
        all_rows.append(without(rows, bad))
        all_seeds.append(own.join(fine.select("family"), "family", "left_semi"))
    lost = [o.select(F.col("family").alias("representative"), "status", "value", F.lit(False).alias("converged"), F.lit(None).cast("string").alias("consensus"), F.lit(None).cast("string").alias("rf"), F.lit(0).alias("size")) for o in over]
    table = lambda schema, parts: edges.pooled(sequences.sparkSession.createDataFrame([], schema), *parts)
    return Grown(written(table(RESULT, results + lost)), _ordered(table(ROW, all_rows)), _ordered(table(ROW, all_seeds)))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with numbers that ascend by family, E-value and name: a range sort, not a task for a family."""
    sorted_rows = rows.orderBy("family", "e_value", "name").withColumn("n", F.monotonically_increasing_id())
    return written(sorted_rows.select(F.col("family").alias("representative"), "n", "name", "aligned"))


def discarded(results: DataFrame) -> DataFrame:
    return results.filter("status <> 'ok'").select(F.col("representative").alias("rep"), F.col("status").alias("reason"), "value")
