"""Alignment rows as a table: occupancy, clipping, renaming."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from . import kernels


def occupancy(rows: DataFrame, family: str = "family", aligned: str = "aligned", gap: str = "-") -> DataFrame:
    """(family, pos, occupancy): share of a family's rows with a residue in each
    column, 0-based. ``gap`` is one ASCII character; a row without text counts as a row.

    Batches of rows become sums by column before they are shuffled, a row for each column
    and not for each character, so a large family is not gathered."""
    if len(gap.encode()) != 1:
        raise ValueError("gap must be one ASCII character")
    known = rows.filter(F.col(family).isNotNull())
    n = known.groupBy(family).agg(F.count("*").alias("rows"))

    def summed(batches):
        for batch in batches:
            for part in _slices(batch, 1 << 22):
                yield _column_sums(part, gap)

    kind = dict(rows.dtypes)[family]
    sums = known.select(F.col(family).alias("_family"), F.coalesce(F.col(aligned), F.lit("")).alias("_aligned")).mapInArrow(summed, f"_family {kind}, pos int, filled long")
    filled = sums.groupBy(F.col("_family").alias(family), "pos").agg(F.sum("filled").alias("filled"))
    return filled.join(n, family).select(family, "pos", (F.col("filled") / F.col("rows")).alias("occupancy"))


def _slices(batch: pa.RecordBatch, limit: int):
    """Slices of a batch of about ``limit`` bytes of text each, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, n = 0, batch.num_rows
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _column_sums(batch: pa.RecordBatch, gap: str) -> pa.RecordBatch:
    """(family, pos, filled) of rows (family, aligned); positions count characters."""
    text = batch.column(1).cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    first = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(first, offsets - offsets[0])
    length = np.diff(at)
    named = batch.column(0).dictionary_encode()
    code = named.indices.to_numpy(zero_copy_only=False)
    width = np.zeros(len(named.dictionary), np.int64)
    np.maximum.at(width, code, length)
    base = np.cumsum(width) - width
    place = np.repeat(base[code] - at[:-1], length) + np.arange(len(first))
    filled = np.bincount(place[data[first] != ord(gap)], minlength=int(width.sum()))
    pos = np.arange(len(filled)) - np.repeat(base, width)
    family = named.dictionary.take(pa.array(np.repeat(np.arange(len(width)), width)))
    return pa.RecordBatch.from_arrays([family, pa.array(pos.astype(np.int32)), pa.array(filled.astype(np.int64))], names=["_family", "pos", "filled"])


def residue_counts(rows: DataFrame) -> DataFrame:
    """(family, pos, residue, filled): how many rows of a family have each kind of residue (its
    place among the amino acids, 20 for any other) in each column, 0-based; gaps don't count.
    Batches become sums before they are shuffled."""
    known = rows.filter("family IS NOT NULL AND aligned IS NOT NULL")

    def summed(batches):
        for batch in batches:
            for part in _slices(batch, 1 << 20):
                named = part.column(0).dictionary_encode()
                code = named.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(code, kind="stable")
                texts = part.column(1).take(pa.array(order)).to_pylist()
                ends = np.searchsorted(code[order], np.arange(len(named.dictionary) + 1))
                for k, family in enumerate(named.dictionary.to_pylist()):
                    own = texts[ends[k] : ends[k + 1]]
                    width = max(map(len, own))
                    letters = np.frombuffer("".join(a.ljust(width, "-") for a in own).encode("ascii", "replace"), np.uint8).reshape(len(own), width)
                    row, pos = np.nonzero(~np.isin(letters, list(kernels.GAPS)))
                    n = np.bincount(pos * 21 + kernels.RESIDUE[letters[row, pos]])
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([family] * len(at), part.schema.field(0).type), pa.array((at // 21).astype(np.int32)), pa.array((at % 21).astype(np.int32)), pa.array(n[at])],
                        names=["family", "pos", "residue", "filled"],
                    )

    sums = known.select("family", "aligned").mapInArrow(summed, f"family {dict(rows.dtypes)['family']}, pos int, residue int, filled long")
    return sums.groupBy("family", "pos", "residue").agg(F.sum("filled").alias("filled"))


def clip_range(columns: DataFrame, threshold: float = 0.5, family: str = "family", exclusive_end: bool = True) -> DataFrame:
    """(family, start, end) of the first and last column over the threshold, 0 and
    the last column if none is. With ``exclusive_end`` the end column itself is
    not kept."""
    over = F.col("occupancy") > threshold
    got = columns.groupBy(family).agg(F.min(F.when(over, F.col("pos"))).alias("a"), F.max(F.when(over, F.col("pos"))).alias("b"), F.max("pos").alias("last"))
    end = F.coalesce("b", "last")
    return got.select(family, F.coalesce("a", F.lit(0)).alias("start"), (end if exclusive_end else end + 1).alias("end"))


def clipped(rows: DataFrame, ranges: DataFrame, family: str = "family", aligned: str = "aligned") -> DataFrame:
    joined = rows.join(ranges, family)
    return joined.withColumn(aligned, F.substr(aligned, F.col("start") + 1, F.col("end") - F.col("start"))).drop("start", "end")


def renumbered(rows: DataFrame, sequences: DataFrame, cut: bool = True) -> DataFrame:
    """Alignment rows (family, n, name, aligned) with names as `id/from-to`, found
    by their residues in the source; a name seen before in its family is dropped."""
    raw = scalar.base_name(F.col("name"))
    r = rows.withColumn("raw", raw).withColumn("residues", scalar.strip_gaps(F.col("aligned")))
    r = r.join(sequences.select(F.col("id").alias("raw"), F.col("seq").alias("source")), "raw")
    start = scalar.find(F.col("source"), F.col("residues"))
    new = scalar.renamed_member(F.col("raw"), F.length("residues"), F.length("name"), F.length("source"), start, cut)
    named = r.withColumn("new_name", new)
    w = Window.partitionBy("family", F.rtrim("new_name")).orderBy("n")
    return named.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("family", "n", F.col("new_name").alias("name"), "aligned", "residues")


def family_tables(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of renumbered rows: members (family, member), first rows (family, rep,
    region, rep_length, sequence), representatives (id, description, seq)."""
    members = rows.select("family", F.col("name").alias("member"))
    first = rows.groupBy("family").agg(F.min_by(F.struct("name", "residues"), "n").alias("r"))
    name = F.col("r.name")
    region = F.when(F.contains(name, F.lit("/")), F.trim(F.split_part(name, F.lit("/"), F.lit(2)))).otherwise("-")
    meta = first.select("family", scalar.base_name(name).alias("rep"), region.alias("region"), F.length("r.residues").alias("rep_length"), F.col("r.residues").alias("sequence"))
    reps = first.select(F.rtrim(name).alias("id"), F.col("family").alias("description"), F.col("r.residues").alias("seq"))
    return members, meta, reps
