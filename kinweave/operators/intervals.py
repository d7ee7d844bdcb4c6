"""Interval complement: the unannotated slices of a sequence.

All of it happens within a row, by sorting and folding the row's regions: no
shuffle, no window, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar

REGIONS = "array<struct<a:int,b:int>>"


def merged(regions: Column) -> Column:
    """Sorted regions with overlapping ones merged (adjacent ones are not)."""
    empty = F.array().cast(REGIONS)

    def step(acc: Column, r: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))))
        return F.when(F.size(acc) == 0, F.array(r)).when(r["a"] > last["b"], F.concat(acc, F.array(r))).otherwise(joined).cast(REGIONS)

    return F.aggregate(F.array_sort(regions), empty, step)


def gaps(regions: Column, length: Column, min_length: int) -> Column:
    """1-based closed gaps of ``min_length`` residues or more between the regions
    and after the last one."""
    acc0 = F.struct(F.lit(1).alias("at"), F.array().cast(REGIONS).alias("out"))

    def gap(a: Column, b: Column) -> Column:
        return F.when(b - a + 1 >= min_length, F.array(F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))).otherwise(F.array().cast(REGIONS))

    def step(acc: Column, r: Column) -> Column:
        # a running maximum of the ends is the merge
        return F.struct(F.greatest(acc["at"], r["b"] + 1).alias("at"), F.concat(acc["out"], gap(acc["at"], r["a"] - 1)).alias("out"))

    folded = F.aggregate(F.array_sort(regions), acc0, step)
    return F.transform(F.array(folded), lambda x: F.concat(x["out"], gap(x["at"], length)))[0]


def annotation(metadata: Column) -> tuple[Column, Column, Column]:
    """(is JSON, has annotation keys, regions) of a metadata payload. A hit's
    region is its last two items, whatever the number of items."""
    parsed = F.try_parse_json(metadata)
    lists = "array<array<string>>"
    hits = [F.coalesce(F.from_json(F.get_json_object(metadata, f"$.{k}"), lists), F.array().cast(lists)) for k in ("p", "m")]
    regions = F.transform(F.concat(*hits), lambda r: F.struct(F.element_at(r, -2).cast("int").alias("a"), F.element_at(r, -1).cast("int").alias("b")))
    keys = F.json_object_keys(metadata)
    has = F.coalesce(F.arrays_overlap(keys, F.array(F.lit("p"), F.lit("m"))), F.lit(False))
    return parsed.isNotNull(), has, regions


def unannotated_slices(proteins: DataFrame, min_length: int = 100) -> DataFrame:
    """(id, seq): slices of annotated proteins named `id_from_to`, and whole
    proteins without annotation keys under their own id. Rows whose metadata is
    not JSON are skipped. A protein with an empty annotation list still gets a region."""
    ok, has, regions = annotation(F.col("metadata"))
    return slices_of(proteins.filter(ok).select("protein_id", "sequence", has.alias("has"), regions.cast(REGIONS).alias("regions")), min_length)


def slices_of(typed: DataFrame, min_length: int) -> DataFrame:
    """The same of rows (protein_id, sequence, has, regions)."""
    whole = F.array(F.struct(F.lit(1).alias("a"), F.length("sequence").alias("b"))).cast(REGIONS)
    long_enough = F.when(F.length("sequence") >= min_length, whole).otherwise(F.array().cast(REGIONS))
    cut = typed.select(
        "protein_id", "sequence", "has", F.explode(F.when(F.col("has"), gaps(F.col("regions"), F.length("sequence"), min_length)).otherwise(long_enough)).alias("g")
    )
    name = F.when(F.col("has"), F.concat_ws("_", "protein_id", "g.a", "g.b")).otherwise(F.col("protein_id"))
    return cut.select(name.alias("id"), scalar.span(F.col("sequence"), F.col("g.a"), F.col("g.b")).alias("seq"))
