"""Domain architectures of families."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar

# fixed values: where links of domains lead
DOMAIN_LINK = "https://www.ebi.ac.uk/interpro/entry/pfam/"


def architectures(members: DataFrame, lookup: DataFrame, by_model_start: bool = True) -> DataFrame:
    """(family, architecture): one per looked-up protein of a family, domains and the
    family itself in the order of their starts, tab between names. ``members``:
    family, member; ``lookup``: family, protein_id, domains (JSON list of hits)."""
    m = members.select("family", scalar.protein_id(F.col("member")).alias("protein_id"), scalar.family_start(F.col("member")).alias("start"))
    starts = m.groupBy("family", "protein_id").agg(F.collect_list("start").alias("starts"))
    joined = lookup.join(starts, ["family", "protein_id"], "left")
    hits = F.coalesce(F.from_json("domains", "array<array<string>>"), F.array().cast("array<array<string>>"))
    at = F.element_at if not by_model_start else None
    place = (lambda h: h[3]) if at is None else (lambda h: at(h, -2))
    own = F.transform(F.coalesce("starts", F.array().cast("array<int>")), lambda s: F.struct(s.cast("int").alias("start"), F.col("family").cast("string").alias("name")))
    others = F.transform(hits, lambda h: F.struct(place(h).cast("int").alias("start"), h[0].alias("name")))
    ordered = F.array_sort(F.concat(others, own))
    return joined.select("family", F.array_join(F.transform(ordered, lambda d: d["name"]), "\t").alias("architecture"))


def top(archs: DataFrame, n: int = 15) -> DataFrame:
    """(family, architecture, count, rank): the most frequent architectures of each
    family; ties go by architecture text."""
    return ranked(archs.groupBy("family", "architecture").agg(F.count("*").alias("count")), n)


def ranked(counts: DataFrame, n: int = 15) -> DataFrame:
    """The same of counted architectures, whatever columns they have besides."""
    w = Window.partitionBy("family").orderBy(F.desc("count"), "architecture")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def documents(ranked: DataFrame, names: DataFrame, prefix: str = "FAM", family_name: str = "Family", family_link: str = "/details/", strict: bool = True) -> DataFrame:
    """(family, json): the ranked architectures with names, links and colours."""
    each = ranked.select("family", "rank", "count", F.posexplode(F.split("architecture", "\t")).alias("pos", "id"))
    joined = each.join(names.select("id", F.col("name").alias("known")), "id", "left")
    is_domain = F.contains("id", F.lit("PF"))
    known = F.coalesce("known", F.raise_error(F.concat(F.lit("no name of "), "id")).cast("string")) if strict else F.coalesce("known", "id")
    name = F.when(is_domain, known).otherwise(F.concat(F.lit(family_name), "id"))
    link = F.when(is_domain, F.concat(F.lit(DOMAIN_LINK), "id")).otherwise(F.concat(F.lit(family_link), scalar.formatted_id(F.col("id"), prefix)))
    color = scalar.string_color(F.when(is_domain, known).otherwise(F.col("id")))
    domain = joined.select("family", "rank", "count", "pos", "id", color.alias("color"), link.alias("link"), name.alias("name"))
    domain = domain.withColumn("font_color", scalar.font_color(F.col("color")))
    item = F.struct("pos", F.struct("id", "color", "link", "name", "font_color").alias("d"))
    lists = domain.groupBy("family", "rank", "count").agg(F.array_sort(F.collect_list(item)).alias("items"))
    container = F.struct("rank", F.struct(F.col("count").cast("string").alias("architecture_text"), F.transform("items", lambda i: i["d"]).alias("domains")).alias("c"))
    whole = lists.groupBy("family").agg(F.array_sort(F.collect_list(container)).alias("all"))
    return whole.select("family", F.to_json(F.struct(F.transform("all", lambda c: c["c"]).alias("architecture_containers"))).alias("json"))
