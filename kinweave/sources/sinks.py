"""Sinks: FASTA, reports with header blocks, JSON, CIF metrics, serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..storage import written


def fasta(df: DataFrame, path: str, id_col: str = "id", seq_col: str = "seq") -> None:
    df.select(F.concat(F.lit(">"), id_col, F.lit("\n"), seq_col)).write.text(path)


def by_family(lines: DataFrame, path: str) -> None:
    """Write text lines (family, n, value) to a folder for each family, in the order of n. Families are dealt by
    ranges, each to one task that sorts it (spilling) and writes one file: readers take a file's record as
    one value, so a family cut into several files would come back in pieces."""
    ordered = lines.repartitionByRange("family").sortWithinPartitions("family", "n")
    ordered.select("family", "value").write.mode("overwrite").partitionBy("family").text(path)


def concatenated(spark: SparkSession, files: str, path: str, header: bool = False) -> None:
    """Write text files one after another, in the order of their paths: the files under ``path``, in
    the order of their names, hold the same lines as the plain concatenation. ``header``: files begin with
    the same line, which is kept once. Files are read in splits and written by a range sort,
    so neither a file nor the whole passes through one task."""
    lines = spark.read.text(files).select(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("at"), "value")
    lines = written(lines)
    if header:
        first = lines.groupBy("at.file").agg(F.min("at").alias("at"))
        top = F.broadcast(first.agg(F.min("at").alias("_top")))  # one row
        others = first.crossJoin(top).filter("at <> _top").select("at")
        lines = lines.join(others, "at", "left_anti")
    lines.orderBy("at").select("value").write.mode("overwrite").text(path)


def stockholm_lines(rows: DataFrame, width: int | None = None) -> DataFrame:
    """(family, n, value): alignment rows (family, n, name, aligned) as the lines of a Stockholm
    alignment, `#=GC RF` after the others, in blocks of ``width`` columns if given.

    ``n`` is (block, row), so no alignment is gathered for its layout."""
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("aligned") / width) - 1, F.lit(0)).cast("int")) if width else F.array(F.lit(0))
    each = rows.select("family", "n", "name", "aligned", F.explode(blocks).alias("block"))
    part = F.substr("aligned", F.col("block") * width + 1, F.lit(width)) if width else F.col("aligned")
    last = F.when(F.col("name") == "#=GC RF", 1).otherwise(0)
    line = F.concat(F.rpad("name", F.greatest(F.length("name"), F.lit(29)), " "), F.lit(" "), part)
    place = lambda block, kind, n: F.struct(block.cast("int").alias("block"), kind.cast("int").alias("kind"), n.cast("long").alias("n")).alias("n")
    body = each.select("family", place(F.col("block"), last, F.col("n")), line.alias("value"))
    families = rows.select("family").distinct()
    lowest, highest = F.lit(-(1 << 31)), F.lit((1 << 31) - 1)
    head = families.select("family", place(lowest, F.lit(0), F.lit(0)), F.concat(F.lit("# STOCKHOLM 1.0\n#=GF ID "), F.col("family").cast("string"), F.lit("\n")).alias("value"))
    return body.unionByName(head).unionByName(families.select("family", place(highest, F.lit(0), F.lit(0)), F.lit("//").alias("value")))


def model_text(models: DataFrame) -> DataFrame:
    """(family, value): models (family, length, scores, consensus, rf) as text, a line for each column.
    Scores are written in full, so :func:`text.models` reads back what was written."""
    line = lambda i: F.concat(F.lit(" "), i.cast("string"), F.lit(" "), F.array_join(F.transform(F.slice("scores", (i - 1) * 21 + 1, F.lit(21)), lambda x: x.cast("string")), " "))
    columns = F.when(F.col("length") > 0, F.transform(F.sequence(F.lit(1), F.greatest("length", F.lit(1))), line)).otherwise(F.array().cast("array<string>"))
    head = [F.concat(F.lit(f"{key} "), F.col(c).cast("string")) for key, c in (("NAME ", "family"), ("LENG ", "length"), ("CONS ", "consensus"), ("RF   ", "rf"))]
    return models.select("family", F.array_join(F.concat(F.array(*head, F.lit("ALPH  amino")), columns, F.array(F.lit("//"))), "\n").alias("value"))


def report_lines(df: DataFrame, ident: str, section: str, description: str, plot: str = "table", order: list[str] | None = None) -> DataFrame:
    """Text lines (n, value) of a report: a `#` header block, column names, rows."""
    spark = df.sparkSession
    head = [f'# id: "{ident}"', f'# section_name: "{section}"', f'# description: "{description}"', '# format: "csv"', f'# plot_type: "{plot}"', ",".join(df.columns)]
    top = spark.createDataFrame([(i - len(head), h) for i, h in enumerate(head)], "n long, value string")
    from ..operators import edges

    text = df.select(F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]).alias("value"), *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order or df.columns)])
    rows = edges.numbered(text, [c for c in text.columns if c != "value"], "n").select("n", "value")
    return top.unionByName(rows)


def report(df: DataFrame, path: str, ident: str, section: str, description: str, **options) -> None:
    """One report file; reports are small tables."""
    report_lines(df, ident, section, description, **options).orderBy("n").coalesce(1).select("value").write.text(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def serving_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty serving tables."""
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.SERVING.items()}


def typed(df: DataFrame, table: str) -> DataFrame:
    """Rows as the serving table has them: missing columns are null, blanks become
    null, values that don't cast become null."""
    out = []
    for field in schemas.SERVING[table].split(", "):
        name, kind = field.split(" ")
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
        elif kind == "binary":
            out.append(F.when(F.octet_length(name) > 0, F.col(name).cast("binary")).alias(name))
        else:
            text = F.col(name).cast("string")
            out.append((F.when(F.trim(text) != "", text).try_cast(kind) if kind != "string" else F.when(F.trim(text) != "", text)).alias(name))
    return df.select(*out)


def child_rows(df: DataFrame, table: str, family_col: str = "id") -> DataFrame:
    """Rows of a child table: the exported `id` is the family's; rows get ids of their own."""
    from ..operators import edges

    named = df.withColumnRenamed(family_col, "family_id")
    order = [c for c in named.columns]
    return typed(edges.numbered(named, order, "id"), table)


def keyed(df: DataFrame, table: str, order: str, stored: DataFrame | None = None, blank_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows that may enter a serving table under its integer key, and those that may not with a ``reason``.

    ``not a key``: the key is no integer (a header row among the data); ``no key``: it is null or
    blank; ``repeated key``: an earlier row, by ``order``, has it; ``known key``: ``stored`` has
    it. So an import that runs again adds nothing. ``blank_text``: empty fields of text columns
    stay empty instead of null. The first row of a key is found by a partial aggregation."""
    key = F.trim(F.col("id").cast("string"))
    marked = df.withColumn("_key", key.try_cast("bigint")).withColumn(
        "reason", F.when(F.coalesce(key, F.lit("")) == "", "no key").when(key.try_cast("bigint").isNull(), "not a key")
    )
    # rows without a key join nothing: as nulls they would all go to one task
    none, own = marked.filter("reason IS NOT NULL"), marked.filter("reason IS NULL")
    first = own.groupBy("_key").agg(F.min(order).alias("_first"))
    judged = own.join(first, "_key", "left").withColumn("reason", F.when(F.col(order) > F.col("_first"), "repeated key"))
    if stored is not None:
        known = stored.select(F.col("id").alias("_key"), F.lit("known key").alias("_known")).distinct()
        judged = judged.join(known, "_key", "left").withColumn("reason", F.coalesce("reason", "_known"))
    good = typed(judged.filter("reason IS NULL"), table)
    if blank_text:
        texts = [f.split(" ")[0] for f in schemas.SERVING[table].split(", ") if f.endswith(" string")]
        kept = judged.filter("reason IS NULL").select("_key", *[F.col(c).alias(f"_{c}") for c in texts if c in df.columns])
        good = good.join(kept, good["id"] == kept["_key"]).select(*[F.col(f"_{c}").alias(c) if f"_{c}" in kept.columns else F.col(c) for c in good.columns])
    bad = [part.select(*[f"`{c}`" for c in df.columns], "reason") for part in (none, judged.filter("reason IS NOT NULL"))]
    return good, bad[0].unionByName(bad[1])


def import_keyed(df: DataFrame, table: str, path: str, order: str, blank_text: bool = False) -> DataFrame:
    """Append to the table under ``path`` what its key allows; the other rows go to ``<table>_rejected``,
    which holds those of the last import, and are returned."""
    spark, where = df.sparkSession, f"{path}/{table}"
    spark.createDataFrame([], schemas.SERVING[table]).write.mode("ignore").parquet(where)
    good, bad = keyed(df, table, order, spark.read.schema(schemas.SERVING[table]).parquet(where), blank_text)
    bad.write.mode("overwrite").parquet(f"{where}_rejected")
    good.write.mode("append").parquet(where)
    return spark.read.schema(bad.schema).parquet(f"{where}_rejected")


def import_serving(tables: dict[str, DataFrame], path: str) -> None:
    """Write serving tables as Parquet under ``path``."""
    for name, df in tables.items():
        typed(df, name).write.mode("append").parquet(f"{path}/{name}")


def update_blobs(families: DataFrame, blobs: dict[str, DataFrame]) -> DataFrame:
    """Families with blob columns taken from (id, blob) tables where there is one."""
    for name, df in blobs.items():
        if name not in schemas.BLOBS:
            raise ValueError(f"no blob column {name}")
        new = df.select("id", F.col(name).alias("_new"))
        families = families.join(new, "id", "left").withColumn(name, F.coalesce("_new", name)).drop("_new")
    return families


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode("append").save()


def manifest(spark: SparkSession, config, versions: dict[str, str]) -> DataFrame:
    """Run manifest: (kind, name, value) of all parameters and versions, distinct."""
    from dataclasses import asdict

    rows = [("parameter", k, str(v)) for k, v in asdict(config).items()] + [("version", k, v) for k, v in versions.items()]
    return spark.createDataFrame(sorted(set(rows)), "kind string, name string, value string")
