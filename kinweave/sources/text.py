"""Scans of the text formats that protein pipelines exchange.

Readers are DataFrame functions over ``spark.read``: a path may be a folder, a
glob, or compressed (gz, bz2; gz does not split, so repartition after it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalar


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def samples(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """Sample sheet of a mode; rows with an empty required field fail."""
    schema = schemas.SAMPLES[mode]
    df = spark.read.csv(path, header=True, schema=schema)
    for c in df.columns:
        df = df.withColumn(c, F.when(F.length(F.trim(c)) > 0, F.col(c)).otherwise(F.raise_error(F.lit(f"sample sheet: empty {c}")).cast("string")))
    return df


def proteins(spark: SparkSession, path: str, min_partitions: int | None = None, quoted_breaks: bool = False) -> DataFrame:
    """Protein CSV: header, quotes doubled, long fields; columns by position.
    ``quoted_breaks``: quoted fields may hold line breaks; files are then not split."""
    df = spark.read.csv(path, header=True, schema=schemas.PROTEIN, quote='"', escape='"', maxCharsPerColumn=-1, enforceSchema=True, multiLine=quoted_breaks)
    return df.repartition(min_partitions) if min_partitions else df


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, description, seq) of FASTA records; wrapped lines are joined. A record
    starts at a `>` that starts a line; one within a header belongs to it."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter(F.length(F.trim("value")) > 0)
    header = F.split_part("value", F.lit("\n"), F.lit(1))
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "")
    ident = F.regexp_extract(header, r"^(\S*)", 1)
    return raw.select(ident.alias("id"), F.regexp_replace(header, r"^\S*\s*|\s+$", "").alias("description"), body.alias("seq"))


def clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.CLUSTER)


def family_members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.FAMILY_MEMBER)


def refined_families(spark: SparkSession, path: str) -> DataFrame:
    """Per-chunk families with the chunk taken from the file name."""
    df = spark.read.csv(path, sep="\t", schema="iteration int, member string")
    return df.select(scalar.file_stem(F.col("_metadata.file_path")).alias("chunk"), "iteration", F.rtrim("member").alias("member"))


def family_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Per-chunk family rows as (family, size, rep, region, ...); rows of fewer
    than seven fields are skipped."""
    df = spark.read.csv(path, schema=schemas.FAMILY_METADATA)
    name = F.concat_ws("_", scalar.file_stem(F.col("_metadata.file_path")), "iteration")
    return df.select(name.alias("family"), *df.columns).filter("consensus IS NOT NULL")


def discarded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.DISCARDED)


def domtbl(spark: SparkSession, path: str) -> DataFrame:
    """Domain table of a profile search: white space between 22 fields, the last
    field takes the rest; `#` lines are comments. Rows with fewer fields are skipped."""
    lines = spark.read.text(path).filter(~F.startswith("value", F.lit("#")) & (F.length(F.trim("value")) > 0))
    parts = F.split(F.trim("value"), r"\s+", 23)
    fields = [f.strip().split(" ") for f in schemas.DOMTBL.split(",")]
    rows = lines.select(parts.alias("p")).filter(F.size("p") >= 22)
    return rows.select(*[F.try_element_at("p", F.lit(i + 1)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def fold_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.FOLD_HIT)


def similarities(spark: SparkSession, path: str) -> DataFrame:
    """Similarity report: header lines and the column line are dropped."""
    rows = spark.read.csv(path, schema="row string, family1 string, family2 string, score string", comment="#")
    return rows.filter(F.col("row").try_cast("int").isNotNull()).select(
        F.col("row").cast("int").alias("row"), "family1", "family2", F.col("score").cast("double").alias("score")
    )


def records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, value): records of text files between ``separator``, which is cut off; blank ones are left out. Files are
    split at separators, so a file of many records is read by many tasks and only a
    record must fit in memory."""
    each = spark.read.option("lineSep", separator).text(path).select(scalar.file_stem(F.col("_metadata.file_path")).alias("file"), "value")
    return each.filter(F.col("value").rlike(r"\S"))


def _reports(spark: SparkSession, path: str, combined: bool) -> DataFrame:
    """(id, value) of profile-profile reports: one in each file, named by the file, or (``combined``)
    many in a file, named by their query."""
    if not combined:
        return spark.read.text(path, wholetext=True).select(scalar.file_stem(F.col("_metadata.file_path")).alias("id"), "value")
    each = records(spark, path, "\nQuery ")
    return each.select(F.regexp_extract("value", r"^(?:Query )?\s*(\S+)", 1).alias("id"), "value")


def hhr_hits(spark: SparkSession, path: str, combined: bool = False) -> DataFrame:
    """Summary block of profile-profile reports: fixed-width rows after the ` No Hit`
    line, up to an empty line."""
    whole = _reports(spark, path, combined)
    block = F.regexp_extract("value", r"(?s)(?:^|\n) No Hit[^\n]*\n(.*)", 1)
    block = F.regexp_extract(block, r"(?s)^(.*?)(?:\n[ \t]*(?:\n|$)|$)", 1)
    rows = whole.select("id", F.posexplode(F.split(block, "\n")).alias("n", "l")).filter(F.length(F.trim("l")) > 0)
    cut = lambda a, b: F.trim(F.substring("l", a + 1, b - a))
    pfam = F.trim(F.split_part(F.trim(F.split_part(cut(4, 34), F.lit(";"), F.lit(1))), F.lit("."), F.lit(1)))
    return rows.select(
        "id", "n", pfam.alias("pfam"), cut(35, 40).alias("prob"), cut(41, 48).alias("e_value"), cut(70, 74).alias("length"),
        cut(75, 83).alias("query_hmm"), scalar.single_spaced(F.substring("l", 85, 15)).alias("template_hmm"),
    )


def hhr_descriptions(spark: SparkSession, path: str, combined: bool = False) -> DataFrame:
    """(id, pfam, name, description): the `>` lines of the reports, `;` between fields."""
    whole = _reports(spark, path, combined)
    lines = whole.select("id", F.posexplode(F.split("value", "\n")).alias("n", "l")).filter(F.startswith("l", F.lit(">")))
    part = lambda i: F.trim(F.coalesce(F.try_element_at(F.split(F.substring("l", 2, 1 << 30), ";"), F.lit(i)), F.lit("")))
    return lines.select("id", "n", part(1).alias("accession"), part(2).alias("name"), part(3).alias("description"))


def atoms(spark: SparkSession, path: str) -> DataFrame:
    """Atom lines of PDB files: (id, line, asym, comp, seq, b). The first line is
    skipped and reading stops at the first TER."""
    whole = spark.read.text(path, wholetext=True).select(scalar.file_stem(F.col("_metadata.file_path")).alias("id"), "value")
    body = F.regexp_replace("value", r"^[^\n]*\n?", "")
    body = F.regexp_extract(body, r"(?s)^(.*?)(?:(?:^|\n)TER|$)", 1)
    lines = whole.select("id", F.posexplode(F.split(body, "\n")).alias("line", "l")).filter(F.startswith("l", F.lit("ATOM")))
    cut = lambda a, b: F.trim(F.substring("l", a + 1, b - a))
    return lines.select("id", "line", cut(20, 22).alias("asym"), cut(17, 20).alias("comp"), cut(22, 26).alias("seq"), cut(60, 66).cast("double").alias("b"))


def secondary_structure(spark: SparkSession, path: str) -> DataFrame:
    """(id, conf, pred, aa) of `horiz` files: three kinds of lines, each concatenated."""
    whole = spark.read.text(path, wholetext=True).select(scalar.file_stem(F.col("_metadata.file_path")).alias("id"), "value")
    get = lambda k: F.array_join(F.transform(F.regexp_extract_all("value", F.lit(rf"(?m)^{k}:([^\n:]*)"), F.lit(1)), lambda x: _strip(x)), "")
    return whole.select("id", get("Conf").alias("conf"), get("Pred").alias("pred"), get("  AA").alias("aa"))


def three_line(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq, labels): records of three lines, the first one after `>`; other line counts fail.
    A record whose labels are not as long as its sequence is skipped. Files are split at records."""
    each = records(spark, path, "\n>")
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: _strip(x)), lambda x: F.length(x) > 0)
    checked = each.select(lines.alias("l")).select(
        F.when(F.size("l") % 3 == 0, F.col("l")).otherwise(F.raise_error(F.lit("not three lines per record")).cast("array<string>")).alias("l")
    )
    at = F.sequence(F.lit(0), F.size("l") - 1, F.lit(3))
    triples = F.transform(at, lambda i: F.struct(F.get("l", i).alias("h"), F.get("l", i + 1).alias("seq"), F.get("l", i + 2).alias("labels")))
    rows = checked.filter(F.size("l") > 0).select(F.explode(triples).alias("r"))
    name = F.regexp_replace(F.regexp_extract("r.h", r"^(\S*)", 1), "^>+", "")
    return rows.select(name.alias("id"), "r.seq", "r.labels").filter(F.length("seq") == F.length("labels"))


def structure_scores(spark: SparkSession, path: str) -> DataFrame:
    return scores_of(spark.read.text(path))


def scores_of(lines: DataFrame) -> DataFrame:
    """(id, plddt, ptm) of log lines (column value) with pLDDT: fields 11, 16 and
    18 between spaces or comma-spaces; `_` in the id becomes `/`."""
    p = F.split("value", r" |, ")
    got = lines.filter(F.contains("value", F.lit("pLDDT"))).select(p.alias("p"))
    at = lambda i: F.try_element_at("p", F.lit(i))
    return got.select(F.replace(at(11), F.lit("_"), F.lit("/")).alias("id"), at(16).try_cast("double").alias("plddt"), at(18).try_cast("double").alias("ptm"))


def failed_sequences(lines: DataFrame, message: str = "Failed (CUDA out of memory)") -> DataFrame:
    """Ids after the word `sequence` in the log lines of failed predictions."""
    name = F.regexp_extract("value", r"sequence (\S+)", 1)
    return lines.filter(F.contains("value", F.lit(message))).select(name.alias("id")).filter("id <> ''").distinct()


def retry_set(sequences: DataFrame, failed: DataFrame) -> DataFrame:
    """Sequences whose id, with `/` as `_`, is among the failed."""
    return sequences.join(failed.select(F.col("id").alias("_f")), F.replace("id", F.lit("/"), F.lit("_")) == F.col("_f"), "left_semi")


def stockholm(spark: SparkSession, path: str) -> DataFrame:
    """(alignment, n, name, aligned): rows of alignments in order; `#=GC RF` is a
    row named `#=GC RF`. Blocks of a wrapped alignment are joined. A file may hold many
    alignments, each ended by `//`, and is split there; an alignment is named by its
    `#=GF ID`, or by its file."""
    each = records(spark, path, "\n//")
    ident = F.regexp_extract("value", r"(?m)^#=GF\s+ID\s+(\S+)", 1)
    each = each.select(F.when(ident != "", ident).otherwise(F.col("file")).alias("alignment"), F.monotonically_increasing_id().alias("record"), "value")
    lines = each.select("alignment", "record", F.posexplode(F.split("value", "\n")).alias("line", "l"))
    is_rf = F.startswith("l", F.lit("#=GC RF"))
    rows = lines.filter(is_rf | (~F.startswith("l", F.lit("#")) & (F.trim("l") != "") & (F.trim("l") != "//")))
    name = F.when(is_rf, "#=GC RF").otherwise(F.regexp_extract("l", r"^(\S+)", 1))
    text = F.regexp_extract("l", r"(\S+)\s*$", 1)
    w = F.array_sort(F.collect_list(F.struct("line", "text")))
    joined = rows.select("alignment", "record", "line", name.alias("name"), text.alias("text")).groupBy("alignment", "record", "name").agg(F.min("line").alias("n"), w.alias("parts"))
    return joined.select("alignment", "n", "name", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("aligned"))


def models(spark: SparkSession, path: str) -> DataFrame:
    """(family, length, scores, consensus, rf): profile texts as :func:`sinks.model_text` writes them,
    any number in a file, which is split at their ends."""
    each = records(spark, path, "\n//")
    head = lambda key: F.regexp_extract("value", rf"(?m)^{key} *(\S*)", 1)
    columns = F.regexp_extract_all("value", F.lit(r"(?m)^ +\d+ (.*)$"), F.lit(1))
    scores = F.flatten(F.transform(columns, lambda line: F.transform(F.split(line, " +"), lambda x: x.cast("double"))))
    return each.select(head("NAME").alias("family"), head("LENG").cast("int").alias("length"), scores.alias("scores"), head("CONS").alias("consensus"), head("RF").alias("rf"))


def aligned_fasta(rows: DataFrame, a3m: bool = False) -> DataFrame:
    """Alignment rows as FASTA text (column value). a3m: columns without a residue
    in the reference line are insertions: lower case, gaps dropped."""
    rf = rows.filter("name = '#=GC RF'").select("alignment", F.col("aligned").alias("rf"))
    seqs = rows.filter("name <> '#=GC RF'").join(rf, "alignment", "left")
    if a3m:
        pairs = F.arrays_zip(F.split("aligned", "").alias("c"), F.split(F.coalesce("rf", "aligned"), "").alias("r"))

        def one(p: Column) -> Column:
            gap = p["c"].isin(".", "-", "~")
            match = ~p["r"].isin(".", "-", "~")
            return F.when(match, F.when(gap, "-").otherwise(F.upper(p["c"]))).when(gap, "").otherwise(F.lower(p["c"]))

        text = F.array_join(F.transform(pairs, one), "")
    else:
        text = F.upper(F.translate("aligned", ".~", "--"))
    return seqs.select("alignment", "n", F.concat(F.lit(">"), "name", F.lit("\n"), text).alias("value"))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key in an order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def jdbc_table(spark: SparkSession, url: str, query: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database scan in ``parts`` key ranges; join it with a key list (left semi)
    instead of sending keys."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return reader.options(**options).load()


def secrets(path: str, section: str) -> dict[str, str]:
    """Connection settings of an INI file, read by the driver."""
    import configparser

    parser = configparser.ConfigParser()
    with open(path, encoding="utf-8") as f:
        parser.read_file(f)
    return dict(parser[section])


def blobs(spark: SparkSession, path: str, name: str, unzip: bool = False) -> DataFrame:
    """(id, blob) of one file per family; the id is the file's stem."""
    df = spark.read.format("binaryFile").load(path)
    content = df["content"]
    if unzip:
        import gzip

        import pandas as pd

        @F.pandas_udf("binary")
        def gunzip(data: pd.Series) -> pd.Series:
            return data.map(gzip.decompress)

        content = gunzip(content)
    ident = F.regexp_extract("path", r"([^/]+?)(?:\.[^/]*)?$", 1)
    return df.select(ident.try_cast("bigint").alias("id"), content.alias(name)).filter("id IS NOT NULL")
