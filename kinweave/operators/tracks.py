"""Residue labels: runs, percentages, feature tracks, residue means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar

RECTS = "array<struct<x:int,y:int>>"

# fixed values: label, name, class, colour
STRUCTURE = (("H", "α-helices", "pred-h", "#db3089"), ("E", "β-strands", "pred-e", "#f2c83f"), ("C", "Coil", "pred-c", "#636263"))
TOPOLOGY = (
    ("I", "Inside (cytosolic)", "tm-i", "#619CFF"),
    ("M", "Transmembrane α-helix", "tm-m", "#F8766D"),
    ("O", "Outside (extracellular)", "tm-o", "#00BA38"),
    ("S", "Signal peptide", "tm-s", "#E69F00"),
    ("B", "Transmembrane β-strand", "tm-b", "#800080"),
    ("P", "Periplasm / lumen", "tm-p", "#00CED1"),
)
TOPOLOGY_COLUMNS = dict(zip("IMOSBP", ("inside_percent", "membrane_alpha_percent", "outside_percent", "signal_percent", "membrane_beta_percent", "periplasm_percent"), strict=True))


def runs(labels: Column) -> Column:
    """Runs of equal adjacent characters of a string, as (label, x, y), 1-based
    and closed. Within the row: a place opens a run if the one before differs."""
    n = F.length(labels)
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    char = lambda i: F.substr(labels, i, F.lit(1))
    starts = F.filter(at, lambda i: (i == 1) | (char(i) != char(F.greatest(i - 1, F.lit(1)))))
    stops = F.concat(F.transform(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), lambda s: s - 1), F.when(n > 0, F.array(n)).otherwise(F.array().cast("array<int>")))
    return F.zip_with(starts, stops, lambda x, y: F.struct(char(x).alias("label"), x.alias("x"), y.alias("y")))


def run_rows(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """The same over rows: (keys, label, x, y) of runs of equal labels in an order
    (gaps and islands); places count from 1 in each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    by_label = Window.partitionBy(*keys, label).orderBy(*order)
    i = df.select(*keys, label, F.row_number().over(w).alias("i"), F.row_number().over(by_label).alias("j"))
    return i.groupBy(*keys, label, (F.col("i") - F.col("j")).alias("island")).agg(F.min("i").alias("x"), F.max("i").alias("y")).drop("island")


def _rects(labels: Column, label: str) -> Column:
    return F.transform(F.filter(runs(labels), lambda r: r["label"] == label), lambda r: F.struct(r["x"].alias("x"), r["y"].alias("y")))


def _track(data: Column, name: str, css: str, color: str, kind: str) -> Column:
    return F.struct(data.alias("data"), F.lit(name).alias("name"), F.lit(css).alias("className"), F.lit(color).alias("color"), F.lit(kind).alias("type"))


def structure_composition(preds: DataFrame) -> DataFrame:
    """(id, helix_percent, strand_percent, coil_percent); empty predictions are skipped."""
    named = (("H", "helix_percent"), ("E", "strand_percent"), ("C", "coil_percent"))
    return preds.filter(F.length("pred") > 0).select("id", *[scalar.label_percent(F.col("pred"), k).alias(n) for k, n in named])


def structure_features(preds: DataFrame) -> DataFrame:
    """(id, json): tracks of helices, strands and coils and the confidence line.
    Records whose parts differ in length fail; empty ones are skipped."""
    same = (F.length("conf") == F.length("pred")) & (F.length("pred") == F.length("aa"))
    checked = preds.filter(F.length("pred") > 0).withColumn("pred", F.when(same, F.col("pred")).otherwise(F.raise_error(F.lit("lengths of a prediction differ")).cast("string")))
    tracks = [_track(_rects(F.col("pred"), k), n, c, color, "rect") for k, n, c, color in STRUCTURE]
    line = F.transform(F.sequence(F.lit(1), F.length("conf")), lambda i: F.struct(i.alias("x"), F.substr("conf", i, F.lit(1)).cast("int").alias("y")))
    line_track = _track(line, "Confidence Score", "conf-score", "#0F8292", "line")
    return checked.select("id", F.to_json(F.struct(F.col("aa").alias("sequence"), F.array(*tracks, line_track).alias("features"))).alias("json"))


def topology_composition(records: DataFrame) -> DataFrame:
    return records.select("id", *[scalar.label_percent(F.col("labels"), k).alias(n) for k, n in TOPOLOGY_COLUMNS.items()])


def topology_features(records: DataFrame) -> DataFrame:
    """(id, json): tracks of the labels that occur."""
    tracks = F.array(*[_track(_rects(F.col("labels"), k), n, c, color, "rect") for k, n, c, color in TOPOLOGY])
    return records.select("id", F.to_json(F.struct(F.col("seq").alias("sequence"), F.filter(tracks, lambda t: F.size(t["data"]) > 0).alias("features"))).alias("json"))


def residue_means(atoms: DataFrame) -> DataFrame:
    """(id, line, asym, comp, seq, mean): mean B factor of consecutive atoms of a residue.
    Atoms that come dealt by id stay where they are."""
    w = Window.partitionBy("id").orderBy("line")
    key = F.struct("asym", "comp", "seq")
    new = atoms.withColumn("_new", F.coalesce((~key.eqNullSafe(F.lag(key).over(w))).cast("int"), F.lit(1)))
    grouped = new.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = grouped.groupBy("id", "_g", "asym", "comp", "seq").agg(F.min("line").alias("line"), F.avg("b").alias("_m"))
    return out.select("id", "line", "asym", "comp", "seq", F.format_string("%.2f", F.bround("_m", 2)).alias("mean"))


def cif_metrics(means: DataFrame) -> DataFrame:
    """(id, n, value): the metric block of a CIF file, header lines first."""
    # fixed values: the header of the metric block
    head = """loop_
_ma_qa_metric.id
_ma_qa_metric.mode
_ma_qa_metric.name
1 global pLDDT
2 local  pLDDT
#
loop_
_ma_qa_metric_local.label_asym_id
_ma_qa_metric_local.label_comp_id
_ma_qa_metric_local.label_seq_id
_ma_qa_metric_local.metric_id
_ma_qa_metric_local.metric_value
_ma_qa_metric_local.model_id
_ma_qa_metric_local.ordinal_id""".split("\n")
    top = means.select("id").distinct().select("id", F.posexplode(F.array(*[F.lit(h) for h in head])).alias("n", "value"))
    top = top.withColumn("n", F.col("n").cast("long") - len(head))
    rows = means.select("id", F.col("line").cast("long").alias("n"), F.concat_ws(" ", "asym", "comp", "seq", F.lit("2"), "mean", F.lit("1"), F.lit("1")).alias("value"))
    return top.unionByName(rows)
