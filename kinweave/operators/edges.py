"""Edge lists: clusters, families, their sizes, numbers and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..storage import tasks, written

HOT, MEETINGS, BAND, NARROW = 1_000, 1_000_000, 1_000, 200


def representatives(clusters: DataFrame, minimum_members: int = 25) -> DataFrame:
    """Representatives of clusters with enough members."""
    return clusters.groupBy("representative").agg(F.count("*").alias("members")).filter(F.col("members") >= minimum_members)


def size_distribution(clusters: DataFrame) -> DataFrame:
    """How many clusters have each size."""
    sizes = clusters.groupBy("representative").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("n"))


def total(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.count("*").alias("n_rows"))


def chunked(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``df`` with ``chunk`` = 1, 2, ... of ``size`` rows each in a given order.

    See :func:`numbered`."""
    return numbered(df, order, "_n").withColumn("chunk", F.expr(f"CAST((_n - 1) DIV {int(size)} + 1 AS int)")).drop("_n")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with 1-based dense row numbers in a total order.

    The sort is a range exchange; each row gets its partition and its place in it,
    and a partition's first number is the sum of the counts before it, so no task
    holds all rows. The numbered rows are written once before they are counted: a
    range exchange that runs twice may cut elsewhere. Equal rows may be numbered
    either way."""
    placed = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # one row per partition
    return joined.select(*[f"`{c}`" for c in df.columns], (F.col("_before") + within + 1).cast("long").alias(name))


def block_pairs(left: DataFrame, right: DataFrame, block: str, order: list[str]) -> DataFrame:
    """All pairs of a row of ``left`` and one of ``right`` with the same ``block``, made where they are used: see :func:`_banded`.
    ``order``: columns of ``left`` that number its rows."""
    left, right, _ = _banded(numbered(left, order, "_i"), right, block, BAND)
    return left.hint("shuffle_hash").join(right, [block, "_part"]).drop("_i", "_part")


def _band(i, rows: int):
    return F.call_function("div", i - 1, F.lit(rows)).cast("int")


def _banded(left: DataFrame, right: DataFrame, block: str, rows: int, columns: int = 1) -> tuple[DataFrame, DataFrame, int]:
    """``left`` in bands of ``rows`` numbers ``_i`` each, and ``right`` once for each band that has rows of its block. So a task
    holds ``rows`` rows, the others pass by, and rows are shuffled, one for each ``rows`` pairs, not pairs. With ``columns``, a band has so many
    tasks, each for those of ``right`` whose number ``_j`` gives that rest. Tasks ``_part`` are addressed by number, as two
    keys of a hash may fall on one task; how many there are is the third result."""
    left = left.withColumn("_band", F.coalesce(_band(F.col("_i"), rows), F.lit(0)))
    spans = left.groupBy(block).agg(F.min("_band").alias("_first"), F.max("_band").alias("_last"))
    parts = max(((spans.agg(F.max("_last")).first()[0] or 0) + 1) * columns, 2)  # one number; a single task would be dealt anew
    spread = right.repartition(right.sparkSession.sparkContext.defaultParallelism, *right.columns)  # a small file is one task
    spread = spread.join(spans, block).withColumn("_band", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    each, rest = F.lit(0), F.lit(0)
    if columns > 1:
        each, rest = F.explode(F.sequence(F.lit(0), F.lit(columns - 1))), F.coalesce(F.pmod("_j", F.lit(columns)), F.lit(0))
    addressed = [
        df.withColumn("_column", c).withColumn("_part", F.col("_band") * columns + F.col("_column")).drop("_band", "_column").repartitionById(parts, "_part")
        for df, c in ((left, each), (spread, rest))
    ]
    return *addressed, parts


def members_of(clusters: DataFrame, reps: DataFrame) -> DataFrame:
    """Edges of the chosen representatives."""
    return clusters.join(reps.select("representative").distinct(), "representative", "left_semi")


def with_sequences(members: DataFrame, sequences: DataFrame) -> DataFrame:
    """Members with their sequences; those without one are dropped."""
    return members.join(sequences.select(F.col("id").alias("member"), "seq"), "member")


def prefixed_edges(edges: DataFrame, chunk: str = "chunk", iteration: str = "iteration") -> DataFrame:
    """Pooled families of all chunks: `chunk_iteration`, member (padding removed)."""
    return edges.select(F.concat_ws("_", chunk, iteration).alias("family"), F.rtrim("member").alias("member"))


def base_proteins(edges: DataFrame) -> DataFrame:
    """Distinct (family, protein) of members, the part before `/`."""
    return edges.select("family", scalar.base_name(F.col("member")).alias("protein")).distinct()


def shared_counts(members: DataFrame, hot: int = HOT, pairs: DataFrame | None = None) -> DataFrame:
    """(i, j, shared), i < j: how many proteins two families have in common, where any.
    ``members``: distinct (id, protein); with a column ``block``, families of one block only are compared.

    Families meet at their proteins. One that more than ``hot`` families have would
    give the square of that number; with ``pairs`` (i, j) given, such a protein is looked up
    for these pairs alone instead, so no protein gives more than ``hot`` rows a member."""
    keys = [c for c in members.columns if c != "id"]
    side = lambda df, name: df.withColumnRenamed("id", name)
    if pairs is None:
        return _met(members)
    common = written(members.groupBy(*keys).count().filter(F.col("count") > hot).select(*keys))
    if common.isEmpty():
        return _met(members)
    rare, many = members.join(common, keys, "left_anti"), members.join(common, keys, "left_semi")
    looked = pairs.distinct().join(side(many, "i"), "i").join(side(many, "j"), ["j", *keys]).groupBy("i", "j").agg(F.count("*").alias("shared"))
    return shared_counts(rare).unionByName(looked).groupBy("i", "j").agg(F.sum("shared").alias("shared"))


def _met(members: DataFrame) -> DataFrame:
    """:func:`shared_counts` of all pairs that meet. Meetings are counted where they are made: the families of a
    protein go as one list to each tile that has one of them, and a tile counts all pairs of its own families. So
    lists are shuffled, not pairs, and there are so many tiles that a task counts about ``MEETINGS`` different pairs at most."""
    blocks = [c for c in members.columns if c == "block"]
    members = members.dropna()  # a null meets nothing
    keys = [c for c in members.columns if c != "id"]
    # dealt first: single ids are shuffled, not lists of one
    lists = written(members.repartition(*keys).groupBy(*keys).agg(F.collect_list("id").alias("ids")).select(*blocks, "ids").filter("size(ids) > 1"))
    n = F.size("ids").cast("double")
    each = lists.groupBy(*blocks).agg(F.sum(n * n / 2).alias("rows"))
    families = members.groupBy(*blocks).agg((F.count_distinct("id").cast("double") ** 2 / 2).alias("pairs"))
    sizes = each.join(families, blocks) if blocks else each.crossJoin(families)
    # two numbers: the most different pairs of a block, and of all
    most, total = sizes.agg(F.max(F.least("rows", "pairs")), F.sum(F.least("rows", "pairs"))).first()
    tiles, tasks = (int((x or 0) // MEETINGS) + 1 for x in (2 * (most or 0), total))
    tile = lambda i: F.pmod(F.xxhash64(i), F.lit(tiles)).cast("int")
    dealt = lists.select(*blocks, "ids", F.explode(F.array_distinct(F.transform("ids", tile))).alias("tile"))
    dealt = dealt.repartition(max(tasks, members.sparkSession.sparkContext.defaultParallelism), *blocks, "tile")
    own = dealt.select(*blocks, "tile", "ids", F.explode(F.filter("ids", lambda i: tile(i) == F.col("tile"))).alias("i"))
    met = own.select(*blocks, "tile", "i", F.explode("ids").alias("j")).filter("i < j")
    return met.groupBy(*blocks, "tile", "i", "j").agg(F.count("*").alias("shared")).select("i", "j", "shared")


def _numbered_sets(family_protein: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(family, n, id) and (id, protein, block if any), written: rows that meet carry numbers, not names."""
    family_protein = written(family_protein)
    sizes = written(family_protein.groupBy("family").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    return sizes, written(family_protein.join(sizes.select("family", "id"), "family").drop("family"))


def _jaccard(n_a, n_b, shared):
    return F.coalesce(F.try_divide(shared, F.coalesce(n_a, F.lit(0)) + F.coalesce(n_b, F.lit(0)) - shared), F.lit(0.0))


def near_sets(family_protein: DataFrame, at_least: float, hot: int = HOT) -> DataFrame:
    """(a, b, score), in both directions: all families whose sets have a Jaccard score of ``at_least``
    (over 0), written. No pair without a common protein is made. A column ``block`` as in :func:`shared_counts`.

    Proteins of more than ``hot`` families bring together only families of which they are a share of
    ``at_least`` or more: any other pair this similar has a rarer protein in common too."""
    sizes, members = _numbered_sets(family_protein)
    side = lambda i, k: sizes.select(F.col("id").alias(i), F.col("family").alias(k), F.col("n").alias(f"n_{k}"))
    keys = [c for c in members.columns if c != "id"]
    common = written(members.groupBy(*keys).count().filter(F.col("count") > hot).select(*keys))
    if common.isEmpty():
        counts = shared_counts(members)
    else:
        many = members.join(common, keys, "left_semi")
        mostly = many.groupBy("id").count().join(sizes.select("id", "n"), "id").filter(F.col("count") >= at_least * F.col("n")).select("id")
        found = [shared_counts(m).select("i", "j") for m in (members.join(common, keys, "left_anti"), many.join(mostly, "id", "left_semi"))]
        counts = shared_counts(members, hot, found[0].unionByName(found[1]))
    met = counts.join(side("i", "a"), "i").join(side("j", "b"), "j")
    near = written(met.select("a", "b", _jaccard(F.col("n_a"), F.col("n_b"), F.col("shared")).alias("score")).filter(F.col("score") >= at_least))
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))


def pair_jaccard(pairs: DataFrame, family_protein: DataFrame, hot: int = HOT, at_least: float = 0.0) -> DataFrame:
    """``pairs`` (a, b) with the Jaccard score of their protein sets, 0 if both
    are empty. Only the given pairs get a score; with a column ``block`` in ``family_protein`` these must be of
    one block. Pairs whose score can't reach ``at_least`` may be left out.

    No set travels with a pair: the numbers of common proteins are counted where families meet
    (:func:`shared_counts`), and a pair takes its number by one join on two integers."""
    sizes, members = _numbered_sets(family_protein)
    zero = lambda c: F.coalesce(c, F.lit(0))
    for k in ("a", "b"):
        own = sizes.select(F.col("family").alias(f"_{k}"), F.col("n").alias(f"_n{k}"), F.col("id").alias(f"_i{k}"))
        pairs = pairs.join(own, pairs[k] == own[f"_{k}"], "left").drop(f"_{k}")
    if at_least > 0:
        low, high = F.least(zero(F.col("_na")), zero(F.col("_nb"))), F.greatest(zero(F.col("_na")), zero(F.col("_nb")))
        pairs = written(pairs.filter(F.try_divide(low, high) >= at_least))
        members = members.join(pairs.select(F.explode(F.array("_ia", "_ib")).alias("id")).distinct(), "id", "left_semi")
    low, high = F.least("_ia", "_ib"), F.greatest("_ia", "_ib")
    asked = pairs.select(low.alias("i"), high.alias("j")).filter("_ia <> _ib")
    counts = shared_counts(members, hot, asked).withColumnRenamed("i", "_i").withColumnRenamed("j", "_j")
    met = pairs.join(counts, (low == F.col("_i")) & (high == F.col("_j")), "left")
    shared = F.when(F.col("_ia") == F.col("_ib"), F.col("_na")).otherwise(zero(F.col("shared")))
    return met.withColumn("score", _jaccard(F.col("_na"), F.col("_nb"), shared)).drop("_na", "_nb", "_ia", "_ib", "_i", "_j", "shared")


def block_jaccard(left: DataFrame, right: DataFrame, block: str, sets: DataFrame) -> DataFrame:
    """All pairs of ``left`` (a) and ``right`` (b) with the same ``block``, with the Jaccard score of their protein sets, 0 if both
    are empty. ``sets``: (family, protein); repeated rows count once. :func:`pair_jaccard` takes any pairs, but shuffles them;
    these are the square of the families, so they are made, and get their score, in one task each (:func:`_banded`).

    The families of a protein go as one list to each task that has one of them, and a task counts its own pairs. Bands and
    columns are such that a task counts about ``MEETINGS`` different pairs at most, and a band has ``NARROW`` rows at least."""
    side = lambda df, name: df.select(F.col(name).alias("family"), block)
    names = side(left, "a").unionByName(side(right, "b")).dropna().distinct()
    # by hash, so that families of many proteins are spread over bands
    ids = numbered(names.withColumn("_hash", F.xxhash64("family")), [block, "_hash", "family"], "id")
    ids = written(ids.select("family", block, F.col("id").cast("int").alias("id")))
    own = sets.join(ids, "family").select("protein", block, "id")
    number_of_tasks = tasks(sets)
    lists = own.repartition(number_of_tasks, "protein", block).groupBy("protein", block).agg(F.collect_set("id").alias("ids"))
    lists = written(lists.select(block, "ids", F.col("protein").isNotNull().alias("meets")))  # a null meets nothing
    sizes = lists.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    known = written(ids.join(sizes, "id", "left"))

    lists = lists.filter(F.col("meets") & (F.size("ids") > 1))
    n, of = F.size("ids").cast("double"), F.col("families")
    weight = lists.groupBy(block).agg(F.sum(n * n).alias("rows")).join(ids.groupBy(block).agg(F.count("*").cast("double").alias("families")), block)
    each = int(weight.agg(F.max(F.least("rows", of * of) / of)).first()[0] or 0) + 1  # one number: families that a family meets
    rows = min(BAND, max(MEETINGS // each, NARROW))
    columns = rows * each // MEETINGS + 1

    number = lambda df, k, i: df.join(known.select(F.col("family").alias(k), block, F.col("id").alias(i), F.col("n").alias(f"_n{k}")), [k, block], "left")
    left, right, parts = _banded(number(left, "a", "_i"), number(right, "b", "_j"), block, rows, columns)
    column = lambda j: F.pmod(j, F.lit(columns)).cast("int")
    of_band = lambda ids, band: F.filter(ids, lambda i: _band(i, rows) == F.col(band))
    # dealt first: few files are few tasks, and each list becomes several rows
    sent = lists.repartition(number_of_tasks).select("ids", F.explode(F.array_distinct(F.transform("ids", lambda i: _band(i, rows)))).alias("_band"))
    if columns > 1:
        sent = sent.select("*", F.explode(F.array_distinct(F.transform("ids", column))).alias("_column"))
        theirs = F.filter("ids", lambda j: column(j) == F.col("_column"))
        sent = sent.select((F.col("_band") * columns + F.col("_column")).alias("_part"), of_band("ids", "_band").alias("own"), theirs.alias("theirs"))
    else:
        sent = sent.select(F.col("_band").alias("_part"), F.col("ids").alias("theirs"))
    sent = sent.repartitionById(parts, "_part")
    own = F.col("own") if columns > 1 else of_band("theirs", "_part")
    met = sent.select("_part", F.explode_outer(own).alias("_i"), "theirs").select("_part", "_i", F.explode("theirs").alias("_j"))
    pair = (F.shiftleft(F.col("_i").cast("long"), 32) + F.col("_j")).alias("_pair")
    counts = met.filter("_i <> _j").select("_part", pair).groupBy("_part", "_pair").agg(F.count("*").alias("_shared"))

    pairs = left.hint("shuffle_hash").join(right, [block, "_part"]).select("*", pair).join(counts.hint("shuffle_hash"), ["_part", "_pair"], "left")
    shared = F.when(F.col("_i") == F.col("_j"), F.col("_na")).otherwise(F.coalesce("_shared", F.lit(0)))
    return pairs.withColumn("score", _jaccard(F.col("_na"), F.col("_nb"), shared)).drop("_part", "_i", "_j", "_pair", "_na", "_nb", "_shared")


def difference(recruited: DataFrame, checked: DataFrame) -> DataFrame:
    """Newly recruited names."""
    return recruited.join(checked, recruited.columns, "left_anti").distinct()


def pooled(*parts: DataFrame) -> DataFrame:
    """Bag union by name."""
    first, *rest = parts
    for p in rest:
        first = first.unionByName(p)
    return first


def membership(original: DataFrame, kept: DataFrame) -> DataFrame:
    """Per family, distinct common proteins over the length of the original list.

    Both lists are summed by protein, then by family, in tasks whose number grows with them."""
    side = lambda df, n: df.select("family", scalar.base_name(F.col("member")).alias("p"), F.lit(n).alias("listed"), F.lit(1 - n).alias("kept"))
    both = side(original, 1).unionByName(side(kept, 0))
    number = tasks(both)
    each = both.repartition(number, "family", "p").groupBy("family", "p").agg(F.sum("listed").alias("listed"), F.max("kept").alias("kept"))
    # a null is in common with nothing
    common = ((F.col("listed") > 0) & (F.col("kept") > 0) & F.col("family").isNotNull() & F.col("p").isNotNull()).cast("int")
    sums = each.select("family", "listed", common.alias("common")).repartition(number, "family").groupBy("family").agg(F.sum("listed").alias("listed"), F.sum("common").alias("common"))
    return sums.filter("listed > 0").select("family", (F.col("common") / F.col("listed")).alias("membership"))
