"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become tokens: words, numbers, signs of units. Numbers (digits or number
words), names (capitalised words that follow a word, a digit, a comma, a colon or
a semicolon and a space; several in a row are one name) and units become the
typed placeholders ``<num>``, ``<name>`` and ``<unit>``; other words are
lower-cased. Every window of ``WINDOW`` tokens is hashed, and the windows of
documents are hash-joined with those of benchmark items. Items of fewer tokens
are one window of their own length.

Windows that match with the same distance between their places in the two texts
lie on one diagonal. Its slots must be consistent: each value that the item has
in a placeholder must stand for one value of the document throughout. So a
question with new numbers, names or units is still found, and a text that shares
only a skeleton of placeholders is not. Windows of which over half are
placeholders don't count. A document is contaminated by an item if the windows
of consistent diagonals cover ``ENOUGH`` places of the item, or all it has.

**An item's first word** is a word at the start of a text and a name after 'Q: '.
So an item has a second reading, its first word as a name; either suffices, and
the counts are those of the plain reading where that does. At the same place
documents offer the capitalised word of a sentence start as a name too. The words
in ``OPENERS`` are never names: there the document must have the same word. A name
that ran together with the capitalised word before it counts as its last part.

**Copies in other letter case**: what is a name depends on capitals, so every item is also
searched by its plain lower-cased tokens (reading 2), without placeholders: a copy
in upper or lower case, or of an item that is all placeholders, is found, and
skeletons are not. White space of any kind and length is one space throughout.

**Two passes.** The first only hashes windows. A match needs ``ENOUGH`` windows of an
item (or all), so one of any further number of them is among any choice that leaves out
fewer than that: the item's rarest windows of that choice are its probes, and only
documents that meet a probe are candidates for its item. Slots, which cost most, are
made in the second pass, of candidates alone; their windows are joined with those of
the candidate's items only, so a window that is common to many items brings no other
pairs.

The benchmark's windows, and the candidate pairs, are broadcast if there are no more than
``BROADCAST_WINDOWS`` of them, else joined by a shuffle; the rows are the same.
Windows are counted per document, item and diagonal before they are shuffled.

Nulls and empty texts have no tokens and match nothing; rows with a null id are
left out of :func:`matches` and kept by :func:`clean`. Repeated rows of one id
count as one document. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _util

WINDOW, ENOUGH, BROADCAST_WINDOWS = 8, 6, 500_000

# fixed values: unit words and number words
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons tonne tonnes "
    "ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "euro euros dollar dollars cent cents usd eur gbp percent degree degrees celsius fahrenheit kmh mph hz khz mhz ghz kb mb gb tb watt watts kw volt volts"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
SIGNS = "%$€£°"
OPENERS = (
    "a about after all also among an and another any are as at because before between both but by can choose compute could define describe determine did do does "
    "during each either every evaluate explain find following for from given had has have he her here his how however i if in into is it its let list many most my "
    "name no not of on one or our over please read select she should simplify since so solve some suppose that the their then there these they this those to under until "
    "using was we were what when where whether which while who whom whose why with would write you your"
).split()

MARK, START = "\u0001", "\u0002"
#: possessive: Java's matcher repeats other groups by recursion, which a run of some thousand names or numbers overflows
NAME_AFTER = r"([\p{L}\p{N},;:] )(\p{Lu}\p{L}*+(?: \p{Lu}\p{L}*+)*+)"
TOKEN = rf"{MARK}[^{MARK}]+{MARK}|\p{{L}}+|\p{{N}}+(?:[.,]\p{{N}}++)*+|[{SIGNS}]"


#: tokens without names
PLAIN = rf"\p{{L}}+|\p{{N}}+(?:[.,]\p{{N}}++)*+|[{SIGNS}]"
BLANKS = "\t\n\u000b\f\r"

#: what NAME_AFTER leaves: a capitalised word that follows neither a mark nor a letter (and a space)
CAPITAL = rf"(?=\p{{Lu}})(?<![\p{{L}}{MARK}])(?<!\p{{L}} )"


def spaced(text: Column, signs: str = "") -> Column:
    """Text whose runs of white space (and of ``signs``) are single spaces."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.regexp_replace(F.translate(text, BLANKS + signs, " " * len(BLANKS + signs)), " {2,}", " ")


def plain(text: Column) -> Column:
    """Lower-cased tokens, names as single words."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(PLAIN), F.lit(0))


def tokens(text: Column, starts: bool = False) -> Column:
    """Lower-cased tokens; names stand between marks. ``starts``: other capitalised
    words begin with ``START``."""
    text = spaced(text, MARK + START if starts else MARK)
    marked = F.regexp_replace(text, NAME_AFTER, f"$1{MARK}$2{MARK}")
    if not starts:
        return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN), F.lit(0))
    return F.regexp_extract_all(F.lower(F.regexp_replace(marked, CAPITAL, START)), F.lit(TOKEN.replace(r"|\p{L}+|", rf"|{START}?\p{{L}}+|")), F.lit(0))


def canonical(raw: Column) -> Column:
    """Template tokens of tokens."""

    def one(t: Column) -> Column:
        first = F.ascii(t)
        # below the letters are the mark, digits and the ASCII signs; most tokens cost one look at a set
        word = lambda t: F.when(t.isin([*UNITS, *SIGNS, *NUMBERS]), F.when(t.isin(NUMBERS), "<num>").otherwise("<unit>")).otherwise(t)
        low = F.when(first == 1, "<name>").when(first == 2, word(F.substring(t, 2, 1 << 30))).when(first >= 48, "<num>").otherwise("<unit>")
        return F.when(first < 97, low).otherwise(word(t))

    return F.transform(raw, one)


def _is_slot(t: Column) -> Column:
    return F.startswith(t, F.lit("<"))


def with_window_hashes(texts: DataFrame, size: int) -> DataFrame:
    """``texts`` with a column ``h{size}``: the hash of each window of ``size``
    tokens. Hashes of shorter windows are joined step by step, each step a
    projection of its own, so a window costs log(size) hashes."""
    name = f"h{size}"
    if name in texts.columns:
        return texts
    if size == 1:
        return texts.withColumn(name, F.transform("template", lambda t: F.xxhash64(t)))
    left = 1 << ((size - 1).bit_length() - 1)
    texts = with_window_hashes(with_window_hashes(texts, left), size - left)
    count = F.greatest(F.size("template") - (size - 1), F.lit(0))
    a, b = F.slice(f"h{left}", F.lit(1), count), F.slice(f"h{size - left}", F.lit(left + 1), count)
    return texts.withColumn(name, F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)))


def _named_first(size: int, i: Column) -> Column:
    """The hash of the window of ``size`` tokens at ``i`` with a name as its first token."""
    if size == 1:
        return F.xxhash64(F.lit("<name>"))
    left = 1 << ((size - 1).bit_length() - 1)
    return F.xxhash64(_named_first(left, i), F.get(f"h{size - left}", i + left))


def _windows(texts: DataFrame, size: int, whole: bool = False, starts: bool = False) -> DataFrame:
    """(id, size, pos, h, slots, named): the windows of rows (id, raw, template), the raw
    slot values of those with placeholders. ``whole``: only texts of that size.
    ``starts``: windows that begin with a ``START`` come a second time, ``named``."""
    # shorter texts have no windows; a filter on their size would be pushed below the
    # projections and make the tokens twice
    own = with_window_hashes(texts.filter(F.size("template") == size) if whole else texts, size)
    has = (F.size("template") >= size) & F.exists("template", _is_slot)
    places = F.sequence(F.lit(0), F.size("template") - size)

    def slots(i: Column, skip: int = 0) -> Column:
        part = F.slice("template", i + 1 + skip, F.lit(size - skip))
        pairs = F.filter(F.arrays_zip(part.alias("t"), F.slice("raw", i + 1 + skip, F.lit(size - skip)).alias("r")), lambda p: _is_slot(p["t"]))
        return F.transform(pairs, lambda p: F.concat(p["t"], p["r"]))

    hashes = F.col(f"h{size}")
    none = F.lit(None).cast("array<string>")
    window = lambda i, h, s, named: F.struct(i.alias("pos"), h.alias("h"), s.alias("slots"), F.lit(named).alias("named"))
    plain = F.transform(hashes, lambda h, i: window(i, h, none, False))
    slotted = F.transform(hashes, lambda h, i: window(i, h, slots(i), False))
    every = F.when(has, slotted).otherwise(plain)
    if starts:
        begin = lambda i: F.startswith(F.get("raw", i), F.lit(START)) & ~_is_slot(F.get("template", i))
        value = lambda i: F.concat(F.lit(f"<name>{MARK}"), F.get("template", i), F.lit(MARK))
        second = F.transform(F.filter(places, begin), lambda i: window(i, _named_first(size, i), F.concat(F.array(value(i)), slots(i, 1) if size > 1 else F.array().cast("array<string>")), True))
        every = F.when(F.size("template") >= size, F.concat(every, second)).otherwise(every)
    out = own.select("id", F.explode(every).alias("w"))
    out = out.select("id", F.lit(size).alias("size"), "w.pos", "w.h", F.when(F.size("w.slots") > 0, F.col("w.slots")).alias("slots"), "w.named")
    return out.filter(F.coalesce(F.size("slots"), F.lit(0)) * 2 <= size)


def _item_windows(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """The windows of items and the sizes under ``WINDOW`` among them."""
    # at most WINDOW - 1 numbers reach the driver
    short = sorted(r[0] for r in items.select(F.size("template")).distinct().filter(F.size("template").between(1, WINDOW - 1)).collect())
    out = _windows(items, WINDOW)
    for n in short:
        out = out.unionByName(_windows(items, n, whole=True))
    return out, short


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """A side of a join, broadcast if its counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_WINDOWS else df


def _hits(own: DataFrame, pairs: DataFrame, n_pairs: int, bench: DataFrame, n_bench: int, short: list[int], starts: bool) -> DataFrame:
    """Windows of candidates with the equal ones of the items that each is a candidate of."""
    found = _windows(own, WINDOW, starts=starts)
    for n in short:
        found = found.unionByName(_windows(own, n, starts=starts))
    found = found.join(_bounded(pairs, n_pairs), "id")
    return found.join(_bounded(bench.withColumnRenamed("size", "item_size"), n_bench), ["item", "h"]).filter(F.col("size") - F.col("item_size") == 0)


def _probes(windows: DataFrame, total: DataFrame) -> DataFrame:
    """(h, item): the windows of (item, reading, size, item_pos, h) of which a match must
    have one: all but ``ENOUGH - 1`` of each reading (or all but one less than it has), the rarest."""
    common = windows.select("h", "item").distinct().groupBy("h").agg(F.count("*").alias("n"))
    at = windows.join(common, "h").groupBy("item", "reading", "size", "item_pos").agg(F.max("n").alias("n"), F.collect_set("h").alias("hs"))
    rank = F.row_number().over(Window.partitionBy("item", "reading").orderBy("n", "size", "item_pos"))
    chosen = at.withColumn("rank", rank).join(total, ["item", "reading"]).filter(F.col("rank") <= F.col("item_windows") - F.least("item_windows", F.lit(ENOUGH)) + 1)
    return chosen.select("item", F.explode("hs").alias("h")).distinct()


def _candidates(own: DataFrame, probes: DataFrame, n_bench: int, short: list[int], short_plain: list[int], starts: bool) -> DataFrame:
    """(id, item) of documents (id, raw, template, words) that have a probe of an item."""

    if starts:
        at = F.transform("raw", lambda t, i: F.when(F.ascii(t) == ord(START), i))
        own = own.withColumn("starts", F.filter(at, lambda i: i.isNotNull()))

    def named(size: int) -> Column:
        return F.transform(F.filter("starts", lambda i: i <= F.size("template") - size), lambda i: _named_first(size, i))

    hashes = []
    for size in (WINDOW, *short):
        own = with_window_hashes(own, size)
        hashes += [F.col(f"h{size}"), named(size)] if starts else [F.col(f"h{size}")]
    own = own.select("id", F.concat(*hashes).alias("found"), F.col("words").alias("template"))
    own = own.withColumn("h1", F.transform("template", lambda t: F.xxhash64(t)))
    for size in (WINDOW, *short_plain):
        own = with_window_hashes(own, size)
    # an expression, not a column: a filter on the column's size would be pushed down and make all twice
    every = F.concat("found", *[F.col(f"h{size}") for size in (WINDOW, *short_plain)], F.array().cast("array<bigint>"))
    return own.select("id", F.explode(every).alias("h")).join(_bounded(probes, n_bench), "h").select("id", "item").distinct()


def _item_copies(benchmark: DataFrame) -> tuple[DataFrame, list[int], DataFrame]:
    """Windows (item, size, item_pos, h) of plain items, their short sizes, and totals."""
    bench, short = _item_windows(benchmark)
    bench = _util.saved(bench.select(F.col("id").alias("item"), "size", F.col("pos").alias("item_pos"), "h").distinct())
    return bench, short, _util.saved(bench.groupBy("item").agg(F.countDistinct("size", "item_pos").alias("item_windows")))


def _copies(hit: DataFrame, total: DataFrame) -> DataFrame:
    """(id, item, reading 2, counts) of items whose tokens a document has in one piece: on one diagonal."""
    line = hit.groupBy("id", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(F.countDistinct("size", "item_pos").alias("n"))
    counted = line.groupBy("id", "item").agg(F.max("n").alias("n_windows")).join(total, "item").filter(F.col("n_windows") >= F.least("item_windows", F.lit(ENOUGH)))
    return counted.select("id", "item", F.lit(2).alias("reading"), "n_windows", "item_windows", F.lit(False).alias("re_parameterised"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per contaminated document and item: (doc id, item id, n_windows,
    item_windows, re_parameterised)."""
    raw = benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).cast("string").alias("_t")).filter("id IS NOT NULL")
    # reading 0 as the item stands, reading 1 as it is read after a colon, where that differs
    bare = raw.select("id", plain(F.col("_t")).alias("template"))
    raw = raw.select("id", tokens(F.col("_t")).alias("raw"), tokens(F.concat(F.lit(": "), F.ltrim(spaced(F.col("_t"))))).alias("raw1"))
    both = raw.select("id", F.size("raw").alias("n0"), F.explode(F.array(
        F.struct(F.lit(0).alias("reading"), F.col("raw").alias("raw")), F.when(F.col("raw") != F.col("raw1"), F.struct(F.lit(1).alias("reading"), F.col("raw1").alias("raw"))),
    )).alias("r")).filter("r IS NOT NULL").select(F.struct("id", "r.reading", (F.col("n0") - F.size("r.raw")).alias("shift")).alias("id"), "r.raw")
    items = _util.saved(both.select("id", "raw", canonical(F.col("raw")).alias("template")))
    bench, short = _item_windows(items)
    bench = bench.select(F.col("id.id").alias("item"), "id.reading", "size", (F.col("pos") + F.col("id.shift")).alias("item_pos"), "h", F.col("slots").alias("item_slots"), ((F.col("id.reading") == 1) & (F.col("pos") == 0)).alias("lead"))
    bench = _util.saved(bench.dropDuplicates(["item", "reading", "size", "item_pos", "h"]))
    total = _util.saved(bench.groupBy("item", "reading").agg(F.countDistinct("size", "item_pos").alias("item_windows")))
    probes = _util.saved(_probes(bench, total))
    # both readings share all windows but those with the first word
    bench = _util.saved(bench.groupBy("item", "size", "item_pos", "h", "item_slots", "lead").agg(F.sort_array(F.collect_set("reading")).alias("readings")))
    copies, short_plain, copy_total = _item_copies(_util.saved(bare.withColumn("raw", F.col("template"))))
    own_probe = _probes(copies.withColumn("reading", F.lit(2)), copy_total.withColumn("reading", F.lit(2)))
    probes = _util.saved(probes.unionByName(own_probe).distinct())
    n_bench = max(bench.count(), copies.count(), probes.count())

    leads = F.regexp_extract(F.get("item_slots", F.lit(0)), rf"{MARK}(\p{{L}}+)", 1)
    starts = not bench.filter(F.col("lead") & ~leads.isin(OPENERS)).isEmpty()
    tokenised = lambda rows: rows.select(F.col(id_col).alias("id"), tokens(F.col(text_col), starts).alias("raw"), plain(F.col(text_col)).alias("words"))
    templates = lambda rows: rows.select("id", "raw", canonical(F.col("raw")).alias("template"), "words")
    own = templates(tokenised(docs.filter(F.col(id_col).isNotNull())))
    pairs = _util.saved(_candidates(own, probes, n_bench, short, short_plain, starts))
    n_pairs = pairs.count()
    some = docs.join(_bounded(pairs.select(F.col("id").alias("_candidate")).distinct(), n_pairs), F.col(id_col) == F.col("_candidate"), "left_semi")
    some = templates(tokenised(some))
    hit = _hits(some, pairs, n_pairs, bench, n_bench, short, starts).filter(~F.col("named") | F.col("lead"))
    # the part of a name that is the item's, if it ran together with a word before it
    ends = lambda a, b: (a == b) | F.endswith(a, F.concat(F.lit(" "), F.substring(b, len("<name>") + 2, 1 << 30)))
    first, item_first = F.get("slots", F.lit(0)), F.get("item_slots", F.lit(0))
    hit = hit.filter(~F.col("lead") | ~leads.isin(OPENERS) | ends(first, item_first))
    hit = hit.select("id", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal"), "item_pos", "size", "slots", "item_slots", "lead", "readings")
    on = ["id", "item", "reading", "diagonal"]
    hit = _util.saved(hit).withColumn("reading", F.explode("readings"))  # few rows: what matches
    pair = hit.filter("item_slots IS NOT NULL").select(*on, "lead", F.posexplode(F.arrays_zip("item_slots", "slots")).alias("i", "p"))
    of_lead = F.col("lead") & (F.col("i") == 0)
    value = pair.groupBy(*on, F.col("p.item_slots").alias("value")).agg(
        F.min(F.when(~of_lead, F.col("p.slots"))).alias("a"), F.max(F.when(~of_lead, F.col("p.slots"))).alias("b"),
        F.min(F.when(of_lead, F.col("p.slots"))).alias("l"), F.max(F.when(of_lead, F.col("p.slots"))).alias("m"),
    )
    apart = F.coalesce(F.col("a") != F.col("b"), F.lit(False)) | F.coalesce(~(ends(F.col("l"), F.col("a")) | ends(F.col("a"), F.col("l"))), F.lit(False))
    changed = F.coalesce(F.col("a") != F.col("value"), ~ends(F.col("l"), F.col("value")) & ~ends(F.col("m"), F.col("value")))
    slots = value.groupBy(*on).agg(F.max(apart).alias("bad"), F.max(changed).alias("changed"))
    good = hit.join(slots, on, "left").filter(~F.coalesce("bad", F.lit(False)))
    counted = good.groupBy("id", "item", "reading").agg(
        F.countDistinct("size", "item_pos").alias("n_windows"), F.max(F.coalesce("changed", F.lit(False))).alias("re_parameterised")
    )
    of_item = ["item", "reading"]
    enough = counted.join(_bounded(total, n_bench), of_item).filter(F.col("n_windows") >= F.least("item_windows", F.lit(ENOUGH)))
    row = ["n_windows", "item_windows", "re_parameterised"]
    enough = enough.select("id", "item", "reading", *row)
    words = some.select("id", F.col("words").alias("template"), F.col("words").alias("raw"))
    enough = enough.unionByName(_copies(_hits(words, pairs, n_pairs, copies, n_bench, short_plain, False), copy_total))
    enough = enough.groupBy("id", "item").agg(F.min(F.struct("reading", *row)).alias("r")).select("id", "item", "r.*")
    return enough.select(F.col("id").alias(id_col), F.col("item").alias(item_col if item_col != id_col else "item"), *row)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated documents; same columns, repeated rows stay."""
    gone = matches(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")


def oracle_sql() -> str:
    """The same rows in SQL, with windows as strings instead of hashes."""
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    greedy = lambda pattern: pattern.replace("*+", "*").replace("++", "+").replace(MARK, "\\x01")  # noqa: E731  DuckDB's matcher has no possessive form and needs none

    spaced_ = "regexp_replace(replace(coalesce(text, ''), chr(1), ' '), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')"

    def windows(name: str, source: str, ident: str, whole: str) -> str:
        return f"""
        {name}_raw AS (
            SELECT {ident} AS id, regexp_extract_all(lower(regexp_replace({spaced_}, '{greedy(NAME_AFTER)}', '\\1' || chr(1) || '\\2' || chr(1), 'g')),
                   '{greedy(TOKEN)}') AS raw, regexp_extract_all(lower({spaced_}), '{greedy(PLAIN)}') AS plain FROM {source} WHERE {ident} IS NOT NULL),
        {name}_tok AS (
            SELECT id, plain, raw, list_transform(raw, lambda t: CASE
                WHEN t[1] = chr(1) THEN '<name>' WHEN t[1] BETWEEN '0' AND '9' THEN '<num>'
                WHEN t IN ({quoted([*UNITS, *SIGNS])}) THEN '<unit>'
                WHEN t IN ({quoted(NUMBERS)}) THEN '<num>' ELSE t END) AS tpl FROM {name}_raw),
        {name}_pos AS (SELECT id, raw, tpl, n, unnest(range(len(tpl) - n + 1)) AS pos FROM {name}_tok JOIN sizes ON len(tpl) >= n {whole.format("tpl")}),
        {name}_win AS (
            SELECT id, n, pos, array_to_string(tpl[pos + 1 : pos + n], ' ') AS w,
                   list_transform(list_filter(range(pos + 1, pos + n + 1), lambda i: tpl[i][1] = '<'), lambda i: tpl[i] || raw[i]) AS slots
            FROM {name}_pos),
        {name}_at AS (SELECT id, plain, n, unnest(range(len(plain) - n + 1)) AS pos FROM {name}_tok JOIN sizes ON len(plain) >= n {whole.format("plain")}),
        {name}_copy AS (SELECT DISTINCT id, n, pos, array_to_string(plain[pos + 1 : pos + n], ' ') AS w FROM {name}_at)"""

    return f"""
    WITH sizes AS (SELECT unnest(range(1, {WINDOW + 1})) AS n),
    {windows("b", "benchmark", "item_id", f"AND (n = {WINDOW} OR len({{}}) = n)")},
    {windows("d", "documents", "doc_id", f"AND (n = {WINDOW} OR n IN (SELECT len(raw) FROM b_tok) OR n IN (SELECT len(plain) FROM b_tok))")},
    total AS (SELECT id AS item, count(DISTINCT (n, pos)) AS item_windows FROM b_win WHERE 2 * len(slots) <= n GROUP BY id),
    hit AS (
        SELECT d.id, b.id AS item, d.pos - b.pos AS diagonal, (b.n, b.pos) AS item_pos, d.slots, b.slots AS item_slots
        FROM d_win d JOIN b_win b ON d.w = b.w AND d.n = b.n WHERE 2 * len(b.slots) <= b.n),
    pair AS (SELECT id, item, diagonal, unnest(item_slots) AS value, unnest(slots) AS other FROM hit WHERE len(item_slots) > 0),
    value_ AS (SELECT id, item, diagonal, value, min(other) AS a, max(other) AS b FROM pair GROUP BY ALL),
    slot AS (SELECT id, item, diagonal, bool_or(a <> b) AS bad, bool_or(a <> value) AS changed FROM value_ GROUP BY ALL),
    counted AS (
        SELECT hit.id, hit.item, count(DISTINCT item_pos) AS n_windows, bool_or(coalesce(changed, false)) AS re_parameterised
        FROM hit LEFT JOIN slot ON hit.id = slot.id AND hit.item = slot.item AND hit.diagonal = slot.diagonal
        WHERE NOT coalesce(bad, false) GROUP BY hit.id, hit.item),
    copy_total AS (SELECT id AS item, count(DISTINCT (n, pos)) AS item_windows FROM b_copy GROUP BY id),
    line AS (SELECT d.id, b.id AS item, count(DISTINCT (b.n, b.pos)) AS n FROM d_copy d JOIN b_copy b ON d.w = b.w AND d.n = b.n GROUP BY d.id, b.id, d.pos - b.pos),
    copy AS (SELECT id, item, max(n) AS n_windows FROM line GROUP BY id, item),
    every AS (
        SELECT id, item, 0 AS reading, n_windows, item_windows, re_parameterised FROM counted JOIN total USING (item) WHERE n_windows >= least(item_windows, {ENOUGH})
        UNION ALL SELECT id, item, 2, n_windows, item_windows, false FROM copy JOIN copy_total USING (item) WHERE n_windows >= least(item_windows, {ENOUGH}))
    SELECT id AS doc_id, item AS item_id, arg_min(n_windows, reading) AS n_windows, arg_min(item_windows, reading) AS item_windows, arg_min(re_parameterised, reading) AS re_parameterised
    FROM every GROUP BY id, item"""
