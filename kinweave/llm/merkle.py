"""Merkle manifest of a dataset: leaves, sub-roots, root and inclusion proofs.

A leaf is the hash of a row's fields. The leaves of one tree (a value of ``lang``) stand in
ascending order, and every ``ARITY`` consecutive nodes (the last run may be shorter) become
their parent while a level holds several. Sub-roots, in order of their tree's name, are
the leaves of the top tree.

**Sparse-forest monoid.** A fragment is a set of nodes keyed by (level, index). The number
of leaves of a tree is known, and with it the arity of every sibling run, so :func:`merged`
of fragments, their union in which each complete run has become its parent, is associative
and commutative: any split of the leaves into partitions and any order of merging gives
the same. Tasks make fragments of the leaves that they hold; fragments are
then merged in rounds of a tree reduction, each written. A round takes the unresolved nodes
of ``2**FAN`` neighbouring subtrees per group, whose size the input doesn't change, and
notes each subtree's siblings up to the round's level. Proofs come top down: a
subtree's path is what its round noted followed by the path of the subtree above it.
Nothing is gathered on the driver but the number of leaves of the largest tree.

Hashes are SHA-256 of the concatenated inputs, digests as lowercase hex text.

Nulls: a null field is ``-``; a null tree name is a tree of its own, the first one; a
null id sorts first and is never tampered with. Rows with equal ids are leaves of
their own, ordered by their hash; equal rows are equal leaves side by side. An empty text
is ``0:``; a text of any length is one hash in the JVM. Other columns, clashing ones
too, are dropped. An empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _util

ARITY = 2
BLOCK, FAN = 10, 8  # levels of a block of leaves, levels that a round resolves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def digest_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def width(leaves: int, level: int) -> int:
    """Nodes of a tree's level."""
    return -(-leaves // ARITY**level)


def height(leaves: int) -> int:
    """The level of the only node that remains."""
    h = 0
    while width(leaves, h) > 1:
        h += 1
    return h


Forest = dict[tuple[int, int], str]


def merged(fragments: Iterable[Forest], leaves: int, top: int | None = None, made: Forest | None = None) -> Forest:
    """The union of fragments of one tree of ``leaves`` leaves, in which every complete
    sibling run up to level ``top`` has become its parent. ``made`` gets all nodes seen."""
    h = height(leaves)
    top = h if top is None else min(top, h)
    forest: Forest = {}
    for f in fragments:
        forest.update(f)
    if made is not None:
        made.update(forest)
    for level in range(top):
        for parent in {i // ARITY for at, i in list(forest) if at == level}:
            run = [(level, i) for i in range(parent * ARITY, min((parent + 1) * ARITY, width(leaves, level)))]
            if all(k in forest for k in run):
                node = digest_of([forest.pop(k) for k in run])
                forest[level + 1, parent] = node
                if made is not None:
                    made[level + 1, parent] = node
    return forest


def siblings(made: Forest, leaves: int, level: int, index: int, top: int) -> list[tuple[str, str]]:
    """The (nodes before, nodes after) of each run on the way from a node up to level ``top``."""
    path = []
    while level < top:
        first = index - index % ARITY
        run = [made[level, i] for i in range(first, min(first + ARITY, width(leaves, level)))]
        path.append(("".join(run[: index - first]), "".join(run[index - first + 1 :])))
        level, index = level + 1, index // ARITY
    return path


def folded(node: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        node = digest_of([before, node, after])
    return node


def numbered(leaves: DataFrame, order: list[Column]) -> DataFrame:
    """``leaves`` (a ``tree`` column among others) with ``idx``, the place in its tree by
    ``order`` (trees sort as a whole), and ``leaves``, the tree's size.

    One range sort, written; numbers of a partition's trees are then summed, a row for each
    tree in each partition, so neither a large tree nor many small ones meet in one task."""
    at = F.monotonically_increasing_id()
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    ranged = _util.saved(ranged.withColumn("_part", F.shiftright("_at", 33)))
    counts = ranged.groupBy("_part", "tree").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = _util.saved(
        counts.select("_part", "tree", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("tree")).alias("leaves"))
    )
    # no hint: broadcast where its written size allows, else a shuffle join
    return ranged.join(counts, ["_part", "tree"]).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")


_NODE = "tree string, leaves long, level int, idx long, digest string"


def fragments(leaves: DataFrame, top: int = BLOCK) -> DataFrame:
    """The unresolved nodes of each task's leaves, merged up to level ``top``."""

    def run(batches):
        held: dict[tuple[str, int], Forest] = {}
        size = 0
        for batch in batches:
            for tree, n, i, d in zip(*(batch.column(c).to_pylist() for c in ("tree", "leaves", "idx", "digest")), strict=True):
                held.setdefault((tree, n), {})[0, i] = d
            size += len(batch)
            if size >= 1 << 16:
                yield _nodes(held, top)
                held, size = {}, 0
        yield _nodes(held, top)

    return leaves.select("tree", "leaves", "idx", "digest").mapInArrow(_util.lean(run), _NODE)


def _nodes(held: dict[tuple[str, int], Forest], top: int) -> pa.RecordBatch:
    rows = [(tree, n, level, i, d) for (tree, n), f in held.items() for (level, i), d in merged([f], n, top).items()]
    return _batch(rows, (("tree", pa.string()), ("leaves", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string())))


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
_PATH = "array<struct<before:string,after:string>>"


def _merger(low: int, top: int):
    """What a round does with a group: the node at level ``top`` (or the root below it), and
    each subtree's siblings from level ``low`` up to it."""

    def step(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, above, n = (k.as_py() for k in key)
        made: Forest = {}
        left = merged([{(a, i): d for a, i, d in zip(*(table.column(c).to_pylist() for c in ("level", "idx", "digest")), strict=True)}], n, top, made)
        (at, i), d = left.popitem()
        reach, start = min(top, height(n)), min(low, height(n))
        assert not left and at == reach, f"leaves of a block of {tree!r} are missing"
        rows = [(tree, n, at, i, d, -1, above, [])]
        if low:
            rows += [(tree, n, -1, -1, "", k, above, [{"before": x, "after": y} for x, y in siblings(made, n, lo, k, reach)]) for lo, k in made if lo == start]
        return pa.Table.from_batches([_batch(rows, _STEPS)])

    return step


def reduced(nodes: DataFrame, block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Tree reduction of fragments: (tree, leaves, root) and (tree, block, path), the
    siblings from each block of ``ARITY**block`` leaves up to its tree's root."""
    nodes = _util.saved(nodes)
    most = nodes.agg(F.max("leaves")).first()[0]  # one number
    h = height(most or 0)
    roots, rounds, low = [], [], 0
    while True:
        top = min(h, block if not rounds else low + fan)
        group = F.expr(f"idx div CAST(pow({ARITY}, {top} - level) AS BIGINT)")

        done = nodes.groupBy("tree", group.alias("above"), "leaves").applyInArrow(_merger(low, top), _NODE + f", below long, above long, path {_PATH}")
        done = _util.saved(done)
        rounds.append(done.filter("level < 0").select("tree", F.col("below").alias("_below"), F.col("above").alias("_above"), F.col("path").alias("_path")))
        up = done.filter("level >= 0").select("tree", "leaves", "level", "idx", "digest")
        if top == h:
            break
        nodes, low = up, top
    roots = up.select("tree", "leaves", F.col("digest").alias("root"))
    blocks = None
    for own in reversed(rounds[1:]):
        if blocks is None:
            blocks = own.select("tree", F.col("_below").alias("block"), F.col("_path").alias("path"))
        else:
            blocks = own.join(blocks.withColumnRenamed("block", "_above"), ["tree", "_above"]).select("tree", F.col("_below").alias("block"), F.concat("_path", "path").alias("path"))
    if blocks is None:
        blocks = up.select("tree", F.lit(0).cast("long").alias("block"), F.array().cast(_PATH).alias("path"))
    return roots, _util.saved(blocks)


_STEPS = (
    ("tree", pa.string()), ("leaves", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()),
    ("below", pa.int64()), ("above", pa.int64()), ("path", pa.list_(_STEP)),
)


def with_paths(leaves: DataFrame, blocks: DataFrame, finish, columns: str, block: int = BLOCK) -> DataFrame:
    """``finish(leaves of a block, their paths up to the block, the block's path)`` of every
    block of a tree, as a table of ``columns``."""

    def run(own: pa.Table, above: pa.Table) -> pa.Table:
        own = own.sort_by("idx")
        n, at, digests = own["leaves"][0].as_py(), own["idx"].to_pylist(), own["digest"].to_pylist()
        made: Forest = {}
        merged([{(0, i): d for i, d in zip(at, digests, strict=True)}], n, block, made)
        reach = min(block, height(n))
        upper = [(s["before"], s["after"]) for s in above["path"][0].as_py()]
        return finish(own, [siblings(made, n, 0, i, reach) + upper for i in at])

    keyed = leaves.withColumn("block", F.expr(f"idx div {ARITY**block}"))
    return keyed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, columns)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, tree, digest, tampered, idx, leaves): numbered leaves, one for each row."""
    cols = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(cols["doc_id"].cast("string").cast("binary")) % 7 == 0
    other = leaf([(c + 1) if name == "n_chars" else c for name, c in cols.items()])
    own = docs.select("doc_id", "lang", field(cols["lang"]).alias("tree"), leaf(cols.values()).alias("digest"), F.when(hit, other).alias("tampered"), F.monotonically_increasing_id().alias("_row"))
    # texts are read and hashed once; what follows reads narrow rows. The row's number splits a large run of equal rows
    return numbered(_util.saved(own), [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("_row")]).drop("_row")


def _joined(own: DataFrame, top: DataFrame) -> DataFrame:
    """Paths in a tree followed by its sub-root's path in the top tree."""
    return own.join(top, "tree").select("tree", "block", F.concat("path", "top_path").alias("path"))


def verified_tree(docs: DataFrame, block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(leaves, paths of their blocks up to the root, sub-roots, root)."""
    leaves = manifest(docs)
    roots, blocks = reduced(fragments(leaves, block), block, fan)
    roots = _util.saved(roots)
    names = leaves.filter("idx = 0").select("tree", "lang")
    tops = numbered(_util.saved(roots.join(names, "tree").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "lang", F.col("root").alias("digest"))), [F.col("lang").asc_nulls_first()])
    root, top_blocks = reduced(fragments(tops, block), block, fan)

    def finish(own: pa.Table, paths: list) -> pa.Table:
        path = pa.array([[{"before": a, "after": b} for a, b in p] for p in paths], pa.list_(_STEP))
        return pa.table({"tree": own["name"], "top_path": path})

    top_paths = with_paths(tops, top_blocks, finish, f"tree string, top_path {_PATH}", block)
    return leaves, _joined(blocks, top_paths), roots, root.select("root")


def proofs(docs: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(doc_id, leaf, path): every row's siblings, level by level up to the root."""
    leaves, paths, _, _ = verified_tree(docs, block, fan)

    def finish(own: pa.Table, found: list) -> pa.Table:
        return pa.table({"doc_id": own["doc_id"], "leaf": own["digest"], "path": pa.array([[{"before": a, "after": b} for a, b in p] for p in found], pa.list_(_STEP))})

    kind = dict(leaves.dtypes)["doc_id"]
    return with_paths(leaves, paths, finish, f"doc_id {kind}, leaf string, path {_PATH}", block)


def verify(docs: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """The digest: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Every leaf is folded with its own siblings, one in seven after it was tampered with."""
    leaves, paths, roots, root = verified_tree(docs, block, fan)

    def finish(own: pa.Table, found: list) -> pa.Table:
        changed = own["tampered"].to_pylist()
        digests = own["digest"].to_pylist()
        proof = [digest_of([s for step in p for s in step]) for p in found]
        again = [folded(c or d, p) for c, d, p in zip(changed, digests, found, strict=True)]
        return pa.table({"doc_id": own["doc_id"], "tree": own["tree"], "leaf": own["digest"], "proof_sha256": proof, "folded_root": again})

    kind = dict(leaves.dtypes)["doc_id"]
    out = with_paths(leaves, paths, finish, f"doc_id {kind}, tree string, leaf string, proof_sha256 string, folded_root string", block)
    out = out.join(roots.select("tree", F.col("root").alias("subroot")), "tree")
    # one row
    out = out.crossJoin(F.broadcast(root))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql() -> str:
    """The same manifest as recursive SQL. DuckDB has no CRC-32, so its steps are spelt out."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    whole = lambda n: "sha256(" + " || ".join(part(n if c == "n_chars" else c) for c in FIELDS) + ")"
    # a byte is xored in, then come eight shifts (-1); 3988292384 is the reversed polynomial
    crc = """xor(list_reduce(list_concat([4294967295], flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]
                 FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                 WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
    climb = lambda name, start, nodes, key: f"""
        {name} AS ({start} UNION ALL
            SELECT c.doc_id, c.lang, c.lv + 1, c.i // 2, (c.n + 1) // 2, c.path || coalesce(s.d, ''),
                   sha256(CASE WHEN c.i % 2 = 1 THEN s.d || c.h ELSE c.h || coalesce(s.d, '') END)
            FROM {name} c LEFT JOIN {nodes} s ON {key} s.lv = c.lv AND s.i = xor(c.i, 1) WHERE c.n > 1)"""  # noqa: E731
    levels = lambda name, start, lang: f"""
        {name} AS ({start} UNION ALL
            SELECT {lang} lv + 1, i // 2, max(n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY {lang} lv, i // 2)"""  # noqa: E731
    return f"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, lang, {whole('n_chars')} AS leaf, {whole('n_chars + 1')} AS other, {crc} % 7 = 0 AS hit,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents),
        {levels('own', "SELECT lang, 0 AS lv, i, n, leaf AS d FROM docs", "lang,")},
        sub AS (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM own WHERE n = 1),
        {levels('top', "SELECT 0 AS lv, i, n, d FROM sub", "")},
        {climb('a', "SELECT doc_id, lang, 0 AS lv, i, n, '' AS path, CASE WHEN hit THEN other ELSE leaf END AS h FROM docs", 'own', 's.lang IS NOT DISTINCT FROM c.lang AND')},
        {climb('b', "SELECT a.doc_id, a.lang, 0 AS lv, sub.i, sub.n, a.path, a.h FROM a JOIN sub ON a.n = 1 AND sub.lang IS NOT DISTINCT FROM a.lang", 'top', '')}
        SELECT b.doc_id, docs.leaf, sub.d AS subroot, top.d AS root, sha256(b.path) AS proof_sha256, b.h AS folded_root, b.h = top.d AS verified
        FROM b JOIN docs ON docs.doc_id = b.doc_id JOIN sub ON sub.lang IS NOT DISTINCT FROM b.lang JOIN top ON top.n = 1 WHERE b.n = 1"""
