"""SimHash near-dedup by anchor points of a covering code.

**Fingerprints.** Words are runs of bytes other than ASCII white space, A-Z
lower-cased; shingles of k words (repeats included) hash by XXH64 with seed 42;
a bit is set if it is set in over half of the hashes. Further 64-bit words of a
wide fingerprint come from the same hashes, mixed with a constant each.

**Links of two fingerprints within t bits** (:func:`links`). The anchors are the
codewords of a product code over the 64 bits: repetition codes [3,1], each of
covering radius 1, on the first 3 * ``triples`` bits and the trivial code on the
rest, so every point is within R = ``triples`` of an anchor and decoding is a
majority vote per block. Two fingerprints at t bits or fewer have a point
between them within ceil(t / 2) of both; its nearest anchor is within
R + ceil(t / 2) of both. So each fingerprint is replicated to the nearest
anchors of all points within ceil(t / 2) of it (about 45 anchors for t = 2),
and those that meet at an anchor are compared. No link is lost. Of each anchor
only a spanning forest of its links goes on.

Equal fingerprints are one class before anything is replicated, so a group of
copies, however large, is one row. The number of distinct fingerprints that can
reach one anchor is bounded by the code, not by the data; many at one anchor
are compared through their neighbours, in n log n, not pairwise.

**Wide fingerprints** (:func:`similar`), for similarities that a few bits can't
express: 256 bits of the distinct shingles, of which the angle estimates the
similarity of the shingle sets with a standard error of 0.03 to 0.04. They only
choose candidates, four standard errors wide; a link is a pair of shingle sets whose
exact Jaccard similarity reaches the limit (:func:`verified`). Each of ``BANDS`` sub-fingerprints of
``BAND_BITS`` bits or more is its own anchor (trivial code, radius 0); what meets
at an anchor is compared over all 256 bits. Sub-fingerprints get a bit longer each
time the input doubles, so that chance meetings stay few, and their number grows by
1/0.85 with each bit, so that the share of similar pairs that meet stays: about 0.97
at a Jaccard similarity of 0.8, 0.99 at 0.87. Anchors with many candidates for their
size first give each node's nearest smaller one, of all its anchors together one, which joins the
groups of copies; then every pair that is still in two groups is compared again, by fingerprints of
``SKETCH_WORDS`` words which only the nodes at such anchors get. These tell similarities
to 0.01 or so; a pair four standard errors off goes no further, so texts that share much of
a template but are less similar than the limit are not brought together. The others leave
the task as chains, and the nodes of a chain are compared by their sets (:func:`alike`).

Nulls and texts without words have fingerprint zero, linked like any other in
:func:`clusters`; :func:`dedupe` keeps each of those that differ. Rows with a
null id get component null and are never representatives.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _util, graph

SEED, TRIPLES, BANDS, BAND_BITS, WIDE_WORDS, SKETCH_WORDS = 42, 9, 60, 16, 4, 32
DIRECT, PAIRS_A_NODE, BLOCK, BLOCK_HASHES = 192, 2, 512, 1 << 21


def shingle_hashes(text: str | None, k: int) -> list[int]:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return []
    one, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= k:
        return [one(b" ".join(words), seed)]
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - k]]
    return [one(joined[a : b - 1], seed) for a, b in zip(starts, ends[k - 1 :], strict=True)]


def fold_bits(hashes: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints (rows x width, uint64) of the hashes between offsets."""
    out = np.zeros((len(offsets) - 1, width), np.uint64)
    step = 1 << 15
    lo = 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + step, "right")) - 1)
        first, last = offsets[lo], offsets[hi]
        for j in range(width):
            total = np.zeros((hi - lo, 64), np.int64)
            for a in range(first, last, 8 * step):  # one very long text may hold more
                h = hashes[a : min(last, a + 8 * step)]
                if j:
                    h = _util.mix(h + np.uint64(j * 0x9E3779B97F4A7C15 & (2**64 - 1)))
                bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
                if hi - lo == 1:
                    total[0] += bits.sum(0, dtype=np.int64)
                else:
                    some = np.flatnonzero(offsets[lo + 1 : hi + 1] > offsets[lo:hi])
                    total[some] = np.add.reduceat(bits, offsets[lo:hi][some] - first, axis=0, dtype=np.int32)
            n = (offsets[lo + 1 : hi + 1] - offsets[lo:hi])[:, None]
            out[lo:hi, j] = np.packbits(2 * total > n, axis=1).view(">u8").reshape(-1).astype(np.uint64)
        lo = hi
    return out


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(np.array(shingle_hashes(text, k), np.uint64))


def digest(hashes: np.ndarray) -> int:
    """The name of a shingle set: a signed 64-bit integer."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def fingerprints(docs: DataFrame, k: int = 3, width: int = 1, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """(id, n_shingles, f0 ... f{width-1}): fingerprint words as signed 64-bit integers.
    ``distinct``: of shingle sets, a repeated shingle counts once; and their ``node``."""
    names = [f"f{j}" for j in range(width)]
    more = {"node": "long"} if distinct else {}

    def run(batches):
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for lo, hi, _, _ in _util.pieces(text):
                each = [(shingle_set if distinct else shingle_hashes)(t.as_py(), k) for t in text[lo:hi]]
                offsets = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
                flat = np.concatenate(each) if distinct else np.fromiter((h for e in each for h in e), np.uint64, int(offsets[-1]))
                f = fold_bits(flat, offsets, width)
                last = [pa.array([digest(e) for e in each], pa.int64())] if distinct else []
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(np.diff(offsets)), *[pa.array(f[:, j].view(np.int64)) for j in range(width)], *last], names=[id_col, "n_shingles", *names, *more])

    own = docs.select(F.col(id_col), F.col(text_col))
    _util.small_batches(docs.sparkSession)
    return own.mapInArrow(_util.lean(run), _util.extended(own.select(id_col), n_shingles="long", **dict.fromkeys(names, "long"), **more))


def anchors(f: np.ndarray, reach: int, triples: int = TRIPLES) -> tuple[np.ndarray, np.ndarray]:
    """(index of fingerprint, anchor) of all anchors nearest to a point within
    ``reach`` bits of each fingerprint."""

    def nearest(x: np.ndarray) -> np.ndarray:
        low = np.uint64(sum(1 << (3 * i) for i in range(triples)))
        a, b, c = x & low, (x >> np.uint64(1)) & low, (x >> np.uint64(2)) & low
        vote = (a & b) | (a & c) | (b & c)
        rest = np.uint64((1 << 64) - (1 << (3 * triples)))
        return (x & rest) | vote  # a block's vote stands for its codeword 000 or 111

    points = f[:, None]
    for _ in range(reach):
        flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
        points = (points[:, :, None] ^ flips).reshape(len(f), -1)
    near = np.sort(nearest(points), axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    return np.repeat(np.arange(len(f)), new.sum(1)), near[new]


def _near(f: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``bits`` in the runs [start, end) of ``f`` (rows x words).

    Runs of up to ``DIRECT`` are compared pair by pair, all runs at once; larger
    ones in rows of a block against the whole run, of which a forest stays."""
    out_a, out_b = [], []
    length = ends - starts
    small = length <= DIRECT
    index = np.concatenate([[0], np.cumsum(length[small])])
    at = np.arange(index[-1]) - np.repeat(index[:-1], length[small]) + np.repeat(starts[small], length[small])
    stop = np.repeat(ends[small], length[small])
    for lag in range(1, int(length[small].max(initial=0))):
        keep = at + lag < stop
        at, stop = at[keep], stop[keep]
        near = np.bitwise_count(f[at] ^ f[at + lag]).sum(1, dtype=np.int32) <= bits
        out_a.append(at[near])
        out_b.append(at[near] + lag)
    for s, e in zip(starts[~small], ends[~small], strict=True):
        own = f[s:e]
        a, b = (_neighbours(own[:, 0], bits) if f.shape[1] == 1 and bits <= 2 else _blocks(own, bits))
        out_a.append(a + s)
        out_b.append(b + s)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _neighbours(own: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within 2 bits of many fingerprints: each meets the
    others at its own value and at those one bit away."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    flips = flips if bits else flips[:1]
    key = (own[:, None] ^ flips).reshape(-1)
    who = np.repeat(np.arange(len(own)), len(flips))
    order = np.argsort(key, kind="stable")
    key, who = key[order], who[order]
    same = key[1:] == key[:-1]
    a, b = who[:-1][same], who[1:][same]
    near = np.bitwise_count(own[a] ^ own[b]) <= bits
    return graph.forest(a[near], b[near])


def _blocks(own: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links of one large run, a block of rows at a time. Nodes
    already linked to the block's first ones are compared once only."""
    left = np.arange(len(own))
    out_a, out_b = [], []
    while len(left) > 1:
        root, rest = left[0], left[1:]
        reached, new = [], np.array([root])
        while len(new) and len(rest):
            near = np.zeros(len(rest), bool)
            by = np.zeros(len(rest), np.int64)
            for x in new:
                todo = np.flatnonzero(~near)
                hit = todo[np.bitwise_count(own[rest[todo]] ^ own[x]).sum(1, dtype=np.int32) <= bits]
                near[hit] = True
                by[hit] = x
            reached.append((rest[near], by[near]))
            new, rest = rest[near], rest[~near]
        for x, y in reached:
            out_a.append(x)
            out_b.append(y)
        left = rest
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _forests(columns: list[np.ndarray], starts: np.ndarray, ends: np.ndarray, bits: int):
    """Edges of a forest of the links within ``bits`` of each run."""
    node = columns[0]
    a, b = _near(np.stack([c.view(np.uint64) for c in columns[1:]], 1), starts, ends, bits)
    yield graph.forest(node[a], node[b]) if len(a) else (a, b)


def _nearest(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Of pairs (a, b) that differ in d bits, those that hold the nearest ``a`` of each ``b``."""
    order = np.lexsort((a, d, b))
    return order[np.concatenate([[True], b[order][1:] != b[order][:-1]])[: len(order)]]


def _graded(columns: list[np.ndarray], starts: np.ndarray, ends: np.ndarray, bits: int, tight: int):
    """All pairs within ``bits`` of runs with few of them. Of other runs each node with its nearest
    smaller one within ``tight`` and their distance, and as an edge to itself: they are open."""
    node, f = columns[0], np.stack([c.view(np.uint64) for c in columns[1:]], 1)
    small = ends - starts <= DIRECT

    def one_each(a: np.ndarray, b: np.ndarray):
        a, b = np.minimum(a, b), np.maximum(a, b)  # a run ascends by node
        d = np.bitwise_count(f[a] ^ f[b]).sum(1, dtype=np.int32)
        kept = np.flatnonzero(d <= tight)
        kept = kept[_nearest(a[kept], b[kept], d[kept])]
        return node[a[kept]], node[b[kept]], d[kept]

    for lo in range(0, int(small.sum()), 4096):
        s, e = starts[small][lo : lo + 4096], ends[small][lo : lo + 4096]
        a, b = _near(f, s, e, bits)
        run = np.searchsorted(s, a, "right") - 1
        many = np.bincount(run, minlength=len(s)) > PAIRS_A_NODE * (e - s)
        yield node[a[~many[run]]], node[b[~many[run]]]
        yield one_each(a[many[run]], b[many[run]])
        for x, y in zip(s[many], e[many], strict=True):
            yield node[x:y], node[x:y]
    for x, y in zip(starts[~small], ends[~small], strict=True):
        a, b = _blocks(f[x:y], tight)
        yield one_each(x + a, x + b)
        yield node[x:y], node[x:y]


def _candidates(*args):
    """The pairs of :func:`_graded` alone."""
    for u, v, *_ in _graded(*args):
        yield u, v


def _across(columns: list[np.ndarray], starts: np.ndarray, ends: np.ndarray, bits: int, sketch_bits: int):
    """All pairs of two groups (the last column) within ``bits``, and within ``sketch_bits``
    of their sketches (the last but one), a block of rows at a time."""
    node, sketch, group, f = columns[0], columns[-2], columns[-1], np.stack([c.view(np.uint64) for c in columns[1:-2]], 1)
    for x, y in zip(starts, ends, strict=True):
        order = x + np.argsort(group[x:y], kind="stable")
        own, label = f[order], group[order]
        wide = np.frombuffer(b"".join(sketch[order].tolist()), np.uint64).reshape(len(order), -1)
        after = np.searchsorted(label, label, "right")  # the first row of a later group
        step = max(1, (1 << 20) // len(order))
        for lo in range(0, len(order), step):
            first = int(after[lo])
            if first == len(order):
                break
            near = np.zeros((min(step, len(order) - lo), len(order) - first), np.int32)
            for w in range(f.shape[1]):
                near += np.bitwise_count(own[lo : lo + step, w][:, None] ^ own[first:, w][None])
            a, b = np.nonzero((near <= bits) & (label[lo : lo + step][:, None] < label[first:][None]))
            for at in range(0, len(a), 1 << 14):
                u, v = lo + a[at : at + (1 << 14)], first + b[at : at + (1 << 14)]
                close = np.bitwise_count(wide[u] ^ wide[v]).sum(1, dtype=np.int32) <= sketch_bits
                yield node[order[u[close]]], node[order[v[close]]]


def _joined(columns: list[np.ndarray], starts: np.ndarray, ends: np.ndarray, bits: int, sketch_bits: int):
    """A forest of the pairs of :func:`_across` for each run: no more edges than nodes leave the task."""
    for x, y in zip(starts, ends, strict=True):
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for u, v in _across(columns, np.array([x]), np.array([y]), bits, sketch_bits):
            if len(u):
                held = graph.forest(np.concatenate([held[0], u]), np.concatenate([held[1], v]))
        yield held


def _meet(keyed: DataFrame, names: list[str], bits: int, search=_forests, *limits: int) -> DataFrame:
    """Edges (u, v, d) of ``node`` from rows (anchor, node, fingerprint words): rows of an
    anchor are brought together and sorted, then each run is searched. ``d`` is null, or the
    bits of an edge of which one of each node will do."""

    def run(batches):
        held = None
        tables = iter(batches)
        while True:
            batch = next(tables, None)
            if batch is not None:
                new = [np.asarray(batch.column(i)) for i in range(batch.num_columns)]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if held is None or not len(held[0]):
                if batch is None:
                    return
                continue
            anchor = held[0]
            edge = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            cut = len(anchor) if batch is None else (int(edge[-1]) if len(edge) else 0)
            if cut:
                bounds = np.concatenate([[0], edge[edge <= cut], [cut]] if batch is None else [[0], edge])
                starts, ends = bounds[:-1], bounds[1:]
                many = ends - starts > 1
                for u, v, *d in search([c[:cut] for c in held[1:]], starts[many], ends[many], bits, *limits):
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(d[0] if d else [None] * len(u), pa.int32())], names=["u", "v", "d"])
                held = [c[cut:] for c in held]
            if batch is None:
                return

    dealt = keyed.select("anchor", "node", *names).repartition("anchor").sortWithinPartitions("anchor", "node")
    return dealt.mapInArrow(_util.lean(run), "u long, v long, d int")


def links(classes: DataFrame, bits: int = 2, triples: int = TRIPLES) -> DataFrame:
    """Edges (u, v) between distinct 64-bit fingerprints (column ``f0``) that
    join all within ``bits`` of each other."""
    reach = math.ceil(bits / 2)

    def spread(batches):
        for batch in batches:
            f = np.asarray(batch.column(0)).view(np.uint64)
            for lo in range(0, len(f), 2048):
                who, anchor = anchors(f[lo : lo + 2048], reach, triples)
                own = f[lo : lo + 2048][who].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(own), pa.array(own)], names=["anchor", "node", "f0"])

    keyed = classes.select("f0").mapInArrow(_util.lean(spread), "anchor long, node long, f0 long")
    return _meet(keyed, ["f0"], bits).select("u", "v")


def similar_bits(similarity: float, width: int = WIDE_WORDS, errors: float = 4.0) -> int:
    """Differing bits expected of two shingle sets of this Jaccard similarity, and some standard errors."""
    p = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    n = 64 * width
    return round(n * p + errors * math.sqrt(n * p * (1 - p)))


def similar(classes: DataFrame, n_classes: int, similarity: float = 0.8, width: int = WIDE_WORDS) -> DataFrame:
    """Candidate pairs (u, v) of ``node``: wide fingerprints that may be similar enough. Pairs
    of a node with itself name those that need a second search, of ``classes`` with
    columns ``sketch`` and ``group``, which joins all pairs of two groups by chains."""
    size = max(BAND_BITS, math.ceil(math.log2(max(2, n_classes))) - 2)
    bands = max(BANDS, math.ceil(4.3 * (1 - 0.1515) ** -size))
    rng = np.random.default_rng(SEED)
    chosen = [np.sort(rng.choice(64 * width, size, replace=False)) for _ in range(bands)]
    words = [f"f{j}" for j in range(width)]
    again = "group" in classes.columns
    kinds = dict.fromkeys(words, "long") | ({"sketch": "binary", "group": "long"} if again else {})
    names = list(kinds)

    def spread(batches):
        for batch in batches:
            f = np.stack([np.asarray(batch.column(i)) for i in range(1, width + 1)], 1).view(np.uint64)
            bits = np.unpackbits(f.astype(">u8").view(np.uint8).reshape(len(f), -1), axis=1)
            for j, own in enumerate(chosen):
                key = np.zeros(len(f), np.uint64)
                for i in own:
                    key = (key << np.uint64(1)) | bits[:, i]
                anchor = _util.mix(key + np.uint64(j << 40)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), *batch.columns], names=["anchor", "node", *names])

    own = classes.select("node", *names)
    keyed = own.mapInArrow(_util.lean(spread), _util.extended(own.sparkSession.createDataFrame([], "anchor long"), node="long", **kinds))
    bits = similar_bits(similarity, width)
    if again:
        met = _meet(keyed, names, bits, _joined, similar_bits(similarity, SKETCH_WORDS))
    else:
        met = _meet(keyed, names, bits, _graded, similar_bits(similarity, width, 1.25))
    pair = met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "d")
    if again:
        return pair.select("u", "v").distinct()
    # all plain pairs; of a node's near ones at all anchors the nearest
    other = F.when(F.col("d").isNull(), F.col("u"))
    best = pair.groupBy("v", other.alias("_u")).agg(F.min(F.struct("d", "u")).alias("b"))
    return best.select("b.u", "v").distinct()


def shingle_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(node, set) of some nodes, written: the sets are made again, of one document of each."""
    wanted = _util.saved(nodes.distinct().join(classes.select("node", "first_id"), "node").select(F.col("node").alias("_node"), F.col("first_id").alias("_id")))

    def run(batches):
        for batch in batches:
            node, text = batch.column(0), batch.column(1)
            for lo, hi, _, _ in _util.pieces(text):
                each = [shingle_set(t.as_py(), k) for t in text[lo:hi]]
                # an id may have several texts
                same = [i for i, e in enumerate(each) if digest(e) == node[lo + i].as_py()]
                ends = np.concatenate([[0], np.cumsum([len(each[i]) for i in same])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *[each[i] for i in same]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([node[lo:hi].take(pa.array(same, pa.int64())), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["node", "set"])

    texts = docs.select(F.col(id_col), F.col(text_col)).join(wanted, F.col(id_col) == F.col("_id")).select("_node", text_col)
    return _util.saved(texts.mapInArrow(_util.lean(run), "node long, set array<long>").dropDuplicates(["node"]))


def sketched(sets: DataFrame) -> DataFrame:
    """(node, sketch): the bytes of ``SKETCH_WORDS`` fingerprint words of each set."""

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                lists = batch.column(1)[lo : lo + 256]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
                f = fold_bits(np.asarray(lists.flatten()).view(np.uint64), offsets, SKETCH_WORDS)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 256], pa.array([r.tobytes() for r in f], pa.binary())], names=["node", "sketch"])

    return sets.select("node", "set").mapInArrow(_util.lean(run), "node long, sketch binary")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of ``similarity`` or more.
    They meet as columns of hashes, so no more than two are held at a time."""
    side = lambda end, name: sets.select(F.col("node").alias(end), F.col("set").alias(name))
    both = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v")
    both = both.select("u", "v", F.size(F.array_intersect("a", "b")).alias("n"), (F.size("a") + F.size("b")).alias("of"))
    return both.filter(F.col("n") / (F.col("of") - F.col("n")) >= similarity).select("u", "v")


def alike(chains: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (u, v) that join all pairs of a Jaccard similarity of ``similarity`` or more among the
    nodes that ``chains`` (u, v) join. The nodes of a group meet in blocks of about
    ``BLOCK`` nodes and ``BLOCK_HASHES`` hashes, two blocks in a task; a task compares its sets
    and gives a forest, so pairs are rows nowhere."""
    each = _util.saved(graph.components(chains).join(sets, "node").select("component", "node", "set"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.size("set")) / BLOCK_HASHES)).cast("int")
    placed = each.join(each.groupBy("component").agg(blocks.alias("n")), "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    # with one other block, itself if there is one block only
    other = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda x: (x != F.col("own")) | (F.col("n") == 1))
    dealt = placed.select("component", "own", "node", "set", F.explode(other).alias("other"))
    dealt = dealt.select("component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "set")

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        lists = table.column("set").combine_chunks()
        flat, length = np.asarray(lists.flatten()), np.asarray(lists.value_lengths()).astype(np.int64)
        starts = np.cumsum(length) - length
        values, flat = np.unique(flat, return_inverse=True)
        has, u, v = np.zeros(len(values), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i in range(len(node) - 1):
            own = flat[starts[i] : starts[i] + length[i]]
            has[own] = True
            n = np.add.reduceat(has[flat[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1], dtype=np.int64)
            has[own] = False
            near = i + 1 + np.flatnonzero(n / (length[i] + length[i + 1 :] - n) >= similarity)
            u, v = np.append(u, np.full(len(near), node[i])), np.append(v, node[near])
            if len(u) > 1 << 18:
                u, v = graph.forest(u, v)
        u, v = graph.forest(u, v) if len(u) else (u, v)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.groupBy("component", "x", "y").applyInArrow(run, "u long, v long")


def clusters(docs: DataFrame, k: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest: id, fingerprint (16 hex digits), component_id (smallest id
    reachable by links of ``bits`` or fewer)."""
    prints = _util.saved(fingerprints(docs, k, 1, id_col, text_col).drop("n_shingles"))
    classes = prints.groupBy("f0").agg(F.min(id_col).alias("first_id"))
    found = graph.components(links(classes, bits)).select(F.col("node").alias("f0"), F.col("component").alias("label"))
    labelled = classes.join(found, "f0", "left").withColumn("label", F.coalesce("label", "f0"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    # the join on a hot fingerprint carries narrow rows and is split by adaptive execution
    return prints.join(labelled.join(smallest, "label").select("f0", "component_id"), "f0").select(
        id_col, F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id")
    )


def dedupe(docs: DataFrame, k: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document (the smallest id) of each group of near copies:
    sets of shingles of ``k`` words, Jaccard similarity of ``similarity`` or more. Of
    rows that repeat the kept id one stays, and rows of one id are one group. Texts
    without words, and rows with a null id, have nothing to compare or to be kept by:
    they stay."""
    width = WIDE_WORDS
    names = [f"f{j}" for j in range(width)]
    prints = _util.saved(fingerprints(docs, k, width, id_col, text_col, distinct=True).filter(F.col(id_col).isNotNull() & (F.col("n_shingles") > 0)))
    classes = _util.saved(prints.groupBy("node", *names).agg(F.min(id_col).alias("first_id")))
    twice = _util.saved(prints.groupBy(id_col).agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).filter("n > 1"))
    pairs = _util.saved(similar(classes, classes.count(), similarity, width))
    two = pairs.filter("u <> v")
    sets = shingle_sets(two.select(F.explode(F.array("u", "v")).alias("node")), classes, docs, k, id_col, text_col)
    edges = _util.saved(verified(two, sets, similarity))
    if not twice.filter("low <> high").isEmpty():
        own = prints.join(twice.select(id_col, "low"), id_col).filter("node <> low").select(F.col("low").alias("u"), F.col("node").alias("v"))
        edges = _util.saved(edges.union(own.distinct()))
    found = _util.saved(graph.components(edges))
    unsettled = pairs.filter("u = v").select(F.col("u").alias("node"))
    if not unsettled.isEmpty():
        rest = classes.join(unsettled, "node").join(found.withColumnRenamed("component", "group"), "node", "left")
        sets = shingle_sets(unsettled, classes, docs, k, id_col, text_col)
        rest = rest.join(sketched(sets), "node").select("node", *names, "sketch", F.coalesce("group", "node").alias("group"))
        chains = similar(rest, classes.count(), similarity, width)
        found = _util.saved(graph.components(edges.union(alike(chains, sets, similarity))))
    # what goes: all but the first of a group
    labelled = classes.join(found, "node", "left").select("node", "first_id", F.coalesce("component", "node").alias("label"))
    tops = labelled.join(labelled.groupBy("label").agg(F.min("first_id").alias("_top")), "label").select("node", "_top")
    gone = prints.join(tops, "node").filter(F.col(id_col) != F.col("_top")).select(F.col(id_col).alias("_gone")).distinct()
    left = docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    return _util.first_of_id(left, twice.select(F.col(id_col).alias("_twice")), id_col)
