"""Embedding near-dedup by product quantisation.

Vectors are made unit length; equal ones are a class with a count. A coarse
quantiser of ``lists`` centroids (about the square root of the input, at most
65,536) assigns each class to an inverted list, where the residual is stored as
one byte per subspace. Each class is also a query: it probes the lists that can
hold a neighbour, compares its residual to the codes by asymmetric table lookup,
and those that come near enough are compared again by exact cosine in double
precision. Only pairs with cosine >= ``threshold`` link.

A list is probed if the query lies within ``reach`` of the plane between that
list's centroid and its own (a neighbour at distance ``reach`` can't be in any
other list), at most ``probes`` lists, nearest first. Every code keeps its own error
(how far its vector is from it) and passes if its distance is within ``reach`` plus that
error, which no neighbour exceeds. So ``probes=None`` finds every link; with a number,
links to lists beyond it can be lost. Recall against brute force is measured in the tests.

Lists of more than ``CHUNK`` classes are dealt out in chunks, and every query of
such a list goes to each of its chunks, so no task holds a hot list. Pairs are
not sent anywhere: a chunk reports how many vectors each query links to and a
spanning forest of the links.

Vectors of each length are searched among themselves. Vectors that are null, empty,
zero or hold null or non-finite components link with nothing. Rows with a null id
link with nothing, have a null component and are kept. Rows that repeat an id are
vectors of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _util, graph

SAMPLE, SUBSPACES, CHUNK, PROBES, SEED = 20_000, 16, 2048, 24, 42
#: single precision's share of a distance between vectors of unit length
ROUNDING = 1e-4


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].astype(np.float32)
    for _ in range(rounds):
        own = nearest(x, centre)
        count = np.bincount(own, minlength=len(centre))
        total = np.zeros_like(centre, np.float64)
        np.add.at(total, own, x)
        some = count > 0
        centre[some] = (total[some] / count[some, None]).astype(np.float32)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    half = (centre * centre).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centre.T - half, axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def train(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES) -> dict:
    """Coarse centroids and codebooks of 256 entries per subspace."""
    rng = np.random.default_rng(SEED)
    x = sample.astype(np.float32)
    coarse = _kmeans(x, lists, 6, rng)
    rest = x - coarse[nearest(x, coarse)]
    bounds = np.linspace(0, x.shape[1], min(subspaces, x.shape[1]) + 1).astype(int)
    books = [_kmeans(rest[:, a:b], 256, 4, rng) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return {"coarse": coarse, "books": books, "bounds": bounds}


def encode(rest: np.ndarray, model: dict) -> np.ndarray:
    b = model["bounds"]
    return np.stack([nearest(rest[:, b[j] : b[j + 1]], book) for j, book in enumerate(model["books"])], 1).astype(np.uint8)


def decode(codes: np.ndarray, model: dict) -> np.ndarray:
    return np.concatenate([book[codes[:, j]] for j, book in enumerate(model["books"])], 1)


def probed(x: np.ndarray, model: dict, reach: float, probes: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home list by row; row and list of every probe, of all lists if ``probes`` is None)."""
    c = model["coarse"]
    d = (x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T
    order = np.argsort(d, axis=1)[:, :probes]
    home = order[:, 0]
    gap = np.take_along_axis(d, order, 1) - d[np.arange(len(x)), home][:, None]
    apart = np.linalg.norm(c[order] - c[home][:, None], axis=2)
    row, col = np.nonzero(gap <= 2 * reach * apart + ROUNDING)
    return home, row, order[row, col]


def classes(rows: DataFrame, id_col: str, vec_col: str, spark_dim: int) -> DataFrame:
    """(node, copies, unit): distinct usable vectors, their smallest id and count."""
    v = F.col(vec_col)
    ok = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) == spark_dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    known = rows.filter(F.coalesce(ok, F.lit(False))).select(F.col(id_col), v.cast("array<double>").alias("v"))
    # a signed zero is no other vector
    return known.select(id_col, F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).groupBy("v").agg(F.min(id_col).alias("node"), F.count("*").alias("copies"))


def link(rows: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", probes: int | None = PROBES, sample: int = SAMPLE) -> DataFrame:
    """One row per row: (id, n_links, component_id, kept)."""
    # a vector alone with its length has no partner
    sizes = rows.groupBy(F.size(vec_col).alias("n")).count().filter("n > 0 AND count > 1").orderBy(F.desc("count"), "n").collect()
    parts = [p for p in (_links(rows, s.n, threshold, id_col, vec_col, probes, sample) for s in sizes) if p is not None]
    if not parts:
        return rows.select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"), F.lit(True).alias("kept"))
    known = parts[0]
    for p in parts[1:]:
        known = known.unionByName(p)
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda z: z + F.lit(0.0))
    whole = rows.select(id_col, F.when(F.col(id_col).isNotNull(), v).alias("v")).join(known, "v", "left")
    component = F.coalesce("component_id", id_col)
    return whole.select(id_col, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col(id_col).eqNullSafe(component).alias("kept"))


def _links(rows: DataFrame, dim: int, threshold: float, id_col: str, vec_col: str, probes: int | None, sample: int) -> DataFrame | None:
    """(v, n_links, component_id) of the usable vectors of one length, None if there are none."""
    spark = rows.sparkSession
    found = _util.saved(classes(rows, id_col, vec_col, dim))
    n = found.count()
    few = found.orderBy(F.xxhash64("v"), "node").limit(sample).select("v").toPandas()["v"]
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    if not len(few):
        return None
    x = unit(np.stack(few.to_numpy()))
    lists = int(min(65_536, max(1, np.sqrt(n)), len(x)))
    model = train(x, lists)
    kind = dict(found.dtypes)["node"]

    def assign(batches):
        for batch in batches:
            node, copies = batch.column(1), np.asarray(batch.column(2))
            v = unit(np.asarray(batch.column(0).flatten()).reshape(len(node), dim))
            for lo in range(0, len(v), 1024):
                part = v[lo : lo + 1024].astype(np.float32)
                home, row, to = probed(part, model, reach, probes)
                rest = part - model["coarse"][home]
                codes = encode(rest, model)
                error = np.linalg.norm(rest - decode(codes, model), axis=1).astype(np.float32)
                at = np.concatenate([np.arange(len(part)), row])
                is_query = np.concatenate([np.zeros(len(part), bool), np.ones(len(row), bool)])
                vec = pa.FixedSizeListArray.from_arrays(pa.array(v[lo : lo + 1024][at].reshape(-1)), dim).cast(pa.list_(pa.float64()))
                code = pa.array([None if q else codes[i].tobytes() for i, q in zip(at, is_query, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([home, to]).astype(np.int32)), pa.array(is_query), node[lo : lo + 1024].take(pa.array(at)), pa.array(copies[lo : lo + 1024][at]), vec, code, pa.array(error[at])],
                    names=["list", "is_query", "node", "copies", "v", "code", "error"],
                )

    placed = found.select("v", "node", "copies").mapInArrow(_util.lean(assign), f"list int, is_query boolean, node {kind}, copies long, v array<double>, code binary, error float")
    # how many chunks each list has: at most 65,536 rows
    load = found.select("v", "node", "copies").mapInArrow(lambda bs: (_homes(b, model, dim) for b in bs), "list int").groupBy("list").count()
    chunks = {r["list"]: -(-r["count"] // CHUNK) for r in load.filter(F.col("count") > CHUNK).collect()}
    n_chunks = F.lit(1)
    if chunks:
        table = spark.createDataFrame([(int(k), int(c)) for k, c in chunks.items()], "list int, n_chunks int")
        placed = placed.join(F.broadcast(table), "list", "left")
        n_chunks = F.coalesce("n_chunks", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("node"), n_chunks).cast("int"))
    each = F.sequence(F.lit(0), n_chunks - 1)
    dealt = placed.select("list", F.explode(F.when(F.col("is_query"), each).otherwise(own)).alias("chunk"), "is_query", "node", "copies", "v", "code", "error")

    def scan(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        query = np.asarray(group["is_query"])
        node = group["node"].to_numpy()
        copies = np.asarray(group["copies"])
        v = np.asarray(pa.concat_arrays(group["v"].chunks).flatten()).reshape(len(query), dim) if len(query) else np.zeros((0, dim))
        have, ask = np.flatnonzero(~query), np.flatnonzero(query)
        out_n, out_c, out_u, out_v = [], [], [], []
        if len(have) and len(ask):
            codes = np.stack([np.frombuffer(c, np.uint8) for c in group["code"].take(pa.array(have)).to_pylist()])
            limit = (reach + ROUNDING + np.asarray(group["error"])[have]) ** 2
            centre = model["coarse"][group["list"][0].as_py()]
            for lo in range(0, len(ask), 512):
                q = ask[lo : lo + 512]
                rest = v[q].astype(np.float32) - centre
                far = np.zeros((len(q), len(have)), np.float32)
                for j, book in enumerate(model["books"]):
                    a, b = model["bounds"][j], model["bounds"][j + 1]
                    far += ((rest[:, None, a:b] - book[None]) ** 2).sum(2)[:, codes[:, j]]
                i, k = np.nonzero(far <= limit)
                for s in range(0, len(i), 1 << 16):
                    x, y = q[i[s : s + (1 << 16)]], have[k[s : s + (1 << 16)]]
                    near = (np.einsum("ij,ij->i", v[x], v[y]) >= threshold) & (node[x] != node[y])
                    x, y = x[near], y[near]
                    if len(x):
                        one, at = np.unique(x, return_inverse=True)
                        out_n.append(node[one])
                        out_c.append(np.bincount(at, copies[y]).astype(np.int64))
                        f = graph.forest(x, y)
                        out_u.append(node[f[0]])
                        out_v.append(node[f[1]])
        kinds = group.schema.field("node").type
        first = [np.concatenate(z) if z else np.zeros(0, np.int64) for z in (out_n, out_c, out_u, out_v)]
        u, w = graph.forest(*(np.asarray(z) for z in first[2:])) if len(first[2]) else first[2:]
        counted = pa.table({"node": pa.array(first[0], kinds), "c": pa.array(first[1], pa.int64()), "other": pa.nulls(len(first[0]), kinds)})
        linked = pa.table({"node": pa.array(u, kinds), "c": pa.nulls(len(u), pa.int64()), "other": pa.array(w, kinds)})
        return pa.concat_tables([counted, linked])

    met = _util.saved(dealt.groupBy("list", "chunk").applyInArrow(scan, f"node {kind}, c long, other {kind}"))
    counts = met.filter("c IS NOT NULL").groupBy("node").agg(F.sum("c").alias("others"))
    joined = graph.components(met.filter("other IS NOT NULL").select("node", "other"))
    return found.join(counts, "node", "left").join(joined, "node", "left").select(
        "v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision; scaled first, so that no square overflows."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _homes(batch: pa.RecordBatch, model: dict, dim: int) -> pa.RecordBatch:
    v = unit(np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, dim)).astype(np.float32)
    return pa.RecordBatch.from_arrays([pa.array(nearest(v, model["coarse"]).astype(np.int32))], names=["list"])
