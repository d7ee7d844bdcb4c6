"""Bounded training samples and the small trainers of the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _util


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def sample_ids(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` ids of each label value, those with the smallest hash.

    Rows with a null id or label don't count; an id with several labels takes
    the largest. Two runs over the same rows choose the same ids."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias(label_col))
    values = [r[0] for r in known.groupBy(label_col).count().orderBy(F.desc("count"), label_col).limit(65).collect()]
    frequent = values[:64]
    parts = [known.filter(F.col(label_col) == v).orderBy(F.xxhash64(id_col), id_col).limit(rows) for v in frequent]
    if len(values) > 64:
        # each of the others holds less than a 64th of the rows, so none is hot
        order = F.row_number().over(Window.partitionBy(label_col).orderBy(F.xxhash64(id_col), id_col))
        parts.append(known.filter(~F.col(label_col).isin(frequent)).withColumn("_n", order).filter(F.col("_n") <= rows).drop("_n"))
    out = parts[0] if parts else known.limit(0)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, object]]:
    """Distinct (text, label) pairs of a bounded sample, in a fixed order.

    The ids (at most ``rows`` of each label value) are broadcast, so the
    texts of the corpus are never shuffled."""
    ids = sample_ids(labels, id_col, label_col, rows).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    got = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(ids), "_id")
    rows_ = got.select("_text", "_label").dropDuplicates().collect()
    return sorted(((r._text, r._label) for r in rows_), key=lambda x: (x[1], x[0]))


def fitted(train, pairs: list, **options) -> dict:
    """The model that ``train`` makes of the pairs, in a driver that keeps no more than it."""
    model = train(pairs, **options)
    pairs.clear()
    _util.trim()
    return model


class Sparse:
    """Rows of (feature, value) in compressed form."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.indptr = np.concatenate([[0], np.cumsum([len(i) for i, _ in rows])]).astype(np.int64)
        self.index = np.concatenate([i for i, _ in rows] or [np.zeros(0, np.int64)]).astype(np.int32)
        self.value = np.concatenate([v for _, v in rows] or [np.zeros(0)]).astype(np.float64)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(self.indptr))
        self.n, self.width = len(rows), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.index], self.n)

    def tdot(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, self.value * g[self.row], self.width)


def adam(params: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    m = np.zeros_like(params)
    v = np.zeros_like(params)
    for t in range(1, steps + 1):
        g = gradient(params)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return params


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
