"""Quality by ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(theta_k - w . x)``: one weight vector over hashed
text shared by all grades, and ordered thresholds. ``x`` holds the mean over a
text's words of two hashed features: the lower-cased word and its shape (runs
of letters, digits and other signs). The model gives the expected grade and the
probability of a grade above a chosen one, by which texts are selected.

Grades may be any number of ordered values; two make it a logistic regression.
Training takes a bounded sample of at most ``SAMPLE`` distinct rated texts of
each grade; scoring reads every whole text.

Nulls and empty texts have no features and score by the thresholds alone. With
fewer than two grades the model returns the only grade (or null) and tail 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _train, _util

DIM, SAMPLE, SCALE = 1 << 18, 3000, 10.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[[*range(0x30, 0x3A)]] = 0x30
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 0x61


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their shapes, one after the other for each word
    (2 x words), and the n + 1 offsets of the texts' words."""
    starts, ends, first = _util.words(data, offsets)
    word = _util.RangeHash(_LOWER[data])(starts, ends)
    kind = _CLASS[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    at = np.concatenate([[0], np.cumsum(new)])
    shape = _util.RangeHash(kind[new], 1)(at[starts], at[ends])
    both = np.stack([word, shape ^ np.uint64(0x5851F42D4C957F2D)], 1).reshape(-1)
    return (_util.mix(both) & np.uint64(DIM - 1)).astype(np.int64), first


def _row(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bucket, first = features(data, np.array([0, len(data)]))
    index, count = np.unique(bucket, return_counts=True)
    return index, SCALE * count / max(1, first[-1])


def train(pairs: list[tuple[str, object]], steps: int = 200, l2: float = 1e-4) -> dict:
    """The model of (text, grade) pairs: grades, weights, ordered thresholds."""
    grades = sorted({g for _, g in pairs})
    if len(grades) < 2:
        return {"grades": [float(g) for g in grades], "weight": np.zeros(DIM, np.float32), "theta": np.zeros(0)}
    x = _train.Sparse([_row(t) for t, _ in pairs], DIM)
    y = np.array([grades.index(g) for _, g in pairs])
    k = len(grades) - 1
    used = np.unique(x.index)
    place = np.zeros(DIM, np.int64)
    place[used] = np.arange(len(used))
    x.index, x.width = place[x.index], len(used)

    def thetas(p: np.ndarray) -> np.ndarray:
        return p[0] + np.concatenate([[0.0], np.cumsum(np.exp(p[1:k]))])

    def gradient(p: np.ndarray) -> np.ndarray:
        w, free = p[:-k], p[-k:]
        theta = np.concatenate([[-np.inf], thetas(free), [np.inf]])
        s = x.dot(w)
        hi, lo = _train.sigmoid(theta[y + 1] - s), _train.sigmoid(theta[y] - s)
        prob = np.maximum(hi - lo, 1e-12)
        up, down = hi * (1 - hi) / prob, lo * (1 - lo) / prob
        d_theta = np.bincount(y, -up, k + 1)[:k] + np.bincount(y[y > 0] - 1, down[y > 0], k)[:k]
        n = len(y)
        tail = np.cumsum(d_theta[::-1])[::-1]
        return np.concatenate([x.tdot((up - down) / n) + l2 * w, [tail[0] / n], tail[1:] * np.exp(free[1:]) / n])

    start = np.zeros(len(used) + k)
    start[-k:] = 0.0
    start[-k] = -(k - 1) / 2
    p = _train.adam(start, gradient, steps, 0.05)
    weight = np.zeros(DIM, np.float32)
    weight[used] = p[:-k]
    return {"grades": [float(g) for g in grades], "weight": weight, "theta": thetas(p[-k:])}


def grade_texts(data: np.ndarray, offsets: np.ndarray, model: dict, above: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and probability of a grade over ``above``."""
    n, grades, theta = len(offsets) - 1, np.array(model["grades"]), model["theta"]
    if len(grades) < 2:
        return np.full(n, grades[0] if len(grades) else np.nan), np.zeros(n)
    bucket, first = features(data, offsets)
    total = _util.sums(model["weight"][bucket].astype(np.float64), 2 * first)
    s = SCALE * total / np.maximum(1, np.diff(first))
    over = 1 - _train.sigmoid(theta[None, :] - s[:, None])
    expected = grades[0] + over @ np.diff(grades)
    k = int(np.searchsorted(grades, above, "right"))
    tail = np.ones(n) if k == 0 else np.zeros(n) if k >= len(grades) else over[:, k - 1]
    return expected, tail


def score(docs: DataFrame, model: dict, above: float = 0.0, text_col: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` (of a grade over
    ``above``), which replace columns of those names."""
    added = ("expected_grade", "tail_probability")
    kept = _util.without(docs, *added)
    _util.small_batches(docs.sparkSession)
    names = kept.columns

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            got = [grade_texts(data, offsets, model, above) for _, _, data, offsets in _util.pieces(text)]
            out = [np.concatenate([g[i] for g in got] or [np.zeros(0)]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out[0], from_pandas=True), pa.array(out[1])], names=[*names, *added])

    return kept.mapInArrow(_util.lean(run), _util.extended(kept, expected_grade="double", tail_probability="double"))


def fit(docs: DataFrame, ratings: DataFrame, grade_col: str = "quality", sample: int = SAMPLE, held_out: int = 5) -> dict:
    return _train.fitted(train, _train.labelled_texts(docs, ratings.filter(_train.fold("doc_id", held_out) != 0), grade_col, sample))


def select_by_quality(docs: DataFrame, ratings: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: expected grade, tail probability, whether it is held
    out from training and whether it is selected. Texts whose tail probability
    is ``threshold`` or more are selected."""
    scored = score(docs.select("doc_id", "text"), fit(docs, ratings))
    return scored.select(
        "doc_id",
        (_train.fold("doc_id", 5) == 0).alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= threshold).alias("selected"),
    )
