"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

A text's features are the distinct character n-grams (3 to 5 code points,
lower case) it holds, hashed to ``DIM`` buckets. The ratio
``r = log(P(gram | toxic) / P(gram | clean))`` scales each feature, and a
logistic regression with L2 penalty weighs the scaled features. Only the
``KEPT`` most telling buckets (chi square) have a weight.

Training takes a bounded sample: at most ``SAMPLE`` distinct labelled texts of
each class. Scoring reads every whole text.

Nulls and empty texts score as texts without features. With no labelled rows,
or one class only, the score is the share of toxic rows in the sample (next to
0 if there is no sample, so that nothing is rejected unseen). Repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _train, _util

DIM, KEPT, SAMPLE, ORDERS = 1 << 20, 8192, 2500, (3, 4, 5)
PIECE = 1 << 18


def grams(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Buckets of the n-grams at each position, a list of (bucket, valid) by
    order, and the n + 1 offsets of the texts in code points."""
    lower = pc.utf8_lower(texts.fill_null(""))
    offsets = np.concatenate([[0], np.cumsum(pc.utf8_length(lower).to_numpy(zero_copy_only=False))]).astype(np.int64)
    data, _ = _util.bytes_of(lower)
    points = np.frombuffer(bytes(data).decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    out = []
    for n in ORDERS:
        m = max(0, len(points) - n + 1)
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + points[k : k + m]
        valid = np.ones(m, bool)
        for back in range(1, n):
            at = offsets[1:] - back
            at = at[(at >= offsets[:-1]) & (at < m)]
            valid[at] = False
        out.append(((_util.mix(h) & np.uint64(DIM - 1)).astype(np.int64), valid))
    return out, offsets


def _features(text: str) -> np.ndarray:
    found, _ = grams(pa.array([text], pa.string()))
    return np.unique(np.concatenate([b[v] for b, v in found]))


def train(pairs: list[tuple[str, int]], steps: int = 150, l2: float = 1e-3) -> dict:
    """The model of (text, 0 or 1) pairs: buckets, their weights, bias."""
    y = np.array([int(bool(label)) for _, label in pairs], np.float64)
    if len(y) == 0 or y.min() == y.max():
        rate = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
        return {"bucket": np.zeros(0, np.int64), "weight": np.zeros(0, np.float32), "bias": float(np.log(rate / (1 - rate)))}
    rows = [_features(t).astype(np.int32) for t, _ in pairs]
    count = [np.zeros(DIM), np.zeros(DIM)]
    for f, label in zip(rows, y, strict=True):
        count[int(label)][f] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    share = (count[1] + count[0]) / len(y)
    chi = (count[1] / n1 - count[0] / n0) ** 2 / np.maximum(share * (1 - share), 1e-9)
    chi[(count[0] + count[1]) < 3] = 0
    kept = np.sort(np.argsort(-chi, kind="stable")[:KEPT])
    kept = kept[chi[kept] > 0]
    p, q = count[1][kept] + 1, count[0][kept] + 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    place = np.full(DIM, -1, np.int64)
    place[kept] = np.arange(len(kept))
    own = [place[f][place[f] >= 0] for f in rows]
    x = _train.Sparse([(f, ratio[f]) for f in own], len(kept))

    def gradient(v: np.ndarray) -> np.ndarray:
        error = (_train.sigmoid(x.dot(v[:-1]) + v[-1]) - y) / len(y)
        return np.append(x.tdot(error) + l2 * v[:-1], error.sum())

    v = _train.adam(np.zeros(len(kept) + 1), gradient, steps, 0.05)
    return {"bucket": kept, "weight": (ratio * v[:-1]).astype(np.float32), "bias": float(v[-1])}


def score_texts(texts: pa.Array, model: dict, dense: np.ndarray) -> np.ndarray:
    found, offsets = grams(texts)
    n = len(texts)
    keys = []
    for bucket, valid in found:
        at = np.flatnonzero(valid & (dense[bucket] != 0))
        keys.append((np.searchsorted(offsets, at, "right") - 1) * DIM + bucket[at])
    key = np.unique(np.concatenate(keys))
    return _train.sigmoid(np.bincount(key // DIM, dense[key % DIM], n) + model["bias"])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` (0 to 1), which replaces one of that name."""
    kept = _util.without(docs, "toxicity")
    _util.small_batches(docs.sparkSession)
    names = kept.columns

    def run(batches):
        dense = np.zeros(DIM, np.float32)
        dense[model["bucket"]] = model["weight"]
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            out = [score_texts(text[lo:hi], model, dense) for lo, hi, _, _ in _util.pieces(text, PIECE)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out or [np.zeros(0)]), pa.float64())], names=[*names, "toxicity"])

    return kept.mapInArrow(_util.lean(run), _util.extended(kept, toxicity="double"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE, held_out: int = 5) -> dict:
    """Train on a sample of the labelled rows that are not held out."""
    return _train.fitted(train, _train.labelled_texts(docs, labels.filter(_train.fold("doc_id", held_out) != 0), label_col, sample))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", (_train.fold("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; same columns."""
    return score(docs, fit(docs, labels)).filter(F.col("toxicity") < threshold).select(*docs.columns)
