"""Language identification, words first, with backoff to character n-grams.

A word that the training texts hold at least ``MIN_COUNT`` times scores by its
log frequency in each language. Any other word falls back: to its n-grams of 5
characters (word ends count as characters), if none is known to those of 4, and
so on down to 1. A text's prediction is the language with the highest sum.

Training takes a bounded sample of at most ``SAMPLE`` texts of each language, of any
number of languages; every word and n-gram of the sample that is frequent enough is in
the model. Prediction reads every whole text. A letter is a character of Unicode's
categories L.

A null text, a text without a letter, and any text when nothing was learned get
``und`` with score 0. Words in letters that no language has shown don't count;
if a text has no other, the first language in sorted order by prior wins.
Ties go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _train, _util

SAMPLE, MIN_COUNT, ORDERS, CACHE = 1200, 2, (5, 4, 3, 2, 1), 400_000


_ALPHANUMERIC = re.compile(r"[^\W\d_]+")


def runs(text: str) -> list[str]:
    """Runs of letters. What the pattern language calls alphanumeric holds other numbers too
    (superscripts, fractions, letter numbers), which are no letters and end a run."""
    found = _ALPHANUMERIC.findall(text)
    if text.isascii():
        return found
    out: list[str] = []
    for w in found:
        if w.isalpha():
            out.append(w)
        else:
            out += "".join(c if c.isalpha() else " " for c in w).split()
    return out


def train(pairs: list[tuple[str, str]]) -> dict:
    """The model of (text, language) pairs: tables of log frequencies."""
    langs = sorted({lang for _, lang in pairs})
    place = {lang: i for i, lang in enumerate(langs)}
    words: list[Counter] = [Counter() for _ in langs]
    for text, lang in pairs:
        words[place[lang]].update(runs(text.lower()))
    both: Counter = Counter()
    for c in words:
        both.update(c)

    def table(counts: list[Counter], kept) -> dict:
        total = [sum(c.values()) + len(kept) for c in counts]
        return {k: tuple(float(np.log((c[k] + 0.5) / t)) for c, t in zip(counts, total, strict=True)) for k in kept}

    known = [w for w, n in both.items() if n >= MIN_COUNT]
    grams = {}
    for n in ORDERS:
        counts: list[Counter] = []
        for c in words:
            own: dict[str, int] = defaultdict(int)
            for w, k in c.items():
                for g in cut(w, n):
                    own[g] += k
            counts.append(Counter(own))
        seen: Counter = Counter()
        for c in counts:
            seen.update(c)
        grams[n] = table(counts, [g for g, k in seen.items() if k >= MIN_COUNT])
    return {"langs": langs, "words": table(words, known), "grams": grams}


def cut(word: str, n: int) -> list[str]:
    """The n-grams of a word between its ends; none if it is shorter."""
    w = f"^{word}$" if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def backoff(word: str, grams: dict, n_langs: int) -> tuple[float, ...]:
    """Mean log frequency of the known n-grams of the longest order that has any."""
    for n in ORDERS:
        table = grams[n]
        found = [table[g] for g in cut(word, n) if g in table]
        if found:
            return tuple(sum(x) / len(found) for x in zip(*found, strict=True))
    return (0.0,) * n_langs


class Scorer(dict):
    """Word to row of a growing matrix; unseen words are scored once while they
    stay in the bounded cache."""

    def __init__(self, model: dict):
        self.model = model
        self.n = len(model["langs"])
        self.base = len(model["words"])
        self.rows = np.zeros((self.base + CACHE, self.n))
        for i, (w, v) in enumerate(model["words"].items()):
            self[w] = i
            self.rows[i] = v
        self.extra: list[str] = []

    def __missing__(self, word: str) -> int:
        i = self.base + len(self.extra)
        self.rows[i] = backoff(word, self.model["grams"], self.n)
        self.extra.append(word)
        self[word] = i
        return i

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = runs(text.lower()) if text and self.n else []
        if not found:
            return "und", 0.0
        total = np.zeros(self.n)
        for lo in range(0, len(found), CACHE // 2):
            part = found[lo : lo + CACHE // 2]
            if len(self.extra) + len(part) > CACHE:
                for w in self.extra:
                    del self[w]
                self.extra.clear()
            total += self.rows[list(map(self.__getitem__, part))].sum(0)
        best = int(np.argmax(total))
        p = np.exp((total - total[best]) / np.sqrt(len(found)))
        return self.model["langs"][best], float(1 / p.sum())


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of those names."""
    added = ("lang_pred", "score")
    kept = _util.without(docs, *added)
    _util.small_batches(docs.sparkSession)
    names = kept.columns

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            got = [scorer(t.as_py()) for t in batch.column(batch.schema.get_field_index(text_col))]
            new = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*names, *added])

    return kept.mapInArrow(_util.lean(run), _util.extended(kept, lang_pred="string", score="double"))


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict:
    """Learn from documents whose crc32(doc_id) mod 4 is not 2 and lang isn't null."""
    labels = docs.select("doc_id", "lang").filter(_train.fold("doc_id", 4) != 2)
    return _train.fitted(train, [(t, lang) for t, lang in _train.labelled_texts(docs, labels, "lang", sample) if t])


def identify(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, held_out, lang_pred, score."""
    scored = predict(docs.select("doc_id", "text"), fit(docs))
    return scored.select("doc_id", (_train.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
