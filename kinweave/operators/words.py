"""Candidates of a profile search by an index of neighbourhood words.

The neighbourhood of a profile's window of ``k`` columns is every word that scores at least
``least`` there. Scores are log odds, so a random word of the background belongs to it with a
probability of at most 2 to the minus ``least`` (in bits), whatever the profile: words of long odds
alone are kept, and the index finds relatives that share no exact word with any member.

A sequence is a candidate of a profile if two words of it hit on one diagonal (their
distance is that of their windows). A word that more than ``hot`` places of the
sequences have would bring all of them together with every profile that knows it; such
a word counts only if the word that follows it hits the following window too, and
the two are the join key. No place of a sequence is dropped and no hit is capped.

Everything is an equi join; only the neighbourhoods are enumerated in Python, from
one profile's scores at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written

K, LEAST, HOT = 5, 22, 100_000


def within(scores: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First column and letters (indices, n x k) of every word that scores ``least`` or more
    on ``k`` columns in a row. A prefix goes on while the best ending could still reach it."""
    top = scores.max(1, initial=-(1 << 30))
    first, letters = [], []
    for c in range(len(scores) - k + 1):
        have, words = np.zeros(1, scores.dtype), np.zeros((1, 0), np.int16)
        for j in range(c, c + k):
            every = have[:, None] + scores[j]
            row, letter = np.nonzero(every + top[j + 1 : c + k].sum() >= least)
            have, words = every[row, letter], np.column_stack([words[row], letter.astype(np.int16)])
        first.append(np.full(len(words), c))
        letters.append(words)
    return (np.concatenate(first), np.concatenate(letters)) if first else (np.zeros(0, int), np.zeros((0, k), np.int16))


def neighbourhood(columns: DataFrame, k: int = K, least: int = LEAST) -> DataFrame:
    """(family, col, word) of profiles given as (family, pos, residue, score): positions
    follow one another, a residue that a position lacks is in no word there."""

    def enumerated(df: pd.DataFrame) -> pd.DataFrame:
        alphabet = np.array(sorted(df.residue.unique()))
        start = int(df.pos.min())
        scores = np.full((int(df.pos.max()) - start + 1, len(alphabet)), -(1 << 20), np.int64)
        scores[df.pos - start, np.searchsorted(alphabet, df.residue)] = df.score
        first, letters = within(scores, k, least)
        words = ["".join(w) for w in alphabet[letters]]
        return pd.DataFrame({"family": [df.family.iloc[0]] * len(words), "col": (first + start).astype(np.int32), "word": words})

    known = columns.filter("family IS NOT NULL AND pos IS NOT NULL AND residue IS NOT NULL AND score IS NOT NULL").select("family", "pos", "residue", "score")
    return known.groupBy("family").applyInPandas(enumerated, f"family {dict(columns.dtypes)['family']}, col int, word string")


def places(sequences: DataFrame, k: int = K) -> DataFrame:
    """(id, pos, word, next): every place of a sequence, its word and the one after it."""
    at = F.when(F.length("seq") >= k, F.sequence(F.lit(1), F.length("seq") - (k - 1))).otherwise(F.array().cast("array<int>"))
    each = sequences.select("id", "seq", F.explode(at).alias("pos"))
    return each.select("id", "pos", F.substr("seq", "pos", F.lit(k)).alias("word"), F.substr("seq", F.col("pos") + k, F.lit(k)).alias("next"))


def candidates(columns: DataFrame, sequences: DataFrame, k: int = K, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """(family, id): the pairs that a profile search must look at. ``sequences``: id, seq."""
    index = written(neighbourhood(columns, k, least))
    found = places(sequences, k)
    common = written(found.groupBy("word").count().filter(F.col("count") > hot).select("word"))
    own, many = index.join(common, "word", "left_anti"), index.join(common, "word", "left_semi")
    # places are exploded: their size is not that of their files, so no task or driver may take them whole
    rare = own.join(found.join(common, "word", "left_anti").hint("merge"), "word")
    two = rare.groupBy("family", "id", (F.col("pos") - F.col("col")).alias("diagonal")).agg(F.count("*").alias("hits")).filter("hits >= 2")
    after = index.select("family", (F.col("col") - k).alias("col"), F.col("word").alias("next"))
    pairs = many.join(after, ["family", "col"]).select("family", "word", "next").distinct()
    both = pairs.join(found.join(common, "word", "left_semi").select("id", "word", "next").distinct().hint("merge"), ["word", "next"])
    return two.select("family", "id").unionByName(both.select("family", "id")).distinct()
