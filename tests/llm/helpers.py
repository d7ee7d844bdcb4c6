"""Brute-force versions and odd inputs."""

import re
from collections import Counter

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("key", "ids", "words", "block", "payload", "f0", "node", "component", "anchor", "toxicity", "score", "size", "slot", "shard", "virtual_slot", "t1", "_t1", "copies", "spans", "raw", "template", "id", "item_id", "_id", "_gone", "_null", "token_ids", "tail_probability", "lang_pred", "u", "v")


def fingerprint(text, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), seed=42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, linked):
    """Smallest index reachable, for each of n nodes."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def repeats(texts, length=200):
    """Per text: removed-byte mask, by counting every string."""
    data = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


def odd_docs(spark, extra=True):
    """Nulls in every column, empty and long texts, repeated rows and ids, ties."""
    long = "la la the of " * 6000 + "end"
    text = "Das ist ein Satz. " * 30
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "a", 5),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, long, "en", "a", len(long)),
        (5, text, "de", "b", len(text)),
        (6, text, "de", "b", len(text)),
        (6, text, "de", "b", len(text)),
        (7, "  \n\t ", "fr", "b", 4),
        (None, "no id here, only a text with some words", "en", "c", 3),
        (None, None, None, None, None),
        (8, "été <|endoftext|> 日本語   x's 12 km\x00\U0001f600", "fr", "c", 1),
        (8, "another text under the same id 8 with other words in it", "en", "c", 1),
        (-9, "a", "en", "c", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASH if c not in df.columns])
    return df, rows
