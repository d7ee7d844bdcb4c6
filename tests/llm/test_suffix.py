import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.llm import suffix, suffix_dedup

from .helpers import odd_docs, repeats


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=70), st.integers(1, 3))
def test_suffix_array_and_prefixes(symbols, times):
    t = np.array(symbols * times, np.uint8)
    b = t.tobytes()
    sa = suffix.suffix_array(t)
    assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    phi, plcp = suffix.common_prefixes(t, sa)
    for p, q in zip(sa[1:].tolist(), sa[:-1].tolist(), strict=True):
        n = 0
        while max(p, q) + n < len(b) and b[p + n] == b[q + n]:
            n += 1
        assert phi[p] == q and plcp[p] == n


def check(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digest(docs, **options).collect()}
    for i, (t, gone) in enumerate(zip(texts, repeats(texts), strict=True)):
        data = np.frombuffer((t or "").encode(), np.uint8)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert got[i] == (len(data), int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()), i


def noise(rng, n):
    return "".join(chr(c) for c in rng.integers(97, 123, n))


def cases():
    rng = np.random.default_rng(5)
    p, q = noise(rng, 260), noise(rng, 199)
    texts = [noise(rng, 300) + p + noise(rng, 100), p + noise(rng, 50), noise(rng, 10) + p[:200], noise(rng, 10) + p[60:], q + noise(rng, 40), noise(rng, 40) + q]
    texts += ["x" * 5000, "ab" * 300, noise(rng, 90) * 5, noise(rng, 150) * 2, "", None, p, p, "é" * 150, "é" * 100 + "x", "short"]
    base = noise(rng, 900)
    texts += [base[: 40 * i] + "Z" + base[40 * i + 1 :] for i in range(20)]
    return texts


def test_against_counting_every_string(spark):
    check(spark, cases())


@pytest.mark.parametrize("size", [300])
def test_hot_keys_are_cut_again(spark, monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "SHARD", size)
    check(spark, cases())


def test_hot_passage_amid_different_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    for n in (120, 199):
        p = noise(rng, n)
        check(spark, [noise(rng, 150) + p + noise(rng, 150) for _ in range(12)] + [p + "x" * 120, "z" + p + "x" * 120])


def test_texts_that_polynomial_hashes_confuse(spark):
    # the Thue-Morse sequence and its complement collide for every base modulo 2^64
    a = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    b = a.translate(str.maketrans("ab", "ba"))
    check(spark, ["zq" * 20 + a, "zq" * 20 + b])
    check(spark, ["zq" * 20 + a + "zq" * 90, "zq" * 20 + b + "zq" * 90, a[:300], b[300:]])


def test_long_texts_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[1500:2500] = data[200:1200]
    offsets = np.array([0, 700, 700, 1400, 3000])
    each = lambda w: sorted((i, k) for f, n, k in zip(*w[:3], strict=True) for i in range(f, f + n))
    whole = each(suffix_dedup.windows(data, offsets))
    monkeypatch.setattr(suffix_dedup, "LONG", 1000)
    assert each(suffix_dedup.windows(data, offsets)) == whole


def test_odd_rows(spark):
    docs, rows = odd_docs(spark)
    got = sorted(((r.n_bytes, r.n_removed) for r in suffix_dedup.digest(docs).collect()))
    assert got == sorted((len((r[1] or "").encode()), int(g.sum())) for r, g in zip(rows, repeats([r[1] for r in rows]), strict=True))
    kept = suffix_dedup.clean(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert kept.filter("text IS NULL").count() == sum(r[1] is None for r in rows)
    assert kept.filter("n_chars <> length(text)").count() == 0
    assert suffix_dedup.digest(docs.limit(0)).count() == 0 and suffix_dedup.clean(docs.limit(0)).count() == 0


@pytest.mark.parametrize("cut", [200, 201])
def test_cut_characters(spark, cut):
    text = "x" + "é" * 130
    docs = spark.createDataFrame([(1, text, "en", "s", 131), (2, "y" + text[1:], "en", "s", 131)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.text for r in suffix_dedup.clean(docs).collect()} == {"x", "y"}
