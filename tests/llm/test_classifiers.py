import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from kinweave.llm import _util, langid, quality, queries, toxicity

from .helpers import odd_docs

SF = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op4_quality(spark, SF).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and np.mean([r.selected == bool(labels[r.doc_id]) for r in held]) > 0.9


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_langid(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97


def test_grades_are_ordinal():
    rng = np.random.default_rng(0)
    words = [["bad", "awful"], ["poor", "weak"], ["fair", "plain"], ["good", "fine"], ["great", "superb"]]
    pairs = [(" ".join(rng.choice(words[g], 12).tolist() + rng.choice(["the", "of", "and"], 20).tolist()), g) for g in range(5) for _ in range(40)]
    model = quality.train(pairs)
    assert (np.diff(model["theta"]) > 0).all()
    mean = []
    for g in range(5):
        data = " ".join(words[g] * 6 + ["the"] * 20).encode()
        mean.append(quality.grade_texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]), model, 2)[0][0])
    assert np.all(np.diff(mean) > 0)
    empty = quality.grade_texts(np.zeros(0, np.uint8), np.array([0, 0]), model, 2)
    assert 0 <= empty[1][0] <= 1


def test_one_class_or_none():
    t = toxicity.train([("a b c", 1)] * 3)
    assert toxicity.score_texts(pa.array(["x"]), t, np.zeros(toxicity.DIM, np.float32))[0] > 0.99
    none = toxicity.train([])
    assert toxicity.score_texts(pa.array(["", None], pa.string()), none, np.zeros(toxicity.DIM, np.float32)).max() < 0.01
    q = quality.train([])
    assert np.isnan(quality.grade_texts(np.zeros(0, np.uint8), np.array([0, 0]), q, 0)[0][0])
    assert langid.Scorer(langid.train([]))("hello") == ("und", 0.0)


def test_letters_are_of_category_l():
    s = langid.Scorer(langid.train([("haus maus", "de")] * 3))
    assert all(s(t) == ("und", 0.0) for t in ("²½ 12", "Ⅷ ⅷ ①", "_ __ 3rd"[:4], "٣٤"))
    assert s("一二")[0] == "de" and langid.runs("a²b½ç一Ⅷ") == ["a", "b", "ç一"]


def test_languages_equal_plain_sums(spark, sf):
    """The scorer on a whole table against sums over a dictionary, word by word."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for r in docs.collect():
        words = ["".join(g) for g in _runs_of_letters((r.text or "").lower())]
        if not words:
            assert got[r.doc_id].lang_pred == "und"
            continue
        total = [0.0] * len(model["langs"])
        for w in words:
            v = model["words"].get(w) or langid.backoff(w, model["grams"], len(total))
            total = [a + b for a, b in zip(total, v, strict=True)]
        best = max(range(len(total)), key=lambda i: total[i])
        assert got[r.doc_id].lang_pred == model["langs"][best]
        assert got[r.doc_id].score == pytest.approx(1 / sum(np.exp((t - total[best]) / len(words) ** 0.5) for t in total), rel=1e-6)


def _runs_of_letters(text):
    run = []
    for c in text + " ":
        if unicodedata.category(c).startswith("L"):
            run.append(c)
        elif run:
            yield run
            run = []


def test_toxicity_equals_plain_sums(spark, sf):
    """Scores of a whole table against sums over the set of n-grams of each text."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    weight = dict(zip(model["bucket"].tolist(), model["weight"].tolist(), strict=True))
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    mask = (1 << 64) - 1

    def bucket(gram):
        h = len(gram)
        for c in gram:
            h = (h * 0x100000001B3 + ord(c)) & mask
        h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
        return (h ^ h >> 31) % toxicity.DIM

    for r in docs.collect():
        t = pa.compute.utf8_lower(pa.scalar(r.text or "")).as_py()
        grams = {t[i : i + n] for n in toxicity.ORDERS for i in range(len(t) - n + 1)}
        z = sum(weight.get(b, 0.0) for b in {bucket(g) for g in grams}) + model["bias"]
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_grades_equal_plain_sums(spark, sf):
    """Grades of a whole table against sums over words and their shapes, word by word."""
    docs, ratings = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, ratings)
    got = {r.doc_id: r for r in quality.select_by_quality(docs, ratings).collect()}
    mask = (1 << 64) - 1

    def mix(h):
        h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
        return h ^ h >> 31

    def hashed(symbols, seed):
        base = mix(seed) | 1 if seed else 0x9E3779B97F4A7C15 | 1
        total, power = 0, 1
        for c in symbols:
            symbol = mix(c + 1)
            total += (mix((symbol + seed) & mask) if seed else symbol) * power
            power = power * base & mask
        return mix((total + len(symbols)) & mask)

    def kind(c):
        return 0x30 if 0x30 <= c <= 0x39 else 0x61 if 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 else c

    known = {}

    def weight(word):
        if word not in known:
            kinds = [kind(c) for c in word]
            shape = [c for i, c in enumerate(kinds) if not i or c != kinds[i - 1]]
            buckets = (hashed(word.lower(), 0), hashed(shape, 1) ^ 0x5851F42D4C957F2D)
            known[word] = sum(float(model["weight"][mix(b) & quality.DIM - 1]) for b in buckets)
        return known[word]

    low, high = model["grades"]
    for r in docs.collect():
        words = (r.text or "").encode().split()
        s = quality.SCALE * sum(map(weight, words)) / max(1, len(words))
        tail = 1 / (1 + np.exp(model["theta"][0] - s))
        assert got[r.doc_id].tail_probability == pytest.approx(tail, abs=1e-6)
        assert got[r.doc_id].expected_grade == pytest.approx(low + tail * (high - low), abs=1e-6)
        assert got[r.doc_id].selected == (got[r.doc_id].tail_probability >= 0.5)


def test_backoff_to_shorter_ngrams():
    model = langid.train([("haus maus laus", "de")] * 3 + [("house mouse louse", "en")] * 3)
    s = langid.Scorer(model)
    assert s("haus")[0] == "de" and s("housemouse")[0] == "en" and s("klaus")[0] == "de" and s("1234 !!")[0] == "und"


def test_word_boundaries_are_those_of_ascii_white_space():
    texts = ["a b", "", "  x\ty\n", "é  z", "last"]
    data, offsets = _util.bytes_of(pa.array(texts))
    starts, ends, first = _util.words(data, offsets)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == [t.encode().split() for t in texts]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    docs, rows = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (6, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    if empty:
        docs, labels, rows = docs.limit(0), labels.limit(0), []
    assert toxicity.predict(docs, labels).count() == len(rows)
    assert quality.select_by_quality(docs, labels).count() == len(rows)
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == "und" for r in got) >= sum(not any(ch.isalpha() for ch in r[1] or "") for r in rows)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert toxicity.score(docs, toxicity.train([])).columns.count("toxicity") == 1


def test_samples_hold_every_label_value(spark):
    from kinweave.llm import _train

    labels = spark.createDataFrame([(100 * v + i, f"v{v}") for v in range(70) for i in range(3 + v % 3)], "doc_id long, lang string")
    got = _train.sample_ids(labels, "doc_id", "lang", 4).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {f"v{v}": min(4, 3 + v % 3) for v in range(70)}
