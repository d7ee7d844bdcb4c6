"""The pipeline stage by stage, against planted cases."""

import random

import corpus_pipeline as cp
from tokenizers import Tokenizer

from kinweave.llm import bpe

from .helpers import DOCS, odd_docs

INSULTS = ("zorgfool", "quaxhead", "blimpface")


def word(rng):
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))


def corpus():
    rng = random.Random(11)
    prose = lambda n: " ".join(word(rng) for _ in range(n))
    item, passage = prose(40), prose(60)
    rows, kind = [], {}

    def add(k, text):
        kind[len(rows)] = k
        rows.append((len(rows), text, "en", "s", len(text)))

    for _ in range(60):
        add("clean", prose(120))
    for i in range(30):
        w = prose(100).split()
        for _ in range(6):
            w[rng.randrange(100)] = INSULTS[i % 3]
        add("toxic", " ".join(w))
    for i in range(10):
        w = rows[i][1].split()
        w[40] = word(rng)
        add("near", " ".join(w))
        add("copy", rows[i + 20][1])
    for _ in range(5):
        add("passage", f"{prose(30)} {passage} {prose(30)}")
    add("leak", f"{prose(50)} {item} {prose(50)}")
    return rows, kind, item, passage


def test_stages(spark, tmp_path):
    rows, kind, item, passage = corpus()
    d = f"file://{tmp_path}"
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, int(k == "toxic")) for i, k in kind.items() if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash near-dedup", "suffix-array dedup", "benchmark decontamination", "bpe encoding and decoding"]
    docs, after = spark.read.parquet(f"{d}/documents.parquet"), []
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, d)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{d}/out{i}")
        docs = spark.read.parquet(f"{d}/out{i}")
        after.append({r.doc_id: r for r in docs.collect()})
    of = lambda k: {i for i, x in kind.items() if x == k}
    assert not of("toxic") & set(after[0]) and set(after[0]) == set(kind) - of("toxic")
    assert set(after[1]) == set(after[0]) - of("near") - of("copy")
    assert set(after[2]) == set(after[1])
    for i in of("passage"):
        assert passage not in after[2][i].text and after[2][i].n_chars == len(after[2][i].text) < rows[i][4]
    assert all(after[2][i].text == rows[i][1] for i in of("clean") if i in after[2])
    assert set(after[3]) == set(after[2]) - of("leak")
    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    for i, r in after[4].items():
        assert r.text == after[3][i].text and r.token_ids == tokenizer.encode(r.text, add_special_tokens=False).ids
    assert cp.run(spark, d).count() == len(after[4])


def test_odd_rows_and_empty_tables(spark, tmp_path):
    d = f"file://{tmp_path}"
    docs, rows = odd_docs(spark)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for name, df in (("all", docs), ("none", docs.limit(0))):
        now = df
        for i, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, now, d)
            assert i == 4 or out.columns == df.columns
            out.write.parquet(f"{d}/{name}{i}")
            now = spark.read.parquet(f"{d}/{name}{i}")
        assert (now.count() > 0) == (name == "all")
