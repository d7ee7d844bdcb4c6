import hashlib

import numpy as np
from tokenizers import Tokenizer

from kinweave.llm import bpe

from .helpers import odd_docs

TOKENIZER = Tokenizer.from_file(bpe.vocabulary_path())


def want(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    decoded = TOKENIZER.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_whole_table_equals_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digest(docs).collect()}
    assert got == {i: want(t) for i, t in texts.items()}


def test_odd_rows(spark):
    docs, rows = odd_docs(spark)
    got = sorted(tuple(r)[1:] for r in bpe.digest(docs).collect())
    assert got == sorted(want(r[1]) for r in rows)
    back = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in rows)
    trip = bpe.round_trip(docs).collect()
    assert sorted(r.text for r in trip) == sorted(r[1] or "" for r in rows) and all(len(r.token_ids) == r.n_tokens for r in trip)


def test_word_splits_at_special_tokens_and_spaces(spark):
    odd = ["!!<|endoftext|>??", "a  <|endoftext|>  b", "<|endoftext|", "x\n\n\n y\t\tz", "don't we'LL I'm", "*" * 30000, " " * 20000 + "x", "a　 b\u0085c", "１２³½ⅷ", "é́̂x"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in bpe.digest(docs).collect()} == {i: want(t)[0] for i, t in enumerate(odd)}
    assert {r.doc_id: r.ids_sha256 for r in bpe.digest(docs).collect()} == {i: want(t)[1] for i, t in enumerate(odd)}


def test_empty_table_and_unknown_ids(spark):
    docs, _ = odd_docs(spark)
    assert bpe.digest(docs.limit(0)).count() == 0
    ids = spark.createDataFrame([(1, [464, 99999, -1]), (2, None), (3, [])], "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(ids).collect()} == {1: "The", 2: "", 3: ""}
