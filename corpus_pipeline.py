"""Corpus pipeline: toxicity, SimHash near-dedup, suffix-array dedup, benchmark
decontamination, BPE encoding and decoding.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. A stage works on all that the stage
before it kept: the first drops documents that score as toxic, the second keeps
one document (the smallest id) of each group of near copies (five-word shingles,
similarity 0.8 or more), the third cuts byte strings of 200 and more that repeat,
the fourth drops documents that hold a benchmark item, and the last gives the
token ids of what is left and the text that they decode to.

Nulls, empty texts, repeated rows and empty tables: as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import _util, bpe, decontaminate, simhash, suffix_dedup, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, _util.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedupe(docs, k=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.clean(docs, length=200)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, _util.table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens, decoded text."""
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("bpe encoding and decoding", tokenise),
]

#: SQL cannot express the stages; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _util.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = _util.saved(docs)
    return docs
