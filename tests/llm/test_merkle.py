"""The Merkle manifest against a plain tree, and the monoid's laws."""

import hashlib
import random
import zlib

import pytest

from kinweave.llm import merkle

from .helpers import DOCS, odd_docs


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    out = ""
    for c in ("doc_id", "source", "lang", "n_chars", "text"):
        v = row[c] + more if c == "n_chars" and row[c] is not None else row[c]
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def tree(nodes):
    """Root, and every leaf's (before, after) siblings."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            if other < len(level):
                paths[k].append((level[other], "") if i % 2 else ("", level[other]))
            else:
                paths[k].append(("", ""))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def plain(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    first = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))
    groups = [sorted((r for r in rows if r["lang"] == lang), key=first) for lang in langs]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, tops = tree([t[0] for t in trees])
    out = []
    for g, (sub, paths), top in zip(groups, trees, tops, strict=True):
        for r, p in zip(g, paths, strict=True):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, 1) if hit else leaf(r)
            for a, b in p + top:
                node = h(a, node, b)
            out.append((r["doc_id"], leaf(r), sub, root, h(*[s for step in p + top for s in step]), node, node == root))
    return out


def same(got, want):
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("block,fan", [(10, 8), (2, 1), (3, 2)])
def test_equals_a_plain_tree(spark, sf, block, fan):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = merkle.verify(docs, block, fan)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    same(rows, plain(docs.collect()))
    assert {r.verified for r in rows} == {True, False}


def test_odd_rows(spark):
    docs, _ = odd_docs(spark)
    same(merkle.verify(docs, 2, 1).collect(), plain(docs.select("doc_id", "text", "lang", "source", "n_chars").collect()))


def test_few_rows(spark):
    rows = [(1, "only", "en", None, 4)]
    same(merkle.verify(spark.createDataFrame(rows, DOCS)).collect(), plain(spark.createDataFrame(rows, DOCS).collect()))
    assert merkle.verify(spark.createDataFrame([], DOCS)).collect() == []


def test_proofs_fold_to_the_root(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    root = merkle.verify(docs).first().root
    for r in merkle.proofs(docs, 3, 2).collect():
        path = [(s.before, s.after) for s in r.path]
        assert merkle.folded(r.leaf, path) == root
        assert merkle.folded(h(r.leaf), path) != root


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 100])
def test_merging_is_associative_and_commutative(n):
    rng = random.Random(n)
    leaves = {(0, i): h(str(i)) for i in range(n)}
    want = tree([leaves[0, i] for i in range(n)])[0]
    for _ in range(20):
        parts = [{} for _ in range(rng.randint(1, 6))]
        for k, v in leaves.items():
            rng.choice(parts)[k] = v
        while len(parts) > 1:  # any order, any grouping
            rng.shuffle(parts)
            parts = [merkle.merged(parts[:2], n), *parts[2:]]
        assert merkle.merged(parts, n) == {(merkle.height(n), 0): want}


def test_fragments_hold_unresolved_nodes_only(spark, sf):
    left = merkle.merged([{(0, i): h(str(i)) for i in range(3, 90)}], 100)
    assert len(left) <= 2 * merkle.height(100)
    assert len(merkle.merged([{(0, i): h(str(i)) for i in range(96, 100)}], 100)) == 1  # the last run is known to be shorter
