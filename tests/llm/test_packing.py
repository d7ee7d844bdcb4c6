"""Packing: the schedule against a sequential deficit round-robin, whole tables against the library."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from kinweave.llm import bpe, packing

from .helpers import DOCS, odd_docs


def round_robin(s):
    """Cells in the order of a sequential loop: the queue whose deficit reaches a cell first."""
    left, sent, out = list(s.cells), [0] * len(s.cells), []
    while sum(left):
        q = min((q for q in range(len(left)) if left[q]), key=lambda q: (Fraction(sent[q] + 1, int(s.weight[q])), q))
        out.append((q, sent[q]))
        sent[q] += 1
        left[q] -= 1
    return out


def drawn(seed):
    rng = random.Random(seed)
    cell = rng.choice([1, 4, 8])
    tokens = [rng.choice([0, rng.randint(0, 30), rng.randint(0, 3000)]) for _ in range(rng.randint(1, 7))]
    weights = None if rng.random() < 0.5 else [rng.choice([0, 1, 2.5, 7, 0.1]) for _ in tokens]
    return rng, packing.Schedule(tokens, weights, cell * rng.choice([1, 4, 8]), cell), tokens


@pytest.mark.parametrize("seed", range(40))
def test_any_task_finds_the_windows_of_the_sequential_loop(seed):
    _, s, _ = drawn(seed)
    order = round_robin(s)
    if order:
        queue, i = (np.array(x) for x in zip(*order, strict=True))
        per, at = s.length // s.cell, s.place(queue, i)
        assert (at // s.length == np.arange(len(order)) // per).all()
        assert sorted(at) == list(range(0, len(order) * s.cell, s.cell))
        for w in range(0, len(order), per):  # cells of a window stand by queue
            inside = sorted(zip(at[w : w + per], queue[w : w + per], strict=True))
            assert [q for _, q in inside] == sorted(queue[w : w + per])


def test_windows_keep_the_proportions_and_carry_deficits():
    s = packing.Schedule([300_000, 100_000, 50_000, 900], None, 2048, 256)
    order = round_robin(s)
    sent = Counter()
    for n, (q, _) in enumerate(order, 1):
        sent[q] += 1
        for k in range(4):
            assert abs(sent[k] - n * s.cells[k] / s.full) < 2
    heavy = packing.Schedule([300_000, 300_000], [3, 1], 2048, 256)
    first = Counter(q for q, _ in round_robin(heavy)[:800])
    assert first == {0: 600, 1: 200}


@pytest.mark.parametrize("seed", range(40))
def test_pieces_cover_documents_and_fill_sequences(seed):
    rng, s, tokens = drawn(seed)
    docs = []
    for q, total in enumerate(tokens):
        p = 0
        while p < total:
            docs.append((q, p, min(total - p, rng.randint(1, 40))))
            p += docs[-1][2]
    if not docs:
        return
    rng.shuffle(docs)
    got = s.pieces(*(np.array(x) for x in zip(*docs, strict=True)))
    check([(d, a, n, seq, off, docs[d][2]) for d, a, n, seq, off in zip(*got.values(), strict=True)], s.length)


def check(pieces, length):
    """Pieces (document, start, length, sequence, offset, tokens) cover every document and every sequence."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for d, a, n, seq, off, total in pieces:
        assert n > 0
        docs[d, total].append((a, n))
        seqs[seq].append((off, n))
    for (_, total), parts in docs.items():
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end == total
    short = 0
    for parts in seqs.values():
        end = 0
        for off, n in sorted(parts):
            assert off == end
            end += n
        assert end == length or end < length and end & (end - 1) == 0  # no padding at all
        short += end < length
    assert sorted(seqs) == list(range(len(seqs))) and short <= 11


def ids_of(texts):
    t = Tokenizer.from_file(bpe.vocabulary_path())
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    ids = dict(zip(texts, ids_of(texts.values()), strict=True))
    got = packing.digest(docs).collect()
    for r in got:
        own = np.array(ids[r.doc_id], "<u4")
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length]) == r.ids_crc32
    assert {r.doc_id for r in got} == set(ids)
    check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset, r.doc_tokens) for r in got], 2048)
    # mixture: every window holds each source's share to within two cells
    total = Counter()
    by_window = defaultdict(Counter)
    for r in got:
        total[r.source] += r.length
        by_window[r.sequence_id][r.source] += r.length
    all_tokens = sum(total.values())
    so_far = Counter()
    for w in range(all_tokens // 2048 - len(total)):
        so_far += by_window[w]
        for s, t in total.items():
            assert abs(so_far[s] - (w + 1) * 2048 * t / all_tokens) <= 3 * packing.CELL


def test_sequences_hold_the_ids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    pieces = packing.pack(docs, length=64, cell=16, mixture={"books": 2.0})
    seqs = packing.sequences(pieces).collect()
    assert sum(len(r.token_ids) for r in seqs) == sum(map(len, ids_of([r.text for r in docs.collect()])))
    assert all(sum(r.lengths) == len(r.token_ids) <= 64 for r in seqs)


def test_odd_rows(spark):
    docs, rows = odd_docs(spark)
    got = packing.pack(docs).collect()
    assert got[0].asDict().keys() == {"doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "token_ids"}
    want = Counter(tuple(x) for x in ids_of([r[1] for r in rows]))
    assert sum(len(r.token_ids) for r in got) == sum(len(k) * v for k, v in want.items())
    alone = [r for r in got if r.length == r.doc_tokens]
    assert {tuple(r.token_ids) for r in alone} <= set(want)
    assert sum(r.token_ids == [1] for r in alone) == 3  # null and empty texts
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    assert all(sorted(p)[0][0] == 0 and sum(n for _, n in p) == max(o + n for o, n in p) for p in seqs.values())
    assert packing.digest(spark.createDataFrame([], DOCS)).collect() == []


def test_more_sources_than_queues(spark):
    docs = spark.createDataFrame([(i, f"text of {i} with some words", "en", f"s{i % 30}", 1) for i in range(120)], DOCS)
    got = packing.pack(docs, length=64, cell=16, queues=5).collect()
    assert {r.source for r in got} == {None, "s0", "s1", "s10", "s11"}
    check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset, r.doc_tokens) for r in got], 64)
