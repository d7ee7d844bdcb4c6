"""Family growth in rounds against the plain loop, the word index against the full search."""

import random

import numpy as np
import pytest

from kinweave import schemas
from kinweave.config import Config, Quirks
from kinweave.operators import alignments, growth, words
from kinweave.operators.kernels import AMINO, Kernels


def random_seq(rng, n):
    return "".join(rng.choice(AMINO) for _ in range(n))


def mutated(rng, s, share):
    return "".join(rng.choice(AMINO) if rng.random() < share else c for c in s)


def with_indel(rng, s):
    at = rng.randrange(10, len(s) - 10)
    return s[:at] + random_seq(rng, 3) + s[at:] if rng.random() < 0.5 else s[:at] + s[at + 3 :]


def plain(members, pool, config, k):
    """One family from its members and all sequences, in memory."""
    seed = k.align([n for n, _ in members], [s for _, s in members])
    seen, converged, model = set(), False, None

    def hits(model, final):
        out = []
        for name, s in pool:
            for h in k.domains(model, s, len(pool), config.recruit_e_value):
                size = h.env_to - h.env_from + 1
                if final or size >= config.recruit_length_fraction * model.length:
                    out.append((h.e_value, name if size == len(s) else f"{name}/{h.env_from}_{h.env_to}", s[h.env_from - 1 : h.env_to]))
        return [(n, s) for _, n, s in sorted(out)]

    def bad(rows):
        n = sum(c not in ".-~" for c in rows[0][1])
        return growth.TOO_SMALL if n < config.min_rep_length else growth.TOO_LARGE if n > config.max_rep_length else None

    for _ in range(3):
        model = k.profile(seed, config.gap_occupancy)
        found = hits(model, False)
        if not found:
            return growth.NO_HITS, None, None, None
        new = {n.split("/")[0] for n, _ in found} - seen
        seen |= new
        if not new:
            converged = True
            break
        rows = k.align_to(model, *zip(*found, strict=True))
        if bad(rows):
            return bad(rows), None, None, None
        seed = k.clip(k.trim(rows, config.max_seed_identity, config.max_seed_sequences), config.gap_occupancy, config.quirks.exclusive_clip_end)
    last = model if config.quirks.final_search_fast_model else k.profile(seed, config.gap_occupancy)
    found = hits(last, True)
    if not found:
        return growth.NO_HITS, None, None, None
    own = {n for n, _ in members}
    if len(own & {n.split("/")[0] for n, _ in found}) / len(members) < config.min_starting_membership:
        return growth.FEW, None, None, None
    rows = k.align_to(last, *zip(*found, strict=True))
    return bad(rows) or "ok", rows, seed, converged


def world():
    """Four clusters: close relatives, an indel family with tandem repeats, far relatives to recruit, and noise."""
    rng = random.Random(11)
    seqs, clusters = [], []
    for f, (length, share) in enumerate([(90, 0.1), (110, 0.3), (100, 0.45)]):
        base = random_seq(rng, length)
        for i in range(9):
            s = mutated(rng, base, share)
            if f == 1:
                s = with_indel(rng, s) if i < 7 else s + random_seq(rng, 25) + mutated(rng, base, 0.2)
            seqs.append((f"f{f}m{i}", s))
            if i < 6:
                clusters.append((f"f{f}m0", f"f{f}m{i}"))
    seqs += [(f"noise{i}", random_seq(rng, 120)) for i in range(12)]
    clusters += [("noise0", "noise0"), ("noise0", "noise1"), ("gone", "gone"), ("tiny", "tiny")]
    seqs += [("tiny", random_seq(rng, 30)), ("null", None), (None, "AAAA")]
    return clusters, seqs


@pytest.mark.parametrize("config,size", [(Config(max_seed_identity=0.7), 2000), (Config(max_seed_identity=0.6, max_seed_sequences=4, quirks=Quirks(final_search_fast_model=False, exclusive_clip_end=False)), 3)])
def test_rounds_equal_the_plain_loop(spark, config, size):
    clusters, seqs = world()
    known, k = [(n, s) for n, s in seqs if n and s], Kernels()
    every = spark.createDataFrame(known, schemas.SEQUENCE).select("id")
    got = growth.grown(
        spark.createDataFrame(clusters, schemas.CLUSTER), spark.createDataFrame(seqs, schemas.SEQUENCE), config, k, size,
        searched=lambda found, _: found.select("family").crossJoin(every),
    )
    results = {r.representative: r for r in got.results.collect()}
    assert set(results) == {c for c, _ in clusters}
    tables = [{}, {}]
    for table, df in zip(tables, (got.rows, got.seeds), strict=True):
        for r in df.orderBy("n").collect():
            table.setdefault(r.representative, []).append((r.name, r.aligned))
    seq_of = dict(known)
    for rep in results:
        members = sorted((m, seq_of[m]) for c, m in clusters if c == rep and m in seq_of)
        status, rows, seed, converged = plain(members, sorted(known), config, k) if members else (growth.NO_HITS, None, None, None)
        r = results[rep]
        assert r.status == status, rep
        if status == "ok":
            assert tables[0][rep] == rows and r.size == len(rows)
            assert sorted(tables[1][rep]) == sorted(seed) and r.converged == converged
            model = k.profile(seed, config.gap_occupancy)
            assert (r.consensus, r.rf) == (model.consensus, model.rf)
        else:
            assert rep not in tables[0]
    assert {r.status for r in results.values()} >= {"ok", growth.NO_HITS}
    # all domains of a protein are recruited
    assert sum(n.startswith("f1m8/") for n, _ in tables[0]["f1m0"]) == 2
    assert {r.reason for r in growth.discarded(got.results).collect()} == {r.status for r in results.values()} - {"ok"}


def test_moving_envelopes_are_no_new_proteins(spark):
    """A family converges when its proteins stay, though an envelope moves."""

    class Moving(Kernels):
        def domains(self, profile, seq, database, most=0.001):
            found = super().domains(profile, seq, database, most)
            for h in found:
                h.env_from = 1 + profile.length % 3  # moves with the model
            return found

    rng = random.Random(2)
    base = random_seq(rng, 100)
    seqs = [(f"p{i}", mutated(rng, base, 0.15)) for i in range(8)]
    config = Config(max_seed_identity=0.99)
    got = growth.grown(spark.createDataFrame([("p0", n) for n, _ in seqs], schemas.CLUSTER), spark.createDataFrame(seqs, schemas.SEQUENCE), config, Moving())
    assert [r.converged for r in got.results.collect()] == [True]


def test_growth_of_nothing(spark):
    got = growth.grown(spark.createDataFrame([], schemas.CLUSTER), spark.createDataFrame([], schemas.SEQUENCE))
    assert got.results.count() == got.rows.count() == got.seeds.count() == 0


def test_index_finds_what_the_full_search_finds(spark):
    """Recall over relatives that share ever fewer residues with the seed's ancestor."""
    rng, k = random.Random(5), Kernels()
    base = random_seq(rng, 120)
    seed = [mutated(rng, base, 0.35) for _ in range(20)]
    rows = [("fam", a) for _, a in k.align([str(i) for i in range(20)], seed)]
    found = growth.models(spark.createDataFrame(rows, "family string, aligned string"), 0.5, k)
    model = growth.profile_from(found.first())
    relatives = [(f"r{share}_{i}", with_indel(rng, mutated(rng, base, share))) for share in (0.3, 0.5, 0.55, 0.6) for i in range(40)]
    others = [(f"x{i}", random_seq(rng, 150)) for i in range(150)]
    seqs = spark.createDataFrame(relatives + others, schemas.SEQUENCE)
    full = {n for n, s in relatives + others if k.domains(model, s, len(relatives) + len(others))}
    assert len(full) > 120
    columns = growth.columns_of(found)
    got = {r.id for r in words.candidates(columns, seqs).collect()}
    assert len(full & got) >= 0.95 * len(full)
    hard = {n for n in full if n.startswith("r0.6")}
    assert len(hard & got) >= 0.9 * len(hard)
    assert sum(n.startswith("x") for n in got) < 0.3 * len(others)
    # words that count as common are split by the next word: still found, and nothing is dropped
    split = {r.id for r in words.candidates(columns, seqs, hot=5).collect()}
    easy = {n for n in full if n.startswith("r0.3")}
    assert len(easy & split) >= 0.9 * len(easy)


def test_words_within_a_score():
    rng = np.random.default_rng(1)
    scores = rng.integers(-4, 8, (7, 4))
    first, letters = words.within(scores, 3, 9)
    want = {(c, a, b, d) for c in range(5) for a in range(4) for b in range(4) for d in range(4) if scores[c][a] + scores[c + 1][b] + scores[c + 2][d] >= 9}
    assert {(int(c), *map(int, w)) for c, w in zip(first, letters, strict=True)} == want and len(first) == len(want)
    assert len(words.within(scores[:2], 3, 9)[0]) == 0


def test_common_words_meet_by_pairs(spark):
    columns = spark.createDataFrame([("f", i, c, 5 if c == x else -5) for i, x in enumerate("AAAABCDE") for c in "ABCDE"], "family string, pos int, residue string, score int")
    seqs = spark.createDataFrame([("runs", "A" * 50), ("half", "AAAAXX"), ("tail", "XXBCDEXX"), ("none", "EDCBX"), ("short", "A"), ("empty", ""), ("null", None)], schemas.SEQUENCE)
    one = {r.id for r in words.candidates(columns, seqs, 2, 10).collect()}
    assert one == {"runs", "half", "tail"}
    pairs = {r.id for r in words.candidates(columns, seqs, 2, 10, hot=3).collect()}
    assert pairs == {"runs", "half", "tail"}
    assert {r.id for r in words.candidates(columns, seqs, 2, 10, hot=0).collect()} == {"runs", "half", "tail"}


@pytest.mark.parametrize("size", [8, 100])
def test_greedy_choice_in_blocks(spark, size):
    rng, k = random.Random(size), Kernels()
    base = random_seq(rng, 60)
    fams = {f: [(f"{f}{i}", 0.0, "".join(c if rng.random() > 0.05 else "-" for c in mutated(rng, base, rng.choice([0.02, 0.2, 0.5])))) for i in range(30)] for f in "ab"}
    rows = spark.createDataFrame([(f, e, n, a) for f, rs in fams.items() for n, e, a in rs], growth.ROW)
    for most in (100, 6):
        got = {}
        for r in growth.trimmed(rows, 0.8, most, size).collect():
            got.setdefault(r.family, set()).add(r.name)
        for f, rs in fams.items():
            want = {n for n, _ in k.trim(sorted((n, a) for n, _, a in rs), 0.8, most)}
            assert got[f] == want and len(want) <= most


def test_residue_counts(spark):
    rows = spark.createDataFrame([("f", "AC-x"), ("f", "A~.B"), ("g", ""), ("g", "C"), (None, "A"), ("f", None), ("f", "A")], "family string, aligned string")
    got = {(r.family, r.pos, r.residue): r.filled for r in alignments.residue_counts(rows).collect()}
    assert got == {("f", 0, 0): 3, ("f", 1, 1): 1, ("f", 3, 20): 2, ("g", 0, 1): 1}


def test_places_of_words_are_never_broadcast(spark):
    """Exploded places are far larger than their files, which is all that the planner knows."""
    columns = spark.createDataFrame([("f", i, c, 9) for i, c in enumerate("ACDEFGHIKL")], "family string, pos int, residue string, score int")
    found = words.candidates(columns, spark.createDataFrame([(1, "ACDEFGHIKL"), (2, "WWWWWWWWWW")], "id int, seq string"), 3, 9, hot=0)
    assert [tuple(r) for r in found.collect()] == [("f", 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") == 2
