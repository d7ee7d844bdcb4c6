"""Family operators: rules, quirks, parsers, and the whole flow on a small set."""

import random

import pytest
from pyspark.sql import functions as F

from kinweave import schemas
from kinweave.config import Config, Quirks
from kinweave.functions import scalar
from kinweave.operators import alignments, architecture, edges, export, families, redundancy, rollup, stats, tracks
from kinweave.operators.kernels import Kernels
from kinweave.plans import flows
from kinweave.sources import sinks
from kinweave.sources import text as sources
from kinweave.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_scalars(spark):
    lit = F.lit
    assert [one(spark, scalar.protein_id(lit(x))) for x in ("25", "25/1_50", "25_50_150", "25_50_200/2_34")] == ["25"] * 4
    assert [one(spark, scalar.family_start(lit(x))) for x in ("25", "25/7_50", "25_50_150", "25_50_200/2_34")] == [1, 7, 50, 51]
    assert one(spark, scalar.formatted_id(lit(12), "X")) == "X0000000012"
    assert one(spark, scalar.formatted_id(lit(12345678901), "X")) == "X12345678901"
    assert one(spark, scalar.path_parent(lit("a:b:c"))) == "a:b" and one(spark, scalar.path_parent(lit("a"))) == ""
    assert one(spark, scalar.path_label(lit("a:b:c"))) == "c"
    assert one(spark, scalar.path_prefixes(lit("a:b:c"))) == ["a", "a:b", "a:b:c"]
    assert one(spark, scalar.strip_gaps(lit("a-C.g~t"))) == "ACGT"
    assert one(spark, scalar.find(lit("ABCD"), lit("CD"))) == 2 and one(spark, scalar.find(lit("ABCD"), lit("X"))) == -1
    assert one(spark, scalar.percent(lit(1), lit(0))) is None
    assert one(spark, scalar.csv_quoted(lit('a"b'))) == '"a""b"'


def color(s):
    h = 0
    for c in s:
        h = ord(c) + 31 * h
    return "#" + "".join(f"{h >> (8 * i) & 255:02x}" for i in range(3))


def test_colors_equal_unbounded_integers(spark):
    words = ["PF00001", "x", "", "Zinc finger, C2H2 type " * 5, "αβγ"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", scalar.string_color(F.col("w")).alias("c"))
    assert {r.w: r.c for r in df.collect()} == {w: color(w) for w in words}


def test_renamed_member(spark):
    def name(raw, length, width, original, start, cut=True):
        return one(spark, scalar.renamed_member(F.lit(raw), F.lit(length), F.lit(width), F.lit(original), F.lit(start), cut))

    assert name("199_125_238", 114, 11, 114, 0) == "199/125-238"
    assert name("77", 50, 2, 50, 0) == "77"
    assert name("77", 10, 9, 50, 4) == "77/5-14  "
    assert name("77", 10, 4, 50, 4) == "77/5" and name("77", 10, 4, 50, 4, cut=False) == "77/5-14"
    assert name("199_125_238", 10, 16, 114, 4) == "199/129-138     "


def test_numbers_are_dense_and_ordered(spark):
    n = edges.numbered(spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")), ["v"], "n").collect()
    assert sorted((r.v, r.n) for r in n) == [(i, i + 1) for i in range(1000)]
    names = spark.createDataFrame([("10_1",), ("1_1",), ("1_10",), ("1_2",)], "family string")
    ids = redundancy.survivor_ids(names, names.limit(0), 5).collect()
    assert [r.family for r in sorted(ids, key=lambda r: r.id)] == ["10_1", "1_1", "1_10", "1_2"] and {r.id for r in ids} == {5, 6, 7, 8}


META = "family string, size int, rep string, region string"
HIT = "query string, target string, qlen int, env_from int, env_to int"


def identified(spark, meta, hits, members, config=Config()):
    got = redundancy.identify(spark.createDataFrame(hits, HIT), spark.createDataFrame(meta, META), spark.createDataFrame(members, "family string, member string"), config)
    return sorted(r.family for r in got[0].collect()), sorted(tuple(r) for r in got[1].collect())


def test_redundancy(spark):
    meta = [("1_1", 10, "a", "1-9"), ("1_2", 12, "b", "1-9"), ("1_3", 12, "a", "1-9"), ("1_4", 3, "c", "-"), ("1_5", 3, "d", "2-3")]
    same = [f"p{i}/x" for i in range(20)]
    members = [(f, m) for f in ("1_1", "1_2", "1_3", "1_4", "1_5") for m in same]
    # 1_1 loses the collision with 1_3; of 1_2 and 1_3 (equal sizes) the larger name goes
    assert identified(spark, meta, [("1_2", "a/1-9", 100, 1, 95)], members)[0] == ["1_1", "1_3"]
    # too short an envelope; a self hit
    assert identified(spark, meta, [("1_2", "a/1-9", 100, 1, 80), ("1_2", "b/1-9", 100, 1, 99)], members)[0] == ["1_1"]
    # a whole representative is never a target, unless corrected
    hits = [("1_5", "c", 100, 1, 100)]
    assert identified(spark, meta, hits, members)[0] == ["1_1"]
    assert identified(spark, meta, hits, members, Config(quirks=Quirks(whole_rep_never_target=False)))[0] == ["1_1", "1_5"]
    # similar, both directions and repeats stay
    half = [("1_2", f"p{i}") for i in range(20)] + [("1_5", f"p{i}") for i in range(8, 24)]
    hits = [("1_2", "d/2-3", 10, 1, 10), ("1_2", "d/2-3", 10, 1, 10), ("1_5", "b/1-9", 10, 1, 9)]
    assert identified(spark, meta, hits, half)[1] == [("1_2", "1_5", 0.5), ("1_2", "1_5", 0.5), ("1_5", "1_2", 0.5)]


def test_jaccard_is_symmetric_and_zero_for_empty_sets(spark):
    sets = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2")], "family string, protein string")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("x", "y"), ("a", None)], "a string, b string")
    for bound in (100, 1, 0):
        got = {(r.a, r.b): r.score for r in edges.pair_jaccard(pairs, sets, bound).collect()}
        assert got == {("a", "b"): 0.5, ("b", "a"): 0.5, ("x", "y"): 0.0, ("a", None): 0.0}


def test_discarded_cluster_gives_its_number_back(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([True, False, True, True])], "chunk int, position int, success boolean")
    assert [r.iteration for r in sorted(redundancy.running_numbers(df).collect(), key=lambda r: r.position)] == [1, 2, 2, 3]


def test_runs_round_trip(spark):
    words = ["", "H", "HHHEECCCH", "IIMMOO", "ABABAB"]
    for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", tracks.runs(F.col("w")).alias("r")).collect():
        assert "".join(x.label * (x.y - x.x + 1) for x in r.r) == r.w
        assert all(a.label != b.label and a.y + 1 == b.x for a, b in zip(r.r, r.r[1:]))


def test_rollup_root_is_the_sum_of_leaves(spark):
    look = spark.createDataFrame([("f", "[[1, 5], [2, 9]]"), ("f", "[[1, 1]]"), ("g", None)], "family string, biomes string")
    names = spark.createDataFrame([("1", "root:Host:Gut"), ("2", "root:Soil")], "id string, name string")
    tree = {r.ids: (r.counts, r.labels, r.parents) for r in rollup.roll_up(rollup.named(rollup.biome_counts(look), names), ["family"]).collect()}
    assert tree == {"root": (3, "root", ""), "root:Host": (2, "Host", "root"), "root:Host:Gut": (2, "Gut", "root:Host"), "root:Soil": (1, "Soil", "root")}
    assert {r.id: r.n for r in rollup.biome_counts(look, ignore_pair_count=False).collect()} == {"1": 6, "2": 9}
    with pytest.raises(Exception, match="no name of"):
        rollup.named(rollup.biome_counts(look), names.limit(1)).collect()


def test_architectures(spark):
    members = spark.createDataFrame([("7", "p1/5_90"), ("7", "p2"), ("7", "p3_40_90")], "family string, member string")
    look = spark.createDataFrame(
        [("7", "p1", '[["PF2", 1, 2, 30, 4, 5, 6], ["PF1", 1, 2, 3, 4, 5, 6]]'), ("7", "p2", None), ("7", "p9", "[]")], "family string, protein_id string, domains string"
    )
    got = sorted(r.architecture for r in architecture.architectures(members, look).collect())
    assert got == ["", "7", "PF1\t7\tPF2"]
    top = architecture.top(architecture.architectures(members, look).filter("architecture <> ''"), 1).collect()
    assert [(r.architecture, r["count"], r["rank"]) for r in top] == [("7", 1, 1)]
    names = spark.createDataFrame([("PF1", "one"), ("PF2", "two")], "id string, name string")
    doc = architecture.documents(architecture.top(architecture.architectures(members, look).filter("architecture LIKE 'PF%'")), names).first().json
    assert color("one") in doc and "FAM0000000007" in doc and '"architecture_text":"1"' in doc


def test_statistics(spark):
    df = spark.createDataFrame([("A" * n,) for n in (1, 2, 3, 4)], "seq string")
    r = stats.sequence_stats(df).first()
    assert (r.num_seqs, r.sum_len, r.min_len, r.avg_len, r.max_len, r.Q1, r.Q2, r.Q3, r.N50, r.N50_num) == (4, 10, 1, 2.5, 4, 1.75, 2.5, 3.25, 3, 2)


def test_text_formats(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    fa = put("a.fa", ">x desc of x\nACD\nEFG\n>y\n\n>z/1_2\tw\nKLM")
    assert [tuple(r) for r in sources.fasta(spark, fa).collect()] == [("x", "desc of x", "ACDEFG"), ("y", "", ""), ("z/1_2", "w", "KLM")]
    dom = put("d.txt", "# c\nt1 ta 50 q1 PF1.5 100 1e-5 30.5 0.1 1 2 1e-4 1e-3 20.1 0.0 1 90 2 91 3 92 0.95 some words here\nbad row\n")
    r = sources.domtbl(spark, dom).collect()
    assert len(r) == 1 and (r[0].target, r[0].query, r[0].qlen, r[0].env_from, r[0].env_to, r[0].description) == ("t1", "q1", 100, 3, 92, "some words here")
    assert [tuple(x) for x in export.domain_hits(sources.domtbl(spark, dom), 0.8).collect()] == [("t1", "PF1", "q1", "1e-5", "30.5", 1, 90, 2, 91, 3, 92, "0.95")]
    assert export.domain_hits(sources.domtbl(spark, dom), 0.95).count() == 0
    head = "Query x\n\n No Hit                             Prob E-value P-value  Score    SS Cols Query HMM  Template HMM\n"
    row = f"  1 {'PF00001.21 ; 7tm_1 ; long na':<30} {'99.5':>5} {'1.1E-20':>7}".ljust(70) + f"{'120':>4} {'1-120':>8} {'2-121  (268)':>15}\n"
    hhr = put("h/f1.hhr", head + row + "\nNo 1\n>PF00001.21 ; 7tm_1 ; receptor; x\n")
    h = sources.hhr_hits(spark, hhr).collect()
    assert [tuple(x)[2:] for x in h] == [("PF00001", "99.5", "1.1E-20", "120", "1-120", "2-121 (268)")] and h[0].id == "f1"
    m = export.model_pfams(sources.hhr_hits(spark, hhr), sources.hhr_descriptions(spark, hhr)).first()
    assert (m["name"], m.description) == ("7tm_1", "receptor")
    ss = put("s/9.horiz", "# x\n\nConf: 123\nPred: HHC\n  AA: ACD\n\nConf: 4\nPred: C\n  AA: E\n")
    p = sources.secondary_structure(spark, ss)
    assert tuple(p.first()) == ("9", "1234", "HHCC", "ACDE")
    assert tuple(tracks.structure_composition(p).first()) == ("9", 50.0, 0.0, 50.0)
    assert '"data":[{"x":1,"y":2}]' in tracks.structure_features(p).first().json
    tm = put("t/tm.3line", ">1 | GLOB\nACDE\nIIMM\n>2 | TM\nAC\nOOO\n")
    t = sources.three_line(spark, tm)
    assert [tuple(x) for x in t.collect()] == [("1", "ACDE", "IIMM")]
    assert '"className":"tm-m"' in tracks.topology_features(t).first().json and "tm-o" not in tracks.topology_features(t).first().json
    atom = "ATOM  %5d  N   %3s%2s%4d    -15.115  15.723 -29.946  1.00%6.2f           N\n"
    pdb = put("p/m.pdb", "HEADER\n" + atom % (1, "MET", "A", 1, 40) + atom % (2, "MET", "A", 1, 41) + atom % (3, "GLY", "A", 2, 10) + "TER\n" + atom % (4, "GLY", "B", 9, 10))
    means = tracks.residue_means(sources.atoms(spark, pdb))
    assert sorted((x.asym, x.comp, x.seq, x["mean"]) for x in means.collect()) == [("A", "GLY", "2", "10.00"), ("A", "MET", "1", "40.50")]
    assert tracks.cif_metrics(means).count() == 17
    logs = spark.createDataFrame([("Failed (CUDA out of memory) on sequence a_b of length 9",), ("fine",)], "value string")
    seqs = spark.createDataFrame([("a/b", "A"), ("c", "C")], schemas.SEQUENCE)
    assert [r.id for r in sources.retry_set(seqs, sources.failed_sequences(logs)).collect()] == ["a/b"]
    sto = put("st/1.sto", "# STOCKHOLM 1.0\n\ns1  AC-d\ns2  ..GT\n#=GC RF xx.x\n//\n")
    rows = sources.stockholm(spark, sto)
    assert sorted((r.name, r.aligned) for r in rows.collect()) == [("#=GC RF", "xx.x"), ("s1", "AC-d"), ("s2", "..GT")]
    assert sorted(r.value for r in sources.aligned_fasta(rows, a3m=True).collect()) == [">s1\nACD", ">s2\n--gT"]


def test_serving(spark, tmp_path):
    t = sinks.serving_tables(spark)
    assert set(t) == set(schemas.SERVING)
    hits = spark.createDataFrame([("1", "PF1", "", "1e-5"), ("2", "PF2", "n", "x")], "id string, pfam string, name string, e_value string")
    rows = sorted(sinks.child_rows(hits, "family_pfams").collect(), key=lambda r: r.id)
    assert [(r.id, r.family_id, r.pfam, r["name"], r.e_value) for r in rows] == [(1, 1, "PF1", None, 1e-5), (2, 2, "PF2", "n", None)]
    fam = sinks.typed(spark.createDataFrame([("1", "")], "id string, protein_rep string"), "family")
    new = sinks.update_blobs(fam, {"rf_blob": spark.createDataFrame([(1, bytearray(b"z"))], "id bigint, rf_blob binary")}).first()
    assert new.rf_blob == b"z" and new.hmm_blob is None and new.protein_rep is None
    lines = sinks.report_lines(spark.createDataFrame([(2, 1), (1, 5)], "size int, n int"), "i", "s", "d").orderBy("n").collect()
    assert [r.value for r in lines][-3:] == ["size,n", "1,5", "2,1"]


def test_occupancy_and_clip(spark):
    rows = spark.createDataFrame([("f", 0, "x", "-AC-"), ("f", 1, "y", "AACG"), ("f", 2, "z", "--C-")], "family string, n int, name string, aligned string")
    r = alignments.clip_range(alignments.occupancy(rows), 0.5)
    assert tuple(r.first()) == ("f", 1, 2)  # the last qualifying column is dropped
    assert tuple(alignments.clip_range(alignments.occupancy(rows), 0.5, exclusive_end=False).first()) == ("f", 1, 3)
    assert sorted(x.aligned for x in alignments.clipped(rows, r).collect()) == ["-", "A", "A"]


def mutated(rng, s, share):
    return "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") if rng.random() < share else c for c in s)


def test_kernels():
    k, rng = Kernels(), random.Random(1)
    base = mutated(rng, "A" * 120, 1)
    seqs = [mutated(rng, base, 0.1) for _ in range(6)]
    rows = k.align([str(i) for i in range(6)], seqs)
    assert len({len(a) for _, a in rows}) == 1 and [a.replace("-", "") for _, a in rows] == seqs
    model = k.profile(rows)
    hit = k.search(model, "G" * 30 + mutated(rng, base, 0.1) + "G" * 30, 100)
    assert hit.e_value < 1e-6 and abs(hit.env_from - 31) < 6 and abs(hit.env_to - 150) < 6
    other = k.search(model, mutated(rng, "A" * 120, 1), 100)
    assert other is None or other.e_value > 1e-3
    same = k.align_to(model, ["a", "b"], seqs[:2])
    assert [a.replace("-", "") for _, a in same] == seqs[:2]
    assert len(k.trim([("a", base), ("b", base), ("c", mutated(rng, base, 0.9))], 0.8, 10)) == 2
    assert k.identity(base, base) == (1.0, 1.0, 1.0)


def test_flow_from_proteins_to_families(spark, tmp_path):
    rng = random.Random(7)
    bases = [mutated(rng, "A" * 130, 1) for _ in range(2)]
    lines = [f">{100 * b + i}\n{mutated(rng, bases[b], 0.08)}" for b in range(2) for i in range(8)]
    (tmp_path / "in.fa").write_text("\n".join(lines) + "\n")
    config = Config(fasta_input=True, minimum_members=3, clusters_chunk_size=1, max_seed_identity=0.99)
    setup = flows.setup_clusters(spark, str(tmp_path / "in.fa"), str(tmp_path / "work"), config)
    clusters = {r.representative: r.members for r in setup.representatives.collect()}
    assert len(clusters) == 2 and all(v >= 3 for v in clusters.values())
    fams = flows.nonredundant_families(setup, str(tmp_path / "work"), config)
    meta = fams.metadata.collect()
    assert len(meta) == 2 and {r.family for r in meta} == {"1", "2"} and all(75 <= r.rep_length <= 2000 for r in meta)
    members = fams.members.collect()
    assert {int(scalar_id.split("/")[0]) // 100 for scalar_id in (m.member for m in members)} == {0, 1}


def test_stream_of_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.csv").write_text(f'id,sequence,full_length,cluster_size,metadata\n{i},ABCDEFGH,true,1,"{{""p"": [[0, 0, 0, 0, 0, 1, 3]]}}"\n')
    q = incremental.run_slices(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), 5)
    assert q.awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["0_4_8", "1_4_8", "2_4_8"]


def test_config_rejects_unknown_modes():
    with pytest.raises(ValueError):
        Config(hh_mode="x")


def test_members_reach_their_representative(spark):
    rng, k = random.Random(3), Kernels()
    chain = [mutated(rng, "A" * 200, 1)]
    for _ in range(6):  # each is near the one before, the last far from the first
        s = list(chain[-1])
        for i in rng.sample(range(200), 30):
            s[i] = rng.choice("ACDEFGHIKLMNPQRSTVWY")
        chain.append("".join(s))
    rows = [(f"s{i}", s) for i, s in enumerate(chain)] + [("copy", chain[0]), ("short", "ACD"), ("alone", mutated(rng, "A" * 150, 1))]
    seqs = dict(rows)
    got = {r.member: r.representative for r in families.linear_clusters(spark.createDataFrame(rows, schemas.SEQUENCE), 0.5, 0.9).collect()}
    assert set(got) == set(seqs) and got["short"] == "short" and got["alone"] == "alone"
    assert len(set(got.values())) < len(got) - 1
    for member, rep in got.items():
        assert got[rep] == rep
        assert member == rep or min(a >= b for a, b in zip(k.identity(seqs[rep], seqs[member]), (0.5, 0.9, 0.9), strict=True))
    assert families.linear_clusters(spark.createDataFrame([], schemas.SEQUENCE)).count() == 0


def test_greedy_rounds_take_direct_pairs_only(spark):
    chain = spark.createDataFrame([(f"s{i:02}", f"s{i + 1:02}", 100 - i) for i in range(20)], "centre string, id string, n_a int")
    got = {r.member: r.representative for part in families.assigned(chain) for r in part.collect()}
    assert got == {f"s{i + 1:02}": f"s{i:02}" for i in range(0, 20, 2)}


def test_occupancy_of_odd_rows(spark):
    rows = spark.createDataFrame([("f", "A-é-"), ("f", None), ("f", ""), ("g", "--"), (None, "AA"), ("g", "A")], "family string, aligned string")
    got = {(r.family, r.pos): r.occupancy for r in alignments.occupancy(rows).collect()}
    assert got == {("f", 0): 1 / 3, ("f", 1): 0, ("f", 2): 1 / 3, ("f", 3): 0, ("g", 0): 0.5, ("g", 1): 0}
    assert alignments.occupancy(rows.limit(0)).count() == 0


def test_jaccard_leaves_out_what_sizes_rule_out(spark):
    sets = {"a": range(10), "b": range(2, 10), "c": range(3), "d": range(5, 15)}
    fp = spark.createDataFrame([(f, str(p)) for f, ps in sets.items() for p in ps], "family string, protein string")
    pairs = spark.createDataFrame([(x, y) for x in "abcd" for y in "abcd" if x != y] + [("a", "none")], "a string, b string")
    every = {(r.a, r.b): r.score for r in edges.pair_jaccard(pairs, fp).collect()}
    some = {(r.a, r.b): r.score for r in edges.pair_jaccard(pairs, fp, at_least=0.8).collect()}
    assert {p: s for p, s in every.items() if s >= 0.8} == {p: s for p, s in some.items() if s >= 0.8} and ("a", "c") not in some and every[("a", "b")] == 0.8


def test_fasta_headers_may_hold_the_record_sign(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one -> two\nAC\nDE\n>b>c\r\nFG\r\n")
    assert [tuple(r) for r in sources.fasta(spark, str(tmp_path / "a.fa")).collect()] == [("one", "-> two", "ACDE"), ("b>c", "", "FG")]


def test_serving_database_and_its_update(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)

    put("r/s4pred/1.horiz", "# x\n\nConf: 1234\nPred: HHCC\n  AA: ACDE\n")
    put("r/structure_scores/log.txt", "2024-01-01 10:00:00 INFO root Predicted structure for sequence number 1 1 with length 10, pLDDT 70.5, pTM 0.5 in 1.0s\n")
    line = "1 ta 50 q1 PF1.5 100 1e-5 30.5 0.1 1 2 1e-4 1e-3 20.1 0.0 1 90 2 91 3 92 0.95 some words\n"
    put("r/pfam/d.txt", "# c\n" + line)
    put("r/funfam/d.txt", line)
    put("r/folds/f.tsv", "1\tfold1\t0.5\t90\t1\t0\t1\t90\t1\t90\t1e-9\t50\n1\tfold2\t0.5\t90\t1\t0\t1\t90\t1\t90\t0.5\t50\n")
    put("r/hhr/1.hhr", "Query x\n")
    put("r/topology/t.3line", ">1 | TM\nACDE\nIIMM\n")
    notes = flows.annotations(spark, str(tmp_path / "r"))
    meta = spark.createDataFrame([("1", 3, "p", "1-4", 4, "ACDE", "ACDE", True)], "family string, size int, rep string, region string, rep_length int, sequence string, consensus string, converged boolean")
    none = spark.createDataFrame([], "x int")
    tables = flows.export_tables(flows.Families(none, meta, none, none, none, none, none, none, none), notes)
    flows.init_db(tables, str(tmp_path / "db"))
    fam = spark.read.parquet(str(tmp_path / "db/family"))
    row = fam.first()
    assert (row.id, row.full_size, row.plddt, row.ptm, row.helix_percent, row.inside_percent) == (1, 3, 70.5, 0.5, 50.0, 50.0)
    folds = spark.read.parquet(str(tmp_path / "db/family_folds")).collect()
    assert [(r.id, r.family_id, r.fold) for r in folds] == [(1, 1, "fold1")]  # the other is over the E-value
    assert spark.read.parquet(str(tmp_path / "db/family_pfams")).first().pfam == "PF1"
    members = spark.createDataFrame([("1", "10/3_9")], "family string, member string")
    proteins = spark.createDataFrame([("10", '{"b": [[5, 2]], "p": [["PF1", "1e-5", "30.5", "1", "9", "1", "9"]]}')], "protein_id string, metadata string")
    biomes = spark.createDataFrame([("5", "root:soil")], "id string, name string")
    domains = spark.createDataFrame([("PF1", "kinase")], "id string, name string")
    new = flows.update_db(fam, members, proteins, biomes, domains, {}).first()
    assert new.biome_blob.decode() == "ids,labels,parents,counts\nroot,root,,1\nroot:soil,soil,root,1\n"
    assert '"name":"kinase"' in new.domain_blob.decode() and new.rf_blob is None


def test_batches_and_cut_sequences(spark):
    reps = spark.createDataFrame([(f"{i:02}", "A" * (10 * i)) for i in range(1, 8)], schemas.SEQUENCE)
    config = Config(structure_chunk=3, structure_chunk_long=2, topology_max_residues=25)
    count = lambda df: sorted(r["count"] for r in df.groupBy("chunk").count().collect())
    assert count(flows.structure_batches(reps, config)) == [1, 3, 3] and count(flows.structure_batches(reps, config, retry=True)) == [1, 2, 2, 2]
    assert max(len(r.seq) for r in flows.topology_input(reps, config).collect()) == 25


def test_jaccard_counts_where_sets_meet(spark):
    """No set travels with a pair, and a protein of many families gives no pair that wasn't asked for."""
    sets = {f"f{i:02}": [*range(i, i + 6), "all"] for i in range(12)} | {"hot": ["all"], "hot2": ["all"]}
    fp = spark.createDataFrame([(f, str(p)) for f, ps in sets.items() for p in ps], "family string, protein string")
    want = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for a, x in sets.items() for b, y in sets.items() if a != b}
    pairs = spark.createDataFrame(list(want), "a string, b string")
    for bound in (edges.HOT, 3):
        scored = edges.pair_jaccard(pairs, fp, bound)
        assert {(r.a, r.b): r.score for r in scored.collect()} == want
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "array_intersect" not in plan
        near = [((r.a, r.b), r.score) for r in edges.near_sets(fp, 0.3, bound).collect()]
        assert len(near) == len(dict(near)) and dict(near) == {p: s for p, s in want.items() if s >= 0.3}


def test_pairs_of_families_are_counted_in_the_task_that_makes_them(spark, monkeypatch):
    """What is shuffled are lists of families, however many pairs they give; nulls meet nothing."""
    sets = {i: {0, i % 7, 10 + i % 3, 20 + i} for i in range(40)}
    rows = [(i, str(p), i % 2) for i, ps in sets.items() for p in ps] + [(1, None, 1), (3, None, 1), (2, "9", None), (4, "9", None)]
    members = spark.createDataFrame(rows, "id long, protein string, block int")
    alike = lambda i, j, blocks: i < j and sets[i] & sets[j] and (not blocks or i % 2 == j % 2)
    for most in (edges.MEETINGS, 20):
        monkeypatch.setattr(edges, "MEETINGS", most)
        for blocks, df in ((True, members), (False, members.filter("block IS NOT NULL").drop("block"))):
            got = edges.shared_counts(df)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert {(r.i, r.j): r.shared for r in got.collect()} == {(i, j): len(sets[i] & sets[j]) for i in sets for j in sets if alike(i, j, blocks)}
            assert plan.count("Exchange ") == 1 and "Join" not in plan
