"""Alignment and model texts written and read back, files of many records, keyed imports."""

import os
import random

import pytest

from kinweave import schemas
from kinweave.operators import edges, growth, stats
from kinweave.operators.kernels import AMINO, Kernels
from kinweave.sources import sinks
from kinweave.sources import text as sources
from kinweave.streaming import incremental


@pytest.fixture
def cut(spark):
    """Files are cut into many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def seq(rng, n):
    return "".join(rng.choice(AMINO + "-.") for _ in range(n))


@pytest.mark.parametrize("width", [None, 7])
def test_stockholm_files(spark, tmp_path, width):
    rng = random.Random(1)
    rows = [(f, n, "#=GC RF" if n == 4 else f"m{n}/1-9", seq(rng, 20)) for f in ("F1", "F2") for n in range(9)] + [("F3", 0, "only", "AC"), ("F4", 0, "empty", "A")]
    df = spark.createDataFrame(rows, "family string, n long, name string, aligned string").repartition(5)
    path = f"{tmp_path}/sto"
    sinks.by_family(sinks.stockholm_lines(df, width), path)
    assert {f for f in os.listdir(path) if "=" in f} == {"family=F1", "family=F2", "family=F3", "family=F4"}
    back = sources.stockholm(spark, path)
    got = {a: [(r.name, r.aligned) for r in sorted(back.filter(back.alignment == a).collect(), key=lambda r: r.n)] for a in ("F1", "F2", "F3", "F4")}
    for f in got:
        own = [(n, a) for g, _, n, a in rows if g == f]
        assert got[f] == [x for x in own if x[0] != "#=GC RF"] + [x for x in own if x[0] == "#=GC RF"]
    # the files of a family, in the order of their names, are the alignment
    text = "".join(open(f"{path}/family=F1/{f}").read() for f in sorted(os.listdir(f"{path}/family=F1")) if f.startswith("part"))
    assert text.startswith("# STOCKHOLM 1.0\n#=GF ID F1\n\n") and text.endswith("\n//\n")


def test_files_of_many_records(spark, tmp_path, cut):
    rng = random.Random(2)
    n = 60
    sto = "".join(f"# STOCKHOLM 1.0\n#=GF ID A{i}\ns{i} {seq(rng, 300)}\n\nt{i} ACDE\n\ns{i} DD\n//\n" for i in range(n))
    tm = "".join(f">p{i} | TM\n{'A' * (i + 1)}\n{'I' * (i + 1)}\n" for i in range(300))
    head = "\n\n No Hit                             Prob E-value P-value  Score    SS Cols Query HMM  Template HMM\n"
    row = lambda i: f"  1 {f'PF{i:05}.21 ; x':<30} {'99.5':>5} {'1.1E-20':>7}".ljust(70) + f"{'120':>4} {'1-120':>8} {'2-121  (268)':>15}\n"
    hhr = "".join(f"Query         q{i}{head}{row(i)}\nNo 1\n>PF{i:05}.21 ; n{i} ; d{i}; x\n\n" for i in range(n))
    for name, text in (("a.sto", sto), ("b.3line", tm), ("c.hhr", hhr)):
        (tmp_path / name).write_text(text)
    rows = sources.stockholm(spark, f"{tmp_path}/a.sto")
    assert rows.count() == 2 * n and sources.records(spark, f"{tmp_path}/a.sto", "\n//").rdd.getNumPartitions() > 5
    assert {(r.alignment, len(r.aligned)) for r in rows.filter("name LIKE 's%'").collect()} == {(f"A{i}", 302) for i in range(n)}
    got = sources.three_line(spark, f"{tmp_path}/b.3line").collect()
    assert sorted((int(r.id[1:]), len(r.seq), len(r.labels)) for r in got) == [(i, i + 1, i + 1) for i in range(300)]
    hits = sources.hhr_hits(spark, f"{tmp_path}/c.hhr", combined=True).collect()
    assert sorted((int(r.id[1:]), r.pfam, r.length) for r in hits) == [(i, f"PF{i:05}", "120") for i in range(n)]
    names = sources.hhr_descriptions(spark, f"{tmp_path}/c.hhr", combined=True).collect()
    assert sorted((int(r.id[1:]), r["name"], r.description) for r in names) == [(i, f"n{i}", f"d{i}") for i in range(n)]


def test_model_text_is_read_back_as_it_was(spark, tmp_path, cut):
    rng, k = random.Random(3), Kernels()
    rows = [(f"f{f}", seq(rng, 40)) for f in range(12) for _ in range(5)]
    found = growth.models(spark.createDataFrame(rows, "family string, aligned string"), 0.5, k)
    sinks.model_text(found).select("value").coalesce(1).write.text(f"{tmp_path}/hmm")
    back = {r.family: r for r in sources.models(spark, f"{tmp_path}/hmm").collect()}
    assert len(back) == 12
    for r in found.collect():
        assert tuple(r) == tuple(back[r.family]), r.family
    none = spark.createDataFrame([("e", 0, [], "", "..")], growth.MODEL)
    sinks.model_text(none).select("value").write.text(f"{tmp_path}/none")
    assert tuple(sources.models(spark, f"{tmp_path}/none").first()) == ("e", 0, [], "", "..")


def test_keyed_import_runs_again_without_effect(spark, tmp_path):
    rows = [("id", "full_size", "x", 0), ("3", "5", "", 1), ("3", "6", "b", 2), (None, "1", "c", 3), (" ", "1", "c", 4), ("x7", "1", "c", 5), (" 4 ", "many", "d", 6), ("5", None, None, 7)]
    df = spark.createDataFrame(rows, "id string, full_size string, protein_rep string, line int")
    bad = sinks.import_keyed(df, "family", str(tmp_path), "line")
    assert sorted((r.line, r.reason) for r in bad.collect()) == [(0, "not a key"), (2, "repeated key"), (3, "no key"), (4, "no key"), (5, "not a key")]
    table = lambda: sorted((r.id, r.full_size, r.protein_rep) for r in spark.read.schema(schemas.SERVING["family"]).parquet(f"{tmp_path}/family").collect())
    first = table()
    assert first == [(3, 5, None), (4, None, "d"), (5, None, None)]
    again = sinks.import_keyed(df, "family", str(tmp_path), "line")
    assert table() == first and sum(r.reason == "known key" for r in again.collect()) == 3
    good, _ = sinks.keyed(df, "family", "line", blank_text=True)
    assert sorted((r.id, r.protein_rep) for r in good.collect()) == [(3, ""), (4, "d"), (5, None)] and good.columns == spark.read.parquet(f"{tmp_path}/family").columns
    good, bad = sinks.keyed(df.limit(0), "family", "line")
    assert good.count() == bad.count() == 0


@pytest.mark.parametrize("header", [False, True])
def test_concatenation_in_order(spark, tmp_path, cut, header):
    rng = random.Random(4)
    os.makedirs(tmp_path / "in")
    texts = [f"id,seq\n{''.join(f'{k}_{i},{seq(rng, 50)}' + chr(10) for i in range(rng.choice([0, 3, 200])))}" for k in range(12)]
    for k in rng.sample(range(12), 12):
        (tmp_path / "in" / f"{k:02}.csv").write_text(texts[k])
    sinks.concatenated(spark, f"{tmp_path}/in", f"{tmp_path}/out", header)
    got = "".join((tmp_path / "out" / f).read_text() for f in sorted(os.listdir(tmp_path / "out")) if f.startswith("part"))
    assert got == texts[0] + "".join(t.split("\n", 1)[1] if header else t for t in texts[1:])
    assert sum(f.startswith("part") for f in os.listdir(tmp_path / "out")) > 1


def test_scans_of_family_tables(spark, tmp_path):
    put = lambda name, text: [os.makedirs((tmp_path / name).parent, exist_ok=True), (tmp_path / name).write_text(text), f"{tmp_path}/{name}"][-1]
    assert [tuple(r) for r in sources.family_members(spark, put("m.tsv", "1\tp1/2-9\n1\tp2\n")).collect()] == [("1", "p1/2-9"), ("1", "p2")]
    assert [tuple(r) for r in sources.refined_families(spark, put("r/chunk3.tsv", "1\tp1/2-9   \n2\tp2\n")).collect()] == [("chunk3", 1, "p1/2-9"), ("chunk3", 2, "p2")]
    meta = sources.family_metadata(spark, put("f/c1.csv", '1,2,"p1",2-9,8,ACDEFGHI,acd,True\n2,1,"p2"\n')).collect()
    assert [(r.family, r.size, r.rep, r.region, r.rep_length, r.converged) for r in meta] == [("c1_1", 2, "p1", "2-9", 8, True)]
    assert [tuple(r) for r in sources.discarded(spark, put("d.csv", "p1,few seed sequences remained,0.5\n")).collect()] == [("p1", "few seed sequences remained", 0.5)]
    assert sources.secrets(put("s.ini", "[db]\nuser = me\n"), "db") == {"user": "me"}
    seqs = spark.createDataFrame([("a", "AC"), ("b", "ACD"), ("c", "AC")], schemas.SEQUENCE)
    assert sorted(tuple(r) for r in stats.sequence_lengths(seqs).collect()) == [(2, 2), (3, 1)]
    members = spark.createDataFrame([("r", "a"), ("r", "none")], schemas.CLUSTER)
    assert [tuple(r) for r in edges.with_sequences(members, seqs).collect()] == [("a", "r", "AC")]


def test_databases(spark):
    url = "jdbc:derby:memory:kinweave;create=true"
    sinks.write_jdbc(spark.createDataFrame([(i, f"p{i}") for i in range(40)], "id int, name string"), url, "proteins", driver="org.apache.derby.jdbc.EmbeddedDriver")
    got = sources.jdbc_table(spark, url, 'SELECT "id", "name" FROM proteins WHERE "id" >= 10', "id", 0, 40, 4, driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert got.rdd.getNumPartitions() == 4 and sorted(r[0] for r in got.collect()) == list(range(10, 40))


def test_late_events_are_left_out(spark, tmp_path):
    rows = [[("2026-01-01 00:10:00", "a", 1.0), ("2026-01-01 00:50:00", "a", 2.0)], [("2026-01-01 09:10:00", "b", 4.0)], [("2026-01-01 09:20:00", "b", 4.0)], [("2026-01-01 00:20:00", "a", 8.0), ("2026-01-01 12:30:00", "a", 1.0)]]
    os.makedirs(tmp_path / "in")
    for i, part in enumerate(rows):
        (tmp_path / "in" / f"{i}.csv").write_text("".join(f"{t},{k},{v}\n" for t, k, v in part))
        os.utime(tmp_path / "in" / f"{i}.csv", (1e9 + i, 1e9 + i))
    events = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).csv(f"{tmp_path}/in")
    counts = incremental.event_counts(events).select("window.start", "event_type", "n", "total")
    counts.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.start.hour, r.event_type, r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(0, "a", 2, 3.0), (9, "b", 2, 8.0)]


def test_rows_without_a_key_join_nothing(spark):
    df = spark.createDataFrame([("", "a", f"{i:03}") for i in range(200)] + [("id", "b", "900"), ("7", "c", "901"), ("7", "d", "902")], "id string, protein_rep string, line string")
    good, bad = sinks.keyed(df, "family", "line", spark.createDataFrame([(8,)], "id long"))
    assert [r.id for r in good.collect()] == [7]
    assert bad.groupBy("reason").count().rdd.map(tuple).collectAsMap() == {"no key": 200, "not a key": 1, "repeated key": 1}
    # the rows without a key pass by no join
    assert "Join" not in bad._jdf.queryExecution().optimizedPlan().children().apply(0).toString()


def test_large_alignment_comes_back_whole(spark, tmp_path, cut):
    rows = [(1, n, f"m{n}", f"{n:024}") for n in range(2000)] + [(2, 0, "one", "AC")]
    df = spark.createDataFrame(rows, "family int, n long, name string, aligned string").repartition(4)
    sinks.by_family(sinks.stockholm_lines(df, 10), f"{tmp_path}/sto")
    back = sources.stockholm(spark, f"{tmp_path}/sto")
    assert sorted((r.alignment, r.name, r.aligned) for r in back.collect()) == sorted((str(f), name, a) for f, _, name, a in rows)
