"""The jobs: growing input in two runs, reruns, stopped batches, odd rows."""

import json
import logging
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from jobs import common, queries, release_update, slice_catalogue


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_equals_sql(spark, sf, duck, name):
    before = dict(spark.conf.getAll)
    got, want = queries.QUERIES[name](spark, sf).toPandas(), duck.execute(queries.SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got)
    assert sorted(map(str, got[columns].itertuples(index=False, name=None))) == sorted(map(str, want[columns].itertuples(index=False, name=None)))
    assert dict(spark.conf.getAll) == before and not spark.streams.active and not spark.catalog.listTables()


CONFIG = {
    "release": "r1",
    "proteins": {"protein_id": "id", "sequence": "seq"},
    "regions": {"protein_id": "id", "start": "a", "stop": "b"},
    "min_length": 5,
    "length_classes": [10, 0],
}


def test_catalogue(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, "kinweave.jobs")
    proteins = [("p1", "A" * 5 + "CCCC" + "G" * 20, 1), ("p2", "G" * 20, 2), ("p2", "TTTT", 3), ("p3", None, 4), (None, "A" * 30, 5), ("p4", "", 6), ("p5", "G" * 20, 7)]
    regions = [("p1", 6, 8), ("p1", 6, 9), ("p1", 6, 9), ("p1", 6, None), (None, 1, 9), ("nobody", 1, 2)] + [("p5", 1, 2)] * 500
    spark.createDataFrame(proteins, "id string, seq string, length int").write.parquet(f"{tmp_path}/p")
    spark.createDataFrame(regions, "id string, a int, b int").write.parquet(f"{tmp_path}/r")
    run = lambda release: slice_catalogue.run(spark, f"{tmp_path}/p", f"{tmp_path}/r", f"{tmp_path}/out", {**CONFIG, "release": release})
    counts = run("r1")
    assert counts == {"proteins": 7, "slices": 3, "copies": 4, "residues": 43}
    got = {(r.seq, r.id, r.copies, r.length, r.length_class) for r in slice_catalogue.output(spark, f"{tmp_path}/out").collect()}
    assert got == {("AAAAA", "p1_1_5", 1, 5, 0), ("G" * 20, "p1_10_29", 2, 20, 10), ("G" * 18, "p5_3_20", 1, 18, 10)}
    first = rows(slice_catalogue.output(spark, f"{tmp_path}/out"))
    assert run("r1") == counts and rows(slice_catalogue.output(spark, f"{tmp_path}/out")) == first
    run("r2")
    both = slice_catalogue.output(spark, f"{tmp_path}/out")
    assert rows(both.filter("release = 'r1'")) == first and both.count() == 6
    assert spark.read.parquet(f"{tmp_path}/out/stats").count() == 2
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/lengths/release=r1").collect()) == [(0, 1, 1, 5), (10, 2, 3, 38)]
    assert "read 7 proteins" in caplog.text and "wrote 3 slices" in caplog.text


def test_catalogue_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "id string, seq string").write.parquet(f"{tmp_path}/p")
    spark.createDataFrame([], "id string, a int, b int").write.parquet(f"{tmp_path}/r")
    assert slice_catalogue.run(spark, f"{tmp_path}/p", f"{tmp_path}/r", f"{tmp_path}/out", CONFIG) == {"proteins": 0, "slices": 0, "copies": 0, "residues": 0}
    assert slice_catalogue.output(spark, f"{tmp_path}/out").count() == 0


UPDATE = {
    "edges": {"schema": "f STRING, p STRING", "family": "f", "protein": "p"},
    "metadata": {"protein": "p", "lineage": "lineage", "architecture": "arch"},
    "buckets": 4,
    "architectures": 2,
    "files_per_batch": 1,
}


@pytest.fixture
def grown(spark, tmp_path):
    meta = [(f"p{i}", f"root:b{i % 3}", f"d{i % 4}\td9", "extra") for i in range(40)] + [("p90", None, None, "extra")]
    spark.createDataFrame(meta, "p string, lineage string, arch string, family string").write.parquet(f"{tmp_path}/meta")

    def add(part, edges):
        spark.createDataFrame(edges, "f string, p string").coalesce(1).write.parquet(f"{tmp_path}/made{part}")
        file = next(f for f in os.listdir(f"{tmp_path}/made{part}") if f.endswith(".parquet"))
        os.makedirs(f"{tmp_path}/edges", exist_ok=True)
        shutil.copy(f"{tmp_path}/made{part}/{file}", f"{tmp_path}/edges/part{part}.parquet")

    add(0, [(f"f{i % 7}", f"p{i}") for i in range(20)] + [("f1", "p1"), (None, "p1"), ("f1", None), ("f2", "no metadata"), ("f3", "p90")])
    add(1, [("f0", f"p{i}") for i in range(10)])
    run = lambda out, check: release_update.run(spark, f"{tmp_path}/edges", f"{tmp_path}/meta", f"{tmp_path}/{out}", f"{tmp_path}/{check}", UPDATE)
    return tmp_path, add, run


def expected(edges):
    pairs = {(f, p) for f, p in edges if f and p and p[1:].isdigit() and int(p[1:]) < 40}
    tree, archs = {}, {}
    for f, p in pairs:
        i = int(p[1:])
        for label in ("root", f"root:b{i % 3}"):
            tree[f, label] = tree.get((f, label), 0) + 1
        archs[f, f"d{i % 4}\td9"] = archs.get((f, f"d{i % 4}\td9"), 0) + 1
    out = {(f, "biome", label, n, 0) for (f, label), n in tree.items()}
    for f in {f for f, _ in archs}:
        own = sorted((-n, a) for (g, a), n in archs.items() if g == f)
        out |= {(f, "architecture", a, -n, k) for k, (n, a) in enumerate(own[:2], 1)}
    return out


def served(spark, path):
    return {(r.family, r.kind, r.label, r.n, r.rank) for r in release_update.output(spark, str(path)).collect()}


FIRST = [(f"f{i % 7}", f"p{i}") for i in range(20)] + [("f0", f"p{i}") for i in range(10)]
MORE = [("f0", "p3"), ("f0", "p30"), ("f9", "p31")]


def test_two_runs_over_growing_input(spark, grown):
    path, add, run = grown
    first = run("out", "check")
    assert [b["rows_read"] for b in first] == [25, 10] and sum(b["edges_added"] for b in first) == 22 + 8
    assert served(spark, path / "out") == expected(FIRST)
    before = rows(release_update.output(spark, f"{path}/out"))
    assert run("out", "check") == [] and rows(release_update.output(spark, f"{path}/out")) == before
    add(2, MORE)
    second = run("out", "check")
    assert [(b["batch"], b["rows_read"], b["edges_added"]) for b in second] == [(2, 3, 2)]  # the new file alone
    assert served(spark, path / "out") == expected(FIRST + MORE)
    # the same as all files in one go
    run("whole", "check2")
    assert rows(release_update.output(spark, f"{path}/whole")) == rows(release_update.output(spark, f"{path}/out"))
    edges = spark.read.parquet(f"{path}/out/edges")
    assert edges.count() == edges.select("family", "protein").distinct().count()


def test_a_stopped_batch_runs_again(spark, grown):
    path, add, run = grown
    run("out", "check")
    add(2, MORE)
    run("out", "check")
    want = rows(release_update.output(spark, f"{path}/out")), rows(spark.read.parquet(f"{path}/out/edges")), rows(spark.read.parquet(f"{path}/out/counts"))
    # the last batch was planned and written, but not committed
    os.remove(f"{path}/check/commits/2")
    os.remove(f"{path}/check/commits/.2.crc")
    assert [b["batch"] for b in run("out", "check")] == [2]
    assert want == (rows(release_update.output(spark, f"{path}/out")), rows(spark.read.parquet(f"{path}/out/edges")), rows(spark.read.parquet(f"{path}/out/counts")))


def test_one_file_and_patterns():
    assert release_update.pattern("/a/b.parquet") == "/a/b.parque[t]"
    assert release_update.pattern("s3://a/b/") == "s3://a/[b]"
    assert release_update.pattern("/a/*.parquet") == "/a/*.parquet"


def test_command_lines(spark, grown, tmp_path, sf):
    path, _, _ = grown
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --driver-memory 1g --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"}
    (tmp_path / "c.json").write_text(json.dumps(UPDATE))
    command = [sys.executable, "-m", "jobs.release_update", "--edges", f"{path}/edges", "--metadata", f"{path}/meta", "--out", f"{path}/cli", "--checkpoint", f"{path}/cli_check", "--config", f"{tmp_path}/c.json"]
    done = subprocess.run(command, cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "batch 1: read 10 rows" in done.stderr
    assert served(spark, path / "cli") == expected(FIRST)
    command = [sys.executable, "-m", "jobs.slice_catalogue", "--proteins", f"{sf}/documents.parquet", "--regions", f"{sf}/lineitem.parquet", "--out", f"{path}/cat", "--config", "jobs/slice_catalogue.json"]
    done = subprocess.run(command, cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "wrote" in done.stderr
    assert slice_catalogue.output(spark, f"{path}/cat").count() == queries.QUERIES["job1_slice_catalogue"](spark, sf).count()


def test_configuration_files_are_the_packaged_ones(spark):
    for job in ("slice_catalogue", "release_update"):
        assert common.configured(spark, os.path.join(os.path.dirname(common.__file__), f"{job}.json")) == common.packaged(job)


def test_regions_of_other_proteins_go_before_the_shuffle(spark, monkeypatch):
    from jobs import slice_catalogue

    proteins = spark.createDataFrame([("a", "x" * 50), ("b", None), (None, "y")], "protein_id string, sequence string")
    regions = spark.createDataFrame([("a", 1, 5), ("b", 1, 5), ("c", 1, 5), (None, 1, 5)], "protein_id string, start int, stop int")
    few = slice_catalogue.regions_of(regions, proteins)
    assert [tuple(r) for r in few.collect()] == [("a", 1, 5)]
    slices = [tuple(r) for r in slice_catalogue.slices(proteins, few, 20).collect()]
    monkeypatch.setattr(slice_catalogue, "FEW", 0)
    every = slice_catalogue.regions_of(regions, proteins)
    assert every.count() == 4 and slices == [tuple(r) for r in slice_catalogue.slices(proteins, every, 20).collect()] == [("a_6_50", "x" * 45)]
