"""Every query with SQL against DuckDB on the small tables, and plan checks."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from kinweave import queries as q


def rows(df, columns):
    return sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", list(q.SQL))
def test_equals_sql(spark, sf, duck, name):
    got, want = q.QUERIES[name](spark, sf).toPandas(), duck.execute(q.SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["family", "id"] and df.count() > 0


def test_every_query_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(q.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_plans_have_no_cartesian_product_and_no_python(spark, sf, name):
    plan = q.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = q.set_difference(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,50.0)" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


def test_hits_of_a_region_are_dealt_over_tasks(spark, sf):
    plan = q.self_hit_length_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [n_regionkey" in plan and "_part" in plan


@pytest.mark.parametrize("name", ["residue_mean", "kmer_candidates", "seed_membership"])
def test_tasks_grow_with_the_input(spark, sf, duck, monkeypatch, name):
    """A task has a bounded number of rows whatever spark.sql.shuffle.partitions says, frequent k-mers
    are split, and the result stays that of the SQL."""
    from kinweave import storage

    monkeypatch.setattr(storage, "ROWS", 100)
    df = q.QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    tasks = [int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert tasks and min(tasks) > 8
    if name == "residue_mean":
        assert plan.count("Exchange hashpartitioning") == 1
    got, want = df.toPandas(), duck.execute(q.SQL[name]).df()
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_hits_are_made_from_ends_that_are_known(spark, sf, duck, monkeypatch):
    """Nothing is joined to a hit after it was made, and a task has a bounded number of queries."""
    from kinweave.operators import edges

    monkeypatch.setattr(edges, "BAND", 1)
    df = q.self_hit_length_filter(spark, "/root/testdata/sf0.01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    root = re.search(r"^(\W*)\w*Join ", plan, re.M)
    assert plan[root.start() :].split("\n")[0].strip("+-: ").startswith("ShuffledHashJoin [n_regionkey")
    assert [int(n) for n in re.findall(r"direct_shuffle_partition_id\(_part#\d+\), (\d+)\)", plan)] == [100, 100]
    small = q.self_hit_length_filter(spark, sf).toPandas()
    want = duck.execute(q.SQL["self_hit_length_filter"]).df()
    assert rows(small, sorted(small.columns)) == rows(want, sorted(small.columns))


def test_pairs_of_blocks(spark):
    from kinweave.operators import edges

    left = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None), ("e", 4)], "x string, block int")
    right = spark.createDataFrame([("p", 1), ("q", 2), ("q", 2), ("r", None), ("s", 3)], "y string, block int")
    want = left.join(right, "block").select("x", "y")
    for band in (1, 2, 100):
        edges.BAND, kept = band, edges.BAND
        try:
            got = edges.block_pairs(left, right, "block", ["block", "x"]).select("x", "y")
            assert sorted(got.collect()) == sorted(want.collect())
            assert edges.block_pairs(left.limit(0), right, "block", ["x"]).count() == 0
        finally:
            edges.BAND = kept


def test_pairs_of_families_are_not_shuffled(spark, sf, duck):
    """Pairs get their score in the task that makes them: no exchange above the join that makes them."""
    df = q.family_jaccard(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    made = next(i for i, line in enumerate(plan) if "Join [n_regionkey" in line)
    assert made < 8 and not any("Exchange" in line for line in plan[:made])


@pytest.mark.parametrize("meetings,band,narrow", [(1, 1, 1), (4, 3, 2), (1_000_000, 2, 1), (1_000_000, 1_000, 200)])
def test_scores_of_blocks(spark, monkeypatch, meetings, band, narrow):
    """Equal to plain sets for any bands and columns: repeated rows, a family without proteins, one of another block, nulls."""
    from kinweave.operators import edges

    for name, value in (("MEETINGS", meetings), ("BAND", band), ("NARROW", narrow)):
        monkeypatch.setattr(edges, name, value)
    sets = {f"f{i}": {p for p in range(12) if (i * 7 + p * 5) % (2 + i % 3) == 0} for i in range(7)} | {"g": {0, 1, 2}}
    block = {f: 2 if f == "g" else 1 for f in sets} | {"empty": 1}
    rows_ = [(f, str(p)) for f, s in sets.items() for p in s] * 2 + [("f0", None), ("f1", None), ("other", "1"), (None, "2")]
    size = lambda f: len(sets.get(f, ())) + (f in ("f0", "f1"))  # noqa: E731  # a null counts, but meets nothing
    fp = spark.createDataFrame(rows_, "family string, protein string")
    left = spark.createDataFrame([(f, b) for f, b in block.items()], "a string, block int")
    right = spark.createDataFrame([(f, b) for f, b in block.items()] + [(None, 1), ("g", 3)], "b string, block int")
    got = edges.block_jaccard(left, right, "block", fp).select("a", "b", "score").collect()
    want = []
    for a in block:
        for b in [b for b in block if block[a] == block[b]] + [None] * (block[a] == 1):
            common = size(a) if a == b else len(sets.get(a, set()) & sets.get(b, set()))
            union = size(a) + size(b) - common
            want.append((a, b, common / union if union else 0.0))
    key = lambda x: (x[0], x[1] or "")
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
