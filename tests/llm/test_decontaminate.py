import os

import duckdb
import pandas as pd
import pytest

from kinweave.llm import decontaminate

from .helpers import odd_docs

ITEM = "A train leaves the old town at 7 o'clock and drives 120 km before Alice counts 7 red houses near the river bank"


def found(spark, texts, items=(ITEM,), **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r.re_parameterised for r in decontaminate.matches(docs, bench, **options).collect()}


def test_equals_sql(spark, sf):
    got = decontaminate.matches(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")).toPandas()
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    want = c.execute(decontaminate.oracle_sql()).df()
    assert len(got) and sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want[got.columns].values.tolist()))


def test_copies_and_new_parameters(spark):
    new = ITEM.replace("7", "9").replace("120 km", "85 miles").replace("Alice", "Bob Smith")
    broken = ITEM.replace("at 7", "at 3").replace("counts 7", "counts 4").replace("120", "99")
    texts = [f"Some words before. {ITEM} and some after.", ITEM.lower(), new, broken, "A train leaves the old town and comes back.", "", None]
    got = found(spark, texts)
    assert got.pop(0) is False and got.pop(2) is True
    assert 3 not in got and 4 not in got and set(got) <= {1}


def test_short_items_and_placeholders(spark):
    short = ["We say. What is the capital of Spain today", "what is the", "What is the capital of France?"]
    assert found(spark, short, ["What is the capital of France"]) == {0: True, 2: False}
    assert found(spark, ["1 2 3 4 5 6 7 8 9 10"], ["9 8 7 6 5 4 3 2 1"]) == {}
    assert found(spark, ["anything"], []) == {} and found(spark, [], [ITEM]) == {}


def test_shuffle_join_gives_the_same(spark, sf, monkeypatch):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    a = sorted(map(tuple, decontaminate.matches(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert a == sorted(map(tuple, decontaminate.matches(docs, bench).collect()))


def test_odd_rows(spark):
    docs, rows = odd_docs(spark)
    bench = spark.createDataFrame([(1, rows[0][1]), (2, None), (None, rows[4][1]), (3, ""), (1, rows[0][1])], "item_id long, text string")
    got = decontaminate.matches(docs, bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1)]
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1


def test_no_python_in_the_plan(spark, sf):
    plan = decontaminate.clean(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 8])
def test_window_hashes(spark, n):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(list("abcdefghij"),), (list("xcdefgh"),), ([],)], "template array<string>")
    a, b, c = (r[0] for r in decontaminate.with_window_hashes(df, n).select(f"h{n}").collect())
    assert len(a) == 11 - n and c == [] and len(b) == max(0, 8 - n)
    if n <= 6:
        assert a[2] == b[1]
    assert F is not None


@pytest.mark.parametrize("n", range(5, 15))
def test_verbatim_after_any_word(spark, n):
    words = "Which planet in the solar system has the most known moons of all today now".split()
    item = " ".join(words[:n])
    texts = [f"{before}{item}? And more." for before in ("", "Q: ", "Question: ", "we ask ", "He said. ", "Sample Question ")]
    assert found(spark, texts, [item + "?"]) == dict.fromkeys(range(6), False)
    assert found(spark, ["Q: Jupiter in a solar system has moons. In the solar system it has the most."], [item]) == {}


def test_short_question_after_a_colon(spark):
    item = "What is the capital of France?"
    assert found(spark, [f"Question: {item}", f"x, {item}", "Lisbon is the capital of Portugal", "So, Lisbon is the capital of France"], [item]) == {0: False, 1: False}


@pytest.mark.parametrize("n", [6, 7, 8, 9, 11, 13])
def test_leading_name_with_new_parameters(spark, n):
    item = " ".join("Alice keeps 7 old cats while Alice feeds 3 brown dogs near the".split()[:n])
    new = item.replace("7", "9").replace("Alice", "Bob")
    texts = [new, f"Q: {new}", f"It rains. {new}", f"It rains. {item.replace('Alice', 'Tom Lee')}", f"Then Sam {new}", f"see {item}"]
    got = found(spark, texts, [item])
    assert got == {0: True, 1: True, 2: True, 3: True, 4: True, 5: False}
    if n > 6:
        assert found(spark, [new.replace("Bob", "Carl", 1), "keeps " + new.lower()], [item]) == {}


@pytest.mark.parametrize("item", ["What is 12 + 30 - 5 * 7?", "3 5 8 13 21 34 55 89 144 233", "see JOHN SMITH, PARIS, FRANCE, LYON", "Rome, Oslo, Bern, Kiev, Riga, Lima, Cairo, Tunis, Quito, Seoul"])
def test_items_of_placeholders_only(spark, item):
    skeleton = item.replace("12", "11").replace("13", "14").replace("SMITH", "JONES").replace("Kiev", "Baku")
    texts = [item, f"Q: {item}", f"Some words. {item} Then more.", f"we solve {item} and go on", f"Sample Question {item}", skeleton, f"Q: {skeleton}", "What is 1 + 2 - 3 * 4?"]
    assert found(spark, texts, [item]) == dict.fromkeys(range(5), False)


def test_runs_of_thousands_of_names_and_numbers(spark):
    texts = [f"so {'Abc ' * 40000}end. {ITEM}", f"{'1,' * 40000} {ITEM}", "9.9" * 30000]
    assert found(spark, texts) == {0: False, 1: False}


def test_every_item_after_six_contexts(spark, sf):
    """A copy of any item is a hit wherever it stands, whatever its white space and letter case."""
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect()]
    before = ["", "Q: ", "Question: ", "We read here that ", "It rained. ", "1) "]
    forms = [lambda t: t, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" ", " \t "), str.upper, str.lower]
    before = [(b, f) for b in before for f in forms]
    n = len(items)
    docs = spark.createDataFrame([(k * n + i, f"{b}{f(t)} And then some.") for k, (b, f) in enumerate(before) for i, t in enumerate(items)], "doc_id long, text string")
    rows = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).select("doc_id", "item_id").collect()}
    assert [(before[k][0], k % len(forms), i) for k in range(len(before)) for i in range(n) if (k * n + i, i) not in rows] == []


def test_sql_has_short_items_and_copies(spark):
    items = ["see JOHN SMITH, PARIS, FRANCE, LYON", "What is the capital of France?", "3 5 8 13 21 34 55 89 144 233", ITEM]
    texts = [f(t) for t in items for f in (str, str.upper, lambda t: t.replace(" ", "  \n"), lambda t: f"so {t} then", lambda t: t[:12])]
    docs, bench = pd.DataFrame({"doc_id": range(len(texts)), "text": texts}), pd.DataFrame({"item_id": range(len(items)), "text": items})
    c = duckdb.connect()
    c.register("documents", docs)
    c.register("benchmark", bench)
    want = c.execute(decontaminate.oracle_sql()).df()
    got = decontaminate.matches(spark.createDataFrame(docs), spark.createDataFrame(bench)).toPandas()
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want[got.columns].values.tolist())) and len(got) == 16
