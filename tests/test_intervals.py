import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.operators import intervals
from kinweave.sources import text as sources

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SCHEMA = "protein_id string, sequence string, full_length boolean, cluster_size int, metadata string"


def hit(a, b, n=7):
    return ["x"] * (n - 2) + [a, b]


def slices(spark, rows, min_length):
    df = spark.createDataFrame([(i, s, True, 1, m) for i, s, m in rows], SCHEMA)
    return sorted((r.id, r.seq) for r in intervals.unannotated_slices(df, min_length).collect())


def expected(seq, regions, min_length):
    masked = [False] * (len(seq) + 1)
    for a, b in regions:
        for i in range(a - 1, min(b, len(seq))):
            masked[i] = True
    masked[len(seq)] = True
    out, start = [], 0
    for i, m in enumerate(masked):
        if m:
            if i - start >= min_length:
                out.append((start + 1, i))
            start = i + 1
    return out


def test_rules(spark):
    m = lambda **k: json.dumps(k)
    rows = [
        ("1", ALPHABET, m(p=[hit(1, 5)])),
        ("2", ALPHABET, m(p=[hit(1, 22)])),
        ("3", ALPHABET, m(p=[hit(1, 5), hit(20, 26)])),
        ("4", ALPHABET, m(m=[hit(1, 5, 5)])),
        ("5", ALPHABET, m(p=[hit(15, 20), hit(6, 18)], m=[hit(20, 26)])),
        ("6", "ABCD", m(b=[[1, 2]])),
        ("7", "ABCDE", m()),
        ("8", "ABCDE", m(p=[])),
        ("9", ALPHABET, "{not json"),
        ("10", "", m(p=[])),
    ]
    assert slices(spark, rows, 5) == sorted(
        [("1_6_26", ALPHABET[5:]), ("3_6_19", ALPHABET[5:19]), ("4_6_26", ALPHABET[5:]), ("5_1_5", "ABCDE"), ("7", "ABCDE"), ("8_1_5", "ABCDE")]
    )


def test_csv_to_fasta_text(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('id,sequence,full_length,cluster_size,metadata\n4706047775,ABCDEFGH,true,3,"{""p"": [[""PF1"", 1e-5, 3.5, 1, 2, 1, 3]]}"\n')
    df = intervals.unannotated_slices(sources.proteins(spark, str(path)), 5)
    assert [tuple(r) for r in df.collect()] == [("4706047775_4_8", "DEFGH")]
    assert hashlib.md5(">4706047775_4_8\nDEFGH\n".encode()).hexdigest() == hashlib.md5("".join(f">{r.id}\n{r.seq}\n" for r in df.collect()).encode()).hexdigest()


def test_published_output(spark):
    """13 proteins give 14 slices whose text has the published checksum."""
    m = lambda p=None, q=None: json.dumps({k: [hit(*x) for x in v] for k, v in (("p", p), ("m", q)) if v is not None})
    rows = [
        ("1", ALPHABET, m([(1, 5)])), ("2", ALPHABET, m([(1, 22)])), ("3", ALPHABET, m([(1, 5), (20, 26)])), ("4", ALPHABET, m(None, [(1, 5)])),
        ("5", ALPHABET, m(None, [(6, 26)])), ("6", ALPHABET, m([(12, 16), (9, 13)])), ("7", ALPHABET, m([(1, 20)])), ("8", ALPHABET, m([(3, 24)], [(1, 26)])),
        ("9", ALPHABET, m([(6, 10)], [(11, 21)])), ("10", ALPHABET, m([(1, 3), (10, 14)], [(23, 26)])), ("11", ALPHABET, m([(10, 12)], [(11, 16)])),
        ("12", "ABCD", json.dumps({"b": []})), ("13", "ABCDE", json.dumps({})),
    ]
    got = slices(spark, rows, 5)
    order = lambda r: [int(x) for x in r[0].split("_")]
    text = "".join(f">{i}\n{s}\n" for i, s in sorted(got, key=order))
    assert len(got) == 14 and hashlib.md5(text.encode()).hexdigest() == "32aaa7e3ff941b773fd9703bb01b1bb7"


REGION = st.tuples(st.integers(1, 40), st.integers(0, 15)).map(lambda t: (t[0], t[0] + t[1]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.lists(REGION, max_size=5)), min_size=1, max_size=12), st.integers(1, 6))
def test_gaps_equal_a_mask(spark, cases, min_length):
    rows = [(str(i), "A" * n, json.dumps({"p": [hit(a, b) for a, b in regions if b <= n]})) for i, (n, regions) in enumerate(cases)]
    got = [i for i, _ in slices(spark, rows, min_length)]
    want = [f"{i}_{a}_{b}" for i, (n, regions) in enumerate(cases) for a, b in expected("A" * n, [r for r in regions if r[1] <= n], min_length)]
    assert sorted(got) == sorted(want)


def test_plan_is_one_stage(spark):
    df = intervals.unannotated_slices(spark.createDataFrame([], SCHEMA), 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and df.count() == 0
