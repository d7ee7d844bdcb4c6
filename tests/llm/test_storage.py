"""Sharding, WARC and embeddings."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from kinweave.llm import embedding_dedup, queries, sharding, warc

from .helpers import groups, odd_docs


def test_shards(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op7_sharding(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    total, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(total) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) <= 0.02 * max(total.values())


def test_map_edits():
    rng = np.random.default_rng(0)
    weight = rng.integers(1, 1000, 512).tolist()
    first = sharding.even_map(8, 512)
    edited = sharding.rebalance(first, weight, 8)
    load = np.bincount(edited, weight, 8)
    assert load.max() - load.min() <= 2 and sum(a != b for a, b in zip(first, edited, strict=True)) < 256
    grown = sharding.grow(edited, weight, 8)
    moved = {b for a, b in zip(edited, grown, strict=True) if a != b}
    assert moved == {8} and abs(np.bincount(grown, weight, 9)[8] - sum(weight) / 9) < 1000
    assert sharding.rebalance(first, [0] * 512, 8) == first


def test_one_record_that_outweighs_a_shard(spark):
    docs = spark.createDataFrame([(i, "x" * (200_000 if i == 7 else 9 + i % 100)) for i in range(2000)], "doc_id long, text string")
    total = defaultdict(int)
    for r in sharding.assign(docs).collect():
        total[r.shard] += r.size
    rest = sorted(total.values())[:-1]
    assert len(rest) == 15 and rest[-1] - rest[0] <= 20


def test_one_id_of_a_third_of_all_rows(spark):
    rows = [(None if i % 3 else i, f"text {i}") for i in range(6000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    n = defaultdict(int)
    for r in got:
        n[r.virtual_slot] += 1
    assert max(n.values()) < 20 and len({(r.shard, r.slot) for r in got}) == 6000


def test_maps_are_edited_by_version(spark, tmp_path):
    path = f"file://{tmp_path}/maps"
    docs = lambda n: spark.createDataFrame([(i, "x" * (i * 37 % 91)) for i in range(n)], "doc_id long, text string")
    of = lambda df: {r.doc_id: (r.virtual_slot, r.shard) for r in df.collect()}
    first = of(sharding.assign(docs(3000), 8, 512, path=path))
    assert sharding.latest(spark, path)[0] == 1
    second = of(sharding.assign(docs(3600), 8, 512, path=path))
    assert all(first[i][0] == second[i][0] for i in first)  # no record is hashed anew
    moved = sum(first[i][1] != second[i][1] for i in first)
    assert 0 < moved < 600 and sharding.latest(spark, path)[0] == 2
    grown = of(sharding.assign(docs(3600), 9, 512, path=path))
    assert {s for _, s in grown.values()} == set(range(9))
    assert sharding.load_map(spark, path).groupBy("version").count().count() == 4
    with pytest.raises(ValueError):
        sharding.assign(docs(10), 4, 512, path=path)


def test_shards_of_odd_rows(spark):
    docs, rows = odd_docs(spark)
    got = sharding.assign(docs, 3).collect()
    assert len(got) == len(rows) and len({(r.shard, r.slot) for r in got}) == len(rows)
    assert sharding.assign(docs.limit(0)).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a", "<p>x</p>"), (1, "http://b\r\nX: y", "<p>x</p>"), (2, None, None), (4, "u", ""), (5, "u", "é" * 10), (3, "http://a", "<p>x</p>"), (None, "n", "<p>x</p>"), (1, "again", "<p>x</p>")]
    path = warc.write(pages(spark, rows), f"file://{tmp_path}/w")
    back = warc.read(spark, path)
    got = sorted((r.record_id or "", r.record_type, r.refers_to or "", r.payload_bytes, r.payload_digest) for r in back.collect())
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    want = sorted(
        ("" if i is None else str(i), "response" if first[t or ""] == i else "revisit", "" if first[t or ""] == i else str(first[t or ""]), len((t or "").encode()), sha(t)) for i, _, t in rows
    )
    assert got == want
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    for r in warc.records(back).collect():
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert head.startswith(b"WARC/1.1\r\n") and len(body) == length + 4 and body.endswith(b"\r\n\r\n")
    warc.export_files(back, f"file://{tmp_path}/files")
    assert spark.read.text(f"file://{tmp_path}/files").filter("value LIKE 'WARC/1.1%'").count() == len(rows)


def test_warc_minimum_and_empty(spark, tmp_path):
    rows = [(1, "a", "xx"), (2, "b", "xx")]
    assert {r.record_type for r in warc.digest(pages(spark, rows), min_bytes=3).collect()} == {"response"}
    assert warc.digest(pages(spark, [])).count() == 0


def test_warc_notices_changed_bytes(spark, tmp_path):
    path = warc.write(pages(spark, [(1, "a", "xx"), (2, "b", "yy")]), f"file://{tmp_path}/c")
    good = spark.read.parquet(f"{path}/payloads").collect()
    changed = spark.createDataFrame([(r.digest, r.n_bytes, r.sha1, r.first_id, bytearray(b"zz")) for r in good], spark.read.parquet(f"{path}/payloads").schema)
    changed.write.mode("overwrite").parquet(f"{path}-bad/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}-bad/headers")
    with pytest.raises(Exception, match="not what its record"):
        warc.read(spark, f"{path}-bad").collect()


def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 24))
    out = [b.tolist() for b in base]
    for i in range(60):
        for scale in (0.05, 0.2, 0.3):
            out.append((base[i] * 3 + rng.normal(size=24) * scale * 3).tolist())
    out += [base[0].tolist()] * 5 + [(base[0] * 2).tolist()]
    return out


@pytest.mark.parametrize("chunk", [2048, 16])
def test_links_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
    rows = vectors()
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [float("inf")] * 24, [1.0] * 3]
    v = np.array(rows)
    v = v / np.linalg.norm(v, axis=1)[:, None]
    linked = (v @ v.T >= 0.95) & ~np.eye(len(v), dtype=bool)
    label = groups(len(v), list(zip(*np.nonzero(linked), strict=True)))
    df = spark.createDataFrame([(i, x, "extra", "extra") for i, x in enumerate(rows + odd)] + [(None, rows[0], "x", "y")], "vec_id long, embedding array<double>, list string, node string")
    got = {r.vec_id: r for r in embedding_dedup.link(df).collect()}
    assert len(got) == len(rows) + len(odd) + 1
    found = sum(got[i].n_links for i in range(len(v)))
    assert all(got[i].n_links <= linked[i].sum() for i in range(len(v))) and found >= 0.9 * linked.sum()
    assert np.mean([got[i].component_id == label[i] for i in range(len(v))]) > 0.95
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(v)))
    assert all(got[len(rows) + k].n_links == 0 and got[len(rows) + k].kept for k in range(len(odd)))
    assert got[None].component_id is None and got[None].kept


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_recall_on_the_table(spark, sf, scale):
    df = spark.read.parquet(f"{sf.replace('0.001', scale)}/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    v = np.array([x for _, x in rows])
    v /= np.linalg.norm(v, axis=1)[:, None]
    want = sum(int((v[a : a + 1000] @ v.T >= 0.95).sum()) for a in range(0, len(v), 1000)) - len(v)
    got = sum(r.n_links for r in embedding_dedup.link(df).collect())
    assert 0.9 * want <= got <= want


def test_all_probes_find_every_link(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(1500, 16))
    v[500:] = v[rng.integers(0, 500, 1000)] + rng.normal(size=(1000, 16)) * 0.33
    v /= np.linalg.norm(v, axis=1)[:, None]
    want = (v @ v.T >= 0.95).sum(1) - 1
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    # codebooks of 64 vectors only: codes are bad, and their own errors say so
    got = {r.vec_id: r.n_links for r in embedding_dedup.link(df, probes=None, sample=64).collect()}
    assert want.sum() > 500 and [got[i] for i in range(len(v))] == want.tolist()


def test_no_usable_vector(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.link(spark.createDataFrame([], schema)).count() == 0
    r = embedding_dedup.link(spark.createDataFrame([(1, None), (2, [0.0])], schema)).collect()
    assert all(x.n_links == 0 and x.kept and x.component_id == x.vec_id for x in r)


def test_vectors_of_each_length_are_linked(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.01]), (3, [3.0, 1.0]), (4, [3.0, 1.01]), (5, [3.0, 1.0]), (6, [-3.0, 1.0, 0.0]), (7, [1.0] * 4)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (0, 6), 7: (0, 7)}
