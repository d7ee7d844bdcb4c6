"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import bpe, decontaminate, embedding_dedup, langid, merkle, packing, quality, sharding, simhash, suffix_dedup, toxicity, warc
from ._util import table


def op1_bpe(spark, d):
    return bpe.digest(table(spark, d, "documents"))


def op2_suffix_dedup(spark, d):
    return suffix_dedup.digest(table(spark, d, "documents"))


def op3_decontamination(spark, d):
    return decontaminate.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op4_quality(spark, d):
    return quality.select_by_quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op5_simhash(spark, d):
    return simhash.clusters(table(spark, d, "documents"))


def op6_toxicity(spark, d):
    return toxicity.predict(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_sharding(spark, d):
    return sharding.assign(table(spark, d, "documents"), shards=16)


def op8_langid(spark, d):
    return langid.identify(table(spark, d, "documents"))


def op9_embedding_dedup(spark, d):
    return embedding_dedup.link(table(spark, d, "embeddings"))


def op10_warc(spark, d):
    return warc.digest(table(spark, d, "pages"))


def op11_merkle(spark, d):
    return merkle.verify(table(spark, d, "documents"))


def op12_packing(spark, d):
    return packing.digest(table(spark, d, "documents"))


def queries():
    return {f.__name__: f for f in (op1_bpe, op2_suffix_dedup, op3_decontamination, op4_quality, op5_simhash, op6_toxicity, op7_sharding, op8_langid, op9_embedding_dedup, op10_warc, op11_merkle, op12_packing)}


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def oracle_sql():
    symbol = f"""substr('{_BASE32}', CAST((CAST('0x' || substr(h, 5 * k + 1, 5) AS INTEGER) >> (5 * (3 - j))) & 31 AS INTEGER) + 1, 1)"""
    return {
        "op3_decontamination": decontaminate.oracle_sql(),
        "op9_embedding_dedup": """
            WITH RECURSIVE v AS (
                SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
                WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
            u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE list_inner_product(e, e) > 0),
            l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
            r(node, top) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.a, r.top FROM r JOIN l ON l.b = r.node),
            c AS (SELECT node, min(top) AS component_id FROM r GROUP BY node)
            SELECT vec_id, (SELECT count(*) FROM l WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
            FROM embeddings JOIN c ON node = vec_id""",
        "op11_merkle": merkle.oracle_sql(),
        "op10_warc": f"""
            WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
                 m AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
            SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
                   list_aggregate(flatten([[{symbol} FOR j IN range(4)] FOR k IN range(8)]), 'string_agg', '') AS payload_digest,
                   CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
            FROM p JOIN m ON p.html = m.html""",
    }
