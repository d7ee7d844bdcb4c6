"""The jobs as registered queries: each runs twice into one new folder and returns what stands there."""

from __future__ import annotations

from jobs import common, release_update, slice_catalogue
from kinweave.storage import shared_folder


def job1_slice_catalogue(spark, d):
    out = shared_folder(spark)
    for _ in range(2):
        slice_catalogue.run(spark, f"{d}/documents.parquet", f"{d}/lineitem.parquet", out, common.packaged("slice_catalogue"))
    return slice_catalogue.output(spark, out)


def job2_release_update(spark, d):
    root = shared_folder(spark)
    for _ in range(2):
        release_update.run(spark, f"{d}/lineitem.parquet", f"{d}/part.parquet", f"{root}/out", f"{root}/checkpoint", common.packaged("release_update"))
    return release_update.output(spark, f"{root}/out")


QUERIES = {f.__name__: f for f in (job1_slice_catalogue, job2_release_update)}

SQL = {
    "job1_slice_catalogue": """
        WITH r AS (SELECT l_orderkey AS k, CAST(l_quantity AS INT) AS a, CAST(l_quantity AS INT) + 3 * l_linenumber AS b FROM lineitem),
        s AS (SELECT r.*, coalesce(max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m
              FROM r WHERE k IN (SELECT doc_id FROM documents)),
        g AS (SELECT k, m + 1 AS f, a - 1 AS t FROM s
              UNION ALL SELECT k, max(b) + 1, max(length(text)) FROM s JOIN documents ON doc_id = k GROUP BY k),
        u AS (SELECT concat_ws('_', k, f, t) AS id, substr(text, f, t - f + 1) AS seq FROM g JOIN documents ON doc_id = k WHERE t - f + 1 >= 20
              UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents
              WHERE doc_id NOT IN (SELECT l_orderkey FROM lineitem) AND length(text) >= 20)
        SELECT min(id) AS id, seq, sha256(seq) AS digest, CAST(length(seq) AS INT) AS length, count(*) AS copies, 'r1' AS release,
               CASE WHEN length(seq) >= 10000 THEN 10000 WHEN length(seq) >= 3000 THEN 3000 WHEN length(seq) >= 1000 THEN 1000
                    WHEN length(seq) >= 300 THEN 300 WHEN length(seq) >= 100 THEN 100 ELSE 0 END AS length_class
        FROM u GROUP BY seq""",
    "job2_release_update": """
        WITH e AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS family, l_partkey FROM lineitem WHERE l_suppkey IS NOT NULL),
        m AS (SELECT family, p_type, p_brand, replace(p_name, ' ', chr(9)) AS a FROM e JOIN part ON p_partkey = l_partkey),
        t AS (SELECT family, unnest(['root', 'root:' || p_type, 'root:' || p_type || ':' || p_brand]) AS label,
                     unnest(['', 'root', 'root:' || p_type]) AS parent FROM m),
        c AS (SELECT family, a AS label, count(*) AS n FROM m GROUP BY 1, 2),
        k AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n DESC, label) AS rank FROM c),
        f AS (SELECT family, 'biome' AS kind, label, parent, count(*) AS n, 0 AS rank FROM t GROUP BY family, label, parent
              UNION ALL SELECT family, 'architecture', label, '', n, CAST(rank AS INT) FROM k WHERE rank <= 15)
        SELECT *, CAST(CAST('0x' || substr(md5(family), 1, 6) AS INT) % 16 AS INT) AS bucket FROM f""",
}
