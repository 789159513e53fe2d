"""Registered queries of the training-data operators, and their DuckDB SQL where one exists.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import (html_marginals, license_scan, lyndon_runs, minmax_dedup, nnls_packing, orc_tokens, poisson_mix, prefix_trie,
                         rank_langid, secret_ledger, subspace_join, taat_topk, warc_bundles)
from tempora.llm.common import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), scratch(spark, "ledger")
    paths = secret_ledger.addressed(docs, ["doc_id"])
    secret_ledger.scan(docs, paths, ledger, ["doc_id"])
    found = secret_ledger.findings(paths, ledger)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_taat_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taat_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sequences")
    nnls_packing.write_sequences(nnls_packing.pack(nnls_packing.cut(table(spark, sf_dir, "documents"))), path)
    return nnls_packing.sequence_digest(spark, path)


def op7_rank_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_langid.identify(table(spark, sf_dir, "documents"))


def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc_bundles.write_bundles(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc_bundles.read_bundles(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.mix(table(spark, sf_dir, "documents"))


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens-orc")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return orc_tokens.token_digest(spark, path)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_html_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_marginals.main_text(table(spark, sf_dir, "pages"))


def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lyndon_runs.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_minmax_dedup": op2_minmax_dedup,
    "op3_taat_topk": op3_taat_topk,
    "op4_license_scan": op4_license_scan,
    "op5_subspace_join": op5_subspace_join,
    "op6_packing": op6_packing,
    "op7_rank_langid": op7_rank_langid,
    "op8_warc_bundles": op8_warc_bundles,
    "op9_poisson_mix": op9_poisson_mix,
    "op10_orc_tokens": op10_orc_tokens,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_html_marginals": op12_html_marginals,
    "op13_lyndon_runs": op13_lyndon_runs,
}

#: Words of a text: A-Z lower-cased, split at ASCII white space.
WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+')"""

ORACLE_SQL: dict[str, str] = {
    "op2_minmax_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [hash(array_to_string(w, ' '))]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: hash(array_to_string(w[i:i + 3], ' ')))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, a.n AS n, b.n AS m, count(*) AS i FROM e a JOIN e b USING (sh)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p WHERE 100 * i >= 80 * (n + m - i)),
r AS (SELECT doc_id AS node, doc_id AS reach FROM s UNION SELECT r.node, l.v FROM r JOIN l ON r.reach = l.u),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c ON c.node = s.doc_id""",
    "op3_taat_topk": """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.w, c.w),
    lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.row <> q.row),
r AS (SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5""",
    "op4_license_scan": """
WITH t AS (SELECT * FROM (VALUES %s) v(license, text)),
tw AS (SELECT license, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM t),
ts AS (SELECT license, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM tw),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
ds AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: {'p': i - 1, 's': array_to_string(w[i:i + 4], ' ')})) AS x FROM dw),
te AS (SELECT license, len(s)::BIGINT AS n, unnest(s) AS s FROM ts)
SELECT doc_id, license, count(DISTINCT te.s)::BIGINT AS n_shared, n AS n_shingles, min(x.p)::BIGINT AS first_word
FROM ds JOIN te ON ds.x.s = te.s GROUP BY doc_id, license, n HAVING 100 * count(DISTINCT te.s) >= 80 * n
""" % ", ".join("('%s', '%s')" % (k, v.replace("'", "''")) for k, v in license_scan.TEMPLATES.items()),
    "op5_subspace_join": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
  AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS reach FROM embeddings UNION SELECT r.node, l.v FROM r JOIN l ON r.reach = l.u),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.node = vec_id LEFT JOIN n ON n.u = vec_id""",
    "op8_warc_bundles": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last, array_to_string(list_transform(range(0, 32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '')
  AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to FROM d""",
    "op9_poisson_mix": """
WITH z AS (SELECT source, sum(coalesce(length(text), 0) + 1)::BIGINT AS size FROM documents GROUP BY source),
t AS (SELECT source, (pow(size::DOUBLE, 0.5) / sum(pow(size::DOUBLE, 0.5)) OVER ()) * (sum(size) OVER ())::DOUBLE / size AS rate
  FROM z),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM t),
p AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
d AS (SELECT *, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents),
n AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS n FROM d JOIN p
  ON d.source IS NOT DISTINCT FROM p.source AND p.cdf <= d.u GROUP BY ALL),
c AS (SELECT *, unnest(range(1, n + 1)) AS copy FROM n)
SELECT doc_id, text, lang, source, n_chars, copy,
  ('0x' || substr(md5('mix:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 13))::BIGINT / 4503599627370496.0
    AS shuffle_key FROM c""",
}
