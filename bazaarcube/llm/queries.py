"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarcube.llm import (
    clustering,
    embed_dedup,
    langid,
    line_dedup,
    lm_score,
    merkle,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    topk,
    toxicity,
)
from bazaarcube.llm.tables import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.domain_labels(table(spark, sf_dir, "labels"))
    return mixing.rates(table(spark, sf_dir, "documents"), labels)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, toxicity.label_columns(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    found, p_names, rejected = toxicity.predict(docs, chain)
    return found.select("doc_id", *p_names, rejected)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, F.col("vec_id") % topk.QUERY_EVERY == 0)


def op11_simplex_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows are received with the line breaks of their texts deleted."""
    tampered = F.coalesce(remainder(F.col("doc_id"), 2) == 0, F.lit(False))
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verify(table(spark, sf_dir, "documents"), received={"text": text})


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_pii": op5_pii,
    "op6_language_id": op6_language_id,
    "op7_minmax_near_dedup": op7_minmax_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_exact_topk": op10_exact_topk,
    "op11_simplex_clustering": op11_simplex_clustering,
    "op12_quality": op12_quality,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_FINITE = (
    "embedding IS NOT NULL AND len(embedding) > 0"
    " AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
)

_OP4 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, low.b) AS component_id,
  e.vec_id = least(e.vec_id, low.b) AS kept
FROM embeddings e LEFT JOIN low ON low.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

_OP7 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  JOIN n m ON m.doc_id = x.doc_id JOIN n o ON o.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, m.n, o.n HAVING 100 * count(*) >= 75 * (m.n + o.n - count(*))
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, low.b) AS component_id,
  d.doc_id = least(d.doc_id, low.b) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.a = d.doc_id
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP8 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), o AS (
  SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), m AS (SELECT k.*, coalesce(k.doc_id <> o.owner, false) AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_OP10 = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND {_FINITE}
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""



def _op11(rounds: int = 10) -> str:
    def round_(t: int) -> str:
        return f"""
d{t} AS MATERIALIZED (
  SELECT r, k, sum((x.c - m.c) * (x.c - m.c)) AS d FROM x JOIN c{t} m USING (i) GROUP BY r, k
), a{t} AS MATERIALIZED (SELECT r, min({{'d': d, 'k': k}}) AS b FROM d{t} GROUP BY r),
s{t} AS (SELECT a.b.k AS k, i, sum(c) AS s, count(*) AS n FROM x JOIN a{t} a USING (r) GROUP BY a.b.k, i),
c{t + 1} AS MATERIALIZED (
  SELECT k, i, CASE WHEN n IS NULL THEN m.c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c{t} m LEFT JOIN s{t} USING (k, i)
)"""

    last = "".join(f",{round_(t)}" for t in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS e
  FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}
), x AS MATERIALIZED (SELECT r, unnest(e) AS c, generate_subscripts(e, 1) AS i FROM v),
p AS (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, e)) - 1 AS k, e FROM v),
c0 AS MATERIALIZED (SELECT k, unnest(e) AS c, generate_subscripts(e, 1) AS i FROM p WHERE k < 8){last},
f AS (SELECT r, k, sum((x.c - m.c) * (x.c - m.c)) AS d FROM x JOIN c{rounds} m USING (i) GROUP BY r, k),
b AS MATERIALIZED (SELECT r, min({{'d': d, 'k': k}}) AS b FROM f GROUP BY r),
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)
SELECT vec_id, b.k::INTEGER AS cluster, b.d::BIGINT AS distance, (sum(b.d) OVER (PARTITION BY b.k))::BIGINT AS cluster_inertia,
  (sum(b.d) OVER ())::BIGINT AS inertia, h.h AS centroid_sha256
FROM v JOIN b USING (r) JOIN h ON h.k = b.b.k
"""


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# levels of runs of three: node number and digest by level, then each leaf's way up
_OP13 = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), d AS MATERIALIZED (
  SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS cut,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
  FROM documents, crc
), l AS MATERIALIZED (
  SELECT *, '=' || source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), up(g, level, pos, h, n) AS (
  SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM l
  UNION ALL
  SELECT g, any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM up WHERE n > 1 GROUP BY g, pos // 3
), sub AS MATERIALIZED (
  SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM up WHERE n = 1
), top(level, pos, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM sub
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM top WHERE n > 1 GROUP BY pos // 3
), node AS MATERIALIZED (
  SELECT coalesce(g, '') AS g, level, pos, h, n FROM up UNION ALL SELECT 'top', level, pos, h, n FROM top
), side AS MATERIALIZED (
  SELECT a.g, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM node a JOIN node b ON a.g = b.g AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.g, a.level, a.pos
), way AS MATERIALIZED (
  SELECT row_number() OVER () AS id, l.doc_id, l.leaf, CASE WHEN l.crc % 2 = 0 THEN l.cut ELSE l.leaf END AS got,
    coalesce(l.g, '') AS g, l.pos, sub.h AS subroot, sub.pos AS top
  FROM l JOIN sub ON l.g IS NOT DISTINCT FROM sub.g
), fold(id, g, top, level, pos, h, proof) AS (
  SELECT id, g, top, 0, pos, got, '' FROM way
  UNION ALL
  SELECT f.id, f.g, f.top, f.level + 1, f.pos // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM fold f JOIN side s ON s.g = f.g AND s.level = f.level AND s.pos = f.pos
), half AS MATERIALIZED (SELECT id, top, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM fold GROUP BY id, top),
rest(id, level, pos, h, proof) AS (
  SELECT id, 0, top, h, proof FROM half
  UNION ALL
  SELECT f.id, f.level + 1, f.pos // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM rest f JOIN side s ON s.g = 'top' AND s.level = f.level AND s.pos = f.pos
), done AS (SELECT id, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM rest GROUP BY id),
root AS (SELECT h FROM top WHERE n = 1)
SELECT w.doc_id, w.leaf, w.subroot, root.h AS root, sha256(done.proof) AS proof_sha256, done.h AS folded_root, done.h = root.h AS verified
FROM way w JOIN done USING (id), root
"""

ORACLE_SQL: dict[str, str] = {
    "op4_embedding_near_dedup": _OP4,
    "op7_minmax_near_dedup": _OP7,
    "op8_line_dedup": _OP8,
    "op10_exact_topk": _OP10,
    "op11_simplex_clustering": _op11(),
    "op13_merkle_manifest": _OP13,
}
