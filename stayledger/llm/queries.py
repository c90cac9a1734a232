"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm import decontaminate, language, lm_scoring, merkle, near_dup, packing, ptolemaic, quality_rules, ranking, secrets, sharding, token_counts, toxicity
from stayledger.llm.common import remainder, table
from stayledger.storage import stage_table


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain passages of the benchmark."""
    found = decontaminate.find_benchmark_text(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(found)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents from labels of the training part."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    docs = docs.select("doc_id", "text")
    model = ranking.train(docs, labels.where(remainder(3) != 1))
    scored = ranking.score(docs, model).withColumn("held_out", remainder(3) == 1)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in random order in eight shards of equal row counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.digest(sharding.shuffle_into_shards(docs))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of token ids in sequences of 2048."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share three quarters of their five-word shingles."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under models of the training part."""
    docs = table(spark, sf_dir, "documents")
    scored = lm_scoring.score(docs, training=remainder(7) != 2)
    return scored.withColumn("held_out", remainder(7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents from labels of the training part."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    docs = docs.select("doc_id", "text")
    model = toxicity.train(docs, labels.where(remainder(5) != 0))
    scored = toxicity.score(docs, model).withColumn("held_out", remainder(5) == 0)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    found = language.identify(pages, docs)
    return found.withColumn("probability", F.round("probability", 6))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents the rules, weighed by estimated accuracy, keep."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = stage_table(quality_rules.signals(docs).drop("text"), "quality-signals")
    return quality_rules.digest(quality_rules.judge(measured))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and where they would be cut to fit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).drop("text")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest of the table, proved from the root; some tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.col("n_chars") + F.when(remainder(7) == 0, 1).otherwise(0)
    manifest = merkle.build(docs.withColumn("tampered", tampered), tampered={"n_chars": "tampered"})
    return merkle.digest(merkle.prove(manifest))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of 40 centroids after five rounds, for every whole vector."""
    return ptolemaic.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


SQL_OP10 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes)),
hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


# Fixed value: the polynomial of the 32-bit cyclic redundancy check, bits reversed.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


SQL_OP12 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC.format('doc_id')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS tampered,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n FROM documents),
low AS (
  SELECT g, 0 AS level, p, leaf AS digest, n FROM d
  UNION ALL
  SELECT g, level + 1, p // 2, sha256(string_agg(digest, '' ORDER BY p)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY g, level, p // 2),
sub AS MATERIALIZED (
  SELECT g, level AS height, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS t, count(*) OVER () AS trees FROM low WHERE n = 1),
top AS (
  SELECT 0 AS level, t AS p, subroot AS digest, trees AS n FROM sub
  UNION ALL
  SELECT level + 1, p // 2, sha256(string_agg(digest, '' ORDER BY p)), (any_value(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, p // 2),
nodes AS MATERIALIZED (
  SELECT low.g AS g, low.level, low.p, low.digest FROM low WHERE n > 1
  UNION ALL
  SELECT sub.g, sub.height + top.level, top.p + 1000000000 * sub.t, top.digest FROM top, sub WHERE top.n > 1),
-- A leaf's place at each level: below its subroot in its group, above it among the groups.
path AS MATERIALIZED (
  SELECT d.doc_id, l.level AS level,
         CASE WHEN l.level < sub.height THEN d.p >> l.level ELSE (sub.t >> (l.level - sub.height)) + 1000000000 * sub.t END AS at,
         (CASE WHEN l.level < sub.height THEN d.p >> l.level ELSE sub.t >> (l.level - sub.height) END) % 2 AS digit, d.g, d.tampered
  FROM d JOIN sub USING (g) JOIN (SELECT DISTINCT g, level FROM nodes) l USING (g)),
step AS MATERIALIZED (
  SELECT path.doc_id, path.level, path.digit, nodes.digest AS sibling
  FROM path LEFT JOIN nodes ON nodes.g = path.g AND nodes.level = path.level
   AND nodes.p = path.at + CASE WHEN path.digit = 0 THEN 1 ELSE -1 END),
fold AS (
  SELECT doc_id, 0 AS level, tampered AS node FROM d
  UNION ALL
  SELECT fold.doc_id, fold.level + 1,
         sha256(CASE WHEN digit = 1 THEN sibling || node ELSE node || coalesce(sibling, '') END)
  FROM fold JOIN step ON step.doc_id = fold.doc_id AND step.level = fold.level)
SELECT d.doc_id, d.leaf, sub.subroot, top.digest AS root, sha256(coalesce(s.proof, '')) AS proof_sha256,
       f.node AS folded_root, f.node = top.digest AS verified
FROM d JOIN sub USING (g) CROSS JOIN (SELECT digest FROM top WHERE n = 1) top
LEFT JOIN (SELECT doc_id, string_agg(sibling, '' ORDER BY level) AS proof FROM step GROUP BY doc_id) s USING (doc_id)
JOIN (SELECT doc_id, arg_max(node, level) AS node FROM fold GROUP BY doc_id) f USING (doc_id)
"""


def _sql_op13() -> str:
    """The rounds of the clustering one after the other; a floor of a quotient is made of truncating parts."""
    parts = [
        """v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS c FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS k, c FROM v
  ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) LIMIT 40)"""
    ]
    for r in range(ptolemaic.ROUNDS + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(c) AS c, arg_min(k, (dist, k)) AS k, min(dist) AS dist FROM (
    SELECT v.vec_id, v.c, c{r}.k, list_sum(list_transform(list_zip(v.c, c{r}.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist
    FROM v CROSS JOIN c{r}) GROUP BY vec_id)"""
        )
        if r < ptolemaic.ROUNDS:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.k AS k, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT k, unnest(c) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY k, i)
    GROUP BY k) m ON m.k = c{r}.k)"""
            )
    last = ptolemaic.ROUNDS
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
       CAST(sum(a.dist) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c USING (k)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_shards": op2_shards,
        "op3_pack": op3_pack,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_lm_scores": op5_lm_scores,
        "op6_toxicity": op6_toxicity,
        "op7_language": op7_language,
        "op8_quality_rules": op8_quality_rules,
        "op9_secrets": op9_secrets,
        "op10_decontaminate": op10_decontaminate,
        "op11_token_counts": op11_token_counts,
        "op12_manifest": op12_manifest,
        "op13_clusters": op13_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_quality_rules": quality_rules.oracle(),
        "op10_decontaminate": SQL_OP10,
        "op12_manifest": SQL_OP12,
        "op13_clusters": _sql_op13(),
    }
