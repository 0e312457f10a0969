"""Registered queries of the subpackage, each over its whole table, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, divergence, laesa, langid, maxscore, mixing, ngram_join, nn_descent, pii, quality, shards, toxicity, weak_rules
from starloom.llm.common import crc_fold, table
from starloom.session import scratch_path

#: Score from which a label is predicted.
THRESHOLD = 0.3
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and groups of all documents."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of all documents in fixed-stride shards; one row per sequence."""
    ids = bpe.packed(table(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY)
    end = max(bpe.prepared(VOCABULARY)[1]) + 1  # after the vocabulary: the end of a document, and padding
    return shards.write_shards(ids, scratch_path(spark, "shards"), "tokens", dtype="uint16", end=end, pad=end + 1)[1]


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 and more among all embeddings, and their groups."""
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))[0]


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes of each."""
    mixed = mixing.taken_words(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def training_labels(spark: SparkSession, sf_dir: str, column: str, folds: int, held: int) -> DataFrame:
    """Ids and labels that may train: those outside the held-out fold."""
    rows = table(spark, sf_dir, "labels", "doc_id", column)
    return rows.where(crc_fold("doc_id", folds) != held).select("doc_id", F.col(column).alias("label"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from three of four folds of the labels."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, training_labels(spark, sf_dir, "toxic", 4, 2)))
    return scored.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors by integer inner product for every twentieth id."""
    return maxscore.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms for personal data, and how many each got."""
    return pii.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"), count_col="replaced")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from four of five folds of the labels."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, training_labels(spark, sf_dir, "quality", 5, 0)))
    return scored.select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from three of four folds of the documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs.where(crc_fold("doc_id", 4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of the bytes they decode to."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.encode(docs, VOCABULARY, decoded_col="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quality rules measure in every text, and the verdict of their weighted votes."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return weak_rules.judge(docs, ["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                     "n_repeat_words", "base_failed", "kept", "score")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all sources of each language, and the terms that set each apart."""
    return divergence.divergences(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings of 64 components after five rounds over 40 centroids."""
    found = laesa.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


OP1_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM tokens WHERE len(w) > 0),
runs AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM runs x JOIN runs y USING (s)
           WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b, c = p.n AND c = q.n AS same FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 5 * c >= 4 * (p.n + q.n - c)),
reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
classes AS (SELECT a AS doc_id, min(b) AS least FROM links WHERE same GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a),
lowest AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id)
SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id)) AS class_id, coalesce(n_links, 0) AS n_links,
       least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id AS kept
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN classes c USING (doc_id) LEFT JOIN degree USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

OP3_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
          WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
reach(vec_id, other) AS (SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a),
lowest AS (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(low, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degree USING (vec_id) LEFT JOIN lowest USING (vec_id)
"""

OP6_SQL = """
WITH whole AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
found AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY ALL HAVING count(DISTINCT row) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
          FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
sums AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v FROM cells),
whole AS (SELECT lang, sum(n) AS total FROM kept GROUP BY lang),
p AS (SELECT s.lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 2) // (s.total + 2 * v)) AS p,
             (1 + 1000000000::HUGEINT * (lang_n + 2) // (w.total + 2 * v)) AS q FROM sums s JOIN whole w USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _op13_sql(rounds: int = 5) -> str:
    """Every round: assign (distance and number in one integer), then move the centroids."""
    steps = []
    for at in range(rounds + 1):
        steps.append(f"""a{at} AS MATERIALIZED (
  SELECT row, vec_id, v, min(64 * list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, 65)])::HUGEINT + no) AS best
  FROM kept, c{at} GROUP BY ALL)""")
        steps.append(f"""s{at} AS MATERIALIZED (
  SELECT no, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
    SELECT best % 64 AS no, i, sum(x)::HUGEINT AS s, count(*) AS n
    FROM (SELECT best, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{at}) GROUP BY ALL) GROUP BY no)""")
        steps.append(f"""c{at + 1} AS MATERIALIZED (
  SELECT o.no, coalesce(s.c, o.c) AS c FROM c{at} o LEFT JOIN s{at} s ON s.no = o.no)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS no, v AS c FROM kept
  ORDER BY no LIMIT 40),
{", ".join(steps[:-2])}
SELECT vec_id, (best % 64)::INT AS cluster, (best // 64)::BIGINT AS distance,
       (sum(best // 64) OVER (PARTITION BY best % 64))::BIGINT AS cluster_inertia, (sum(best // 64) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON no = best % 64
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The numbered operators by query name."""
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_training_order": op2_training_order,
        "op3_nn_descent": op3_nn_descent,
        "op4_source_mix": op4_source_mix,
        "op5_toxicity": op5_toxicity,
        "op6_maxscore": op6_maxscore,
        "op7_pseudonyms": op7_pseudonyms,
        "op8_quality": op8_quality,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_language": op10_language,
        "op11_weak_rules": op11_weak_rules,
        "op12_source_divergence": op12_source_divergence,
        "op13_laesa_clusters": op13_laesa_clusters,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name, where SQL can express the operator."""
    return {
        "op1_ngram_jaccard": OP1_SQL,
        "op3_nn_descent": OP3_SQL,
        "op6_maxscore": OP6_SQL,
        "op12_source_divergence": OP12_SQL,
        "op13_laesa_clusters": _op13_sql(),
    }
