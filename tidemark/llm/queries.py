"""The operators' queries over the synthetic tables, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

def vocabulary(name: str) -> str:
    """A public vocabulary's file; the module is there on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fertility_vocabularies() -> tuple[str, ...]:
    """The vocabularies whose fertility the quality rules measure."""
    return vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_multi_50k.tiktoken")


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_crf

    documents = table(spark, sf_dir, "documents")
    model = line_crf.train(documents, table(spark, sf_dir, "labels"), folds=3, left_out=1)
    return line_crf.score(documents, model, folds=3, left_out=1)


def op2_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import round_trip

    return round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), seed=7, dropout=0.1)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import join

    return join(table(spark, sf_dir, "documents"), size=5, percent=75)


def op5_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kdtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import round_trip

    return round_trip(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)


def op7_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .katz import score

    return score(table(spark, sf_dir, "documents"), order=2, folds=10)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), folds=5, left_out=0)
    return toxicity.score(documents, model, folds=5, left_out=0)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import score

    return score(table(spark, sf_dir, "documents"), fertility_vocabularies())


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2, size=1024)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_host_paths": op2_host_paths,
    "op3_merge_dropout": op3_merge_dropout,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_kd_top_k": op5_kd_top_k,
    "op6_token_files": op6_token_files,
    "op7_katz_backoff": op7_katz_backoff,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
}

#: SQL forms of the queries that have one; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_jaccard_join": """WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * same >= 75 * (x.n + y.n - same)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.doc_id WHERE r.root <= l.b)
SELECT s.doc_id, s.n AS n_shingles, min(r.root) AS component_id FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY 1, 2""",
    "op5_kd_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0 AND len(q.e) = len(v.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
}
