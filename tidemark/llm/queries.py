"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, fingerprint, let_workers_import, near, neighbours, packing, passages, pii, quality, ranked_search, runs, secret_scan, sorted_passes, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary; TOKENIZER_DIR overrides the installed package."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_bpe(spark, sf_dir):
    return bpe.encoding_digests(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_neighbours(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op4_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit_pii(docs))


def op5_passages(spark, sf_dir):
    return passages.repeated_passages(_table(spark, sf_dir, "documents")).drop("rest", "text_hash")


def op6_secrets(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.find_secrets(docs, secret_scan.fit_secrets(docs))


def op7_simhash(spark, sf_dir):
    found = near.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint.as_hex(F.col("fp")[0]).alias("fingerprint"), "component_id")


def op9_fingerprint(spark, sf_dir):
    return fingerprint.document_fingerprints(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", "expected_severity", "severity", "risk", "toxic")


def op10_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))


def op11_ranked_search(spark, sf_dir):
    return ranked_search.search(ranked_search.build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op12_vector_copies(spark, sf_dir):
    return sorted_passes.near_vectors(_table(spark, sf_dir, "embeddings"))


def op13_runs(spark, sf_dir):
    return runs.run_digests(runs.periodic_runs(runs.with_planted_runs(_table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (op1_packing, op2_bpe, op3_neighbours, op4_pii, op5_passages, op6_secrets, op7_simhash, op8_toxicity, op9_fingerprint, op10_quality)
    return {f.__name__: f for f in (*numbered, op11_ranked_search, op12_vector_copies, op13_runs)}


_TERMS = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"

_RANKED_SEARCH = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS term FROM documents WHERE doc_id IS NOT NULL),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
norms AS (SELECT doc_id, 10 + (90 * n * (SELECT count(*) FROM lengths)) // (SELECT CAST(sum(n) AS BIGINT) FROM lengths) AS m FROM lengths),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * (SELECT count(*) FROM lengths) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM counts GROUP BY ALL
),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} AS term FROM benchmark)),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_ranked_search": _RANKED_SEARCH}
