"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again,
so a lost executor or driver costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import free_names, let_workers_import, near, packing, passages, secret_scan, toxicity
from tidemark.llm.queries import vocabulary
from tidemark.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones, does not reject. Blank texts stay.

    Columns with names of scores are carried along untouched.
    """
    let_workers_import(spark)
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    clash = [c for c in docs.columns if c.lower() in ("expected_severity", "severity", "toxic", "risk", "_scores")]
    (held,) = free_names(docs, "held")
    carried = docs.withColumn(held, F.struct(*map(F.col, clash))).drop(*clash) if clash else docs
    kept = toxicity.score_toxicity(carried, model).where("not toxic")
    return kept.select(*(F.col(f"{held}.{c}") if c in clash else F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 0.8 or more: the one with the smallest doc_id."""
    let_workers_import(spark)
    return near.keep_one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 or more words that an earlier one holds; those that hold nothing else go."""
    let_workers_import(spark)
    return _recounted(docs, passages.without_repeats(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of every secret."""
    let_workers_import(spark)
    return _recounted(docs, secret_scan.redact_secrets(docs, secret_scan.fit_secrets(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    let_workers_import(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Models, chains and tokenizers have no SQL twin; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def _recounted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``n_chars`` follows the text; texts that did not change keep theirs, as it is equal."""
    if "n_chars" not in after.columns:
        return after
    return after.withColumn("n_chars", F.coalesce(F.char_length("text").cast(before.schema["n_chars"].dataType), "n_chars"))
