"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and returns documents (the last one,
token ids). Stages are written as Parquet and read back, so a lost executor costs no more
than the stage it was in. An empty table passes through as an empty table.

Stages with Python workers set the session's ``spark.sql.execution.arrow.maxBytesPerBatch``,
unless it has a value: by rows alone (10,000 a batch), whole texts fill tens of megabytes in
the executor and again in each worker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.llm.decontamination import without_contaminated
from tripdemand.llm.language_id import UNDETERMINED, fit_prototypes, predict_language
from tripdemand.llm.ngram_join import one_row_of_each_class
from tripdemand.llm.queries import table, tokenizer
from tripdemand.llm.secret_scan import redact_secrets
from tripdemand.llm.sentencepiece_codec import encode_documents
from tripdemand.llm.stored import written


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of ``BATCH_BYTES``, unless the session names a size."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; ``lang`` becomes the predicted one. Null texts and texts without letters go."""
    small_batches(spark)
    labels, prototypes = fit_prototypes(docs)
    if not labels:  # nothing to learn from: only texts without letters can be told apart
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # the row goes as one column, so that none of its columns clashes with what is predicted
    predicted = predict_language(docs, labels, prototypes, [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")])
    kept = predicted.where(F.col("lang_pred") != UNDETERMINED)
    return kept.select(*(F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document row of each group of near duplicates."""
    small_batches(spark)
    return one_row_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; ``n_chars`` follows the text."""
    small_batches(spark)
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of the text decoded from them."""
    small_batches(spark)
    return encode_documents(docs, tokenizer("piece_bpe_32k.model"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("token_ids", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
