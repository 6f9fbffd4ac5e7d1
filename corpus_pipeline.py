"""A corpus pipeline over the operators of ``lodestar.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written as
Parquet and read again as the next stage's ``docs``:

1. toxicity: a classifier chain, fitted on the labelled documents, rejects documents.
2. line_dedup: lines that an earlier document holds go; every document stays, maybe with an empty text.
3. ngram_join: of the documents linked by near copies the one of the smallest ``doc_id`` stays.
4. decontamination: documents that quote benchmark items too much go.
5. byte_bpe: each document's number of tokens and digests of its ids and of the decoded bytes.

All but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from lodestar.llm.common import id_key, spare_names, stored, text_key
from lodestar.llm.queries import bpe_digests, toxicity_chain
from lodestar.plans.catalog import load


def set_aside(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but id and text under names that no operator gives its results."""
    return docs.select(*(F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"own_{i}") for i, c in enumerate(docs.columns)))


def given_back(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from what became of ``set_aside(docs)``."""
    return out.select(*(F.col(c if c in ("doc_id", "text") else f"own_{i}").alias(c) for i, c in enumerate(docs.columns)))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity_chain(docs, load(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    rows = set_aside(docs)
    return given_back(toxicity.score_documents(rows, chain, keep=rows.columns).where(~F.col("flagged")), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = given_back(line_dedup.dedup_lines(set_aside(docs)), docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(docs, load(spark, sf_dir, "benchmark", ["item_id", "text"]))
    d, t = spare_names(docs.columns, "d", "t")
    found = judged.where("contaminated").select(F.col("d").alias(d), F.col("t").alias(t)).distinct()
    mine = docs.withColumns({d: id_key(), t: text_key()})
    kept = mine.join(decontaminate.small(stored(found, "contaminated")), [d, t], "left_anti")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # no common pre-tokens: after four stages the driver's memory is scarcer than CPU
    return bpe_digests(bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), common=0, known=400_000))


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("ngram_join", ngram_join_stage),
          ("decontamination", decontamination_stage), ("byte_bpe", byte_bpe_stage)]

#: The toxicity stage is no SQL; tests hold the pipeline against a version without Spark.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result for ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
