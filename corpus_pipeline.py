"""From raw documents to token ids: rules, repeated lines, near copies, leaks, tokens.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame: all but the last the columns
of documents, the last (doc_id, n_tokens, token_ids). Stages work on everything their
predecessor kept. Null or empty texts fail the rules and go in the first stage; rows equal
in id and text stay or go together; extra columns pass through up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontaminate, forest, line_chunks, minhash, spm
from terrace.llm.common import in_short_batches, quoted, table
from terrace.llm.queries import MODEL
from terrace.sources.tables import materialise


@in_short_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the forest reject go."""
    return forest.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of chunks, two lines or more, are cut out; documents left without a word go."""
    cut = line_chunks.without_repeats(docs, joined=True)[0].select(*map(quoted, docs.columns))
    # Stored first: Spark would move the filter below the cutting and, for it, write all of its
    # nested array expressions out once more, evaluated anew for every element.
    left = materialise(cut, "cut").filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


@in_short_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs)


@in_short_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a segment of one, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@in_short_batches
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document."""
    ids = spm.token_ids(spm.model_bytes(spark, MODEL), F.col("text"))
    return docs.select("doc_id", ids.alias("token_ids")).select(
        "doc_id", F.coalesce(F.size("token_ids"), F.lit(0)).alias("n_tokens"), "token_ids"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# The forest and the similarity groups are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result but the last stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
