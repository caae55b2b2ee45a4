"""The corpus operators over the test tables, one query each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontaminate, forest, gam, line_chunks, minhash, parity, runs, sharding, spm, token_shards, toxicity, trie, windows
from terrace.llm.common import in_short_batches, table
from terrace.session import work_folder
from terrace.sources import storage

# Tokenizer files stay where they are installed.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def _fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds


def _scored(docs: DataFrame, held_out: Column, score: Column) -> DataFrame:
    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


@in_short_batches
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(_fold(F.col("doc_id"), 5) != 0))
    return _scored(docs, _fold(F.col("doc_id"), 5) == 0, toxicity.score(model, F.col("text")))


@in_short_batches
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = minhash.Settings(shingle=3, percent=85, band_rows=5, bands=25)
    return minhash.link(table(spark, sf_dir, "documents"), settings=settings)


@in_short_batches
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = decontaminate.indexes(table(spark, sf_dir, "benchmark"))
    found = table(spark, sf_dir, "documents").select("doc_id", decontaminate.leaks(blocks, F.col("text")).alias("leaks"))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("leaked"),
        F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"),
        F.aggregate("leaks", F.lit(0), lambda n, x: n + x["edits"]).alias("edits"),
    )


@in_short_batches
def op4_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = MODEL) -> DataFrame:
    model = spm.model_bytes(spark, model_path)
    return table(spark, sf_dir, "documents").select("doc_id", spm.digest(model, F.col("text")).alias("d")).select("doc_id", "d.*")


@in_short_batches
def op5_token_shards(spark: SparkSession, sf_dir: str, ranks_path: str = RANKS) -> DataFrame:
    """The manifest of shards written to the shared work folder."""
    encoder = token_shards.RankFile(spm.model_bytes(spark, ranks_path))
    path = storage.qualified(spark, f"{work_folder(spark)}/token-shards-{uuid.uuid4().hex[:8]}")
    manifest = token_shards.write_shards(table(spark, sf_dir, "documents"), path, encoder, stored=True)
    return manifest.withColumn("first_doc", F.col("first_doc").cast("long"))


@in_short_batches
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done, cut = windows.without_repeats(docs)
    span = F.aggregate(f"{cut}.spans", F.lit(0), lambda n, s: n + s["to_word"] - s["from_word"])
    return done.select(
        "doc_id", f"{cut}.n_words", span.cast("long").alias("n_removed"),
        F.sha2(F.col(f"{cut}.kept_text"), 256).alias("kept_sha256"),
    )


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, names = line_chunks.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", *names.values(), F.sha2("text", 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sharding.text_sizes(table(spark, sf_dir, "documents"))
    return sharding.shuffle_rows(sizes, 24, "op8").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@in_short_batches
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


@in_short_batches
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = gam.fit(docs, labels.filter(_fold(F.col("doc_id"), 3) != 1))
    return _scored(docs, _fold(F.col("doc_id"), 3) == 1, gam.score(model, F.col("text")))


@in_short_batches
def op11_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.link(table(spark, sf_dir, "documents"))


@in_short_batches
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    shaped = docs.select("doc_id", runs.found(runs.with_tail_repeated(F.col("text"), seed)).alias("found"))
    best = shaped.select("doc_id", "found.*").withColumn("best", runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@in_short_batches
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return trie.trie(*trie.with_shared_openings(turns))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash": op2_minhash,
    "op3_decontamination": op3_decontamination,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_token_shards": op5_token_shards,
    "op6_substrings": op6_substrings,
    "op7_line_chunks": op7_line_chunks,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality": op10_quality,
    "op11_parity_join": op11_parity_join,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op2_minhash": parity.oracle_sql(3, 85, kept=True),
    "op6_substrings": windows.ORACLE_SQL,
    "op7_line_chunks": line_chunks.ORACLE_SQL,
    "op11_parity_join": parity.oracle_sql(5, 80),
    "op12_periodic_runs": runs.ORACLE_SQL,
    "op13_prefix_trie": trie.ORACLE_SQL,
}
