"""The five stages together, each checked on its own input."""

from __future__ import annotations

import corpus_pipeline
import pytest
from compare import assert_same, duck
from pyspark.sql import functions as F
from test_dedup import groups

from terrace.llm import queries
from terrace.sources.tables import materialise

SF = "/root/testdata/sf0.001"


def test_stages_decide_on_their_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = {r["doc_id"]: r["text"] for r in docs.collect()} if "text" in docs.columns else None
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        if name != "encoding":
            assert docs.columns == columns
    out = {r["doc_id"]: r for r in docs.collect()}
    assert set(inputs["line_dedup"]) < set(inputs["quality_rules"])
    assert set(out) == set(inputs["encoding"])
    near = groups(inputs["near_dedup"].items(), 5, 80)
    assert set(inputs["decontamination"]) == {i for i, root in near.items() if i == root}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, t in inputs["decontamination"].items() if not any(x in t for x in items)}
    assert set(inputs["encoding"]) == clean
    assert all(r["n_tokens"] == len(r["token_ids"]) > 0 for r in out.values())
    assert corpus_pipeline.run(spark, SF).count() == len(out)


def test_stages_on_tricky_rows(spark, tricky, no_docs):
    rows = spark.createDataFrame(
        [(i, t, "en", None, len(t or ""), "x") for i, t in tricky], "doc_id long, text string, lang string, source string, n_chars long, stat string"
    )
    for docs in (rows, rows.limit(0)):
        kept = []
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SF), "tricky")
            kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        assert docs.columns == ["doc_id", "n_tokens", "token_ids"]
        assert all(later <= earlier for earlier, later in zip(kept, kept[1:], strict=False))
        if kept[0]:
            # No words and too few words go at once; of a text, its copies and near copies the first stays.
            assert not kept[0] & {4, 5, 6, 7, 8} and {1, 9, 12} <= kept[-1]
            assert not kept[-1] & {2, 3, 17, *range(200, 230)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, name):
    assert assert_same(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE_SQL[name]) > 0


def test_exact_copies_of_many_lines_leave_one_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.filter(F.size(F.split("text", "\n")) > 1).orderBy("doc_id").limit(40)
    copies = [base.withColumn("doc_id", F.col("doc_id") + 10_000_000 * k) for k in (1, 2)]
    planted = materialise(docs.unionByName(copies[0]).unionByName(copies[1]), "planted")
    cut = materialise(corpus_pipeline.line_dedup(spark, planted, SF), "planted-cut")
    assert cut.filter(F.col("doc_id") >= 10_000_000).count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, cut, SF).collect()} == {
        r["doc_id"] for r in corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, SF), SF).collect()
    }
