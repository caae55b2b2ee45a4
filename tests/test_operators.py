"""Operators on small hand-made and skewed inputs, against brute force."""

from __future__ import annotations

import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrace.functions.casts import exact_sum
from terrace.operators import joins
from terrace.operators.dedupe import duplicated_rows, first_duplicated_rows, has_duplicates, keep_first
from terrace.operators.joins import hot_keys, salted_join
from terrace.operators.keys import dense_key
from terrace.operators.profile import KeyPair, approximate_profile, key_differences, missing_members, profile
from terrace.operators.rules import AcceptedValues, Between, InSet, LengthEquals, NotNull, Relationship, Unique, evaluate
from terrace.sources.tables import materialise


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows: a third on key 0, a tenth without key, the rest spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(0)).when(n % 10 != 1, n % 400)
    return spark.range(3000).select(n.alias("row"), key.cast("long").alias("k")).cache()


# -------------------------------------------------------------------- joins


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    # Some keys are missing on the right, some are there twice, one is null.
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    right = right.unionAll(right.filter("k % 50 = 0")).unionAll(
        spark.sql("select cast(null as long) k, cast(1 as long) v")
    )
    salted = salted_join(skewed, right, "k", how, rows_per_task=100)
    expected = skewed.join(right, "k", how)
    assert salted.columns == expected.columns
    assert Counter(salted.collect()) == Counter(expected.collect())


def test_hot_keys_may_come_from_another_table(spark, skewed):
    """Whatever table they are looked up in, the result is the same."""
    right = spark.range(300).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    expected = Counter(skewed.join(right, "k", "left").collect())
    for keys_from in (skewed.filter("row % 2 = 0"), spark.range(50000).select((F.col("id") % 2).alias("k"))):
        salted = salted_join(skewed, right, "k", "left", rows_per_task=100, keys_from=keys_from)
        assert Counter(salted.collect()) == expected


def test_salted_join_on_two_keys(spark, skewed):
    left = skewed.withColumn("k2", F.col("row") % 2)
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 2).alias("k2"), F.lit(1).alias("v"))
    salted = salted_join(left, right, ["k", "k2"], "left", rows_per_task=50)
    assert Counter(salted.collect()) == Counter(left.join(right, ["k", "k2"], "left").collect())


def test_hot_keys_are_the_heavy_ones(skewed):
    found = hot_keys(skewed.filter("k is not null"), ["k"], rows_per_task=100).collect()
    heavy = skewed.filter("k is not null").groupBy("k").count().filter("count > 100")
    assert {r["k"]: r["_salts"] for r in found} == {r["k"]: -(-r["count"] // 100) for r in heavy.collect()}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_unlike_key_types_meet(spark, how):
    """One hot key, int on the left and bigint on the right; then double with both zeros."""
    left = spark.range(1000).select(F.lit(7).cast("int").alias("k"), "id")
    right = spark.createDataFrame([(7, "seven"), (8, "eight")], "k long, v string")
    assert salted_join(left, right, "k", how, rows_per_task=100).count() == left.join(right, "k", how).count()
    zeros = spark.range(500).select(F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("k"), "id")
    ints = spark.createDataFrame([(0, "zero")], "k int, v string")
    assert salted_join(zeros, ints, "k", how, rows_per_task=100).count() == zeros.join(ints, "k", how).count()


def test_more_hot_keys_than_any_cap(spark):
    left = spark.range(60_000).select((F.col("id") % 3_000).alias("k"), F.col("id").alias("row"))
    right = spark.range(3_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert hot_keys(left, ["k"], 10).count() == 3_000
    joined = salted_join(left, right, "k", "left", rows_per_task=10)
    assert joined.filter("v = 2 * k").count() == 60_000


def test_hot_keys_are_counted_once_per_join(spark, skewed, monkeypatch):
    calls = []
    real = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda *a: calls.append(a) or real(*a))
    right = spark.range(300).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = salted_join(skewed, right, "k", "left", rows_per_task=90)
    # Both sides read the stored answer; the plan counts nothing.
    assert len(calls) == 1 and "Aggregate" not in plan(joined)


def test_hot_keys_are_found_without_shuffling_keys(spark, skewed):
    """Summaries and a count of candidates: no exchange carries the keys of the table."""
    text = plan(hot_keys(skewed, ["k"], rows_per_task=100))
    assert "approx_top_k" not in text.split("Exchange hashpartitioning(k")[-1]
    exchanged = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanged) == 1 and "BroadcastHashJoin" in text  # the candidates' counts alone
    none = hot_keys(skewed, ["k"], rows_per_task=5000)
    assert none.count() == 0 and "Exchange" not in plan(none)


def test_hot_keys_are_searched_once_per_table_and_key(spark, skewed, monkeypatch):
    calls = []
    real = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda *a: calls.append(a) or real(*a))
    right = spark.range(300).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    for _ in range(3):
        salted_join(skewed, right, "k", "left", rows_per_task=70)
    salted_join(skewed.select("row", "k"), right, "k", "inner", rows_per_task=70)
    assert len(calls) == 1


def test_salting_spreads_the_hot_key(spark, skewed, monkeypatch):
    right = spark.range(400).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = salted_join(skewed, right, "k", "left", rows_per_task=50)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 1000  # the third on one key is split
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_balanced_join_salts_only_large_right_sides(spark, skewed, tmp_path, monkeypatch):
    spark.range(400).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "r"))
    right = spark.read.parquet(str(tmp_path / "r"))
    assert "hot-keys" not in plan(joins.balanced_join(skewed, right, "k"))
    monkeypatch.setattr(joins, "broadcast_limit", lambda df: 10)
    assert "hot-keys" in plan(joins.balanced_join(skewed, right, "k"))
    with pytest.raises(ValueError):
        joins.balanced_join(skewed, right, "k", "full")


def test_broadcast_limit_reads_size_suffixes(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.range(1)
    try:
        for text, size in (("10485760", 10485760), ("10485760b", 10485760), ("10MB", 10 << 20), ("1g", 1 << 30), ("-1", -1)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert joins.broadcast_limit(df) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --------------------------------------------------------------------- keys


def test_dense_key_equals_global_row_number(spark):
    names = [f"Customer#{i * 37 % 1000:06d}" for i in range(1000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int").repartition(7)
    found = {r["name"]: r["name_key"] for r in dense_key(df, "name", "name_key").collect()}
    assert found == {n: i + 1 for i, n in enumerate(sorted(names))}


def test_dense_key_with_repeated_and_missing_keys(spark):
    rows = [(5, i) for i in range(400)] + [(None, 1), (None, 2), (1, 0), (9, 0)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(5)
    found = dense_key(df, "k", "key").collect()
    assert sorted(r["key"] for r in found) == list(range(1, len(rows) + 1))
    order = [r["k"] for r in sorted(found, key=lambda r: r["key"])]
    assert order == [1] + [5] * 400 + [9, None, None]


def test_dense_key_runs_no_single_partition_window(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    text = plan(dense_key(df, "k", "key"))
    # The only global window adds up one row per range.
    assert text.count("SinglePartition") == 1 and "_size" in text


# ------------------------------------------------------------------- dedupe


def test_keep_first_in_file_order(spark):
    rows = [("c1", "x", 0), ("c2", "y", 1), ("c1", "z", 2), (None, "n", 3), (None, "m", 4)]
    df = spark.createDataFrame(rows, "id string, city string, at int").select(
        "id", "city", F.struct("at").alias("_position")
    ).repartition(3)
    kept = keep_first(df, ["id"])
    assert {(r["id"], r["city"]) for r in kept.collect()} == {("c1", "x"), ("c2", "y"), (None, "n")}
    # Every task drops all but one row per key ahead of the shuffle.
    assert "Partial" in plan(kept).split("Exchange")[1]


def test_duplicate_reports(spark):
    rows = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (3, "f"), (3, "g")]
    df = spark.createDataFrame(rows, "k int, v string")
    assert has_duplicates(df, ["k"]).first()[0] is True
    assert has_duplicates(df, ["k", "v"]).first()[0] is False
    assert Counter(duplicated_rows(df, "k").collect()) == Counter(
        r for r in df.collect() if r["v"] != "c"
    )
    top = [r["v"] for r in first_duplicated_rows(df, "k", 3, ["v"]).collect()]
    assert top == ["a", "b", "f"]
    assert [r["v"] for r in first_duplicated_rows(df, "k", 20, ["v"]).collect()] == list("abfgde")


# -------------------------------------------------------------------- rules


def verdicts(df):
    return {(r["rule"], r["column"]): (r["checked"], r["unexpected"], r["failures"], r["success"]) for r in df.collect()}


def test_row_rules_share_one_scan_and_skip_nulls(spark, tmp_path):
    rows = [("a", 1.0), ("bb", 6.0), (None, None), ("cc", -1.0)]
    spark.createDataFrame(rows, "s string, x double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    result = evaluate(df, [
        NotNull("s"), NotNull("s", mostly=0.75), InSet("s", values=("a", "bb")),
        LengthEquals("s", length=2), Between("x", low=0, high=5), Between("x", low=-1),
    ])
    assert plan(result).count("FileScan") == 1
    assert [tuple(r)[:5] + (r["success"],) for r in result.collect()] == [
        ("not_null", "s", 4, 1, 1, False),
        ("not_null", "s", 4, 1, 1, True),
        ("in_set", "s", 3, 1, 1, False),
        ("length_equals", "s", 3, 1, 1, False),
        ("between", "x", 3, 2, 2, False),
        ("between", "x", 3, 0, 0, True),
    ]


def test_not_null_with_tolerance(spark):
    n = F.col("id")
    for missing, passes in ((3, True), (4, False)):
        df = spark.range(1000).select(F.when(n >= missing, n).alias("c"))
        assert evaluate(df, [NotNull("c", mostly=0.997)]).first()["success"] is passes


def test_key_rules(spark):
    df = spark.createDataFrame(
        [(1, None), (1, "x"), (2, "x"), (None, None), (None, None), (3, "y")], "a int, b string"
    )
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    found = verdicts(evaluate(df, [
        Unique(("a",)), Unique(("a", "b")), AcceptedValues(("b",), values=("y",)),
        Relationship(("a",), parent=parent, parent_column="id"),
    ]))
    assert found == {
        ("unique", "a"): (4, 2, 1, False),
        ("compound_unique", "a,b"): (4, 0, 0, True),
        ("accepted_values", "b"): (3, 2, 1, False),
        ("relationships", "a"): (4, 1, 1, False),
    }


def test_rules_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert all(r["success"] for r in evaluate(df, [NotNull("a"), Between("a", low=0), Unique(("a",))]).collect())


def test_unreadable_number_is_out_of_range(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert verdicts(evaluate(df, [Between("a", low=0)])) == {("between", "a"): (2, 1, 1, False)}


# ---------------------------------------------------------------- profiling


def test_profile(spark):
    long = "z" * 200
    rows = [(1, "a", 0.5), (1, long, None), (2, None, 0.5), (None, long, None)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    expected = {
        ("k", "int", 3, 4, 1, 2), ("s", "string", 3, 4, 1, 2), ("x", "double", 3, 4, 2, 1),
    }
    for build in (profile, approximate_profile):
        assert {tuple(r)[1:] for r in build(df, "t").collect()} == expected
    empty = profile(df.limit(0), "t").collect()
    assert [(r["rows"], r["nulls"], r["distinct_values"]) for r in empty] == [(0, 0, 0)] * 3


def test_profile_takes_one_scan_and_one_exchange_of_values(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS a", "if(id % 2 = 0, 0.0D, -0.0D) AS z").write.parquet(f"{tmp_path}/t")
    found = profile(spark.read.parquet(f"{tmp_path}/t"), "t")
    text = plan(found)
    assert {(r["column"], r["distinct_values"]) for r in found.collect()} == {("id", 100), ("a", 3), ("z", 1)}
    assert text.count("FileScan parquet") == 1 and len(re.findall(r"Exchange hashpartitioning\(_no#\d+, _value", text)) == 1


def test_rows_of_duplicates_keep_native_keys(spark):
    zeros = spark.createDataFrame([(0.0, "a"), (-0.0, "b"), (3.0, "c"), (None, "d"), (None, "e"), (float("nan"), "f"), (float("nan"), "g")], "k double, v string")
    assert sorted(r["v"] for r in duplicated_rows(zeros, "k").collect()) == list("abdefg")
    whole = spark.createDataFrame([(2**62, 1), (2**62, 2), (2**62 + 1, 3)], "k long, v int")
    found = duplicated_rows(whole, "k")
    assert sorted(r["v"] for r in found.collect()) == [1, 2] and "cast(k" not in plan(found)


def test_sums_of_amounts_do_not_depend_on_partitions(spark):
    amounts = spark.range(5000).select((F.rand(3) * 1e6).alias("v")).cache()
    sums = {amounts.repartition(n).agg(exact_sum(F.col("v")).alias("s")).first()["s"] for n in (1, 3, 7, 16)}
    assert len(sums) == 1


def test_key_differences_treat_null_as_a_key(spark):
    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "k string")

    result = key_differences([
        KeyPair("one", keys("a", None, "a"), "k", keys("b"), "k"),
        KeyPair("two", keys("a", None), "k", keys(None, "b"), "k"),
    ])
    assert {tuple(r) for r in result.collect()} == {("one", 2, 1), ("two", 1, 1)}


def test_missing_members_match_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    known = spark.createDataFrame([("b",)], "c string")
    assert {tuple(r) for r in missing_members(df, "c", known, "c").collect()} == {("a", 2), (None, 1)}
    with_null = spark.createDataFrame([("b",), (None,)], "c string")
    assert {tuple(r) for r in missing_members(df, "c", with_null, "c").collect()} == {("a", 2)}


# ------------------------------------------------------------------- storage


def test_exchanges_go_when_a_result_is_stored(spark):
    """Many stored steps in a row must not pile up their exchanges on disk."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def exchanges():
        files = disk.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before = exchanges()
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stored = materialise(counted, "counted")
    for _ in range(50):
        if not exchanges() - before:
            break
        time.sleep(0.1)
    assert not exchanges() - before
    assert {tuple(row) for row in stored.collect()} == {(k, 100) for k in range(10)}
