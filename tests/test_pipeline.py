"""The whole run over hand-made raw files, and its parts."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import random
from decimal import Decimal
from pathlib import Path

import pytest
import retail
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terrace import config
from terrace.plans import checks, gold, pipeline, silver
from terrace.plans.pipeline import Places
from terrace.session import work_folder
from terrace.sources import bronze
from terrace.sources.tables import commit, latest_load, new_attempt, publish, published, read_table, write_table


def rows(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """One complete run."""
    root = tmp_path_factory.mktemp("warehouse")
    places = Places.under(str(root / "lake"))
    raw_dir = retail.write(root / "raw")
    report = pipeline.run(
        spark, raw_dir, places, "2026-01-01", databases=("silver_external", "gold")
    )
    return places, raw_dir, report.collect()


def table(spark, finished, layer, name):
    return read_table(spark, getattr(finished[0], layer), name)


# ------------------------------------------------------------------- bronze


def test_land_copies_bytes_and_writes_manifest(spark, tmp_path):
    raw_dir = retail.write(tmp_path / "raw", sellers=None)
    done = bronze.land(spark, raw_dir, str(tmp_path / "b"), "2026-01-01")
    assert done.missing == ("sellers.csv",)
    for name, text in retail.FILES.items():
        copy = tmp_path / "b" / name.removesuffix(".csv") / "ingestion_date=2026-01-01" / name
        assert copy.exists() is (name != "sellers.csv")
        if copy.exists():
            assert copy.read_bytes() == text.encode("utf-8")
    parts = (tmp_path / "b/_manifests/ingestion_manifest/load_id=2026-01-01").glob("attempt=*/part-*.json")
    manifest = [json.loads(line) for part in parts for line in part.read_text().splitlines()]
    found = {m["table_name"]: m for m in manifest}
    assert set(found) == set(config.RAW_COLUMNS) - {"sellers"}
    reviews = found["order_reviews"]
    assert tuple(reviews) == bronze.MANIFEST_COLUMNS
    assert reviews["row_count"] == 4  # a quoted line break does not start a record
    assert reviews["file_size_bytes"] == len(retail.FILES["order_reviews.csv"].encode("utf-8"))
    assert reviews["s3_key"] == "order_reviews/ingestion_date=2026-01-01/order_reviews.csv"
    assert dt.datetime.fromisoformat(reviews["uploaded_at"]).tzinfo is not None


def test_land_again_and_on_another_day(spark, tmp_path):
    sources = {"sellers": config.Source("sellers", "sellers.csv")}
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    target = str(tmp_path / "b")
    for day, ids in (("2026-01-01", "ab"), ("2026-01-01", "c"), ("2026-02-01", "de")):
        raw = retail.write(tmp_path / "raw", sellers=header + "".join(f"{i},1,x,SP\n" for i in ids))
        bronze.land(spark, raw, target, day, sources)
    assert rows(bronze.read_load(spark, target, sources["sellers"]), "seller_id") == {("d",), ("e",)}
    first = spark.read.csv(f"{target}/sellers/ingestion_date=2026-01-01", header=True)
    assert rows(first, "seller_id") == {("c",)}


def test_land_keeps_equal_names_apart_and_drops_what_left_the_feed(spark, tmp_path):
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    raw, target = tmp_path / "raw", str(tmp_path / "b")
    source = config.Source("sellers", "*/part-*.csv")
    for folder, name, seller in (("a", "part-0.csv", "s1"), ("b", "part-0.csv", "s2")):
        (raw / folder).mkdir(parents=True)
        (raw / folder / name).write_text(header + f"{seller},1,x,SP\n")
    done = bronze.land(spark, str(raw), target, "2026-01-01", {"sellers": source})
    assert rows(done.manifest, "s3_key", "row_count") == {
        ("sellers/ingestion_date=2026-01-01/a/part-0.csv", 1), ("sellers/ingestion_date=2026-01-01/b/part-0.csv", 1),
    }
    assert rows(bronze.read_load(spark, target, source), "seller_id") == {("s1",), ("s2",)}

    (raw / "a/part-0.csv").unlink()
    (raw / "b/part-0.csv").rename(raw / "b/part-9.csv")
    done = bronze.land(spark, str(raw), target, "2026-01-01", {"sellers": source})
    assert rows(done.manifest, "row_count") == {(1,)}
    assert rows(bronze.read_load(spark, target, source), "seller_id") == {("s2",)}


@pytest.mark.parametrize("cut_bytes", [64, 1 << 20])
def test_packed_files_are_copied_as_they_are_and_read_whole(spark, tmp_path, cut_bytes):
    """A load of packed and plain files, the plain one large enough to be cut: order and quoted breaks as in the files."""
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    raw, target = tmp_path / "raw", str(tmp_path / "b")
    raw.mkdir()
    texts = {f"part-{n}.csv{ending}": header + "".join(f'{n}{i},1,"a\n{"b" * (i % 40)}""",SP\n' for i in range(60))
             for n, ending in enumerate((".gz", "", ".gz"))}
    for name, text in texts.items():
        (raw / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    source = config.Source("sellers", "part-*")
    done = bronze.land(spark, str(raw), target, "2026-01-01", {"sellers": source})
    for name in texts:
        assert (tmp_path / "b/sellers/ingestion_date=2026-01-01" / name).read_bytes() == (raw / name).read_bytes()
    assert rows(done.manifest, "source_file", "row_count", "file_size_bytes") == {(n, 60, (raw / n).stat().st_size) for n in texts}
    read = bronze.read_load(spark, target, source, cut_bytes=cut_bytes).orderBy(config.POSITION)
    assert [(r["seller_id"], r["seller_city"]) for r in read.collect()] == [
        (f"{n}{i}", f'a\n{"b" * (i % 40)}"') for n in range(3) for i in range(60)
    ]


def test_a_run_leaves_no_copies_of_the_raw_text_behind(spark, tmp_path, monkeypatch):
    """Neither parsed tables nor cut pieces, whether the gate refuses the load or not; a consumed feed goes too."""
    monkeypatch.setattr(bronze.read_load, "__defaults__", (None, 600, ""))
    kept = lambda: {str(p) for p in Path(work_folder(spark)).rglob("*") if p.name.startswith(("raw-", "cuts-", "parsed-"))}
    before, places = kept(), Places.under(str(tmp_path / "lake"))
    bad = retail.write(tmp_path / "bad", customers=retail.FILES["customers.csv"].replace(",SP", ",SPX"))
    with pytest.raises(checks.DataQualityError):
        pipeline.run(spark, bad, places, "2026-01-01")
    assert kept() == before and Path(bad).exists()

    def stopped(*_):
        assert kept() == before
        raise InterruptedError

    monkeypatch.setattr(pipeline, "build_gold", stopped)
    raw = retail.write(tmp_path / "raw")
    with pytest.raises(InterruptedError):
        pipeline.run(spark, raw, places, "2026-01-02", consume=True)
    assert not Path(raw).exists() and read_table(spark, places.silver, "sellers").count() == 2


def test_a_run_for_an_older_date_reads_that_date(spark, tmp_path):
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    places = Places.under(str(tmp_path / "lake"))
    for day, n in (("2026-02-01", 3), ("2026-01-01", 1)):
        raw = retail.write(tmp_path / day, order_payments=header + "".join(f"o1,{i + 1},voucher,1,5.0\n" for i in range(n)))
        report = pipeline.run(spark, raw, places, day)
        assert ("bronze", "order_payments", "load_date", int(day.replace("-", ""))) in rows(report, "step", "subject", "metric", "value")
        for root, table in ((places.silver, "order_payments"), (places.gold, "fact_payments")):
            assert spark.read.parquet(f"{root}/{table}/load_id={day}").count() == n


def test_land_many_files_of_one_entity(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    for i in range(3):
        (raw / f"sellers part+{i}.csv").write_text(header + f"s{i},1,x,SP\n" * (i + 1))
    sources = {"sellers": config.Source("sellers", "sellers part*.csv")}
    done = bronze.land(spark, str(raw), str(tmp_path / "b"), "2026-01-01", sources)
    assert rows(done.manifest, "source_file", "row_count") == {(f"sellers part+{i}.csv", i + 1) for i in range(3)}
    assert bronze.read_load(spark, str(tmp_path / "b"), sources["sellers"]).count() == 6


def test_land_without_any_file(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    done = bronze.land(spark, str(tmp_path / "raw"), str(tmp_path / "b"), "2026-01-01")
    assert done.landed == () and len(done.missing) == 9 and done.manifest.count() == 0
    with pytest.raises(FileNotFoundError):
        bronze.land(spark, str(tmp_path / "nowhere"), str(tmp_path / "b"), "2026-01-01")


def test_latest_load_has_one_clear_error(spark, tmp_path):
    source = config.Source("sellers", "sellers.csv")
    with pytest.raises(FileNotFoundError):
        bronze.read_load(spark, str(tmp_path), source)
    (tmp_path / "sellers/ingestion_date=2026-01-01").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        bronze.read_load(spark, str(tmp_path), source)


def test_raw_reader_keeps_text_and_finds_missing_values(spark, tmp_path):
    header = retail.FILES["order_reviews.csv"].splitlines()[0] + "\n"
    text = header + 'r1,007,1,NA,"a\nb ""c""",null,""\n,o2,2,"N/A",x,y,z\n'
    raw = retail.write(tmp_path / "raw", order_reviews=text)
    sources = {"order_reviews": config.Source("order_reviews", "order_reviews.csv")}
    bronze.land(spark, raw, str(tmp_path / "b"), "2026-01-01", sources)
    df = bronze.read_load(spark, str(tmp_path / "b"), sources["order_reviews"])
    assert rows(df.drop("_position")) == {
        ("r1", "007", "1", None, 'a\nb "c"', None, None), (None, "o2", "2", None, "x", "y", "z"),
    }


def test_reader_rejects_a_header_in_another_order(spark, tmp_path):
    raw = retail.write(tmp_path / "raw", category_translation=(
        "product_category_name_english,product_category_name\nperfumery,perfumaria\n"
    ))
    source = config.sources()["category_translation"]
    bronze.land(spark, raw, str(tmp_path / "b"), "2026-01-01", {"category_translation": source})
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        bronze.read_load(spark, str(tmp_path / "b"), source).collect()


def test_keep_first_follows_file_order(spark, tmp_path):
    """Many rows per key: the first record of the file wins."""
    lines = "".join(f"c{i % 7},u,1,city{i},SP\n" for i in range(500))
    raw = retail.write(tmp_path / "raw", customers=retail.FILES["customers.csv"].splitlines()[0] + "\n" + lines)
    for multi_line in (True, False):
        source = config.Source("customers", "customers.csv", multi_line)
        target = str(tmp_path / f"b{multi_line}")
        bronze.land(spark, raw, target, "2026-01-01", {"customers": source})
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        try:
            found = silver.customers(bronze.read_load(spark, target, source))
            assert rows(found, "customer_id", "customer_city") == {(f"c{i}", f"city{i}") for i in range(7)}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


# ------------------------------------------------------------------- silver


def test_silver_customers_and_sellers(spark, finished):
    assert rows(table(spark, finished, "silver", "customers"), "customer_id", "customer_zip_code_prefix", "customer_city", "customer_state") == {
        ("c1", "01037", "sao paulo", "SP"), ("c2", "01037", "sao paulo", "SP"),
        ("c3", "00200", "niteroi", "RJ"), ("c4", "01037", "sao paulo", "SP"),
        ("c5", "00200", "niteroi", "RJ"), ("c6", "99999", "rio, centro", "RJ"),
    }
    assert rows(table(spark, finished, "silver", "sellers")) == {
        ("s1", "01037", "sao joao d'oeste", "SC"), ("s2", "123456", "osasco", "SP"),
    }


def test_silver_geolocation(spark, finished):
    found = {r[0]: tuple(r)[1:] for r in table(spark, finished, "silver", "geolocation").collect()}
    assert set(found) == {"01037", "00200"}
    assert found["01037"] == (pytest.approx(-23.6), pytest.approx(-46.5), "sao paulo", "SP")
    assert found["00200"] == (-14.0, -53.0, "a", "XX")


def test_geolocation_mode_skips_nulls_and_keeps_hot_zip_whole(spark):
    data = [("1", "0", "-40", None, "SP")] * 50 + [("1", "1", "-41", "b", None)] * 3 + [("1", "2", "-42", "a", "RJ")] * 3
    data += [("2", "0", "-40", None, None), (None, "0", "-40", "n", "NN"), ("3", None, "-40", "x", "XX")]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in config.RAW_COLUMNS["geolocation"]))
    found = {r[0]: tuple(r)[1:] for r in silver.geolocation(df).collect()}
    assert found == {
        "00001": (pytest.approx(9 / 56), pytest.approx(-(2000 + 123 + 126) / 56), "a", "SP"),
        "00002": (0.0, -40.0, None, None),
        None: (0.0, -40.0, "n", "NN"),
    }


def test_silver_orders(spark, finished):
    found = rows(table(spark, finished, "silver", "orders"), "order_id", "order_status", "is_delivered", "delivery_delay_days", "order_delivered_carrier_date")
    assert found == {
        ("o1", "delivered", True, -1, None), ("o2", "delivered", True, 0, dt.datetime(2018, 1, 3)),
        ("o3", "shipped", False, None, None), ("o4", "delivered", True, 1, dt.datetime(2018, 2, 4)),
    }


def test_silver_status_without_value(spark):
    df = spark.createDataFrame([(" Delivered",), ("SHIPPED",), (None,)], "order_status string")
    for c in config.RAW_COLUMNS["orders"]:
        if c != "order_status":
            df = df.selectExpr("*", f"cast(null as string) {c}")
    assert rows(silver.orders(df), "order_status", "is_delivered") == {
        ("delivered", True), ("shipped", False), (None, False),
    }


def test_silver_payments_items_reviews_types(spark, finished):
    payments = table(spark, finished, "silver", "order_payments")
    assert ("o1", "1", "credit_card", 2, 10.0) in rows(payments)
    items = table(spark, finished, "silver", "order_items")
    assert dict(items.dtypes)["shipping_limit_date"] == "timestamp_ntz"
    assert ("o2", "p3", None, 30.25) in rows(items, "order_id", "product_id", "shipping_limit_date", "price")
    reviews = table(spark, finished, "silver", "order_reviews")
    assert rows(reviews, "review_id", "review_score", "review_comment_title", "review_comment_message") >= {
        ("r1", 4, None, 'two\nlines, "quoted"'), ("r2", 5, None, None),
    }


def test_silver_products_fall_back(spark, finished):
    assert rows(table(spark, finished, "silver", "products"), "product_id", "product_category_name", "product_category_name_english", "product_photos_qty") == {
        ("p1", "perfumaria", "perfumery", 1.0), ("p2", "pc_gamer", "pc_gamer", 1.0), ("p3", "unknown", "unknown", None),
    }


def test_missing_installments_stop_the_job(spark):
    df = spark.createDataFrame([("o", "1", "x", None, "1")], ", ".join(f"{c} string" for c in config.RAW_COLUMNS["order_payments"]))
    with pytest.raises(PySparkException, match="payment_installments must be a number"):
        silver.order_payments(df).collect()


# --------------------------------------------------------------------- gold


def test_dim_customers_representative_address(spark, finished):
    found = rows(table(spark, finished, "gold", "dim_customers"), "customer_key", "customer_unique_id", "customer_zip_code_prefix", "customer_state")
    assert found == {(1, "u1", "01037", "SP"), (2, "u2", "00200", "RJ"), (3, "u3", "99999", "RJ")}
    nowhere = table(spark, finished, "gold", "dim_customers").filter("customer_key = 3").first()
    assert nowhere["latitude"] is None


def test_fact_orders_rolls_up_without_fan_out(spark, finished):
    found = {r["order_id"]: r for r in table(spark, finished, "gold", "fact_orders").collect()}
    one, three = found["o1"], found["o3"]
    assert len(found) == 4
    assert (one["total_payment_value"], one["payment_method_count"], one["avg_review_score"], one["review_count"]) == (15.5, 2, Decimal("4.67"), 3)
    assert (three["total_payment_value"], three["payment_method_count"], three["avg_review_score"], three["review_count"]) == (0, 0, None, 0)
    assert (three["delivery_date_key"], three["carrier_date_key"], one["purchase_date_key"]) == (-1, -1, 20180101)
    assert [found[o]["customer_key"] for o in ("o1", "o2", "o3", "o4")] == [1, 1, 2, 3]


def test_fact_order_items_keys(spark, finished):
    found = rows(table(spark, finished, "gold", "fact_order_items"), "order_id", "order_item_id", "product_key", "seller_key", "customer_key", "shipping_limit_date_key")
    assert found == {
        ("o1", "1", 1, 1, 1, 20180105), ("o1", "2", 2, 1, 1, 20180105),
        ("o2", "1", 3, 2, 1, -1), ("o4", "1", None, 1, 3, 20180205),
    }


def test_items_without_an_order_are_dropped(spark, finished):
    places = finished[0]
    items = read_table(spark, places.silver, "order_items")
    orphan = items.limit(1).selectExpr("'zz' as order_id", *[c for c in items.columns if c != "order_id"])
    fact = gold.fact_order_items(
        items.unionByName(orphan), read_table(spark, places.gold, "fact_orders"),
        read_table(spark, places.gold, "dim_products"), read_table(spark, places.gold, "dim_sellers"),
    )
    assert rows(fact, "order_id", "product_key") == {("o1", 1), ("o1", 2), ("o2", 3), ("o4", None)}


def _last_join_input(df) -> set[str]:
    """Names of the columns that enter the last join of a plan from the left."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    names = node.left().output()
    return {names.apply(i).name() for i in range(names.size())}


def test_facts_move_keys_instead_of_ids_and_moments(spark, finished):
    places = finished[0]
    silver_of = {t: read_table(spark, places.silver, t) for t in config.SILVER_TABLES}
    gold_of = {t: read_table(spark, places.gold, t) for t in config.GOLD_TABLES}
    lines = gold.fact_order_items(
        silver_of["order_items"], gold_of["fact_orders"], gold_of["dim_products"], gold_of["dim_sellers"]
    )
    assert not _last_join_input(lines) & {"product_id", "seller_id", "shipping_limit_date"}
    bridge = gold.customer_bridge(silver_of["customers"], gold_of["dim_customers"])
    orders = gold.fact_orders(silver_of["orders"], silver_of["order_payments"], silver_of["order_reviews"], bridge)
    assert not _last_join_input(orders) & {"customer_id", *config.ORDER_DATE_COLUMNS}
    assert rows(lines) == rows(gold_of["fact_order_items"]) and rows(orders) == rows(gold_of["fact_orders"])


def test_default_calendar(spark):
    days = {r["date_key"]: r for r in gold.dim_date(gold.fixed_days(spark)).collect()}
    assert len(days) == 1201 and max(days) == 20190414
    parts = ("day_of_week", "week_of_year", "day_of_year", "is_weekend", "day_name", "month_name")
    assert tuple(days[20160101][p] for p in parts) == (5, 53, 1, False, "Friday", "January")
    assert tuple(days[20160103][p] for p in parts) == (0, 53, 3, True, "Sunday", "January")
    assert tuple(days[20190414][p] for p in parts) == (0, 15, 104, True, "Sunday", "April")
    assert tuple(days[-1][p] for p in parts) == (None, None, None, None, "Unknown", "Unknown")
    assert days[-1]["full_date"] is None


def test_fact_reviews_and_payments(spark, finished):
    assert ("r2", "o1", 20180112, -1, 5) in rows(table(spark, finished, "gold", "fact_reviews"))
    assert table(spark, finished, "gold", "fact_payments").count() == 3


# -------------------------------------------------------------- whole runs


def test_report_counts_every_step(finished):
    found = {(r["step"], r["subject"], r["metric"]): r["value"] for r in finished[2]}
    assert found["bronze", "order_reviews", "rows"] == 4
    assert found["silver", "geolocation", "rows_in"] == 6
    assert found["silver", "geolocation", "out_of_range"] == 1
    assert found["silver", "geolocation", "rows"] == 2
    assert found["silver", "customers", "duplicates_dropped"] == 0
    assert found["silver", "products", "category_filled"] == 1
    assert found["silver", "products", "untranslated"] == 2
    assert found["gold", "fact_orders", "rows"] == 4
    assert sum(k[0] == "gate" and k[2] == "success" for k in found) == 19
    assert sum(k[0] == "tests" and k[2] == "success" for k in found) == 25
    assert {r["load_id"] for r in finished[2]} == {"2026-01-01"}


def test_published_tables_are_the_files(spark, finished):
    assert spark.table("silver_external.orders").count() == 4
    assert spark.sql("select count(*) from gold.fact_order_items").first()[0] == 4


def test_running_a_date_again_changes_nothing(spark, finished):
    places, raw_dir, _ = finished
    before = rows(read_table(spark, places.gold, "fact_orders"))
    pipeline.run(spark, raw_dir, places, "2026-01-01")
    assert rows(read_table(spark, places.gold, "fact_orders")) == before
    assert "/fact_orders/load_id=2026-01-01/attempt=" in latest_load(spark, places.gold, "fact_orders")


def test_gate_stops_before_silver(spark, tmp_path):
    bad = retail.FILES["orders.csv"].replace("o3,c5,shipped", "o3,c5,teleported")
    places = Places.under(str(tmp_path / "lake"))
    with pytest.raises(checks.DataQualityError, match="orders.order_status in_set"):
        pipeline.run(spark, retail.write(tmp_path / "raw", orders=bad), places, "2026-01-01")
    assert not (tmp_path / "lake/silver").exists()
    log = pipeline.run_log(spark, places)
    assert log.filter("step = 'gate' and metric = 'success' and value = 0").count() == 1


def broken(spark, rows: int):
    """A table whose last task fails after the others wrote their files."""
    fails = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("killed"))).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 4).select(fails.alias("id"))


def test_a_failed_rerun_leaves_the_load_in_service(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(3), root, "t", "2026-01-01")
    with pytest.raises(PySparkException, match="killed"):
        write_table(broken(spark, 8), root, "t", "2026-01-01")
    assert read_table(spark, root, "t").count() == 3
    with pytest.raises(PySparkException, match="killed"):
        write_table(broken(spark, 8), root, "t", "2026-01-02")
    assert read_table(spark, root, "t").count() == 3
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "other")


def test_readers_keep_their_files_while_a_load_is_replaced(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(3), root, "t", "d1")
    before = read_table(spark, root, "t")
    write_table(spark.range(5), root, "t", "d1")
    assert before.count() == 3 and read_table(spark, root, "t").count() == 5
    # Two writers of one load: both files are whole, the later commit is served.
    attempts = [new_attempt(f"{root}/t/load_id=d1") for _ in range(2)]
    for n, path in zip((7, 9), attempts, strict=True):
        spark.range(n).write.parquet(path)
    for path in reversed(attempts):
        commit(spark, path)
    assert read_table(spark, root, "t").count() == 7
    assert len(list((tmp_path / "t/load_id=d1").glob("attempt=*"))) == 2  # the current one and the one before
    write_table(spark.range(1), root, "t", "d0")
    assert read_table(spark, root, "t", until="d0").count() == 1 and read_table(spark, root, "t").count() == 7


# ------------------------------------------------------- landing without loss


def test_a_source_that_left_the_feed_leaves_the_date(spark, tmp_path):
    sources = {e: config.sources()[e] for e in ("sellers", "order_payments")}
    target = str(tmp_path / "b")
    raw = retail.write(tmp_path / "raw")
    bronze.land(spark, raw, target, "2026-01-01", sources)
    (tmp_path / "raw/sellers.csv").unlink()
    (tmp_path / "b/sellers/ingestion_date=2026-01-01/_sellers.csv.lost").write_text("half a co")
    done = bronze.land(spark, raw, target, "2026-01-01", sources)
    assert done.landed == ("order_payments",) and done.missing == ("sellers.csv",)
    assert not list((tmp_path / "b/sellers").rglob("*.csv*"))
    with pytest.raises(FileNotFoundError):
        bronze.read_load(spark, target, sources["sellers"])
    (tmp_path / "raw/order_payments.csv").unlink()
    done = bronze.land(spark, raw, target, "2026-01-01", sources)
    assert done.landed == () and bronze.read_manifest(spark, target, "2026-01-01").count() == 0
    assert not list((tmp_path / "b/order_payments").rglob("*.csv"))


@pytest.mark.parametrize("cut_bytes", [64, 700, 5000])
def test_a_file_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path, cut_bytes):
    """Cut anywhere, the pieces hold the records of the whole file, in order."""
    rng = random.Random(cut_bytes)
    header = ",".join(config.RAW_COLUMNS["order_reviews"]) + "\n"

    def field() -> str:
        text = "".join(rng.choice(["a", "é", ",", '"', "\n", "\r\n", " "]) for _ in range(rng.randint(0, 30)))
        return '"' + text.replace('"', '""') + '"'

    text = header + "".join(f"r{i},o{i},{i % 5 + 1},{field()},{field()},,x\n" for i in range(300))
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "order_reviews.csv").write_bytes(text.encode())
    sources = {"order_reviews": config.sources()["order_reviews"]}
    target = str(tmp_path / "b")
    done = bronze.land(spark, str(raw), target, "2026-01-01", sources)
    assert done.manifest.first()["row_count"] == 300
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        whole = bronze.read_load(spark, target, sources["order_reviews"])
        cut = bronze.read_load(spark, target, sources["order_reviews"], cut_bytes=cut_bytes)
        assert whole.select(F.spark_partition_id()).distinct().count() == 1
        assert cut.select(F.spark_partition_id()).distinct().count() > 2
        order = config.POSITION
        assert [tuple(r)[:-1] for r in cut.orderBy(order).collect()] == [tuple(r)[:-1] for r in whole.orderBy(order).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # A stray quote: the file stays whole.
    (raw / "order_reviews.csv").write_bytes(text.encode() + b'r9,o9,1,5" disk,x,,\n')
    bronze.land(spark, str(raw), target, "2026-01-01", sources)
    rows_ = [bronze.read_load(spark, target, sources["order_reviews"], cut_bytes=n).drop(order) for n in (cut_bytes, 1 << 20)]
    assert rows(rows_[0]) == rows(rows_[1])


# ------------------------------------------------------------- run ledger


def test_a_run_goes_on_after_its_last_good_step(spark, tmp_path, monkeypatch):
    places, raw = Places.under(str(tmp_path / "lake")), retail.write(tmp_path / "raw")
    calls = []
    for name in ("build_silver", "build_gold"):
        real = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, _real=real, _name=name: calls.append(_name) or _real(*a))
    landing = bronze.land
    monkeypatch.setattr(bronze, "land", lambda *a: calls.append("land") or landing(*a))
    results = checks.model_results
    monkeypatch.setattr(checks, "model_results", lambda gold: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.run(spark, raw, places, "2026-01-01")
    monkeypatch.setattr(checks, "model_results", results)
    whole = rows(pipeline.run(spark, raw, places, "2026-01-01", resume=True), "step", "subject", "metric", "value")
    assert calls == ["land", "build_silver", "build_gold"]
    assert {r[0] for r in whole} == {"bronze", "gate", "silver", "gold", "tests", "calendar"}
    # Another run from the start records its steps anew; nothing recorded before counts after it.
    calls.clear()
    again = rows(pipeline.run(spark, raw, places, "2026-01-01"), "step", "subject", "metric", "value")
    assert calls == ["land", "build_silver", "build_gold"] and again == whole


def test_metrics_of_every_transform(finished):
    found = {(r["subject"], r["metric"]): r["value"] for r in finished[2] if r["step"] == "silver"}
    for name in config.SILVER_TABLES:
        assert {f"nulls_in.{c}" for c in config.RAW_COLUMNS[name]} <= {m for t, m in found if t == name}
        assert found[name, "rows_in"] >= found[name, "rows"] > 0
    assert found["customers", "changed.customer_city"] == 5 and found["customers", "changed.customer_zip_code_prefix"] == 4
    assert found["products", "nulls_in.product_category_name"] == 1 and found["products", "nulls.product_category_name"] == 0
    assert found["orders", "unparsed"] == 2 and found["order_items", "unparsed"] == 1


def test_moments_follow_the_form_of_their_column(spark, tmp_path):
    header = ",".join(config.RAW_COLUMNS["order_items"]) + "\n"
    text = header + "".join(f"o{i},1,p,s,{m},1,1\n" for i, m in enumerate(["", "2018-01-05T10:00:00", "2018-01-06 10:00:00", "2018-01-07"]))
    raw = retail.write(tmp_path / "raw", order_items=text)
    places = Places.under(str(tmp_path / "lake"))
    sources = config.sources()
    bronze.land(spark, raw, places.bronze, "2026-01-01", sources)
    tables, forms = pipeline.parsed_raw(spark, places, sources)
    assert forms["shipping_limit_date"] == "t_seconds" and forms["order_purchase_timestamp"] == "seconds"
    assert forms["order_delivered_carrier_date"] is None
    found = rows(silver.order_items(tables["order_items"], forms), "order_id", "shipping_limit_date")
    assert found == {("o0", None), ("o1", dt.datetime(2018, 1, 5, 10)), ("o2", None), ("o3", None)}


# --------------------------------------------------------------- catalogue


def test_readers_of_a_snapshot_see_one_load_while_the_next_is_published(spark, tmp_path, monkeypatch):
    root, names = str(tmp_path), ("a", "b")
    for name in names:
        write_table(spark.range(1), root, name, "d1")
    first = publish(spark, "shelf", root, names)
    assert published(spark, "shelf") == first
    for name in names:
        write_table(spark.range(2), root, name, "d2")
    seen = []
    real = type(spark).sql

    def watched(self, text, *args, **kwargs):
        now = published(self, "shelf") if text.startswith(("CREATE", "ALTER")) else None
        if now:
            seen.append(tuple(self.table(f"{now}.{name}").count() for name in names))
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", watched)
    second = publish(spark, "shelf", root, names)
    monkeypatch.undo()
    assert set(seen) == {(1, 1), (2, 2)}  # never one table of each load
    assert published(spark, "shelf") == second != first
    assert spark.table(f"{first}.a").count() == 1 and spark.table("shelf.a").count() == 2
    publish(spark, "shelf", root, names, "d1")
    assert spark.table("shelf.b").count() == 1 and not spark.catalog.databaseExists(first)
