"""CSV in, Parquet and catalog tables out, and the whole run."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillroll.plans import round_trip, views
from tillroll.plans import run as batch
from tillroll.schemas import RAW, WAREHOUSE, ContractError, conform
from tillroll.sources.csv_tables import read_tables
from tillroll.sources.parquet_tables import FACT_PARTITION, WriteFailure, current_paths, drop_old_versions, read_folders, write_catalog, write_folders

FILES = {
    "shop_orders_dataset.csv": """order_status,order_id,customer_id,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
delivered,o1,c1,2018-01-01 10:00:00,2018-01-01 11:00:00,,2018-01-12 00:00:00,2018-01-10 00:00:00
shipped,o2,c2,2018-02-03 10:00:00,,,,2018-02-10 00:00:00
delivered,o3,c9,bad,,,NA,2018-02-10 00:00:00
""",
    "shop_customers_dataset.csv": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01037, Sao Paulo ,sp
c2,u1,09999,RIO,RJ
""",
    "shop_order_items_dataset.csv": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-05 00:00:00,10.50,1.25
o1,1,p1,s1,2018-01-05 00:00:00,10.50,1.25
o1,2.0,p2,s1,2018-01-05 00:00:00,-3,NaN
""",
    "shop_order_payments_dataset.csv": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,11.75
o2,1,boleto,1,-1
""",
    "shop_order_reviews_dataset.csv": 'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
    'r1,o1,5,"He said ""good""","line one\nline two, with comma",2018-01-13 00:00:00,2018-01-14 00:00:00\n'
    "r2,o2,n/a,,null,2018-01-13 00:00:00,2018-01-14 00:00:00\n",
    "shop_products_dataset.csv": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,brinquedos,40,100,1,200,10,5,4
p2,,,,,,,,
""",
    "shop_sellers_dataset.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00123,Campinas,sp \n",
    "shop_geolocation_dataset.csv": "zip,lat\n01037,-23.5\n",
    "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\nbrinquedos,toys\n",
}


@pytest.fixture()
def folder(tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    for name, text in FILES.items():
        (source / name).write_text(text, encoding="utf-8")
    return source


def test_csv_is_typed_by_name_and_tolerant(spark, folder):
    raw = read_tables(spark, str(folder))
    assert set(raw) == set(RAW) | {"geo"}
    for name, schema in RAW.items():
        assert [(f.name, f.dataType) for f in raw[name].schema] == [(f.name, f.dataType) for f in schema]
    assert raw["customers"].orderBy("customer_id").first().customer_zip_code_prefix == "01037"
    orders = {r.order_id: r for r in raw["orders"].collect()}
    assert orders["o1"].order_purchase_timestamp == datetime(2018, 1, 1, 10) and orders["o1"].order_status == "delivered"
    assert orders["o3"].order_purchase_timestamp is None and orders["o3"].order_delivered_customer_date is None
    reviews = {r.review_id: r for r in raw["reviews"].collect()}
    assert reviews["r1"].review_comment_title == 'He said "good"'
    assert reviews["r1"].review_comment_message == "line one\nline two, with comma"
    assert reviews["r2"].review_score is None and reviews["r2"].review_comment_message is None
    items = raw["order_items"].collect()
    assert [i.order_item_id for i in items] == [1, 1, 2] and items[2].freight_value is None
    assert raw["category_translation"].first().product_category_name_english == "toys"
    assert raw["geo"].columns == ["zip", "lat"]


def test_optional_and_required_files(spark, folder):
    (folder / "shop_geolocation_dataset.csv").unlink()
    (folder / "product_category_name_translation.csv").unlink()
    raw = read_tables(spark, str(folder))
    assert "geo" not in raw and raw["category_translation"].isEmpty()
    (folder / "shop_orders_dataset.csv").unlink()
    with pytest.raises(FileNotFoundError, match="orders"):
        read_tables(spark, str(folder))


def test_missing_column_is_named(spark, folder):
    (folder / "shop_sellers_dataset.csv").write_text("seller_id\ns1\n")
    with pytest.raises(ValueError, match="seller_city"):
        read_tables(spark, str(folder))


def test_whole_run(spark, folder, tmp_path):
    target = str(tmp_path / "warehouse")
    for _ in range(2):  # a second run replaces the first
        tables = batch.run(spark, str(folder), target)
    assert set(tables) == set(WAREHOUSE)
    assert [(f.name, f.dataType) for f in tables["fact_orders"].schema] == [
        (f.name, f.dataType) for f in WAREHOUSE["fact_orders"]
    ]
    fact = {r.order_id: r for r in tables["fact_orders"].collect()}
    assert len(fact) == 3
    o1 = fact["o1"]
    assert (o1.delivery_delay_days, o1.is_late, o1.total_payment, o1.total_items_value, o1.total_freight) == (2.0, 1, 11.75, 10.5, 1.25)
    assert (o1.total_order_value, o1.item_count, o1.payment_type, o1.review_score) == (11.75, 2, "credit_card", 5.0)
    assert (o1.customer_city, o1.customer_state, o1.time_id) == ("sao paulo", "SP", 1)
    assert (fact["o2"].is_late, fact["o2"].total_payment, fact["o2"].time_id) == (None, None, 2)
    assert (fact["o3"].customer_unique_id, fact["o3"].time_id, fact["o3"].is_late) == (None, None, 0)
    products = {r.product_id: r for r in tables["dim_products"].collect()}
    assert products["p1"].product_category_name_english == "toys" and products["p2"].product_weight_g == 200.0
    assert products["p1"].product_name_lenght == 40

    views.register(spark, tables)
    months = spark.sql("select year, month, total_orders, revenue, late_deliveries from v_monthly_revenue").collect()
    assert [tuple(r) for r in months] == [(2018, 1, 1, 11.75, 1)]
    people = spark.sql("select customer_unique_id, customer_state, order_count from v_customer_summary").collect()
    assert {tuple(r) for r in people} == {("u1", "SP", 1), ("u1", "RJ", 1)}
    assert spark.sql("select total_orders from v_seller_performance").first()[0] == 1

    fact_path = current_paths(spark, target)["fact_orders"][1]
    month = f"{fact_path}/{FACT_PARTITION}=2018-01"
    assert spark.read.parquet(month).count() == 1
    pruned = spark.read.parquet(fact_path).filter(F.col(FACT_PARTITION) == "2018-01")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan


def test_write_skips_empty_and_goes_on_after_a_failure(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "a int")
    tables = {
        "empty": good.filter("a > 1"),
        "broken": good.select(F.raise_error(F.lit("boom")).cast("int").alias("a")),
        "good": good,
    }
    with pytest.raises(WriteFailure) as failure:
        write_folders(tables, str(tmp_path / "out"))
    assert set(failure.value.failures) == {"broken"}
    assert spark.read.parquet(current_paths(spark, str(tmp_path / "out"))["good"][1]).count() == 1
    assert not (tmp_path / "out" / "empty").exists()


def test_bucketed_catalog_tables_join_without_shuffle(spark, tmp_path):
    spark.sql(f"create database shop location '{tmp_path / 'db'}'")
    try:
        orders = spark.range(100).selectExpr("cast(id as string) order_id", "id v")
        tables = {"fact_orders": orders, "payments": orders.withColumnRenamed("v", "w")}
        assert write_catalog(tables, "shop", buckets=4) == ["fact_orders", "payments"]
        joined = spark.table("shop.fact_orders").hint("merge").join(spark.table("shop.payments"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.sql("drop database shop cascade")


def test_a_failing_table_does_not_stop_the_fact(spark, tmp_path, monkeypatch):
    from retail_fixture import raw_tables

    from tillroll.plans import clean

    def broken(raw):
        tables = whole(raw)
        return tables | {"payments": tables["payments"].withColumn("payment_value", F.raise_error(F.lit("broken")).cast("double"))}

    whole = clean.clean_tables
    monkeypatch.setattr(batch.clean, "clean_tables", broken)
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    with pytest.raises(WriteFailure) as failed:
        batch.load_warehouse(spark, raw, str(tmp_path / "w"), str(tmp_path / "s"))
    assert "payments" in failed.value.failures
    assert {"dim_time", "dim_products", "reviews", "order_items"} <= set(failed.value.written)
    assert "fact_orders" in failed.value.written or "fact_orders" in failed.value.failures


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    folder = str(tmp_path / "w")
    schema = {"t": spark.createDataFrame([], "a int").schema}
    old = spark.range(10).selectExpr("cast(id as int) a")
    assert write_folders({"t": old}, folder) == ["t"]
    # Fails in the last of many rows, when most of the new version has been written.
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("id").cast("int")).alias("a"))
    for _ in range(2):
        with pytest.raises(WriteFailure):
            write_folders({"t": broken}, folder, probes={"t": old})
        assert read_folders(spark, folder, schema)["t"].count() == 10
    reader = read_folders(spark, folder, schema)["t"]
    write_folders({"t": old.filter("a < 3")}, folder)
    assert reader.count() == 10 and read_folders(spark, folder, schema)["t"].count() == 3
    assert len(drop_old_versions(spark, folder)) == 1
    assert read_folders(spark, folder, schema)["t"].count() == 3
    with pytest.raises(FileNotFoundError, match="other"):
        read_folders(spark, folder, {"other": schema["t"]})


def test_contracts_are_held(spark, tmp_path):
    contract = spark.createDataFrame([], "a string, n bigint, x double").schema
    good = spark.createDataFrame([("k", 1, 2.0, "more")], "a string, n int, x double, y string")
    assert conform(good, contract).dtypes == [("a", "string"), ("n", "bigint"), ("x", "double")]
    for df, says in ((good.drop("a"), "a is missing"), (good.withColumn("x", F.lit("2")), "x is string, not double"), (good.withColumn("n", F.lit(1.5)), "n is double, not bigint")):
        with pytest.raises(ContractError, match=says):
            conform(df, contract)
    assert conform(good.drop("a"), contract, optional=["a"]).columns == ["n", "x"]
    write_folders({"t": good}, str(tmp_path / "c"))
    with pytest.raises(ContractError, match="t: n is int, not bigint"):
        read_folders(spark, str(tmp_path / "c"), {"t": contract})


def test_two_data_sets_in_one_folder_are_not_mixed(spark, folder):
    (folder / "other_orders_dataset.csv").write_text((folder / "shop_orders_dataset.csv").read_text())
    with pytest.raises(ValueError, match="several files"):
        read_tables(spark, str(folder))


def test_cheap_probes_spare_the_others(spark, tmp_path):
    old, none = spark.range(3), spark.range(0)
    dear = spark.range(3).filter(F.raise_error(F.lit("looked at")).isNull())
    assert write_folders({"t": old}, str(tmp_path / "a"), probes={"t": (old, dear)}) == ["t"]
    assert write_folders({"t": old}, str(tmp_path / "b"), probes={"t": (none, old)}) == ["t"]
    assert write_folders({"t": none}, str(tmp_path / "c"), probes={"t": (none, none)}) == []


def test_reviews_are_found_by_few_of_them_or_all(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "PROBED_SHARE", 1 << 40)  # no review id is among the few
    assert batch.run(spark, str(folder), str(tmp_path / "w"))["reviews"].count() > 0


def test_files_of_the_batch_run_are_compressed(spark, folder, tmp_path):
    raw = read_tables(spark, str(folder))
    round_trip.write_csv(raw, str(tmp_path / "written"))
    parts = [p for p in (tmp_path / "written").rglob("part-*")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    again = read_tables(spark, str(tmp_path / "written"))
    assert all(sorted(map(str, again[t].collect())) == sorted(map(str, raw[t].collect())) for t in again)
    batch.run(spark, str(tmp_path / "written"), str(tmp_path / "w"))
    written = [p for p in (tmp_path / "w").rglob("part-*.parquet") if "manifest" not in p.parts]
    assert written and all(".zstd." in p.name for p in written)
