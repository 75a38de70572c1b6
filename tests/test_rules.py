"""One test per rule that decides results; expected values are written out."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.functions import statistics as S
from tillroll.plans import analysis, clean, quality, views, warehouse

T0 = datetime(2018, 3, 1)


def values(df, column=None):
    return [r[column or 0] for r in df.collect()]


def test_delay_rounds_down_and_late_needs_a_full_day(spark):
    hours = [-12, 0, 12, 23, 24, 36, None]
    rows = [(str(i), "delivered", T0, None if h is None else T0 + timedelta(hours=h)) for i, h in enumerate(hours)]
    rows.append(("x", "shipped", T0, T0 + timedelta(days=9)))
    orders = spark.createDataFrame(
        rows,
        "order_id string, order_status string, order_estimated_delivery_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz",
    )
    got = {r.order_id: (r.delivery_delay_days, r.is_late) for r in warehouse.delay_of(orders).collect()}
    assert got == {
        "0": (-1, 0), "1": (0, 0), "2": (0, 0), "3": (0, 0), "4": (1, 1), "5": (1, 1), "6": (None, 0), "x": (None, None),
    }
    assert warehouse.delivery_delay(orders).count() == 7


def test_delay_of_microseconds_is_exact(spark):
    df = spark.sql(
        "select timestamp_ntz'2018-01-01 00:00:00' a, timestamp_ntz'2017-12-31 23:59:59.999999' b, "
        "timestamp_ntz'0001-01-01 00:00:00' c, timestamp_ntz'9999-12-31 00:00:00' d"
    )
    assert tuple(df.select(C.floor_days(F.col("b"), F.col("a")), C.floor_days(F.col("d"), F.col("c"))).first()) == (
        -1,
        (datetime(9999, 12, 31) - datetime(1, 1, 1)).days,
    )


def test_delay_buckets_are_right_closed(spark):
    edges = {-999: None, -8: 1, -7: 1, 0: 2, 1: 3, 3: 3, 4: 4, 7: 4, 8: 5, 14: 5, 15: 6, 999: 6, 1000: None}
    df = spark.createDataFrame([(k,) for k in edges], "d int")
    got = {r[0]: r[1] for r in df.select("d", C.bucket_number(F.col("d"), C.DELAY_EDGES)).collect()}
    assert got == edges
    labels = values(df.filter("d in (0, 1)").select(C.label_of(C.bucket_number(F.col("d"), C.DELAY_EDGES), C.DELAY_LABELS)))
    assert labels == ["Early 1-7d", "On Time"]


PAYMENT = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"


def test_payment_type_is_the_mode_and_the_lowest_on_a_tie(spark):
    rows = [
        ("tie", 1, "voucher", 1, 1.0), ("tie", 2, "boleto", 3, 2.0), ("tie", 3, "voucher", 1, 3.0), ("tie", 4, "boleto", 1, 4.0),
        ("most", 1, "voucher", 2, 1.0), ("most", 2, "voucher", 1, 1.5), ("most", 3, "boleto", 1, 1.0),
        ("none", 1, None, 1, None), (None, 1, "boleto", 1, 9.0),
    ]
    got = {r.order_id: tuple(r)[1:] for r in warehouse.payment_agg(spark.createDataFrame(rows, PAYMENT)).collect()}
    assert got == {"tie": (10.0, 3, "boleto"), "most": (3.5, 2, "voucher"), "none": (0.0, 1, None)}


def test_payments_keep_zero_and_drop_negative_null_and_copies(spark):
    rows = [("a", 1, "v", 1, 0.0), ("a", 1, "v", 1, 0.0), ("a", 2, "v", 1, -1.0), ("a", 3, "v", 1, None)]
    assert values(clean.clean_payments(spark.createDataFrame(rows, PAYMENT)), "payment_value") == [0.0]


ITEM = (
    "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp_ntz, "
    "price double, freight_value double"
)


def test_all_null_sums_are_zero_and_missing_groups_null(spark):
    items = spark.createDataFrame([("a", 1, "p", "s", None, None, 2.0), ("a", 2, "p", "s", None, None, None)], ITEM)
    assert tuple(warehouse.items_agg(items).first()) == ("a", 0.0, 2.0, 2, 2.0)


def test_negative_amounts_become_null_and_rows_stay(spark):
    items = spark.createDataFrame([("a", 1, "p", "s", None, -1.0, 2.0), ("a", 1, "p", "s", None, -1.0, 2.0)], ITEM)
    rows = clean.clean_order_items(items).collect()
    assert [(r.price, r.freight_value) for r in rows] == [(None, 2.0)]


REVIEW = "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"


def test_unanswered_review_counts_as_latest(spark):
    rows = [("r1", "o", 1, T0, T0 + timedelta(days=1)), ("r2", "o", 2, T0, None), ("r3", "o", 3, T0, T0)]
    assert values(warehouse.latest_review(spark.createDataFrame(rows, REVIEW)), "review_score") == [2.0]
    later = [r for r in rows if r[0] != "r2"] + [("r4", "o", None, T0, None)]
    assert values(warehouse.latest_review(spark.createDataFrame(later, REVIEW)), "review_score") == [1.0]


def test_review_id_shared_by_orders_stays_with_the_first(spark):
    rows = [("r", "b", 5, T0, T0), ("r", "a", 4, T0, T0), ("r", "c", 3, T0, None), ("q", "c", None, T0, T0)]
    kept = clean.clean_reviews(spark.createDataFrame(rows, REVIEW)).collect()
    assert [(r.review_id, r.order_id, r.review_score) for r in kept] == [("r", "a", 4)]


def test_median_is_over_the_whole_table(spark):
    schema = (
        "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
        "product_height_cm double, product_width_cm double"
    )
    rows = [("a", "x", 1.0, 1.0, None, None), ("b", "x", 4.0, None, None, 7.0), ("c", "y", None, 3.0, None, 9.0)]
    got = {r.product_id: tuple(r)[2:] for r in clean.impute_median(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": (1.0, 1.0, None, 8.0), "b": (4.0, 2.0, None, 7.0), "c": (2.5, 3.0, None, 9.0)}


def test_category_falls_back_to_the_original(spark):
    products = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "product_id string, product_category_name string")
    words = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    got = {r[0]: r[2] for r in clean.translate_category(products, words).collect()}
    assert got == {"1": "A", "2": "b", "3": None}


def test_strip_removes_every_white_space(spark):
    df = spark.createDataFrame([("\t são  paulo \n",)], "t string")
    assert values(df.select(C.strip(F.col("t")))) == ["são  paulo"]


def test_text_of_another_shape_is_no_timestamp(spark):
    text = ["2018-01-02 03:04:05", "2018-01-02", "bad", None, "2018-02-30 00:00:00"]
    df = spark.createDataFrame([(t,) for t in text], "t string")
    assert values(df.select(C.parse_timestamp(F.col("t")))) == [datetime(2018, 1, 2, 3, 4, 5), None, None, None, None]
    assert values(df.select(C.parse_timestamp(F.col("t"), permissive=True)))[1] == datetime(2018, 1, 2)


def test_parsing_ignores_the_session_time_zone(spark):
    # 02:30 does not exist in this zone on that day.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2018-03-11 02:30:00",)], "t string")
        assert values(df.select(C.second_text(C.parse_timestamp(F.col("t"))))) == ["2018-03-11 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (0.5,), (5.0,), (None,)], "x double")
    assert values(df.select(C.clip(F.col("x"), F.lit(0.0), F.lit(1.0)))) == [0.0, 0.5, 1.0, None]


def test_skewness_is_bias_corrected(spark):
    def skew(xs):
        return spark.createDataFrame([(float(x),) for x in xs], "x double").agg(S.skew_g1(F.col("x"))).first()[0]

    assert skew([1, 2, 3, 4, 100]) == pytest.approx(2.2323959116, abs=1e-9)
    assert skew([7, 7, 7, 7]) == 0.0
    assert skew([1, 2]) is None


@pytest.mark.parametrize("t, df, p", [(2.0, 60, 0.050033), (1.984, 100, 0.049997), (0.0, 5, 1.0), (-2.0, 60, 0.050033)])
def test_t_tail(t, df, p):
    assert S.two_sided_t_tail(t, df) == pytest.approx(p, abs=1e-6)


def test_t_tail_of_huge_samples_is_the_normal_tail():
    assert S.two_sided_t_tail(1.959963985, 10**12) == pytest.approx(0.05, abs=1e-9)
    assert S.two_sided_t_tail(None, 5) is None


ORDER = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)


def order(oid, day=0, status="delivered", cid="c", delivered=None, estimated=T0):
    return (oid, cid, status, None if day is None else T0 + timedelta(days=day), None, None, delivered, estimated)


def test_first_order_row_wins_and_null_time_comes_first(spark):
    df = spark.createDataFrame([order("a", 1), order("a", 0, "canceled"), order("b", 3), order("b", None, "shipped")], ORDER)
    assert {r.order_id: r.order_status for r in clean.clean_orders(df).collect()} == {"a": "canceled", "b": "shipped"}


def test_dim_time_lists_only_dates_that_occur(spark):
    days = [order("a", 0), order("b", 0), order("c", 2), order("d", None), order("e", 305)]
    rows = warehouse.dim_time(spark.createDataFrame(days, ORDER)).orderBy("time_id").collect()
    assert [r.time_id for r in rows] == [1, 2, 3]
    assert [(r.day_of_week, r.is_weekend, r.month_name, r.quarter) for r in rows] == [
        ("Thursday", 0, "March", 1), ("Saturday", 1, "March", 1), ("Monday", 0, "December", 4),
    ]
    assert rows[2].week_of_year == 1 and str(rows[2].date) == "2018-12-31"


def test_future_orders_depend_on_as_of(spark):
    raw = {"orders": spark.createDataFrame([order("a", 0), order("b", 10)], ORDER)}
    got = dict(map(tuple, quality.date_consistency(raw, F.lit("2018-03-05 00:00:00").cast("timestamp_ntz")).collect()))
    assert got["future_orders"] == "1" and got["max_purchase"] == "2018-03-11 00:00:00"
    assert dict(map(tuple, quality.date_consistency(raw).collect()))["future_orders"] == "0"


def test_orphans_match_null_with_null(spark):
    from tillroll.operators.joins import orphan_counts

    child = spark.createDataFrame([("a",), (None,), ("x",), ("x",)], "k string")
    with_null = spark.createDataFrame([("a",), (None,)], "k string")
    without = spark.createDataFrame([("a",)], "k string")
    assert {r.k: r.n for r in orphan_counts(child, with_null, "k").collect()} == {"x": 2}
    assert {r.k: r.n for r in orphan_counts(child, without, "k").collect()} == {"x": 2, None: 1}


def test_weekday_without_orders_is_null(spark):
    raw = {"orders": spark.createDataFrame([order("a", 0), order("b", 7)], ORDER)}
    rows = analysis.orders_by_weekday(raw).orderBy("weekday_no").collect()
    assert [(r.day_of_week, r.orders) for r in rows][2:5] == [("Wednesday", None), ("Thursday", 2), ("Friday", None)]


def test_installments_are_the_smallest_numbers(spark):
    rows = [(str(i), 1, "credit_card", i, 1.0) for i in range(1, 20)] + [("z", 1, "boleto", 0, 1.0)]
    raw = {"payments": spark.createDataFrame(rows, PAYMENT)}
    assert values(analysis.cc_installments(raw), "payment_installments") == list(range(1, 13))


def test_small_groups_give_no_test(spark):
    raw = {
        "orders": spark.createDataFrame([order(str(i), delivered=T0) for i in range(20)], ORDER),
        "reviews": spark.createDataFrame([(str(i), str(i), 1, T0, T0) for i in range(20)], REVIEW),
    }
    assert analysis.ttest_late_reviews(raw).count() == 0
    assert analysis.pearson_delay_review(raw).count() == 0


def test_no_variation_gives_null_statistics(spark):
    raw = {
        "orders": spark.createDataFrame(
            [order(str(i), delivered=T0 + timedelta(days=5 * (i % 2))) for i in range(200)], ORDER
        ),
        "reviews": spark.createDataFrame([(str(i), str(i), 4, T0, T0) for i in range(200)], REVIEW),
    }
    t = analysis.ttest_late_reviews(raw).first()
    assert (t.mean_on_time, t.mean_late, t.t_stat, t.p_value) == (4.0, 4.0, None, None)
    r = analysis.pearson_delay_review(raw).first()
    assert (r.n, r.r, r.strength) == (200, None, None)


def test_seller_view_repeats_items_per_review(spark):
    items = [("o1", 1, "p", "s", None, 10.0, 0.0), ("o1", 2, "p", "s", None, None, 0.0), ("o2", 1, "p", "s", None, 5.0, 0.0)]
    reviews = [("a", "o1", 5, T0, T0), ("b", "o1", 1, T0, T0), ("c", "o1", None, T0, T0)]
    sellers = spark.createDataFrame([("s", "SP"), ("idle", "RJ")], "seller_id string, seller_state string")
    got = {
        r.seller_id: tuple(r)[2:]
        for r in views.seller_performance(
            sellers, spark.createDataFrame(items, ITEM), spark.createDataFrame(reviews, REVIEW)
        ).collect()
    }
    assert got == {"s": (2, 35.0, 35.0 / 4, 3.0), "idle": (0, None, None, None)}


def test_bi_export_has_no_times_and_no_booleans(spark):
    df = spark.sql("select timestamp_ntz'2018-01-02 03:04:05' t, date'2018-01-02' d, true b, cast(null as timestamp_ntz) n, 1 i")
    assert tuple(warehouse.bi_export(df).first()) == ("2018-01-02 03:04:05", "2018-01-02", 1, None, 1)


@pytest.mark.parametrize("t, df, p", [(3.0, 999_999, 0.002699862541488), (3.0, 1_000_001, 0.0026998625413553), (1e6, 1, 6.366197723673692e-07)])
def test_t_tail_is_one_rule_for_every_size(t, df, p):
    assert S.two_sided_t_tail(t, df) == pytest.approx(p, rel=1e-9)


def test_t_tail_is_smooth_over_large_samples():
    below, above = S.two_sided_t_tail(20.0, 999_999), S.two_sided_t_tail(20.0, 1_000_001)
    assert above < below and above == pytest.approx(below, rel=1e-6)


def test_orphan_sample_lists_each_order_once(spark):
    orders = spark.createDataFrame([("o2", "x"), ("o1", None), ("o2", "x"), ("o3", "c")], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c",)], "customer_id string")
    sample = quality.orphan_order_sample({"orders": orders, "customers": customers})
    assert [r.order_id for r in sample.collect()] == ["o1", "o2"]
