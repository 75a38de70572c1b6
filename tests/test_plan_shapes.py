"""What the physical plans must and must not contain."""

import re

import pytest
from oracle_compare import TESTDATA

import __spark_entry__

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = {k: q for k, q in __spark_entry__.queries().items() if k in __spark_entry__._QUERIES}
WITH_P_VALUE = {"ttest_late_reviews", "pearson_delay_review"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {key: plan_of(query(spark, SF_DIR)) for key, query in QUERIES.items()}


def test_python_runs_only_for_p_values(plans):
    assert {k for k, p in plans.items() if "Python" in p or "Pandas" in p} == WITH_P_VALUE


def test_no_cartesian_product(plans):
    assert not [k for k, p in plans.items() if "CartesianProduct" in p]


def _crossed_sides(node):
    """The right sides of all joins without a key, found in the optimized plan."""
    if node.nodeName() == "Join" and node.joinType().toString() == "Cross":
        yield node.right()
    children = node.children()
    for i in range(children.size()):
        yield from _crossed_sides(children.apply(i))


def test_nested_loops_only_meet_a_one_row_frame(spark, plans):
    looping = [k for k, p in plans.items() if "BroadcastNestedLoopJoin" in p]
    assert looping
    for key in looping:
        for line in plans[key].splitlines():
            assert "NestedLoopJoin" not in line or "BuildRight, Cross" in line, (key, line)
        sides = list(_crossed_sides(QUERIES[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan()))
        assert sides and all(side.maxRows().isDefined() and side.maxRows().get() <= 1 for side in sides), key


def test_fact_joins_by_order_add_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["v_customer_summary"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", plan)
    assert len(by_order) == 3  # one each for orders, items and reviews: their own aggregation


def test_payments_are_reduced_before_they_are_shuffled(spark):
    from tillroll.plans import warehouse

    payments = spark.range(20_000).selectExpr(
        "'hot' as order_id", "cast(id as int) as payment_sequential", "if(id % 3 = 0, 'boleto', 'voucher') as payment_type",
        "1 as payment_installments", "1.0D as payment_value",
    )
    per_order = warehouse.payment_agg(payments.repartition(4))
    assert [tuple(r) for r in per_order.collect()] == [("hot", 20_000.0, 1, "voucher")]
    steps = re.findall(r"Exchange (?:hashpartitioning|RoundRobin)|HashAggregate", plan_of(warehouse.payment_agg(payments)).split("Initial Plan")[-1])
    assert steps[-2:] == ["Exchange hashpartitioning", "HashAggregate"]  # from the top: the rows meet an aggregate first


def test_unused_parts_of_the_fact_are_not_computed(spark):
    from retail_fixture import RawTables
    from tillroll.plans import clean, warehouse

    raw = RawTables(spark, SF_DIR)
    cleaned = clean.clean_tables({t: raw[t] for t in ("orders", "customers", "order_items", "payments", "reviews", "products", "sellers")})
    fact = warehouse.fact_orders(cleaned, parts=("payment", "items", "review"))
    assert "Join" not in optimized(fact.groupBy("order_status").count())


def test_scans_read_only_their_columns_and_push_filters(spark):
    raw = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    from tillroll.plans import analysis

    tables = {
        "orders": raw.selectExpr(
            "o_orderdate order_purchase_timestamp", "o_orderstatus order_status", "o_orderdate order_delivered_customer_date",
            "o_orderdate order_estimated_delivery_date", "cast(o_orderkey as string) order_id",
        )
    }
    plan = plan_of(analysis.monthly_orders(tables))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan
    plan = plan_of(analysis.late_summary(tables))
    assert "EqualTo(o_orderstatus,delivered)" in plan and "ReadSchema: struct<o_orderstatus:string,o_orderdate" in plan.replace(
        "o_orderdate:timestamp_ntz,o_orderstatus:string", "o_orderstatus:string,o_orderdate:timestamp_ntz"
    )


def test_results_do_not_depend_on_partitioning(spark):
    from retail_fixture import RAW_TABLES, RawTables
    from tillroll.plans import analysis, quality

    raw = RawTables(spark, SF_DIR)
    shuffled = {t: raw[t].repartition(7) for t in RAW_TABLES}
    for query in (quality.duplicate_check, quality.review_quality, analysis.category_avg_price, analysis.delay_stats):
        a = sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in query(raw).collect())
        b = sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in query(shuffled).collect())
        assert a == b


def _exchanged(node):
    """The columns that each exchange of a physical plan carries."""
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.initialPlan()
    if node.nodeName() == "Exchange":
        output = node.output()
        yield {output.apply(i).name() for i in range(output.size())}
    children = node.children()
    for i in range(children.size()):
        yield from _exchanged(children.apply(i))


def test_full_row_duplicates_shuffle_narrow_rows(spark):
    from tillroll.operators import profile

    wide = spark.range(100).selectExpr("id % 9 k", *[f"repeat(cast(id % 7 as string), 50 + {i}) c{i}" for i in range(8)])
    carried = list(_exchanged(profile.duplicate_check(wide, "t", "k")._jdf.queryExecution().executedPlan()))
    assert carried and not [c for columns in carried for c in columns if c.startswith("c") and c[1:].isdigit()]
    assert any("_row" in columns for columns in carried)


def test_orphans_shuffle_each_side_once(spark):
    from tillroll.operators.joins import orphan_counts

    child = spark.range(100).selectExpr("cast(id % 9 as string) as k")
    parent = spark.range(50).selectExpr("cast(id % 5 as string) as k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(orphan_counts(child, parent, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "coalesce(k" not in plan
