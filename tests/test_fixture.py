"""The derived raw tables: both engines make the same ones of the given data, and the dirt they should hold is there."""

import duckdb
import oracle_compare
import pytest
from oracle_compare import TESTDATA
from pyspark.sql import functions as F

from retail_fixture import RAW_TABLES, SQL, RawTables, duckdb_cte
from tillroll.plans import warehouse

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return RawTables(spark, SF_DIR)


@pytest.fixture(scope="module")
def con():
    return oracle_compare.connect(SF_DIR)


def asked(con: duckdb.DuckDBPyConnection, table: str, what: str):
    return con.execute(f"WITH {duckdb_cte(table)} SELECT {what} FROM raw_{table}").fetchall()[0]


@pytest.mark.parametrize("table", list(SQL))
def test_rows_and_distinct_rows(raw, con, table):
    rows, distinct = raw[table].count(), raw[table].distinct().count()
    assert rows == asked(con, table, "count(*)")[0] > 0
    assert distinct == con.execute(f"WITH {duckdb_cte(table)} SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{table})").fetchall()[0][0]


@pytest.mark.parametrize("table, column", [("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_value"), ("reviews", "review_score")])
def test_sums(raw, con, table, column):
    got = raw[table].agg(F.sum(column), F.count(column)).first()
    total, known = asked(con, table, f"sum({column}), count({column})")
    assert got[0] == pytest.approx(float(total), rel=1e-12) and got[1] == known


def test_every_line_is_kept(raw, con):
    """Nothing of the given lines is left out: all have an item and a review."""
    lines, marked = con.execute("SELECT count(*), count(*) FILTER (l_orderkey % 50 = 1) + 2 * count(*) FILTER (l_orderkey % 50 = 2) FROM lineitem").fetchall()[0]
    assert raw["reviews"].count() == lines
    assert raw["order_items"].count() == lines + marked


def test_the_dirt_is_there(raw):
    assert set(RAW_TABLES) == set(SQL) - {"order_text"}
    orders, items, payments = raw["orders"], raw["order_items"], raw["payments"]
    assert orders.count() > orders.select("order_id").distinct().count()
    assert items.count() > items.distinct().count() and items.filter("price < 0").count() and items.filter("price IS NULL").count()
    assert payments.filter("payment_value < 0").count() and payments.count() > payments.distinct().count()
    assert raw["reviews"].filter("review_score IS NULL").count() and raw["reviews"].filter("order_id = '-1'").count()


def test_delay(raw, con):
    row = (
        warehouse.delay_of(raw["orders"].filter("order_status = 'delivered'"))
        .agg(F.sum("delivery_delay_days"), F.sum("is_late"), F.min("delivery_delay_days"), F.max("delivery_delay_days"))
        .first()
    )
    days = "floor(date_diff('microsecond', order_estimated_delivery_date, order_delivered_customer_date) / 86400000000.0)"
    status = "FILTER (order_status = 'delivered')"
    wanted = asked(con, "orders", f"sum({days}) {status}, sum(CAST({days} > 0 AS INT)) {status}, min({days}) {status}, max({days}) {status}")
    assert tuple(row) == tuple(int(x) for x in wanted)
