"""Generic operators against brute force on small frames."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions.columns import digestible, row_digest
from tillroll.operators import dedup, profile
from tillroll.operators.dedup import keep_first
from tillroll.operators.histogram import histogram
from tillroll.operators.joins import hot_keys, repeat_copies, right_skew_join, skew_join, split_copies
from tillroll.operators.moments import correlation_matrix, correlations, pearson, pooled_t
from tillroll.operators.presence import Reference, broken_references, key_presence
from tillroll.operators.quantiles import capped_summary, quantile_row, quantiles

P = (0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


def column(spark, xs, kind="double"):
    return spark.createDataFrame([(x,) for x in xs], f"x {kind}")


DRAWS = {
    "spread": [random.Random(1).uniform(-1e6, 1e6) for _ in range(997)],
    "heavy tail": [math.exp(random.Random(i).gauss(0, 12)) for i in range(500)],
    "tiny": [random.Random(i).uniform(-1, 1) * 1e-300 for i in range(300)] + [5e-324, -5e-324, 0.0],
    "one value": [42.5] * 100,
    "one hot value": [7.0] * 400 + [float(i) for i in range(200)],
    "close together": [1000.0 + i * 2**-40 for i in range(300)],
    "two": [1.0, 2.0],
    "single": [3.0],
}


@pytest.mark.parametrize("name", list(DRAWS))
def test_quantiles_are_exact(spark, name):
    xs = DRAWS[name]
    got = {r.p: r.value for r in quantiles(column(spark, xs).repartition(5), ["x"], P).collect()}
    for p in P:
        assert got[p] == pytest.approx(float(np.quantile(xs, p)), rel=1e-12, abs=1e-310)


def test_quantiles_of_whole_numbers_and_several_columns(spark):
    rng = random.Random(3)
    rows = [(rng.randint(-70_000, 70_000), rng.random() if i % 3 else None) for i in range(800)]
    df = spark.createDataFrame(rows, "a int, b double")
    ints = {r.p: r.value for r in quantiles(df, ["a"], P).collect()}
    both = {(r.column_name, r.p): r.value for r in quantiles(df, ["a", "b"], P).collect()}
    a, b = [r[0] for r in rows], [r[1] for r in rows if r[1] is not None]
    for p in P:
        assert ints[p] == both["a", p] == pytest.approx(np.quantile(a, p))
        assert both["b", p] == pytest.approx(np.quantile(b, p))


def test_quantiles_ignore_null_and_nan_and_give_one_row_anyway(spark):
    df = column(spark, [1.0, None, float("nan"), 2.0])
    assert quantile_row(df, {"m": ("x", 0.5)}).collect()[0].m == 1.5
    assert [tuple(r) for r in quantile_row(column(spark, [None]), {"m": ("x", 0.5)}).collect()] == [(None,)]


@pytest.mark.parametrize(
    "xs", [DRAWS["spread"], [float(i) for i in range(-28, 41)], [5.0, 5.0], [0.1 * i for i in range(61)], [1.0, 2.0]]
)
def test_histogram_matches_numpy(spark, xs):
    rows = histogram(column(spark, xs), "x", 60).orderBy("bin_no").collect()
    counts, edges = np.histogram(xs, bins=60)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.lo for r in rows] == pytest.approx(edges[:-1].tolist()) and rows[-1].hi == edges[-1]


def test_histogram_of_nothing_lists_empty_bins(spark):
    rows = histogram(column(spark, [None]), "x", 4).collect()
    assert [(r.lo, r.hi, r.n) for r in rows] == [(0.0, 0.25, 0), (0.25, 0.5, 0), (0.5, 0.75, 0), (0.75, 1.0, 0)]


def test_keep_first_follows_the_declared_order(spark):
    rows = [("k", 2, "b"), ("k", None, "c"), ("k", 2, "a"), ("l", 1, None), ("l", 1, "z"), (None, 9, "n")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert {tuple(r) for r in keep_first(df, "k", ["o"]).collect()} == {("k", None, "c"), ("l", 1, None), (None, 9, "n")}
    last = keep_first(df, "k", ["o"], nulls_last=["o"], copies="n")
    assert {tuple(r) for r in last.collect()} == {("k", 2, "a", 3), ("l", 1, None, 2), (None, 9, "n", 1)}
    assert last.columns == ["k", "o", "v", "n"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_one(spark, how):
    rng = random.Random(5)
    left = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", "gone", None])) for i in range(900)]
    right = [("hot", 1), ("a", 2), ("b", 3), ("b", 4), ("unused", 5), (None, 6)]
    l_df = spark.createDataFrame(left, "i int, k string")
    r_df = spark.createDataFrame(right, "k string, v int")
    salted = skew_join(l_df, r_df, "k", "i", how, rows_per_salt=20)
    plain = l_df.join(r_df, "k", how)
    assert sorted(map(str, salted.select("k", "i", "v").collect())) == sorted(map(str, plain.select("k", "i", "v").collect()))


def test_hot_keys_get_salts_by_size(spark):
    df = spark.createDataFrame([("h",)] * 100 + [("m",)] * 30 + [("c",)] * 5 + [(None,)] * 50, "k string")
    assert {r[0]: r[1] for r in hot_keys(df, "k", 20).collect()} == {"h": 6, "m": 2}


def test_salts_spread_a_hot_key_over_tasks(spark):
    left = spark.range(3000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(left, right, "k", "id", rows_per_salt=50)
        shares = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(shares.values()) == 3000 and max(shares.values()) < 1500


def test_cut_copies_give_the_plain_product(spark):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["hot", "hot", "a", "b", "gone", None])], "i int, k string")
    counted = spark.createDataFrame([("hot", 1, 23), ("hot", 2, 3), ("a", 1, 1), ("b", 1, 10), ("other", 9, 40)], "k string, v int, n bigint")
    left, right = split_copies(rows, counted, "k", "n", chunk=5)
    assert {(r["k"], r["v"]): r["s"] for r in right.groupBy("k", "v").agg(F.sum("n").alias("s")).collect()} == {
        (r["k"], r["v"]): r["n"] for r in counted.collect()
    }
    assert right.agg(F.max("n")).first()[0] <= 5
    joined = skew_join(left, right, ["k", "_part"], "i", "inner", rows_per_salt=2).drop("_part")
    got = Counter((r.k, r.i, r.v) for r in repeat_copies(joined, "n").collect())
    plain = {(r.k, r.i, r.v): r.n for r in rows.join(counted, "k").collect()}
    assert got == plain


def test_describe(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None), (100.0, None)], "x double, e double")
    rows = {r.column_name: r for r in profile.describe(df, ["x", "e"], {"p50": 0.5, "p99": 0.99}).collect()}
    x = rows["x"]
    assert (x["count"], x["mean"], x["min"], x["p50"], x["max"]) == (5, 22.0, 1.0, 3.0, 100.0)
    assert x["p99"] == pytest.approx(96.16) and x["std"] == pytest.approx(43.6176569751)
    assert tuple(rows["e"])[1:] == (0, None, None, None, None, None, None)


def test_null_profile_rounds_half_even_and_flags(spark):
    rows = [(1, None if i < 1 else i, None if i < 160 else i) for i in range(800)]
    got = {tuple(r)[1:] for r in profile.null_profile(spark.createDataFrame(rows, "a int, b int, c int"), "t").collect()}
    assert got == {("b", 1, 0.12, 0), ("c", 160, 20.0, 1)}


def test_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, None), (None, None), ("b", 1)], "k string, v int")
    assert tuple(profile.duplicate_check(df, "t", "k").first()) == ("t", "k", 2, 3)
    assert [tuple(r) for r in profile.duplicate_keys(df, "t", "k").collect()] == [("t", "a", 3)]


def test_duplicates_are_not_fooled_by_look_alikes(spark):
    """Rows that read alike when joined up, nulls and their names, both zeros, NaN, and types without a digest."""
    zero, nan = 0.0, float("nan")
    rows = [
        (1, "a", "bc", zero, [1]), (1, "ab", "c", zero, [1]), (1, "a", "bc", -zero, [1]), (1, "1:a", "", zero, [1]),
        (1, "", "1:a", zero, [1]), (1, None, "null,", zero, [1]), (1, "null,", None, zero, [1]), (1, None, None, nan, [1]),
        (1, None, None, nan, [1]), (1, "a", "bc", zero, [2]), (2, "a", "bc", zero, [1]), (1, "a", "bc", None, [1]),
    ]
    df = spark.createDataFrame(rows, "k int, s string, t string, d double, l array<int>").repartition(3)
    assert tuple(profile.duplicate_check(df, "t", "k").first()) == ("t", "k", 2, 10)
    assert df.count() - df.distinct().count() == 2


def test_row_digest_groups_like_the_columns(spark):
    rng = random.Random(5)
    texts = [None, "", "0", "1:0", "null,", "é", "0:"]
    rows = [(rng.choice(texts), rng.choice(texts), rng.choice([None, 0.0, -0.0, 1.5])) for _ in range(600)]
    df = spark.createDataFrame(rows, "a string, b string, c double").selectExpr(
        "a", "b", "c", "cast(c as decimal(9, 2)) d", "timestamp_micros(cast(c as bigint)) t", "cast(c as float) f"
    )
    assert all(digestible(kind) for _, kind in df.dtypes)
    told = df.withColumn("h", row_digest(df.dtypes))
    assert told.select("h").distinct().count() == df.distinct().count() == told.distinct().count()


def test_rows_are_told_by_numbers_alone(spark, capsys):
    df = spark.createDataFrame([(1, 0.5, "a")], "k int, d double, s string")
    told = df.select(row_digest(df.dtypes).alias("h")).schema["h"].dataType
    assert [f.dataType.simpleString() for f in told] == ["bigint", "bigint"]
    profile.duplicate_check(df, "t", "k").explain(True)
    plan = capsys.readouterr().out
    assert "sha2" not in plan and "as string" not in plan


def test_domains_are_numbers(spark):
    tables = {"a": spark.createDataFrame([("x",), ("y",), (None,)], "k string"), "b": spark.createDataFrame([("x",)], "k string")}
    frame, names, numbers = key_presence(tables, [Reference("r", "a", "k", "b", "k")], [("a", "k")], [("b", "k")])
    assert dict(frame.dtypes)["domain"] == "int" and numbers == {"b.k": 0}
    assert {(r["domain"], r["key"], r[names["a", "k"]], r[names["b", "k"]]) for r in frame.collect()} == {(0, "x", 1, 1), (0, "y", 1, 0), (0, None, 1, 0)}


def test_value_counts_keep_null(spark):
    df = column(spark, ["b", "a", "a", None, "b", "c"], "string")
    assert [tuple(r)[2:] for r in profile.value_counts(df, "t", "x").collect()] == [("a", 2), ("b", 2), ("c", 1), (None, 1)]
    assert profile.distinct_values(df, "t", ["x"]).first().distinct_values == 3


def test_correlation_of_pairs_and_of_a_constant(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=200)
    y = 0.5 * x + rng.normal(size=200)
    rows = [(float(a), float(b) if i % 4 else None, 0.1) for i, (a, b) in enumerate(zip(x, y))]
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(spark.createDataFrame(rows, "x double, y double, c double"), ["x", "y", "c"]).collect()}
    keep = [i for i in range(200) if i % 4]
    assert got["x", "y"] == got["y", "x"] == pytest.approx(np.corrcoef(x[keep], y[keep])[0, 1])
    assert got["x", "x"] == 1.0 and got["c", "c"] is None and got["x", "c"] is None and len(got) == 9


def test_every_hot_key_is_salted(spark):
    left = spark.range(6000).selectExpr("id % 1500 as k", "id as row")
    right = spark.range(1500).selectExpr("id as k", "id * 2 as twice")
    assert hot_keys(left, "k", 2).count() == 1500
    joined = skew_join(left, right, "k", spread_by="row", how="inner", rows_per_salt=2)
    assert joined.count() == 6000 and joined.filter("twice <> 2 * k").count() == 0


def test_quantile_rows_meet_one_bucket_at_most(spark):
    """Six wanted ranks lie in one coarse bucket; the join with the buckets still gives every row once."""
    df = spark.range(1000).selectExpr("cast(id % 7 as int) as v")
    found = quantiles(df, ["v"], [0.1, 0.25, 0.5, 0.75, 0.9, 0.99])
    assert {r.p: r.value for r in found.collect()} == {
        p: float(np.quantile(np.arange(1000) % 7, p)) for p in (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    targets_in_groups = [line for line in plan.split("\n") if "Aggregate" in line and "_rank" in line and "count(1)" in line]
    assert not targets_in_groups


@pytest.mark.parametrize("cap", [0.99, 0.5, 1.0])
@pytest.mark.parametrize("name", list(DRAWS))
def test_capped_summary_is_that_of_the_capped_values(spark, name, cap):
    xs = DRAWS[name]
    limit = float(np.quantile(xs, cap))
    kept = [x for x in xs if x <= limit]
    got = capped_summary(column(spark, xs).repartition(5), "x", cap, {"median": 0.5, "p9": 0.9}).first()
    near = lambda v: pytest.approx(float(v), rel=1e-9, abs=1e-310)
    assert got.cap == near(limit)
    if got.cap == limit or name != "close together":
        assert (got["count"], got.min, got.max) == (len(kept), min(kept), max(kept))
        assert got.mean == pytest.approx(float(np.mean(kept)), rel=1e-9, abs=max(map(abs, xs)) * 1e-12)
        assert got.median == near(np.quantile(kept, 0.5)) and got.p9 == near(np.quantile(kept, 0.9))


def test_capped_summary_of_nothing(spark):
    assert tuple(capped_summary(column(spark, [None]), "x", 0.99).first()) == (None, 0, None, None, None)
    assert tuple(capped_summary(column(spark, [None]), "x", 0.99, {"m": 0.5}).first()) == (None, 0, None, None, None, None)


def test_quantiles_meet_their_input_once_per_level(spark):
    df = column(spark, [1.0, 2.0, 3.0]).withColumn("x", F.col("x") + F.lit(1))
    for made, times in ((quantiles(df, ["x"], P), 3), (capped_summary(df, "x", 0.9), 3), (capped_summary(df, "x", 0.9, {"m": 0.5}), 6)):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == times


def moments_rows():
    rng = np.random.default_rng(9)
    x = rng.normal(size=300) * 1e-3 + 1e9
    y = 2 * (x - 1e9) + rng.normal(size=300) * 1e-3
    return [(float(a), float(b) if i % 5 else None, i % 2, i % 4, 0.1) for i, (a, b) in enumerate(zip(x, y))]


def test_weighted_moments_equal_written_out_copies(spark):
    rows = moments_rows()
    schema = "x double, y double, late int, w int, c double"
    df = spark.createDataFrame(rows, schema).repartition(4)
    copies = spark.createDataFrame([r for r in rows for _ in range(r[3])], schema)
    kept = [(r[0], r[1]) for r in rows for _ in range(r[3]) if r[1] is not None]
    wanted = np.corrcoef(*zip(*kept))[0, 1]
    for made in (correlations(df, [("x", "y"), ("x", "c")], "w"), correlations(copies, [("x", "y"), ("x", "c")])):
        found = {(r.col_x, r.col_y): (r.n, r.corr) for r in made.collect()}
        assert found["x", "y"] == (len(kept), pytest.approx(wanted, abs=1e-4)) and found["x", "c"][1] is None
    r, n, p, strength, direction = pearson(df, "x", "y", "w").first()
    assert (r, n, strength, direction) == (pytest.approx(wanted, abs=1e-4), len(kept), "strong", "positive") and p < 1e-9
    assert pearson(df, "x", "y", "w", min_rows=len(kept)).count() == 0
    assert pearson(df, "x", "c", "w").first().r is None


def test_pooled_t_of_any_columns(spark):
    rows = moments_rows()
    df = spark.createDataFrame(rows, "x double, y double, late int, w int, c double").repartition(3)
    a = [r[0] - 1e9 for r in rows for _ in range(r[3]) if r[2] == 0]
    b = [r[0] - 1e9 for r in rows for _ in range(r[3]) if r[2] == 1]
    pooled = (np.var(a) * len(a) + np.var(b) * len(b)) / (len(a) + len(b) - 2)
    wanted = (np.mean(a) - np.mean(b)) / math.sqrt(pooled * (1 / len(a) + 1 / len(b)))
    row = pooled_t(df, "x", "late", "w", ("early", "late")).first()
    assert (row.n_early, row.n_late, row.df) == (len(a), len(b), len(a) + len(b) - 2)
    assert row.t_stat == pytest.approx(wanted, abs=1e-3) and 0 <= row.p_value <= 1
    assert pooled_t(df, "x", "late", "w", min_group=len(a)).count() == 0
    assert pooled_t(df, "c", "late", "w").first().t_stat is None
    assert pooled_t(df.limit(0), "x", "late").count() == 0


def test_references_from_one_shuffle(spark):
    child = spark.createDataFrame([("a", "x"), ("a", None), ("gone", "x"), ("gone", "x"), (None, "lost"), (None, "x")], "k string, other string")
    tables = {"child": child, "parent": spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string"),
              "second": spark.createDataFrame([("x", 1), ("x", None)], "other string, v int")}
    refs = [Reference("k", "child", "k", "parent", "k"), Reference("o", "child", "other", "second", "other")]
    made = broken_references(tables, refs, [("child", "k"), ("second", "v"), ("second", "other")], [("parent", "k"), ("child", "k"), ("second", "v")])
    assert made.first().asDict() == {
        "orphans k": 2, "orphans o": 1, "nulls child.k": 2, "nulls second.v": 1, "nulls second.other": 0,
        "repeats parent.k": 1, "most parent.k": 2, "repeats child.k": 2, "most child.k": 2, "repeats second.v": 0, "most second.v": None,
    }
    assert broken_references(tables, refs, null_is_key=True).first().asDict() == {"orphans k": 2, "orphans o": 2}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    nothing = {name: df.limit(0) for name, df in tables.items()}
    assert set(broken_references(nothing, refs).first()) == {0}


def test_right_side_split_equals_the_plain_left_join(spark):
    products = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("unsold", 4), (None, 5)], "k string, v int")
    pairs = spark.createDataFrame([("hot", f"s{i}") for i in range(500)] + [("a", "s1"), ("a", None), ("other", "s2"), (None, "s3")], "k string, s string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = right_skew_join(products, pairs, "k", "s", rows_per_salt=20)
        shares = Counter(r[0] for r in split.select(F.spark_partition_id()).collect())
        rows = sorted(map(str, split.select("k", "v", "s").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows == sorted(map(str, products.join(pairs, "k", "left").select("k", "v", "s").collect()))
    assert max(shares.values()) < 700


def _shuffled_rows(df):
    """Records that the exchanges of a plan that has run have written, by what stands below them."""
    found, plan = [], df._jdf.queryExecution().executedPlan()
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange":
            found.append((node.child().output().size(), node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_rows_that_come_once_stay_out_of_the_shuffle(spark, monkeypatch, bits):
    monkeypatch.setattr(dedup, "TABLE_BITS", bits)
    rows = [(f"k{i}", i % 9, float(i), None) for i in range(3000)] + [(f"k{i}", i % 4, -0.0 if i % 2 else 0.0, "x") for i in range(0, 60, 2)]
    rows += [(None, 1, None, None)] * 2 + [(None, None, 0.0, "y"), ("z", 1, -0.0, "same"), ("z", 1, 0.0, "same"), ("lone", 1, -0.0, None)]
    df = spark.createDataFrame(rows, "k string, o int, x double, y string").repartition(3)

    def listed(d):
        return sorted(map(repr, d.collect()))

    for nulls_last in ((), ("o",)):
        assert listed(dedup.keep_first_apart(df, "k", ["o"], nulls_last)) == listed(keep_first(df, "k", ["o"], nulls_last))
    assert listed(dedup.distinct_apart(df)) == listed(df.distinct())
    nested = df.withColumn("a", F.array("o"))
    assert listed(dedup.distinct_apart(nested)) == listed(nested.distinct())
    assert listed(dedup.distinct_apart(df.limit(0))) == []


def test_the_batch_run_shuffles_few_whole_rows(spark, tmp_path):
    from tillroll.plans import clean
    from tillroll.schemas import RAW

    rows = spark.range(5000).selectExpr("cast(id as string) order_id", "1 payment_sequential", "'a' payment_type", "1 payment_installments", "double(id) payment_value")
    rows.union(rows.limit(5)).write.parquet(str(tmp_path / "p"))
    tables = {t: spark.createDataFrame([], schema) for t, schema in RAW.items()} | {"payments": spark.read.parquet(str(tmp_path / "p"))}
    paid = clean.clean_tables(clean.Landed(tables))["payments"]
    assert len(paid.collect()) == 5000
    whole = sum(n for columns, n in _shuffled_rows(paid) if columns >= 5)
    assert 5 <= whole < 100
