"""Plans and results that must hold when data grows or one key holds a third of the rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starloom.operators import ordering
from starloom.operators.dedup import latest_row, modal_row
from starloom.operators.durable import durable
from starloom.operators.joins import integer_counts, key_counts, orphan_rows, rollup_via
from starloom.operators.keys import dense_keys, row_keys
from starloom.operators.ordering import ntile, ntiles, ordered, top_k, weighted_percentiles
from starloom.plans.clean import clean_views
from starloom.plans.star import build_lazy
from starloom.workload.feed import raw_feed
from starloom.workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

# Windows over a whole input are allowed only where its size is fixed: calendar months, top-k rows,
# bucket, file or range totals, days of the calendar.
WHOLE_WINDOWS = {
    "d2_key_resolution", "f4_row_numbers", "f6_running_total", "f8_ntile", "g5_categories_by_name", "j2_dim_customer", "j3_dim_product",
    "j4_dim_seller", "j6_row_keys", "j9_fact_sales", "j10_fact_order_fulfillment", "m3_state_share", "m4_on_time_vs_late", "n8_sales_growth",
    "n9_rfm_scores", "n10_category_pareto", "n13_seller_concentration", "n15_rfm_segments", "k17_k19_calendar", "k21_verdict", "e14_duration_percentiles",
}

# Values with line breaks are cut into records in Arrow batches, as no expression counts quotes over the lines of a split.
IN_ARROW = {"a1_csv_scan_reviews"}


def has_whole_window(plan: str) -> bool:
    lines = plan.split("\n")
    return any("- Window [" in line and "SinglePartition" in " ".join(lines[i + 1:i + 4]) for i, line in enumerate(lines))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" not in plan and "Pandas" not in plan and "Arrow" not in plan) or name in IN_ARROW
    assert not has_whole_window(plan) or name in WHOLE_WINDOWS


def test_whole_windows_are_noticed(spark):
    assert has_whole_window(plan_of(entry.queries()["n8_sales_growth"](spark, SMALL)))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["a12_parameter_query"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(order_status), IsNotNull(order_purchase_date_key), EqualTo(order_status,delivered)" in plan
    plan = plan_of(entry.queries()["l1_total_revenue"](spark, SMALL))
    assert "ReadSchema: struct<sales_amount:decimal(18,2)>" in plan
    plan = plan_of(entry.queries()["l2_monthly_revenue"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(purchase_month" in plan


def test_key_of_a_hot_product_is_combined_before_the_join(spark):
    plan = plan_of(entry.queries()["l7_category_performance"](spark, SMALL))
    scan = plan.index("sales_amount:decimal")
    join = max(plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin"))
    assert plan.count("partial_sum") >= 2 and join < plan.rindex("partial_sum") < scan


def test_facts_never_shuffle_on_a_date(spark):
    """Even with automatic broadcasts off, a busy day must not become one task."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "-1")
        for name in ["n1_monthly_trend", "n8_sales_growth", "l5_orders_by_weekday", "n14_cohorts", "n9_customer_value", "n7_on_time_by_delivery_month", "d3_role_playing_join"]:
            plan = plan_of(entry.queries()[name](spark, SMALL))
            assert "BroadcastHashJoin" in plan
            assert "hashpartitioning(date_key" not in plan and "hashpartitioning(order_purchase_date_key" not in plan
    finally:
        spark.conf.set(setting, before)


@pytest.fixture(scope="module")
def hot_rows():
    rnd = random.Random(7)
    return [(0 if i % 3 == 0 else rnd.randint(1, 400), rnd.choice("abcde") if i % 5 else None, rnd.randint(0, 9), i) for i in range(6000)]


def test_modal_row_with_a_hot_key(spark, hot_rows):
    df = spark.createDataFrame([(k, a, str(v)) for k, a, v, _ in hot_rows], "k int, a string, b string")
    groups = defaultdict(Counter)
    for k, a, v, _ in hot_rows:
        groups[k][a, str(v)] += 1
    expected = {k: min(c, key=lambda t: (-c[t], t[0] is None, t[0] or "", t[1])) for k, c in groups.items()}
    assert {r.k: (r.a, r.b) for r in modal_row(df, "k", ["a", "b"]).collect()} == expected


def test_latest_row_with_a_hot_key(spark, hot_rows):
    df = spark.createDataFrame([(k, v, i) for k, _, v, i in hot_rows], "k int, v int, i int")
    expected = {}
    for k, _, v, i in hot_rows:
        expected[k] = max(expected.get(k, (-1, -1)), (v, i))
    assert {r.k: (r.v, r.i) for r in latest_row(df, "k", ["v", "i"], ["v", "i"]).collect()} == expected


def test_rollup_and_orphans_with_a_hot_key(spark, hot_rows):
    fact = spark.createDataFrame([(k if k % 7 else None, v) for k, _, v, _ in hot_rows], "k int, v int")
    dim = spark.createDataFrame([(k, k % 4) for k in range(300)], "k int, g int")
    sums = Counter()
    for k, _, v, _ in hot_rows:
        if k % 7 and k < 300:
            sums[k % 4] += v
    out = rollup_via(fact, "k", {"s": F.sum("v")}, dim, ["g"]).groupBy("g").agg(F.sum("s").alias("s"))
    assert {r.g: r.s for r in out.collect()} == dict(sums)
    counts = key_counts(fact, {"k": ("k", "d"), "same": ("k", "d"), "alone": ("k", None)}, {"d": (dim, "k")}).collect()
    present = sum(1 for k, *_ in hot_rows if k % 7)
    lost = sum(1 for k, *_ in hot_rows if k % 7 and k >= 300)
    missing, distinct = len(hot_rows) - present, len({k for k, *_ in hot_rows if k % 7})
    assert sorted(tuple(r) for r in counts) == [
        ("alone", present, missing, distinct, 0), ("k", present, missing, distinct, lost), ("same", present, missing, distinct, lost)]
    assert orphan_rows(fact, "k", dim, "k").count() == lost


@pytest.mark.parametrize("tiles", [1, 3, 5, 7])
def test_order_operators_equal_brute_force(spark, hot_rows, tiles):
    rows = hot_rows[: 100 * tiles + tiles - 1]
    df = spark.createDataFrame([(k, i, v) for k, _, v, i in rows], "k int, i int, v int")
    order = ["-k", "i"]
    expected, running = {}, 0
    for n, (k, _, v, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[3])), start=1):
        running += v
        expected[i] = (n, running)
    got = ordered(df, order, running={"total": "v"}, row_no="n", row_count="rows").collect()
    assert {r.i: (r.n, r.total) for r in got} == expected
    assert {r["rows"] for r in got} == {len(rows)}
    q, extra = divmod(len(rows), tiles)
    bounds = [(t + 1) * q + min(t + 1, extra) for t in range(tiles)]
    tile_of = {i: next(t for t, b in enumerate(bounds, start=1) if n <= b) for i, (n, _) in expected.items()}
    assert {r.i: r.t for r in ntile(df, order, tiles, "t").collect()} == tile_of


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.range(3).withColumnRenamed("id", "i")
    assert [r.t for r in ntile(df, ["i"], 5, "t").orderBy("i").collect()] == [1, 2, 3]
    assert ordered(df.filter("i < 0"), ["i"]).isEmpty()


def test_running_sum_ignores_null_values(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 2)], "i int, v int")
    got = ordered(df, ["i"], running={"total": "v"}).orderBy("i").collect()
    assert [r.total for r in got] == [None, 5, 5, 7]


def exchanges(df) -> list[str]:
    """The exchanges of the final plan, as the planner names them."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.split("== Initial Plan ==")[0].splitlines() if "Exchange " in line and "ReusedExchange" not in line]


@pytest.mark.parametrize("tiles", [1, 2, 5, 9])
def test_ntiles_over_many_ranges_with_hot_values_and_nulls(spark, monkeypatch, tiles):
    """Equal values fill many ranges, and each order has directions and nulls of its own."""
    monkeypatch.setattr(ordering, "RANGES", 7)
    monkeypatch.setattr(ordering, "SAMPLED", 3)
    rng = random.Random(tiles)
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3, 50]), rng.choice([None, "a", "b", "b", "é"])) for i in range(1501)]
    df = spark.createDataFrame(rows, "i int, v int, s string").repartition(6)
    orders = {"up": ["v", "i"], "down": ["-v", "-i"], "text": ["-s", "v", "i"], "plain": ["-i"]}

    def key(name):
        def one(value, down):
            absent = value is None
            return (not absent, value if not absent else 0) if not down else (absent, ReverseOrder(value) if not absent else 0)
        def whole(r):
            return tuple(one(r["ivs".index(t.removeprefix("-"))], t.startswith("-")) for t in orders[name])
        return whole

    q, extra = divmod(len(rows), tiles)
    bounds = [(t + 1) * q + min(t + 1, extra) for t in range(tiles)]
    got = {r.i: r.asDict() for r in ntiles(df, orders, tiles).collect()}
    for name in orders:
        expected = {r[0]: next(t for t, b in enumerate(bounds, start=1) if n <= b) for n, r in enumerate(sorted(rows, key=key(name)), start=1)}
        assert {i: r[name] for i, r in got.items()} == expected, name


class ReverseOrder:
    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return other.value == self.value


def test_ntiles_move_no_row(spark):
    df = durable(spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.lit("wide").alias("other")), "test-ntiles")
    out = ntiles(df, {"t": ["v", "id"]}, 5)
    assert [r["count"] for r in out.groupBy("t").count().collect()] == [1000] * 5
    # only rows of ranges that hold a cut are ranked, in subqueries, without other columns
    assert all("SinglePartition" in e or "hashpartitioning(range" in e for e in exchanges(out))
    assert "rangepartitioning" not in plan_of(out)


def test_running_sums_shuffle_rows_once(spark):
    df = durable(spark.range(5000).select("id", (F.col("id") * 7 % 31).alias("v")), "test-running")
    written = []
    real = ordering.durable

    def seen(frame, label, **kw):
        if label == "ordered":
            written.append(frame)
        return real(frame, label, **kw)

    ordering.durable = seen
    try:
        out = ordered(df, ["v", "id"], running={"total": "id"})
    finally:
        ordering.durable = real
    assert len(exchanges(written[0])) - sum("SinglePartition" in e for e in exchanges(written[0])) == 1
    assert not [e for e in exchanges(out) if "hashpartitioning" in e]
    assert out.agg(F.max("total")).first()[0] == sum(range(5000))


def test_weighted_percentiles_equal_the_built_in(spark, hot_rows):
    df = spark.createDataFrame([(k % 5 if k % 11 else None, v) for k, _, v, _ in hot_rows], "g int, v int")
    counts = durable(df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")), "test-counts")
    points = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: list(r)[1:] for r in weighted_percentiles(counts, "g", "v", "n", points, "total").collect()}
    expected = {r.g: [r.total, *r.at] for r in df.where("v is not null").groupBy("g").agg(F.count("v").alias("total"), F.percentile("v", points).alias("at")).collect()}
    assert got == expected
    plan = weighted_percentiles(counts, "g", "v", "n", points, "total")._jdf.queryExecution().toString()
    assert "percentile(" not in plan
    assert weighted_percentiles(counts.where("false"), "g", "v", "n", points, "total").isEmpty()


def test_integer_counts_equal_distinct_counts(spark, hot_rows):
    values = [None, None, 0, -1, -40000, 32767, 32768, 32769, 2**40, *[k * 1000 for k, *_ in hot_rows]]
    df = spark.createDataFrame([(v,) for v in values], "k long").repartition(5)
    present = [v for v in values if v is not None]
    assert tuple(integer_counts(df, "k").first()) == (len(present), 2, len(set(present)))
    assert tuple(integer_counts(df.where("false"), "k").first()) == (0, 0, 0)
    keys = durable(spark.range(200_000).withColumnRenamed("id", "k"), "test-keys")
    one = integer_counts(keys, "k")
    assert one.first().distinct_values == 200_000
    plan = one._jdf.queryExecution().executedPlan()
    assert "shuffle records written" not in plan.toString()


def test_top_k_numbers_rows(spark, hot_rows):
    df = spark.createDataFrame([(k, i) for k, _, _, i in hot_rows], "k int, i int")
    got = top_k(df, [F.desc("k"), F.asc("i")], 5, rank_as="n").collect()
    best = sorted(((k, i) for k, _, _, i in hot_rows), key=lambda t: (-t[0], t[1]))[:5]
    assert [(r.n, r.k, r.i) for r in sorted(got, key=lambda r: r.n)] == [(n, *t) for n, t in enumerate(best, start=1)]


def test_dense_keys_do_not_depend_on_partitions(spark, hot_rows):
    df = spark.createDataFrame([(f"p{k}", i) for k, _, _, i in hot_rows], "k string, i int")
    a = {(r.k, r.i): r.key for r in dense_keys(df, "k", "key").collect()}
    b = {(r.k, r.i): r.key for r in dense_keys(df.repartition(13, "i"), "k", "key", digits=1).collect()}
    assert a == b and len(a) == len(hot_rows)
    assert sorted(set(a.values())) == list(range(1, len({k for k, *_ in hot_rows}) + 1))


def test_dense_keys_compute_their_input_once(spark, tmp_path):
    spark.createDataFrame([(f"p{i % 300}", i) for i in range(1000)], "k string, i int").write.parquet(f"{tmp_path}/t")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    for unique, rows in ((True, spark.read.parquet(f"{tmp_path}/t").dropDuplicates(["k"])), (False, spark.read.parquet(f"{tmp_path}/t"))):
        seen.value = 0
        watched = rows.mapInArrow(count, rows.schema)
        got = dense_keys(watched, "k", "key", unique=unique)
        assert got.count() == (300 if unique else 1000) == seen.value
        assert got.agg(F.max("key"), F.count_distinct("key")).first() == (300, 300)


def test_dense_keys_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, i int")
    got = {r.i: r.key for r in dense_keys(df, "k", "key").collect()}
    assert got == {1: 1, 3: 1, 2: 2}
    assert dense_keys(df.where("false"), "k", "key").isEmpty() and dense_keys(df.where("false"), "k", "key", unique=True).isEmpty()


def test_row_keys_are_dense_over_many_files(spark, hot_rows):
    df = spark.createDataFrame([(i,) for *_, i in hot_rows], "i int").repartition(37)
    keys = [r.key for r in row_keys(df, "key", "test").collect()]
    assert sorted(keys) == list(range(1, len(hot_rows) + 1))


def test_star_does_not_depend_on_input_order(spark):
    raw = raw_feed(spark, SMALL)
    mixed = {t: raw[t].repartition(5).sortWithinPartitions(F.rand(3)) for t in raw}
    a = build_lazy(spark, clean_views(raw))
    b = build_lazy(spark, clean_views(mixed))
    for table in a:
        assert a[table].exceptAll(b[table]).isEmpty() and b[table].exceptAll(a[table]).isEmpty()


def test_star_with_a_hot_customer_product_and_order(spark):
    """A third of all orders belong to one person, and a third of all items to one order and product."""
    raw = {t: df for t, df in raw_feed(spark, SMALL).items()}
    hot = F.col("order_id").cast("int") % 3 == 0
    raw["customers"] = raw["customers"].withColumn(
        "customer_unique_id", F.when(F.substring("customer_id", 2, 20).cast("int") % 3 == 0, "7").otherwise(F.col("customer_unique_id")))
    raw["order_items"] = (
        raw["order_items"].withColumn("order_item_id", F.when(hot, F.row_number().over(_by_all())).otherwise(F.col("order_item_id")).cast("string"))
        .withColumn("product_id", F.when(hot, "11").otherwise(F.col("product_id"))).withColumn("order_id", F.when(hot, "3").otherwise(F.col("order_id"))))
    raw["order_payments"] = raw["order_payments"].withColumn("order_id", F.when(hot, "3").otherwise(F.col("order_id")))
    star = build_lazy(spark, clean_views(raw))
    items = raw["order_items"].toPandas()
    sales = star["fact_sales"].toPandas()
    assert len(sales) == len(items) and sales.order_id.value_counts()["3"] == (items.order_id == "3").sum()
    assert sales.groupby("order_id").customer_key.nunique(dropna=False).max() == 1
    total = items.price.replace("", "0").fillna("0").astype(float).sum() + items.freight_value.astype(float).sum()
    assert abs(float(sales.sales_amount.sum()) - total) < 0.01
    orders = star["fact_order_fulfillment"].toPandas().set_index("order_id")
    payments = raw["order_payments"].toPandas()
    assert orders.loc["3"].payment_count == (payments.order_id == "3").sum()
    assert len(orders) == raw["orders"].count()


def _by_all():
    from pyspark.sql import Window

    return Window.orderBy("order_id", "order_item_id", "product_id")


def test_few_keys_are_dealt_to_few_tasks(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    for unique in (True, False):
        folder = tmp_path / str(unique)
        keys = dense_keys(df, "k", "key", unique=unique, folder=str(folder)).collect()
        assert sorted(r.key for r in keys) == list(range(1, 1001))
        assert len(list(folder.glob("key-ranked-*/*.parquet"))) == 1


def test_key_counts_group_whole_numbers(spark):
    fact = spark.createDataFrame([(1, 1), (2, 5), (None, 5)], "a bigint, b int")
    dim = spark.range(3)
    counts = key_counts(fact, {"x": ("a", "d"), "y": ("b", "d"), "z": ("b", None)}, {"d": (dim, "id")})
    assert "keys=[place#" in plan_of(counts) and "keys=[label#" not in plan_of(counts)
    assert {tuple(r) for r in counts.collect()} == {("x", 2, 1, 2, 0), ("y", 3, 0, 2, 2), ("z", 3, 0, 2, 0)}


def test_extracts_are_written_side_by_side(monkeypatch):
    from starloom.workload import queries

    jobs = []
    monkeypatch.setattr(queries, "together", lambda *given: jobs.extend(given))
    queries._write_extracts({}, ["orders", "sellers"], "nowhere")
    assert len(jobs) == 2
