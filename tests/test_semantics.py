"""Edge cases whose plain Spark translation would be wrong."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F
from small_shop import by, raw_shop

from starloom.functions import blank_to_null, calendar_key, date_key, days_between, exact_avg, hours_between, not_blank, pct, place_label, title_case, typed
from starloom.operators.calendar import day_spine, gap_fill, missing_days, month_spine
from starloom.operators.dedup import duplicate_keys, latest_row, modal_row
from starloom.plans import analysis, metrics
from starloom.plans.clean import clean_views
from starloom.schemas import star_schema
from starloom.plans.star import DATE_ROLES, Calendar, build_lazy, calendar_of, dim_date, role_keys, role_keys_by_join, stored_orders
from starloom.workload.feed import _hundredths, line_cents, raw_order_items


@pytest.fixture(scope="module")
def views(spark):
    return clean_views(raw_shop(spark))


@pytest.fixture(scope="module")
def star(spark, views):
    return build_lazy(spark, views, Calendar(dt.date(2016, 1, 1), dt.date(2019, 12, 31)))


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_blank_and_strict_casts(spark):
    df = spark.createDataFrame([("",), (" 7 ",), (None,)], "c string")
    assert [r.v for r in df.select(typed("c", "int").alias("v")).collect()] == [None, 7, None]
    assert [r.v for r in df.select(not_blank("c").alias("v")).collect()] == [False, True, None]
    assert one(spark, blank_to_null(F.lit("x"))) == "x"
    for bad in ("abc", "  "):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            spark.createDataFrame([(bad,)], "c string").select(typed("c", "int")).collect()


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([("12.345",), ("-2.345",)], "c string")
    assert [r.v for r in df.select(typed("c", "decimal(12,2)").alias("v")).collect()] == [D("12.35"), D("-2.35")]


def test_trim_takes_spaces_only(spark, views):
    rows = by(views["vw_customers"], "customer_id")
    assert rows["c1"].customer_city == "sao paulo"
    assert rows["c1"].customer_zip_code_prefix == "01001"
    assert set(rows) == {f"c{i}" for i in range(1, 8)}


def test_category_fallback_and_weight_rounding(views):
    rows = by(views["vw_products"], "product_id")
    assert [rows[p].category_name_english for p in ("p1", "p2", "p3")] == ["perfumery", "sem_nome", "unknown"]
    assert rows["p1"].product_weight_g == D("0.01")
    assert " " not in rows


def test_orders_keep_blank_ids_but_the_fact_drops_them(views, star):
    assert views["vw_orders"].count() == 8
    assert set(by(star["fact_order_fulfillment"], "order_id")) == {"o1", "o2", "o3", "o4", "o5", "o6"}


def test_item_filters_and_price_rounding(views):
    rows = by(views["vw_order_items"], "order_id", "order_item_id")
    assert set(rows) == {("o1", 1), ("o1", 2), ("o2", 1), ("o3", 1), ("o4", 1), ("lost", 1)}
    assert rows["o1", 1].price == D("12.35")


def test_payments_sum_ignores_blank_and_counts_legs(views):
    rows = by(views["vw_order_payments_agg"], "order_id")
    assert (rows["o1"].total_payment_value, rows["o1"].payment_count) == (D("15.85"), 3)
    assert (rows["o3"].total_payment_value, rows["o3"].payment_count) == (None, 1)


def test_latest_review_text_order_null_first_and_ties(views):
    rows = by(views["vw_order_reviews_latest"], "order_id")
    assert {k: r.review_score for k, r in rows.items()} == {"o1": 5, "o2": 2, "o3": 1}


def test_modal_place_ties_and_nulls_last(star):
    rows = by(star["dim_customer"], "customer_unique_id")
    assert rows["u1"].customer_city == "sao paulo"
    assert rows["u2"].customer_city == "a town"
    assert rows["u3"].customer_city == "z town"  # the NULL city loses the tie
    assert sorted(r.customer_key for r in rows.values()) == [1, 2, 3]


def test_modal_row_counts_beat_order(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (2, None), (2, None), (2, "a")], "k int, a string")
    assert {r.k: r.a for r in modal_row(df, "k", ["a"]).collect()} == {1: "b", 2: None}


def test_latest_row_null_is_latest(spark):
    df = spark.createDataFrame([(1, "2020", "x"), (1, None, "y"), (1, "2021", "z")], "k int, t string, v string")
    assert latest_row(df, "k", ["t"], ["v"]).first().v == "y"


def test_duplicate_keys_keep_null_groups(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k int")
    assert {r.k: r.occurrences for r in duplicate_keys(df, ["k"]).collect()} == {None: 2, 2: 2}


def test_durations(star):
    o = by(star["fact_order_fulfillment"], "order_id")
    assert o["o1"].hours_to_approval is None  # approved before purchase
    assert o["o2"].hours_to_approval == D("0.00")  # equal stamps
    assert o["o3"].hours_to_approval == D("0.33")
    assert o["o3"].hours_to_customer is None
    assert o["o1"].total_fulfillment_hours == D("110.00")
    assert o["o2"].days_vs_estimate == D("0.33")
    assert o["o1"].days_vs_estimate == D("0.00")


def test_on_time_compares_time_stamps(star):
    o = by(star["fact_order_fulfillment"], "order_id")
    assert (o["o1"].is_on_time, o["o2"].is_on_time, o["o3"].is_on_time) == (True, False, None)


def test_days_before_estimate_are_negative_and_zone_free(spark):
    df = spark.createDataFrame([("2018-11-03 23:00:00", "2018-11-04 05:00:00")], "a string, b string").select(
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # clocks moved forward in this night
        r = df.select(hours_between("a", "b").alias("h"), days_between("b", "a").alias("d"), date_key("b").alias("k")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (r.h, r.d, r.k) == (D("6.00"), D("-0.25"), 20181104)


def test_dates_outside_the_calendar_have_no_key(star):
    o = by(star["fact_order_fulfillment"], "order_id")
    assert o["o4"].order_purchase_date_key is None
    assert o["o1"].order_purchase_date_key == 20170110
    assert by(star["fact_sales"], "order_id", "order_item_id")["o4", 1].date_key is None


def test_items_survive_missing_partners(star):
    s = by(star["fact_sales"], "order_id", "order_item_id")
    assert s["lost", 1].customer_key is None and s["lost", 1].sales_amount == D("7.00")
    assert s["o4", 1].product_key is None and s["o4", 1].seller_key is None
    assert s["o1", 2].sales_amount == D("2.50") and s["o1", 2].price is None
    assert s["o3", 1].sales_amount == D("0.00")
    assert len(s) == 6


def test_role_keys_two_ways(spark, views):
    cal = Calendar(dt.date(2017, 1, 1), dt.date(2017, 2, 15))
    a = role_keys(views["vw_orders"], cal)
    b = role_keys_by_join(views["vw_orders"], dim_date(spark, cal)).select(a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_calendar_key_range(spark):
    key = calendar_key(F.lit("2019-12-31 23:59:59").cast("timestamp_ntz"), dt.date(2016, 1, 1), dt.date(2019, 12, 31))
    assert one(spark, key) == 20191231


def test_calendar_days(spark):
    days = dim_date(spark, Calendar(dt.date(2016, 1, 1), dt.date(2019, 12, 31)))
    assert days.count() == 1461
    r = days.filter("date_key = 20170101").first()
    assert (r.day_of_week, r.day_name, r.is_weekend, r.week_of_year, r.month_name, r.quarter) == (1, "Sunday", True, 52, "January", 1)


def test_title_case_after_any_mark(spark):
    cases = {"santa barbara d'oeste": "Santa Barbara D'Oeste", "embu-guacu": "Embu-Guacu", "SÃO PAULO": "São Paulo", "": "", "4º centro": "4º Centro"}
    for raw, shown in cases.items():
        assert one(spark, title_case(F.lit(raw))) == shown
    assert one(spark, title_case(F.lit(None).cast("string"))) is None


def test_exact_mean_rounds_once(spark):
    df = spark.createDataFrame([("1.00",), ("2.00",), ("2.00",)], "v string").select(F.col("v").cast("decimal(12,2)"))
    assert df.agg(exact_avg("v", 2).alias("m")).first().m == D("1.67")
    # The mean 0.00499975 is 0.005000 at six digits, which would round up to 0.01.
    close = spark.range(40_000).select(F.when(F.col("id") < 1, F.lit("199.99")).otherwise(F.lit("0.00")).cast("decimal(12,2)").alias("v"))
    assert close.agg(F.round(F.avg("v"), 2).alias("m")).first().m == D("0.01")
    assert close.agg(exact_avg("v", 2).alias("m")).first().m == D("0.00")
    assert df.filter("false").agg(exact_avg("v", 2).alias("m")).first().m is None


def test_pct_and_labels(spark):
    assert one(spark, pct(F.lit(1), F.lit(8))) == D("12.50")
    assert one(spark, pct(F.lit(1), F.lit(0))) is None
    assert one(spark, place_label(F.lit("a"), F.lit("B"))) == "a (B)"


def test_spines_and_gap_fill(spark):
    months = month_spine(spark, dt.date(2016, 1, 1), dt.date(2018, 12, 1))
    assert months.count() == 36
    some = spark.createDataFrame([(dt.date(2016, 3, 1), D("5.00"))], "month_start date, v decimal(12,2)")
    filled = {r.month_start: r.v for r in gap_fill(months, some, "month_start", {"v": 0}).collect()}
    assert filled[dt.date(2016, 3, 1)] == D("5.00") and filled[dt.date(2016, 4, 1)] == D("0.00")
    with pytest.raises(ValueError):
        day_spine(spark, dt.date(1, 1, 1), dt.date(9999, 1, 1))


def test_missing_days(spark):
    days = day_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 10)).filter("full_date != date'2020-01-04'")
    assert [r.missing_date for r in missing_days(days).collect()] == [dt.date(2020, 1, 4)]
    assert missing_days(days.filter("false")).isEmpty()


def test_unknown_flag_is_late_and_day_limit_comes_before_rounding(spark):
    rows = [("1920.00", True, 5), ("1920.01", True, 5), ("11.99", None, 3), ("12.00", False, 4), ("100.00", True, None)]
    fof = spark.createDataFrame(rows, "h string, is_on_time boolean, review_score int").select(
        F.col("h").cast("decimal(8,2)").alias("total_fulfillment_hours"), "is_on_time", "review_score")
    out = {(r.delivery_status, int(r.delivery_day)): r.order_count for r in metrics.delivery_day_vs_review({"fact_order_fulfillment": fof}, 80).collect()}
    assert out == {("On Time", 80): 1, ("Late", 0): 1, ("Late", 1): 1}
    assert sum(r.order_count for r in metrics.delivery_day_vs_review({"fact_order_fulfillment": fof}).collect()) == 4
    assert sum(r.order_count for r in metrics.on_time_vs_late({"fact_order_fulfillment": fof}, 80).collect()) == 3


def sales_star(spark, sold):
    """A star of sales on given days, with the calendar their years need."""
    days = sorted(sold)
    calendar = dim_date(spark, Calendar(dt.date(days[0].year, 1, 1), dt.date(days[-1].year, 12, 31)))
    rows = [(i, f"o{i}", 1, 1, 1, 1, int(f"{d:%Y%m%d}"), D(v), D("0.00"), D(v)) for i, (d, v) in enumerate(sorted(sold.items()))]
    return {"dim_date": calendar, "fact_sales": spark.createDataFrame(rows, star_schema("fact_sales"))}


def test_month_spine_takes_whole_months(spark):
    star = sales_star(spark, {dt.date(2017, 1, 2): "10.00", dt.date(2017, 3, 30): "5.00", dt.date(2017, 5, 1): "7.00"})
    out = {r.year_month: r.total_revenue for r in metrics.monthly_revenue(star, dt.date(2017, 1, 15), dt.date(2017, 3, 15)).collect()}
    assert out == {"2017-01": D("10.00"), "2017-02": D("0.00"), "2017-03": D("5.00")}
    assert len(metrics.monthly_revenue(star).collect()) == 12


def test_growth_compares_with_the_month_before(spark):
    star = sales_star(spark, {dt.date(2017, 1, 2): "100.00", dt.date(2017, 4, 2): "200.00", dt.date(2017, 5, 2): "300.00", dt.date(2018, 4, 2): "50.00"})
    out = {(r.year, r.month): (r.mom_growth_pct, r.yoy_growth_pct) for r in analysis.sales_growth(star).collect()}
    assert out == {(2017, 1): (None, None), (2017, 4): (None, None), (2017, 5): (D("50.00"), None), (2018, 4): (None, D("-75.00"))}


def test_calendar_comes_from_the_orders(spark):
    orders = clean_views(raw_shop(spark))["vw_orders"]
    late = orders.filter("order_id = 'o1'").select(*[
        F.lit("late").alias(c) if c == "order_id" else (F.col(c) + F.expr("INTERVAL 12 YEARS")).alias(c) if c == "order_purchase_timestamp" else F.col(c)
        for c in orders.columns])
    found = calendar_of(orders.unionByName(late))
    purchase = late.first()["order_purchase_timestamp"].date()
    assert found.first < purchase <= found.last
    assert calendar_of(orders, Calendar(dt.date(2000, 1, 1))).first == dt.date(2000, 1, 1)
    assert calendar_of(orders.filter("false")) == Calendar(dt.date(1970, 1, 1), dt.date(1970, 1, 1))


@pytest.mark.parametrize("year", [2900, 9999])
@pytest.mark.parametrize("column", ["order_purchase_timestamp", "order_estimated_delivery_date"])
def test_a_stray_date_neither_stretches_the_calendar_nor_stops_the_load(spark, year, column):
    """Its row is loaded, without a key for that day."""
    views = dict(clean_views(raw_shop(spark)))
    plain = calendar_of(views["vw_orders"])
    stray = F.lit(f"{year}-12-31 10:00:00").cast("timestamp_ntz")
    views["vw_orders"] = views["vw_orders"].withColumn(column, F.when(F.col("order_id") == "o1", stray).otherwise(F.col(column)))
    found = calendar_of(views["vw_orders"])
    assert plain.first <= found.first and found.last <= plain.last
    kept, same = stored_orders(views["vw_orders"])
    assert same == found and kept.count() == views["vw_orders"].count()
    star = build_lazy(spark, views)
    role = next(r for r, stamp in DATE_ROLES.items() if stamp == column)
    keys = {r.order_id: r[role] for r in star["fact_order_fulfillment"].collect()}
    assert "o1" in keys and keys["o1"] is None and any(keys.values())
    assert star["dim_date"].count() == (found.last - found.first).days + 1


def test_a_given_end_is_kept(spark):
    orders = clean_views(raw_shop(spark))["vw_orders"]
    wanted = Calendar(dt.date(2016, 1, 1), dt.date(2019, 12, 31))
    assert stored_orders(orders, wanted)[1] == wanted == calendar_of(orders, wanted)
    assert calendar_of(orders.filter("false"), Calendar(last=dt.date(2000, 1, 1))) == Calendar(dt.date(2000, 1, 1), dt.date(2000, 1, 1))
    with pytest.raises(ValueError, match="--first-day"):
        day_spine(spark, dt.date(1, 1, 1), dt.date(9999, 1, 1))


def test_missing_days_of_groups(spark):
    days = [(g, dt.date(2020, 1, d)) for g, ds in (("a", [1, 2, 5, 5, 9]), ("b", [3]), (None, [1, 3])) for d in ds] + [("a", None)]
    got = Counter(tuple(r) for r in missing_days(spark.createDataFrame(days, "g string, day date"), "day", ["g"]).collect())
    assert got == Counter([("a", dt.date(2020, 1, d)) for d in (3, 4, 6, 7, 8)] + [(None, dt.date(2020, 1, 2))])
    assert "LeftAnti" not in missing_days(spark.createDataFrame(days, "g string, day date"), "day", ["g"])._jdf.queryExecution().toString()


def test_empty_facts(star):
    empty = {t: df.filter("false") for t, df in star.items()}
    assert metrics.total_revenue(empty).first().total_revenue == D("0.00")
    assert metrics.delivery_success(empty).first().delivery_success_rate_pct is None
    assert metrics.on_time_rate_all_orders(empty).first().on_time_rate_pct is None
    assert metrics.repeat_rate(empty).first().repeat_rate_pct == D("0.00")
    assert metrics.review_trend_line(empty).isEmpty()


def test_weekdays_without_sales_stay(star):
    week = metrics.orders_by_weekday(star).collect()
    assert [r.day_name for r in week] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert sum(r.total_orders for r in week) == 3  # o4 is outside the calendar, lost has no order


def test_top_k_null_category_and_sorts(star):
    by_name = metrics.top_categories(star, "name", None).collect()
    assert [r.rank_no for r in by_name] == list(range(1, len(by_name) + 1))
    assert [r.category for r in by_name] == sorted(r.category for r in by_name)
    assert metrics.top_categories(star, "quantity", 1).first().category == "perfumery"


def test_durations_from_the_first_to_the_last_year(spark):
    span = spark.sql("SELECT TIMESTAMP_NTZ '0001-01-01 00:00:00' AS a, TIMESTAMP_NTZ '9999-12-31 23:00:00' AS b")
    row = span.select(hours_between("a", "b").alias("hours"), days_between("a", "b").alias("days"), days_between("b", "a").alias("back")).first()
    assert (str(row.hours), str(row.days), str(row.back)) == ("87649415.00", "3652058.96", "-3652058.96")


def test_hundredths_equal_decimal_casts(spark):
    values = [0.0, -0.0, 0.07, 1.005, 2.675, -1.005, -84197.04, 0.1 + 0.2, 0.285, 1e-9, 9999999999.99, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", (F.col("x").cast("decimal(12,2)") * 100).cast("bigint").alias("want"), _hundredths("x", "decimal(12,2)").alias("got")).collect()
    assert all(r.want == r.got for r in rows)

    def outcome(x, col):
        try:
            return spark.createDataFrame([(x,)], "x double").select(col.alias("v")).first().v
        except ArithmeticException:
            return "refused"

    for odd in (float("nan"), float("inf"), 1e10):
        assert outcome(odd, _hundredths("x", "decimal(12,2)")) == outcome(odd, (F.col("x").cast("decimal(12,2)") * 100).cast("bigint"))
    assert outcome(1e10, _hundredths("x", "decimal(12,2)")) == "refused"


def test_cents_of_lines_are_rounded_half_away_and_summed_as_whole_numbers(spark):
    lines = spark.createDataFrame([(1, 1, 1, 1, 1.0, "R", dt.datetime(1996, 1, 1), p, d, t) for p, d, t in [(0.5, 0.01, 0.01), (-0.5, 0.01, 0.01), (84197.04, 0.07, 0.08)]],
                                  "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string, l_shipdate timestamp, "
                                  "l_extendedprice double, l_discount double, l_tax double")
    assert [(r.price, r.freight) for r in line_cents(lines).collect()] == [(50, 1), (-50, -1), (7830325, 673576)]
    plan = raw_order_items({"lineitem": lines})._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(price#" in plan and "Aggregate" in plan and "decimal(12,2)), 2)" not in plan
