"""Report programs, exports and streams on small frames or the smallest data set."""

import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import Row, functions as F

from tests.test_operators import rows
from tillroll.plans import calendar as cal, cashiers, compare, exports, flights, picking, reconciliation as rec, rollups, sales, settlements, stock
from tillroll.sources import loads, scratch, sinks
from tillroll.sources.inline import inline_table
from tillroll.sources.mart import Mart
from tillroll.sources.published import Conflict, Published
from tillroll.streaming import orders
from tillroll.streaming.live import LiveMart
from tillroll.streaming.orders import append_new_orders, compact_orders, loaded_orders
from tillroll.streaming.picking import OpenStarts, compact_pairs, picking_pairs, write_pairs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return Mart(spark, SMALL)


# -- invariants over the smallest data set ----------------------------------------------------


def test_returns_are_negative_amounts_and_positive_quantities(mart):
    bad = mart.sales_rows.filter(
        (F.col("return_amount") > 0) | (F.col("qty_return") < 0) | ((F.col("qty_sold") > 0) & (F.col("qty_return") > 0))
    )
    assert bad.count() == 0
    parts = mart.sales_rows.filter(F.col("sales_excl_vat") + F.col("sales_vat") != F.col("sales_amount"))
    assert parts.count() == 0


def lines_of(spark, base, lines):
    """A table folder whose receipt rows are the given (order, line, part, quantity, price, flag)."""
    folder = f"{scratch.scratch_path(spark)}-tables"
    day = F.lit("2000-05-05 00:00:00").cast(dict(base.table("lineitem").dtypes)["l_shipdate"])
    raw = spark.createDataFrame(lines, "o bigint, n int, p bigint, q double, e double, f string")
    like = {f.name: f.dataType for f in base.table("lineitem").schema.fields}
    made = {"l_orderkey": F.col("o"), "l_linenumber": F.col("n"), "l_partkey": F.col("p"), "l_suppkey": F.col("p"), "l_quantity": F.col("q"),
            "l_extendedprice": F.col("e"), "l_discount": F.lit(0.0), "l_tax": F.lit(0.0), "l_returnflag": F.col("f"), "l_linestatus": F.lit("F"), "l_shipdate": day}
    raw.select(*[(made[c] if c in made else F.lit(None)).cast(t).alias(c) for c, t in like.items()]).write.parquet(f"{folder}/lineitem.parquet")
    for name in ("orders", "customer", "part", "supplier", "nation", "region"):
        base.table(name).write.parquet(f"{folder}/{name}.parquet")
    return Mart(spark, folder)


def test_amounts_of_millions(spark, mart):
    made = lines_of(spark, mart, [(1, 1, 1, 100.0, 5_000_000.0, "N"), (1, 2, 1, 1.0, 9_999_999_999.99, "N")])
    assert rows(made.sales_rows.select("sales_amount")) == [(Decimal("5000000.00"),), (Decimal("9999999999.99"),)]


def test_each_receipt_is_one_customer(spark, mart):
    """Receipts with two lines of number 1, and with none, count once like any other."""
    orders = [r[0] for r in mart.receipts.select("receipt_id").limit(3).collect()]
    made = lines_of(spark, mart, [
        (orders[0], 1, 1, 1.0, 10.0, "N"), (orders[0], 1, 2, 1.0, 10.0, "N"), (orders[1], 3, 1, 1.0, 10.0, "N"), (orders[2], 1, 2, 1.0, 10.0, "N"), (orders[2], 1, 2, 1.0, 10.0, "N"),
    ])
    firsts = made.receipt_rows.filter("line_no = 1").groupBy("receipt_id").count()
    assert sorted(map(tuple, firsts.collect())) == sorted((o, 1) for o in orders)
    assert made.sales_rows.select("receipt_idx").distinct().count() == 5
    bags = cashiers.bags_per_customer(made.receipt_rows, made.articles, bag_group=made.articles.filter("article_idx = 1").first().lev1_id)
    assert all(r.customers >= 1 for r in bags.collect())
    assert "Window" not in made.sales_rows.select("article_idx", "sales_amount")._jdf.queryExecution().optimizedPlan().toString()


def test_a_substitute_replaces_one_line(spark, mart):
    made = lines_of(spark, mart, [(1, 1, 1, 1.0, 10.0, "N"), (1, 1, 2, 1.0, 20.0, "N"), (1, 1, 3, 1.0, 30.0, "R"), (1, 2, 4, 1.0, 40.0, "R"), (1, 3, 5, 1.0, 50.0, "R")])
    pairs = made.order_lines.filter("NOT is_substitute").join(made.order_lines.filter("is_substitute").select("order_no", "link_no", F.col("article_idx").alias("b")), ["order_no", "link_no"])
    assert rows(pairs.select("article_idx", "b")) == [(1, 3), (2, 4)]


def test_latest_cost_is_that_of_a_sold_row(spark, mart):
    order = mart.receipts.filter("tender_id = 3").first().receipt_id
    made = lines_of(spark, mart, [(order, 1, 1, 1.0, 10.0, "N"), (order, 2, 1, 1.0, 90.0, "R")])
    got = flights.collected_revenue(made.collected_orders, made.order_lines, made.sales_rows).first()
    assert got.gross_profit == got.revenue - 2 * Decimal("7.00")


def test_lottery_and_counters_meet_the_receipts(mart):
    """The branches that join the log with receipts hold values."""
    days = rec.lottery_by_day(mart.payments).join(mart.receipts.select("store_idx", "sale_date").distinct(), ["store_idx", "sale_date"])
    assert days.filter("lottery > 0").count() > 0
    counters = mart.accumulations.select("store_idx", (F.year("business_date") * 100 + F.month("business_date")).alias("znr")).distinct()
    assert counters.join(mart.system_totals.select("store_idx", "znr").distinct(), ["store_idx", "znr"]).count() > 0


def test_all_discounts_are_listed(mart):
    full = sales.discount_detail(mart.receipt_rows, mart.articles, mart.stores)
    assert full.count() > sales.discount_detail(mart.receipt_rows, mart.articles, mart.stores, cap=50).count() == 50


def test_spans_prune_the_log(mart):
    from tillroll.plans import finance

    plan = finance.pay_outs(mart.payments, ((20240105, 930), (20240121, 1745)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_chosen_stores_reduce_receipts_before_the_rows(mart):
    from tillroll.operators.filters import store_group

    chosen = store_group(mart.stores, "2,7", mart.STORE_GROUP_COLUMNS)
    plan = sales.top_articles_by_store(mart.receipt_rows, chosen, mart.articles)._jdf.queryExecution().optimizedPlan().toString()
    inner = plan.index("Join LeftSemi")
    facts = max(k for k, line in enumerate(plan.split("\n")) if "Join Inner" in line and "receipt_id" in line)
    assert plan[:inner].count("\n") > facts


def test_period_filter_reaches_the_scan(mart):
    kept = mart.sales_rows.filter(cal.within("sale_date", (dt.date(1999, 1, 1), dt.date(1999, 1, 31)))).select("article_idx")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "ReadSchema: struct<l_partkey:bigint,l_shipdate" in plan


def test_no_plan_hints_a_broadcast():
    base = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(base, "tillroll")):
        for name in files:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, name)) as f:
                    source = f.read()
                assert "broadcast(" not in source and "crossJoin" not in source and ".collect()" not in source, name


def test_three_channels_add_up(mart):
    def total(channel):
        out = flights.channel_quantities(mart.receipt_rows, mart.collected_orders, mart.order_lines, mart.articles, channel=channel)
        return {r.group_id: (r.sold, r.revenue) for r in out.collect()}

    everything, collected, other = total(0), total(1), total(2)
    for group, (sold, revenue) in everything.items():
        c = collected.get(group, (Decimal(0), Decimal(0)))
        assert (sold - c[0], revenue - c[1]) == other[group]


def test_ledger_sides_agree_per_store_and_day(mart):
    counted = rec.counted_cash_by_day(mart.counts, mart.system_totals)
    branches = rec.daily_branches(mart.receipt_rows, mart.receipts, counted, rec.lottery_by_day(mart.payments), mart.articles)
    lines = rec.account_lines(branches)
    gap = lines.groupBy("store_idx", "sale_date").agg((F.sum("debit_amount") - F.sum("credit_amount")).alias("gap"))
    assert gap.filter(F.col("gap") != 0).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_period_is_split_into_months_and_edge_days(spark, mart):
    rollup = rollups.sales_rollup(spark, scratch.scratch_path(spark))
    with pytest.raises(ValueError):
        rollup.between(dt.date(1997, 1, 1), dt.date(1997, 1, 31))
    facts = mart.sales_facts
    assert len(rollup.refresh(facts)) > 70
    for first, last in ((dt.date(1997, 1, 1), dt.date(1999, 12, 31)), (dt.date(1997, 1, 12), dt.date(1999, 12, 30)), (dt.date(1998, 2, 3), dt.date(1998, 2, 9)), (dt.date(1998, 2, 28), dt.date(1998, 3, 1))):
        got = rollup.between(first, last)
        assert "l_quantity" not in plan_of(got)
        want = sales.reduce_to(facts.filter(cal.within("sale_date", (first, last))), "article_idx", "supplier_idx", "price_type")
        keys = ["article_idx", "supplier_idx", "price_type", "quantity", "revenue_incl_vat", "gross_profit", "use_derived", "min_derived_used", "max_derived_used"]
        assert rows(sales.regroup(got, "article_idx", "supplier_idx", "price_type").select(*keys)) == rows(want.select(*keys))
    with pytest.raises(ValueError):
        rollup.between(dt.date(1997, 1, 1), dt.date(2030, 1, 1))


def test_late_row_changes_one_month(spark, mart):
    folder = scratch.scratch_path(spark)
    rollup = rollups.sales_rollup(spark, folder)
    facts = mart.sales_facts.filter(cal.within("sale_date", (dt.date(1998, 1, 1), dt.date(1998, 6, 30))))
    assert rollup.refresh(facts, "a") == [199801, 199802, 199803, 199804, 199805, 199806]
    before = Published(spark, folder).read()["months"]
    assert rollup.refresh(facts, "a") == [] and rollup.refresh(facts.filter("FALSE"), "a") == []  # the token says that nothing is new
    assert rollup.refresh(facts, "b") == []
    late = facts.filter(F.col("sale_date") == dt.date(1998, 3, 9)).limit(1)
    assert rollup.refresh(facts.union(late), "c") == [199803]
    after = Published(spark, folder).read()["months"]
    assert [m for m in after if after[m]["folder"] != before[m]["folder"]] == ["199803"]
    added = late.select(F.col("qty_sold") - F.col("qty_return")).first()[0]
    total = lambda df: df.agg(F.sum("quantity")).first()[0]
    want = facts.agg(F.sum("qty_sold") - F.sum("qty_return")).first()[0]
    assert total(rollup.between(dt.date(1998, 1, 1), dt.date(1998, 6, 30))) == want + added
    assert rollup.refresh(facts.filter(F.month("sale_date") < 6), "d") == [199803]
    assert sorted(Published(spark, folder).read()["months"]) == ["199801", "199802", "199803", "199804", "199805"]


def test_months_are_aggregated_in_pieces_from_one_exchange(spark, monkeypatch):
    """Months of more rows than a piece, with repeated rows and empty keys, by day and by month in one job."""
    monkeypatch.setattr(rollups, "PIECE_ROWS", 100)
    keys = ("if(id % 7 = 0, NULL, id % 50) AS article_idx", "id % 3 AS supplier_idx", "CAST(id % 2 AS INT) AS price_type", "if(id % 5 = 0, 'F', 'O') AS line_status")
    amounts = ("qty_sold", "qty_return", "sales_amount", "return_amount", "sales_excl_vat", "return_excl_vat", "list_amount", "cost_amount", "sales_vat", "return_vat")
    day = "date_add(DATE'1998-01-01', CAST(id % 90 AS INT)) AS sale_date"
    facts = spark.range(3000).selectExpr(day, *keys, *[f"CAST((id * {k + 3}) % 1000 / 100 AS DECIMAL(12,2)) AS {a}" for k, a in enumerate(amounts)])
    facts = facts.union(facts.limit(500))
    folder = scratch.scratch_path(spark)
    rollup = rollups.sales_rollup(spark, folder)
    assert rollup.refresh(facts) == [199801, 199802, 199803]
    place = glob.glob(f"{folder}/rolled/*")
    assert len(place) == 1 and all(len(glob.glob(f"{place[0]}/grain={g}/month_key=199802/*.parquet")) > 1 for g in ("daily", "monthly"))
    names = ["article_idx", "supplier_idx", "price_type", *sales.measures(), "use_derived", "min_derived_used", "max_derived_used"]
    for first, last in ((dt.date(1998, 1, 1), dt.date(1998, 3, 31)), (dt.date(1998, 1, 5), dt.date(1998, 3, 3)), (dt.date(1998, 2, 3), dt.date(1998, 2, 9))):
        want = sales.reduce_to(facts.filter(cal.within("sale_date", (first, last))), *names[:3]).select(*names)
        assert rows(sales.regroup(rollup.between(first, last), *names[:3]).select(*names)) == rows(want)


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def largest_task(df):
    """Rows of the largest partition."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_totals_by_cashier_are_summed_in_pieces(spark, one_partition, monkeypatch):
    folder = f"{scratch.scratch_path(spark)}-tables"
    # Every cashier has two receipts of a month and tender; one cashier is listed twice, one receipt has no cashier, one no amount.
    spark.range(4000).selectExpr(
        "id AS o_orderkey", "if(id = 7, NULL, id % 2000) AS o_custkey", "'F' AS o_orderstatus", "if(id = 9, NULL, 1.25D) AS o_totalprice",
        "timestamp_ntz'2001-03-04 00:00:00' AS o_orderdate", "concat(id % 2000 % 5 + 1, '-X') AS o_orderpriority",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(2001).selectExpr("id % 2000 AS c_custkey", "concat('C', id % 2000) AS c_name", "int(id % 2000 % 3) AS c_nationkey", "'BUILDING' AS c_mktsegment").write.parquet(f"{folder}/customer.parquet")
    whole = rows(Mart(spark, folder).system_totals)
    monkeypatch.setattr("tillroll.operators.aggregates.PIECE_GROUPS", 100, raising=False)
    totals = Mart(spark, folder).system_totals
    assert rows(totals) == whole and totals.count() == 2000 and dict(totals.dtypes)["amount"] == "decimal(22,2)"
    sums = {r.cashier_idx: (r.amount, r.transactions) for r in totals.collect()}
    assert sums[5] == (Decimal("2.50"), 2) and sums[0] == (Decimal("5.00"), 4)
    assert sums[7] == (Decimal("1.25"), 1) and sums[9] == (Decimal("1.25"), 2)
    assert largest_task(totals) < 500


def test_sketches_unite_within_their_error(spark):
    """Each value in many days and in three stores, united over part of the days."""
    days = spark.range(400_000).selectExpr("CAST(id % 3 AS INT) AS store_idx", "id % 150000 AS cashier_idx", "date_add(DATE'1998-01-01', CAST(id % 90 AS INT)) AS sale_date")
    rollup = rollups.desk_rollup(spark, scratch.scratch_path(spark))
    rollup.refresh(days)
    first, last = dt.date(1998, 1, 10), dt.date(1998, 3, 20)
    exact = {r.store_idx: (r.n, r.c) for r in days.filter(cal.within("sale_date", (first, last))).groupBy("store_idx").agg(F.count("*").alias("n"), F.countDistinct("cashier_idx").alias("c")).collect()}
    for r in rollups.desks_between(rollup, first, last).collect():
        n, c = exact[r.store_idx]
        assert r.receipts == n and abs(r.cashiers - c) < 0.02 * c


def test_zero_sale_and_sold_articles_make_the_catalogue(mart):
    revenue = flights.article_revenue(mart.receipt_rows.filter(F.col("store_idx") == 3))
    sold = flights.revenue_with_last_sold(revenue, mart.articles, mart.sales_rows, as_of=dt.date(2001, 8, 1), n=None)
    zero = flights.revenue_with_last_sold(revenue, mart.articles, mart.sales_rows, as_of=dt.date(2001, 8, 1), n=None, zero_sale=True)
    assert sold.count() + zero.count() == mart.articles.count()


def test_unknown_choices_are_refused(mart):
    with pytest.raises(ValueError):
        sales.sales_by_choice(mart.sales_rows, mart.articles, "Colour")
    with pytest.raises(ValueError):
        sales.revenue_figures(
            mart.sales_rows, mart.articles, mart.suppliers, "Colour", period=cal.Period("Y"), as_of=dt.date(2001, 8, 1)
        )


# -- hand-made frames -------------------------------------------------------------------------


def test_group_sold_only_last_year_is_left_out_of_the_year_report(spark):
    shape = "lev1_name string, " + ", ".join(
        f"{m}_{w} int" for m in ("revenue", "items", "customers") for w in ("period", "ytd", "last_year", "last_ytd")
    )
    sums = spark.createDataFrame([("a", 10, 30, 8, 20, 2, 6, 2, 5, 1, 3, 0, 2), ("b", 0, 5, 1, 1, 0, 1, 1, 1, 0, 1, 1, 1)], shape)
    got = {(r.lev1_name, r.measure): r for r in compare.year_report(sums).collect()}
    assert ("b", "1 Revenue") not in got
    assert got["a", "6 PricePerItem"].period == 5.0
    assert got["Total", "3 NoOfCustomers"].period == 1.0
    assert got["a", "4 RevenuePerCustomer"].last_year == 8.0
    assert got["Total", "1 Revenue"].ytd == 35.0


def test_start_without_stop_counts_no_time(spark):
    at = dt.datetime(2024, 1, 1, 8, 0, 0)
    log = [
        ("o1", 1, at, 40, "P1", 1), ("o1", 2, at + dt.timedelta(seconds=90), 50, "P1", 1), ("o1", 3, at + dt.timedelta(hours=1), 40, "P2", 1),
        ("o2", 4, at, 40, "P1", 1), ("o2", 5, at + dt.timedelta(seconds=30), 60, "P1", 5), ("o3", 6, at, 50, "P1", 1),
        ("o4", 7, at, 40, "P1", 1), ("o4", 8, at + dt.timedelta(seconds=40), 60, "P1", 5), ("o4", 9, at + dt.timedelta(hours=2), 40, "P1", 1),
    ]
    events = spark.createDataFrame(log, "order_no string, tracking_no bigint, created_at timestamp, status int, picker string, amount int")
    got = {(r.order_no, r.picker): r.time_used for r in picking.pick_times(events).collect()}
    assert got == {
        ("o1", "P1"): "00:01:30", ("o1", "P2"): "00:00:00", ("o1", "Total"): "00:01:30",
        # A confirmed line ends a start only where a later start of the order follows it.
        ("o2", "P1"): "00:00:00", ("o2", "Total"): "00:00:00", ("o4", "P1"): "00:00:40", ("o4", "Total"): "00:00:40",
    }


def test_age_checks_are_not_multiplied(spark):
    checks = spark.createDataFrame([(1, "a", True)] * 3 + [(1, "a", False)] * 2, "cashier_idx int, cashier_name string, approved boolean")
    got = cashiers.age_check_summary(checks).first()
    assert (got.approved_no, got.refused_no, got.total_no, got.approved_share) == (3, 2, 5, 60.0)


def test_lottery_gain_paid_out_before_it_was_won_is_open(spark):
    d = dt.date(2024, 1, 10)
    tickets = spark.createDataFrame(
        [(1, d, 90305, 50), (1, d - dt.timedelta(days=1), 90307, 50), (2, d, 90305, 70), (2, d, 90307, 70), (3, d, 90305, 2000), (4, d, 90306, 5)],
        "voucher_no int, log_date date, trans_type int, amount int",
    )
    got = cashiers.bottle_lottery(tickets, as_of=dt.date(2024, 1, 31)).first()
    assert tuple(got) == (5, 120, 2000, 2050, 0)


def test_previous_count_skips_months_without_count(spark):
    lines = spark.createDataFrame([(202405, 1, 10), (202402, 1, 4), (202401, 1, 99), (202405, 2, 6), (202405, 3, 0)], "count_no int, article_idx int, counted_qty int")
    articles = spark.createDataFrame([(i, str(i), "PCS", 2) for i in (1, 2, 3)], "article_idx int, article_id string, unit_name string, retail_price int")
    got = rows(stock.against_previous_count(lines, articles, count_no=202405))
    assert got == [("1", "PCS", 10, 20, 2.5, 2.5), ("2", "PCS", 6, 12, 0.0, 0.0)]


def _lines(spark, data, revision=None):
    shape = "store_idx int, znr int, debit_account string, credit_account string, vat_rate int, debit_amount int, credit_amount int"
    df = spark.createDataFrame(data, shape)
    return df if revision is None else df.withColumn("revision", F.lit(revision))


def test_counts_are_set_against_book_in_pieces(spark, one_partition, monkeypatch):
    n = 2000
    lines = spark.range(2 * n).selectExpr(
        "int(200101 + id div 4000) AS count_no", "id % 2000 AS article_idx", "cast(2 AS decimal(12,2)) AS in_stock_qty", "cast(if(id < 2000, 1, 2) AS decimal(12,2)) AS counted_qty", "80 AS line_status"
    )
    # 11 is a pack of six of 10; the pack 13 is one of an article that isn't known; 20 is known by two prices.
    links = spark.createDataFrame([(11, 10, 6), (13, -1, 6)], "master_idx bigint, linked_idx bigint, link_qty int").withColumn("link_qty", F.col("link_qty").cast("decimal(4,0)"))
    articles = spark.range(n + 1).selectExpr(
        "if(id = 2000, 20, id) AS article_idx", "string(if(id = 2000, 20, id)) AS article_id", "concat('n', id % 1) AS article_name", "concat('g', id % 1) AS lev3_id", "concat('G', id % 1) AS lev3_name",
        "cast(if(id = 2000, 3, 1) AS decimal(12,2)) AS retail_price",
    )
    whole = rows(stock.count_against_book(lines, links, articles, only_changed=True))
    monkeypatch.setattr("tillroll.operators.aggregates.PIECE_GROUPS", 100, raising=False)
    out = stock.count_against_book(lines, links, articles, only_changed=True)
    assert rows(out) == whole
    got = {r.article_id: (int(r.in_stock_qty), int(r.counted_qty), int(r.in_stock_value), int(r.unit_cost)) for r in out.collect()}
    assert len(got) == n - 2 and "11" not in got and "13" not in got
    assert got["5"] == (4, 3, 4, 1) and got["10"] == (28, 21, 28, 1) and got["20"] == (8, 6, 16, 3)
    groups = stock.count_against_book(lines, links, articles, by_group=True).collect()
    assert [(int(g.in_stock_qty), int(g.counted_qty)) for g in groups] == [(4 * (n + 5), 3 * (n + 5))]
    assert largest_task(out) < 500


def test_revision_sees_swapped_accounts_and_duplicates(spark):
    stored = _lines(spark, [(1, 1, "a", "", 0, 5, 0), (1, 1, "b", "", 0, 7, 0), (2, 1, "a", "", 0, 5, 0), (3, 1, "a", "", 0, 5, 0), (3, 1, "a", "", 0, 5, 0)], 4)
    new = _lines(spark, [(1, 1, "a", "", 0, 7, 0), (1, 1, "b", "", 0, 5, 0), (2, 1, "a", "", 0, 5, 0), (3, 1, "a", "", 0, 5, 0), (9, 1, "a", "", 0, 1, 0)])
    current, archived = settlements.revise(new, stored)
    assert {(r.store_idx, r.revision) for r in current.collect()} == {(1, 5), (2, 4), (3, 5), (9, 1)}
    assert sorted(r.store_idx for r in archived.collect()) == [1, 1, 3, 3]


def test_unchanged_settlement_is_not_revised(spark):
    stored = _lines(spark, [(1, 1, "a", "", 0, 5, 0)], 2)
    current, archived = settlements.revise(stored.drop("revision"), stored)
    assert rows(current) == rows(stored) and archived.count() == 0


def test_settlement_store_keeps_revisions_and_archive(spark):
    store = settlements.SettlementStore(spark, scratch.scratch_path(spark))
    a = _lines(spark, [(1, 1, "a", "", 0, 5, 0), (1, 1, "b", "", 0, 7, 0), (2, 1, "a", "", 0, 5, 0), (3, 1, "a", "", 0, 5, 0), (3, 1, "a", "", 0, 5, 0), (4, 1, "a", "", 0, 5, 0)])
    b = _lines(spark, [(1, 1, "a", "", 0, 7, 0), (1, 1, "b", "", 0, 5, 0), (2, 1, "a", "", 0, 5, 0), (3, 1, "a", "", 0, 5, 0), (9, 1, "", "c", 0, 0, 1)])
    assert store.commit(a) == 1 and {r.revision for r in store.current().collect()} == {1}
    assert store.commit(a) == 2 and store.archive().count() == 0 and store.current().count() == 6
    assert store.commit(b) == 3  # swapped amounts, a dropped duplicate, a lost and a new settlement
    assert {(r.store_idx, r.revision) for r in store.current().collect()} == {(1, 2), (2, 1), (3, 2), (9, 1)}
    assert sorted(r.store_idx for r in store.archive().collect()) == [1, 1, 3, 3, 4]
    assert store.commit(a) == 4
    assert {(r.store_idx, r.revision) for r in store.current().collect()} == {(1, 3), (2, 1), (3, 3), (4, 3)}


def test_of_two_commits_one_wins(spark):
    folder = scratch.scratch_path(spark)
    one, two = settlements.SettlementStore(spark, folder), settlements.SettlementStore(spark, folder)
    base = one.version()
    one.commit(_lines(spark, [(1, 1, "a", "", 0, 5, 0)]), base)
    with pytest.raises(Conflict):
        two.commit(_lines(spark, [(1, 1, "a", "", 0, 6, 0)]), base)
    assert [r.debit_amount for r in two.current().collect()] == [5]


def test_week_file_counts_articles_listed_twice_on_one_line(spark):
    """Lines come once for each key, before and after the file's text is made; no line is copied for the sums."""
    names = ["receipt_id", "line_no", "store_idx", "sale_date", "article_idx", "supplier_idx", "list_amount", "sales_amount", "sales_excl_vat", "return_excl_vat", "cost_amount", "qty_sold", "qty_return", "sales_vat", "return_vat"]
    sold = [(1, 1, 7, dt.date(1999, 5, 4), 5, 1, 3, 3, 2, 0, 1, 2, 0, 1, 0), (2, 1, 7, dt.date(1999, 5, 5), 5, 1, 3, 3, 2, 0, 1, 2, 0, 1, 0), (2, 2, 7, dt.date(1999, 5, 5), 6, 1, 4, 3, 2, 0, 1, 2, 0, 1, 0), (3, 1, 7, None, 6, 1, None, 3, 2, 0, 1, 2, 0, 1, 0)]
    facts = spark.createDataFrame(sold, ", ".join(f"{n} {'date' if n == 'sale_date' else 'int'}" for n in names))
    facts = facts.select(*names[:6], *[F.col(n).cast("decimal(12,2)").alias(n) for n in names[6:]])
    goods = [(5, "5", "five", "A", "L", 3), (5, "5", "five", "A", "PCS", 1), (6, "6", "six", "A", "L", None)]
    articles = spark.createDataFrame(goods, "article_idx int, gtin string, article_name string, lev1_id string, unit_name string, unit_amount int").withColumn("unit_amount", F.col("unit_amount").cast("decimal(8,2)"))
    lines = exports.week_sales_lines(facts, articles)
    assert lines.count() == lines.select("store_idx", "week", "report_code", "article_idx", "supplier_idx").distinct().count() == 3
    report = exports.report_lines(lines)
    assert "Expand" not in plan_of(report)
    got = sorted(r.line for r in report.filter("week IS NOT NULL").collect())
    assert got == [
        "OTU,7,1999050918,SUM,10.00,5.00,16.00,4,5.00", "OVUN,7,1999050918,P,5,8.00,4.00,16.00,4,4.00,1,A,five", "OVUT,7,1999050918,P,6,2.00,1.00,,0,1.00,1,A,six", "RIGAL95,6.0",
    ]


def test_most_specific_posting_rule_wins(spark):
    found = spark.createDataFrame(
        [(1, 1, "sale", None, 8, "PROMO", 10), (1, 1, "sale", None, 8, "X", 20), (1, 1, "sale", None, 3, "PROMO", 30), (1, 1, "sale", None, 3, None, 40), (1, 1, "payment", 1, None, None, 60), (1, 1, "payment", 2, None, None, 5), (1, 1, "difference", None, None, None, -35)],
        "store_idx int, znr int, kind string, tender_id int, vat_rate int, department string, amount int",
    ).withColumn("amount", F.col("amount").cast("decimal(24,2)"))
    rules = spark.createDataFrame(
        [(1, "sale", None, None, None, "all"), (2, "sale", None, 8, None, "vat"), (3, "sale", None, None, "PROMO", "dep"), (4, "sale", None, 8, "PROMO", "both"), (5, "payment", 1, None, None, "cash"), (6, "difference", None, None, None, "diff"), (7, "sale", None, 8, None, "later")],
        "rule_no int, kind string, tender_id int, vat_rate int, department string, account string",
    )
    got = {(r.kind, r.tender_id, r.vat_rate, r.department): r.account for r in settlements.account_of(found, rules).collect()}
    assert got == {
        ("sale", None, 8, "PROMO"): "both", ("sale", None, 8, "X"): "vat", ("sale", None, 3, "PROMO"): "dep", ("sale", None, 3, None): "all",
        ("payment", 1, None, None): "cash", ("payment", 2, None, None): "?", ("difference", None, None, None): "diff",
    }
    sums = settlements.posted_lines(found, rules).agg(F.sum("debit_amount"), F.sum("credit_amount")).first()
    assert sums[0] == sums[1] == 100


def test_posted_lines_balance(mart):
    rules = mart.spark.createDataFrame([(1, k, None, None, None, k) for k in ("sale", "payment", "difference")], "rule_no int, kind string, tender_id int, vat_rate int, department string, account string")
    lines = settlements.posted_lines(settlements.postings(mart.receipts, mart.receipt_rows, mart.articles), rules)
    assert settlements.debit_equals_credit(lines).filter("approved = 0").count() == 0
    assert lines.select("vat_rate").distinct().count() > 5


# -- files ------------------------------------------------------------------------------------


def test_report_file_order(spark):
    lines = spark.createDataFrame([(1, "w", 2, "OVUN,b"), (1, "w", 3, "OTU"), (1, "w", 1, "HEAD"), (1, "w", 2, "OVUT,a"), (2, "w", 1, "HEAD")], "store_idx int, week string, part int, line string")
    path = scratch.scratch_path(spark)
    sinks.write_report_lines(lines, path)
    folder = os.path.join(path.replace("file:", ""), "store_idx=1")
    content = [open(os.path.join(folder, f)).read().split() for f in os.listdir(folder) if f.endswith(".txt")]
    assert content == [["HEAD", "OVUT,a", "OVUN,b", "OTU"]]


def test_export_round_trip_with_blanks_and_separators(spark):
    df = spark.createDataFrame([("a;b", None, 1), ("c", "", 2)], "x string, y string, n int")
    path = scratch.scratch_path(spark)
    sinks.export_csv(df, path)
    back = spark.read.schema(df.schema).options(sep=";", header=True).csv(path)
    assert rows(back.select("x", "n")) == [("a;b", 1), ("c", 2)]


def test_revision_write_keeps_the_old_state(spark):
    stored, new = _lines(spark, [(1, 1, "a", "", 0, 5, 0)], 1), _lines(spark, [(1, 1, "a", "", 0, 6, 0)])
    base = scratch.scratch_path(spark)
    current = sinks.write_revision(new, stored, f"{base}/r2", f"{base}/log")
    assert [r.revision for r in current.collect()] == [2]
    assert rows(spark.read.parquet(f"{base}/log").select("debit_amount", "revision")) == [(5, 1)]


def test_file_name():
    assert sinks.export_name("17", dt.date(2021, 2, 3)) == "sales_17_20210203.csv"


def test_empty_result_has_a_schema(spark):
    assert loads.empty_like(spark, "a string, b int").dtypes == [("a", "string"), ("b", "int")]


def test_inline_table_has_a_known_size(spark):
    plan = inline_table(spark, {"a": [1, 2]})._jdf.queryExecution().optimizedPlan()
    assert "LocalRelation" in plan.toString()


# -- streams ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def event_files(spark, mart):
    """The event log in files that arrive one after the other."""
    folder = scratch.scratch_path(spark).replace("file:", "")
    log = mart.table("events")
    third = log.count() // 3 + 1
    for i in range(3):
        part = log.filter(F.floor(F.col("event_id") / third) == i).coalesce(1)
        part.write.parquet(f"{folder}/part{i}")
    os.makedirs(f"{folder}/live")
    for i in range(3):
        name = next(f for f in os.listdir(f"{folder}/part{i}") if f.endswith(".parquet"))
        target = f"{folder}/live/events-{i}.parquet"
        with open(f"{folder}/part{i}/{name}", "rb") as src, open(target, "wb") as out:
            out.write(src.read())
        os.utime(target, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
    return f"{folder}/live"


def test_orders_are_loaded_once_over_several_batches(spark, mart, event_files):
    live = LiveMart(spark, event_files, "events-*.parquet", files_per_batch=1)
    base = scratch.scratch_path(spark)
    for _ in range(2):  # a second run finds nothing new
        append_new_orders(live.order_events, f"{base}/orders", f"{base}/state").awaitTermination()
    got = loaded_orders(spark, f"{base}/orders")
    batch = mart.order_events.groupBy("order_no").agg(F.min("tracking_no").alias("tracking_no"))
    assert rows(got.select("order_no", "tracking_no")) == rows(batch)


def test_a_new_checkpoint_adds_to_what_is_loaded(spark, mart, event_files):
    base = scratch.scratch_path(spark)
    for k, pattern in enumerate(("events-[01].parquet", "events-*.parquet")):
        live = LiveMart(spark, event_files, pattern, files_per_batch=1)
        append_new_orders(live.order_events, f"{base}/orders", f"{base}/state{k}").awaitTermination()
    batch = mart.order_events.groupBy("order_no").agg(F.min("tracking_no").alias("tracking_no"))
    assert rows(loaded_orders(spark, f"{base}/orders").select("order_no", "tracking_no")) == rows(batch)


@pytest.fixture(scope="module")
def small_log(spark):
    """Twelve files of forty orders, each order started in one file and stopped in a later one."""
    folder = scratch.scratch_path(spark).replace("file:", "")
    os.makedirs(folder)
    at = dt.datetime(2024, 1, 1, 8)
    shape = "order_no string, tracking_no bigint, created_at timestamp, status int, picker string"
    for n in range(12):
        lines = [(f"n{n}-{k}", 1000 * n + k, at + dt.timedelta(days=n), 40, "P") for k in range(40)]
        lines += [(f"n{n - 2}-{k}", 1000 * n + 500 + k, at + dt.timedelta(days=n, seconds=k), 50, "P") for k in range(0, 40, 2) if n > 1]
        spark.createDataFrame(lines, shape).coalesce(1).write.parquet(f"{folder}/_{n}")
        name = next(f for f in os.listdir(f"{folder}/_{n}") if f.endswith(".parquet"))
        os.rename(f"{folder}/_{n}/{name}", f"{folder}/log-{n:02d}.parquet")
        os.utime(f"{folder}/log-{n:02d}.parquet", (1_700_000_000 + n * 60,) * 2)

    def read(pattern="log-*.parquet", files=1):
        return spark.readStream.schema(shape).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).parquet(folder)

    return read


def test_orders_with_starts_only_read_no_state():
    """Starts join those that wait without a read; a stop closes all that wait, those of the same batch after it excepted."""
    class Waiting:
        rows, reads = [], 0

        def get(self):
            self.reads += 1
            return iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def appendList(self, rows):
            self.rows = [*self.rows, *rows]

        def clear(self):
            self.rows = []

    class Handle:
        def getListState(self, name, shape):
            return Waiting()

    def line(number, status):
        return Row(tracking_no=number, created_at=dt.datetime(2024, 1, 1, 8, number), status=status)

    def batch(*lines):
        return [(r.tracking_no, r.stopped_at and r.stopped_at.minute) for r in starts.handleInputRows(("a",), iter(lines), None)]

    starts = OpenStarts()
    starts.init(Handle())
    assert batch(line(2, 40), line(1, 40)) == [(1, None), (2, None)] and batch(line(3, 40)) == [(3, None)] and starts._open.reads == 0
    assert batch(line(5, 40), line(4, 50)) == [(1, 4), (2, 4), (3, 4), (5, None)] and starts._open.reads == 1
    assert [r[0] for r in starts._open.rows] == [5] and batch(line(6, 50)) == [(5, 6)] and starts._open.rows == []


def test_first_lines_are_picked_in_parts():
    """One line for each order whatever the batches, the smallest number first, that of a loaded order before all others."""
    import pyarrow as pa

    def batch(*lines):
        return pa.RecordBatch.from_pylist([dict(zip(("order_no", "tracking_no", "loaded"), r)) for r in lines], pa.schema({"order_no": pa.string(), "tracking_no": pa.int64(), "loaded": pa.bool_()}))

    orders.GATHERED, before = 2, orders.GATHERED
    try:
        parts = [batch(("b", 4, False), ("a", 9, False), ("a", 3, False)), batch(), batch(("a", 2, False), ("c", 7, False)), batch(("b", None, True), ("c", 8, False)), batch(("d", 1, False))]
        got = pa.Table.from_batches(orders.first_lines(iter(parts)), parts[0].schema).to_pylist()
    finally:
        orders.GATHERED = before
    assert [tuple(r.values()) for r in got] == [("a", 2, False), ("b", None, True), ("c", 7, False), ("d", 1, False)]
    assert list(orders.first_lines(iter([batch()]))) == []


def test_batches_of_the_order_load_cost_their_own_lines(spark, small_log):
    base = scratch.scratch_path(spark)
    stream = append_new_orders(small_log(), f"{base}/orders", f"{base}/state")
    stream.awaitTermination()
    progress = [p for p in stream.recentProgress if p["numInputRows"]]
    assert len(progress) == 12 and [p["numInputRows"] for p in progress][2:] == [60] * 10
    # State is updated for the orders of the batch only, whatever is loaded: none is read or written beside them.
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in progress] == [40] * 12
    assert loaded_orders(spark, f"{base}/orders").count() == 480 == loaded_orders(spark, f"{base}/orders").select("order_no").distinct().count()
    before = rows(loaded_orders(spark, f"{base}/orders"))
    assert compact_orders(spark, f"{base}/orders") >= 11 and compact_orders(spark, f"{base}/orders") == 0
    assert rows(loaded_orders(spark, f"{base}/orders")) == before
    # A new checkpoint starts from what is loaded, compacted or not, and adds nothing twice.
    append_new_orders(small_log(files=6), f"{base}/orders", f"{base}/state2").awaitTermination()
    assert rows(loaded_orders(spark, f"{base}/orders")) == before


def test_a_new_checkpoint_of_the_pairs_loses_nothing(spark, small_log):
    base = scratch.scratch_path(spark)
    write_pairs(small_log("log-0[0-7].parquet"), f"{base}/pairs", f"{base}/state").awaitTermination()
    part = rows(picking_pairs(spark, f"{base}/pairs").filter("stopped_at IS NOT NULL"))
    write_pairs(small_log(files=5), f"{base}/pairs", f"{base}/state2").awaitTermination()
    assert compact_pairs(spark, f"{base}/pairs") > 5
    got = picking_pairs(spark, f"{base}/pairs")
    assert set(part) <= set(rows(got)) and got.count() == 480 and got.filter("stopped_at IS NOT NULL").count() == 200
    assert got.filter("stopped_at < started_at").count() == 0


def test_starts_are_given_up_after_the_patience(spark, small_log):
    base = scratch.scratch_path(spark)
    stream = write_pairs(small_log(), f"{base}/pairs", f"{base}/state", patience="36 hours")
    stream.awaitTermination()
    got = picking_pairs(spark, f"{base}/pairs")
    assert got.count() == 480 and got.filter("stopped_at IS NOT NULL").count() < 200
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in stream.recentProgress if p["stateOperators"]]
    assert kept[-1] < 480


def test_two_writers_cannot_both_publish(spark):
    folder = scratch.scratch_path(spark)
    a, b = Published(spark, folder), Published(spark, folder)
    assert a.version() == b.version() == 0 and a.read() == {}
    assert a.publish(0, {"rows": "x"}) == 1
    with pytest.raises(Conflict):
        b.publish(0, {"rows": "y"})
    assert b.publish(1, {"rows": "z"}) == 2 and a.read() == {"rows": "z"} and a.read(1) == {"rows": "x"}
    assert a.children("_versions") == ["v0000000001.json", "v0000000002.json"]


def test_streamed_pairs_equal_batch_pairs(spark, mart, event_files):
    live = LiveMart(spark, event_files, "events-*.parquet", files_per_batch=1)
    base = scratch.scratch_path(spark)
    write_pairs(live.order_events, f"{base}/pairs", f"{base}/state").awaitTermination()
    got = picking_pairs(spark, f"{base}/pairs")
    batch = picking.start_stop_pairs(mart.order_events)
    same = batch.select("order_no", "tracking_no", F.col("stopped_at").cast("timestamp_ntz").alias("stopped_at"))
    assert rows(got.select("order_no", "tracking_no", "stopped_at")) == rows(same)
    assert got.filter("stopped_at IS NULL").count() > 0
