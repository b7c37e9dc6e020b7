"""Aggregation, windows, ranking, reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.functions.money import in_home_currency, net_amount_sum, net_qty_sum, safe_div
from tillroll.operators import aggregates as agg, ranking, reshape
from tillroll.plans.rollups import desks_between
from tillroll.sources.mart import AS_OF, EVENTS_AS_OF, Mart


@query("a01_grouped_sums", """
    SELECT article_idx, supplier_idx, price_type, sum(qty_sold)::DOUBLE AS qty_sold, sum(qty_return)::DOUBLE AS qty_return,
           sum(sales_amount)::DOUBLE AS sales_amount, sum(return_amount)::DOUBLE AS return_amount
    FROM sales_row GROUP BY article_idx, supplier_idx, price_type""")
def _(m: Mart) -> DataFrame:
    return m.sales_rows.groupBy("article_idx", "supplier_idx", "price_type").agg(
        *[F.sum(c).alias(c) for c in ("qty_sold", "qty_return", "sales_amount", "return_amount")]
    )


@query("a02_conditional_sums", """
    SELECT store_idx, sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END)::DOUBLE AS cash,
           sum(CASE WHEN tender_id IN (3, 5) THEN amount ELSE 0 END)::DOUBLE AS cards,
           sum(CASE WHEN tender_id = 8 AND exchange_rate > 11 THEN amount END)::DOUBLE AS dear_currency
    FROM receipt GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    tender = F.col("tender_id")
    return m.receipts.groupBy("store_idx").agg(
        *agg.conditional_sums({"cash": tender == 1, "cards": tender.isin(3, 5)}, "amount"),
        *agg.conditional_sums({"dear_currency": (tender == 8) & (F.col("exchange_rate") > 11)}, "amount", None),
    )


def part_attributes(m: Mart) -> DataFrame:
    """Article attributes as key/value rows."""
    wide = m.articles.select("article_idx", "brand_id", F.col("lev1_id").alias("group"), "unit_name", F.col("age_limit").cast("string").alias("age"))
    return wide.unpivot("article_idx", ["brand_id", "group", "unit_name", "age"], "key", "value")


@query("a03_attributes_wide", """
    SELECT article_idx, brand_id AS brand_id, lev1_id AS "group", unit_name, CAST(age_limit AS VARCHAR) AS age FROM article""")
def _(m: Mart) -> DataFrame:
    return agg.attributes_wide(part_attributes(m), ["article_idx"], "key", "value", ["brand_id", "group", "unit_name", "age"])


@query("a04_pivot", """
    SELECT store_idx, till_id, sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END)::DOUBLE AS "1",
           sum(CASE WHEN tender_id = 3 THEN amount ELSE 0 END)::DOUBLE AS "3",
           sum(CASE WHEN tender_id = 6 THEN amount ELSE 0 END)::DOUBLE AS "6"
    FROM receipt GROUP BY store_idx, till_id""")
def _(m: Mart) -> DataFrame:
    return agg.pivot_sums(m.receipts, ["store_idx", "till_id"], "tender_id", [1, 3, 6], "amount")


@query("a05_subtotals", """
    SELECT lev1_id, CASE WHEN grouping(lev2_id) = 1 THEN 'Total' ELSE lev2_id END AS lev2_id,
           sum(sales_amount + return_amount)::DOUBLE AS revenue
    FROM sales_row JOIN article USING (article_idx) GROUP BY ROLLUP (lev1_id, lev2_id) HAVING grouping(lev1_id) = 0""")
def _(m: Mart) -> DataFrame:
    per_article = m.sales_rows.groupBy("article_idx").agg(net_amount_sum().alias("revenue"))
    groups = per_article.join(m.articles, "article_idx")
    return agg.subtotals(groups, "lev1_id", "lev2_id", [F.sum("revenue").alias("revenue")])


@query("a06_count_distinct", """
    SELECT store_idx, count(DISTINCT receipt_id) AS receipts, count(DISTINCT (till_id, cashier_idx)) AS desks
    FROM receipt GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    return m.receipts.groupBy("store_idx").agg(
        agg.count_distinct("receipt_id").alias("receipts"), agg.count_distinct("till_id", "cashier_idx").alias("desks")
    )


@query("a06_distinct_over_stored_sketches", """
    SELECT store_idx, count(*) AS receipts, count(DISTINCT cashier_idx) AS cashiers FROM receipt
    WHERE sale_date BETWEEN DATE '1996-05-20' AND DATE '1996-09-10' GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    return desks_between(m.desk_rollup, dt.date(1996, 5, 20), dt.date(1996, 9, 10))


@query("a07_string_aggregation", """
    SELECT lev1_region_name, string_agg(DISTINCT store_name, ', ' ORDER BY store_name) AS stores FROM store GROUP BY lev1_region_name""")
def _(m: Mart) -> DataFrame:
    return m.stores.groupBy("lev1_region_name").agg(agg.distinct_text("store_name").alias("stores"))


@query("a08_having", """
    SELECT article_idx, sum(qty_sold - qty_return)::DOUBLE AS qty FROM sales_row GROUP BY article_idx
    HAVING sum(sales_amount + return_amount) < 0""")
def _(m: Mart) -> DataFrame:
    grouped = m.sales_rows.groupBy("article_idx").agg(net_qty_sum().alias("qty"), net_amount_sum().alias("revenue"))
    return grouped.filter(F.col("revenue") < 0).drop("revenue")


_CHOICE = """SELECT '{name}' AS choice, {ident} AS id, sum(sales_amount + return_amount)::DOUBLE AS revenue
             FROM sales_row JOIN article USING (article_idx) GROUP BY 2"""


@query("a09_group_by_choice", " UNION ALL ".join(
    _CHOICE.format(name=n, ident=i)
    for n, i in (
        ("Lev1ArticleHierarchy", "lev1_id"), ("Lev2ArticleHierarchy", "lev2_id"), ("Manufacturer", "brand_id"),
        ("LeafArticleHierarchy", "CASE num_levels WHEN 1 THEN lev1_id WHEN 2 THEN lev2_id ELSE lev3_id END"),
    )
))
def _(m: Mart) -> DataFrame:
    from tillroll.plans.sales import sales_by_choice

    parts = [
        sales_by_choice(m.sales_rows, m.articles, name).groupBy(F.lit(name).alias("choice"), "id").agg(
            F.sum("revenue_incl_vat").alias("revenue")
        )
        for name in ("Lev1ArticleHierarchy", "Lev2ArticleHierarchy", "Manufacturer", "LeafArticleHierarchy")
    ]
    return reshape.union_rows(*parts)


@query("a10_collapsed_level", """
    SELECT store_idx, CAST(NULL AS VARCHAR) AS till_id, sum(amount)::DOUBLE AS amount FROM receipt GROUP BY store_idx
    UNION ALL SELECT store_idx, till_id, sum(amount)::DOUBLE FROM receipt GROUP BY store_idx, till_id""")
def _(m: Mart) -> DataFrame:
    def by(keep: bool) -> DataFrame:
        till = F.col("till_id") if keep else F.lit(None).cast("string")
        return m.receipts.groupBy("store_idx", till.alias("till_id")).agg(F.sum("amount").alias("amount"))

    return by(False).unionByName(by(True))


@query("a11_two_steps", """
    SELECT till_id, count(*) AS receipts, sum(qty)::DOUBLE AS qty, max(qty)::DOUBLE AS largest
    FROM (SELECT receipt_id, till_id, sum(qty_sold - qty_return) AS qty FROM receipt_row GROUP BY receipt_id, till_id) GROUP BY till_id""")
def _(m: Mart) -> DataFrame:
    per_receipt = m.sales_rows.groupBy("receipt_id").agg(net_qty_sum().alias("qty"))
    return per_receipt.join(m.receipts, "receipt_id").groupBy("till_id").agg(
        F.count("*").alias("receipts"), F.sum("qty").alias("qty"), F.max("qty").alias("largest")
    )


@query("a12_first_and_last_value", """
    SELECT article_idx, first_qty::DOUBLE AS first_qty, last_qty::DOUBLE AS last_qty FROM (
        SELECT DISTINCT article_idx,
               first_value(counted_qty) OVER (PARTITION BY article_idx ORDER BY count_no, counted_qty) AS first_qty,
               first_value(counted_qty) OVER (PARTITION BY article_idx ORDER BY count_no DESC, counted_qty DESC) AS last_qty
        FROM count_line)""")
def _(m: Mart) -> DataFrame:
    return m.count_lines.groupBy("article_idx").agg(
        agg.at_extreme("counted_qty", ["count_no"], last=False).alias("first_qty"),
        agg.at_extreme("counted_qty", ["count_no"], last=True).alias("last_qty"),
    )


@query("a13_rows_at_group_maximum", """
    SELECT c.store_idx, c.znr, c.till_id, c.count_no, sum(c.amount)::DOUBLE AS amount FROM counting c
    JOIN (SELECT store_idx, znr, till_id, max(count_no) AS last_no FROM counting GROUP BY ALL) x
      ON x.store_idx = c.store_idx AND x.znr = c.znr AND x.till_id = c.till_id AND x.last_no = c.count_no
    GROUP BY c.store_idx, c.znr, c.till_id, c.count_no""")
def _(m: Mart) -> DataFrame:
    keys = ["store_idx", "znr", "till_id"]
    per_count = m.counts.groupBy(*keys, "count_no").agg(F.sum("amount").alias("amount"))
    return agg.latest_rows(per_count, keys, ["count_no"], ["count_no", "amount"])


@query("a14_grand_total", """
    SELECT lev1_id, sum(sales_amount + return_amount)::DOUBLE AS revenue, count(*) AS row_count
    FROM sales_row JOIN article USING (article_idx) GROUP BY lev1_id
    UNION ALL SELECT 'Total', sum(sales_amount + return_amount)::DOUBLE, count(*) FROM sales_row""")
def _(m: Mart) -> DataFrame:
    per_article = m.sales_rows.groupBy("article_idx").agg(net_amount_sum().alias("revenue"), F.count("*").alias("row_count"))
    groups = per_article.join(m.articles, "article_idx")
    return agg.with_grand_total(groups, ["lev1_id"], [F.sum(c).alias(c) for c in ("revenue", "row_count")]).drop("is_total")


@query("a15_ratios", """
    SELECT article_idx,
           coalesce(sum(sales_amount + return_amount)::DOUBLE / nullif(sum(qty_sold - qty_return)::DOUBLE, 0), 0) AS avg_price,
           (sum(sales_excl_vat + return_excl_vat) - sum(cost_amount))::DOUBLE / nullif(sum(sales_excl_vat + return_excl_vat)::DOUBLE, 0) AS margin,
           sum(return_amount)::DOUBLE / coalesce(nullif(sum(sales_amount)::DOUBLE, 0), 1) AS return_share
    FROM sales_row GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    net = net_amount_sum("sales_excl_vat", "return_excl_vat")
    return m.sales_rows.groupBy("article_idx").agg(
        safe_div(net_amount_sum(), net_qty_sum()).alias("avg_price"),
        safe_div(net - F.sum("cost_amount"), net, "null").alias("margin"),
        safe_div(F.sum("return_amount"), F.sum("sales_amount"), "one").alias("return_share"),
    )


@query("a16_flag_combination", """
    SELECT article_idx, min(u) + min(d) + max(d) AS config FROM (
        SELECT article_idx, (line_status = 'F')::BIGINT AS u, (price_type = 0)::BIGINT AS d FROM sales_row) GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.sales import price_source_sum, reduce_to

    return reduce_to(m.sales_rows, "article_idx").select("article_idx", price_source_sum().alias("config"))


@query("a17_latest_state", """
    SELECT voucher_no, sum(CASE WHEN trans_type = 90305 THEN amount END)::DOUBLE AS gain FROM bottle GROUP BY voucher_no
    HAVING count(CASE WHEN trans_type = 90305 THEN 1 END) > 0
       AND coalesce(max(CASE WHEN trans_type = 90307 THEN log_date END) < min(CASE WHEN trans_type = 90305 THEN log_date END), TRUE)""")
def _(m: Mart) -> DataFrame:
    kind = F.col("trans_type")
    state = m.bottle_receipts.groupBy("voucher_no").agg(
        F.sum(F.when(kind == 90305, F.col("amount"))).alias("gain"),
        F.min(F.when(kind == 90305, F.col("log_date"))).alias("won"),
        F.max(F.when(kind == 90307, F.col("log_date"))).alias("paid"),
    )
    still_open = F.col("paid").isNull() | (F.col("paid") < F.col("won"))
    return state.filter(F.col("won").isNotNull() & still_open).select("voucher_no", "gain")


@query("a18_ageing_buckets", """
    SELECT cashier_idx, sum(CASE WHEN DATE '2024-01-31' - log_date < 10 THEN amount ELSE 0 END)::DOUBLE AS recent,
           sum(CASE WHEN DATE '2024-01-31' - log_date >= 10 THEN amount ELSE 0 END)::DOUBLE AS old,
           sum(CASE WHEN amount < 100 THEN amount ELSE 0 END)::DOUBLE AS small, sum(CASE WHEN amount >= 100 THEN amount ELSE 0 END)::DOUBLE AS large
    FROM bottle GROUP BY cashier_idx""")
def _(m: Mart) -> DataFrame:
    age = F.datediff(F.lit(EVENTS_AS_OF), "log_date")
    return m.bottle_receipts.groupBy("cashier_idx").agg(
        *agg.conditional_sums(
            {"recent": age < 10, "old": age >= 10, "small": F.col("amount") < 100, "large": F.col("amount") >= 100}, "amount"
        )
    )


@query("a19_home_currency", """
    SELECT store_idx, sum(amount * CASE WHEN exchange_rate = 0 THEN 1 ELSE exchange_rate END)::DOUBLE AS home_amount
    FROM receipt GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    return m.receipts.groupBy("store_idx").agg(F.sum(in_home_currency("amount", "exchange_rate")).alias("home_amount"))


@query("a20_correlated_count", """
    SELECT a.order_no, a.line_no, a.article_idx, (SELECT count(*) FROM order_line b WHERE b.order_no = a.order_no AND b.link_no = a.link_no
        AND b.is_substitute) AS substitutes
    FROM order_line a WHERE a.line_status = 10""")
def _(m: Mart) -> DataFrame:
    found = m.order_lines.filter("is_substitute").groupBy("order_no", "link_no").agg(F.count("*").alias("substitutes"))
    open_lines = m.order_lines.filter(F.col("line_status") == 10).select("order_no", "line_no", "link_no", "article_idx")
    return open_lines.join(found, ["order_no", "link_no"], "left").drop("link_no").fillna(0, ["substitutes"])


@query("a21_counts_with_sums", """
    SELECT tender_id, sub_tender_id, count(*) AS payments, sum(amount)::DOUBLE AS amount FROM payment GROUP BY tender_id, sub_tender_id""")
def _(m: Mart) -> DataFrame:
    return m.payments.groupBy("tender_id", "sub_tender_id").agg(F.count("*").alias("payments"), F.sum("amount").alias("amount"))


@query("a22_report_totals", """
    WITH d AS (SELECT lev1_id, CAST(strftime(sale_date, '%Y%m') AS INTEGER) AS month_no, sum(sales_amount + return_amount) AS revenue
               FROM sales_row JOIN article USING (article_idx) GROUP BY ALL)
    SELECT lev1_id, month_no, revenue::DOUBLE AS revenue,
           (sum(revenue) OVER (PARTITION BY lev1_id ORDER BY month_no ROWS UNBOUNDED PRECEDING))::DOUBLE AS running,
           (min(revenue) OVER (PARTITION BY lev1_id))::DOUBLE AS lowest, (max(revenue) OVER (PARTITION BY lev1_id))::DOUBLE AS highest
    FROM d""")
def _(m: Mart) -> DataFrame:
    from pyspark.sql import Window

    month = (F.year("sale_date") * 100 + F.month("sale_date")).alias("month_no")
    per_month = m.sales_rows.groupBy("article_idx", month).agg(net_amount_sum().alias("revenue")).join(m.articles, "article_idx").groupBy(
        "lev1_id", "month_no"
    ).agg(F.sum("revenue").alias("revenue"))
    group = Window.partitionBy("lev1_id")
    running = agg.running_total(per_month, ["lev1_id"], ["month_no"], "revenue", "running")
    return running.select("*", F.min("revenue").over(group).alias("lowest"), F.max("revenue").over(group).alias("highest"))


@query("a23_distinct_rows", "SELECT DISTINCT store_idx, till_id, tender_id, currency FROM receipt")
def _(m: Mart) -> DataFrame:
    return m.receipts.select("store_idx", "till_id", "tender_id", "currency").distinct()


# -- W ----------------------------------------------------------------------------------------


@query("w01_latest_count", """
    SELECT store_idx, znr, till_id, tender_id, count_no, amount::DOUBLE AS amount, bag_id FROM (
        SELECT *, row_number() OVER (PARTITION BY store_idx, znr, till_id, tender_id ORDER BY count_no DESC) AS rn FROM counting) WHERE rn = 1""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.reconciliation import last_counts

    return last_counts(m.counts).drop("counted_by")


@query("w02_last_sale", """
    SELECT article_id, max(sale_date)::VARCHAR AS last_sold FROM article a
    LEFT JOIN sales_row s ON s.article_idx = a.article_idx GROUP BY article_id""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.flights import last_sold

    return last_sold(m.articles, m.sales_rows).select("article_id", "last_sold")


@query("w03_days_since_last_sale", """
    SELECT article_idx, DATE '2001-08-01' - max(sale_date) AS days_since FROM sales_row GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    last = m.sales_rows.groupBy("article_idx").agg(F.max("sale_date").alias("last"))
    return last.select("article_idx", F.datediff(F.lit(AS_OF), "last").alias("days_since"))


@query("w04_elapsed_seconds", """
    SELECT order_no, tracking_no, date_diff('second', created_at, (SELECT min_by(p.created_at, p.tracking_no) FROM order_event p
           WHERE p.order_no = s.order_no AND p.status = 50 AND p.tracking_no > s.tracking_no)) AS seconds
    FROM order_event s WHERE status = 40""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.picking import start_stop_pairs

    return start_stop_pairs(m.order_events).select(
        "order_no", "tracking_no", (F.unix_timestamp("stopped_at") - F.unix_timestamp("created_at")).alias("seconds")
    )


# -- L ----------------------------------------------------------------------------------------

_ARTICLE_TOTALS = """SELECT article_id, sum(qty_sold - qty_return) AS sold_qty, sum(sales_excl_vat + return_excl_vat) AS net_sales,
    sum(sales_excl_vat + return_excl_vat - cost_amount) AS gross_profit FROM sales_row JOIN article USING (article_idx) GROUP BY article_id"""


def article_totals(m: Mart) -> DataFrame:
    from tillroll.plans.sales import reduce_to

    return reduce_to(m.sales_rows, "article_idx").join(m.articles, "article_idx").select(
        "article_id", F.col("quantity").alias("sold_qty"), F.col("revenue").alias("net_sales"), "gross_profit"
    )


@query("l01_top_n", f"""
    SELECT article_id, sold_qty::DOUBLE AS sold_qty, net_sales::DOUBLE AS net_sales, gross_profit::DOUBLE AS gross_profit
    FROM ({_ARTICLE_TOTALS}) ORDER BY sold_qty DESC, article_id LIMIT 50""")
def _(m: Mart) -> DataFrame:
    return ranking.top_by_name(article_totals(m), "TopQuantity", 50, ["article_id"])


@query("l02_bottom_n", f"""
    SELECT article_id, sold_qty::DOUBLE AS sold_qty, net_sales::DOUBLE AS net_sales, gross_profit::DOUBLE AS gross_profit
    FROM ({_ARTICLE_TOTALS}) ORDER BY gross_profit ASC NULLS LAST, article_id LIMIT 50""")
def _(m: Mart) -> DataFrame:
    return ranking.top_by_name(article_totals(m), "LowGrossProfit", 50, ["article_id"])


@query("l03_top_then_sort", f"""
    SELECT article_id, net_sales::DOUBLE AS net_sales FROM (SELECT * FROM ({_ARTICLE_TOTALS}) ORDER BY net_sales DESC, article_id LIMIT 100)
    ORDER BY article_id""")
def _(m: Mart) -> DataFrame:
    return ranking.top_then_sort(article_totals(m), "net_sales", 100, ["article_id"], ["article_id"]).select("article_id", "net_sales")


@query("l04_zero_sale", """
    SELECT article_id, article_name FROM article WHERE article_idx NOT IN (
        SELECT article_idx FROM receipt_row WHERE store_idx = 4 AND sale_date >= DATE '2000-01-01')""")
def _(m: Mart) -> DataFrame:
    import datetime as dt

    sold = m.receipt_rows.filter((F.col("store_idx") == 4) & (F.col("sale_date") >= F.lit(dt.date(2000, 1, 1))))
    return m.articles.join(sold, "article_idx", "left_anti").select("article_id", "article_name")


@query("l05_fixed_cap", """
    SELECT receipt_idx, article_idx, discount_amount::DOUBLE AS discount_amount FROM sales_row WHERE discount_amount > 0
    ORDER BY discount_amount DESC, receipt_idx, article_idx LIMIT 1000""")
def _(m: Mart) -> DataFrame:
    rows = m.sales_rows.filter(F.col("discount_amount") > 0).select("receipt_idx", "article_idx", "discount_amount")
    return ranking.top_n(rows, "discount_amount", 1000, ["receipt_idx", "article_idx"])


@query("l06_ordered_listing", """
    SELECT store_name, lev1_region_name, airport FROM store ORDER BY lev1_region_name, store_name""")
def _(m: Mart) -> DataFrame:
    return m.stores.select("store_name", "lev1_region_name", "airport").orderBy("lev1_region_name", "store_name")


# -- U ----------------------------------------------------------------------------------------


@query("u01_union_distinct", """
    SELECT store_idx, till_id FROM receipt WHERE tender_id = 1 UNION SELECT store_idx, till_id FROM payment""")
def _(m: Mart) -> DataFrame:
    keys = ["store_idx", "till_id"]
    return reshape.union_distinct(m.receipts.filter(F.col("tender_id") == 1).select(*keys), m.payments.select(*keys))


@query("u02_union_all", """
    SELECT 'sale' AS kind, article_idx, count(*) AS n FROM sales_row WHERE qty_sold > 0 GROUP BY article_idx
    UNION ALL SELECT 'return', article_idx, count(*) FROM sales_row WHERE qty_return > 0 GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    def branch(kind: str, col: str) -> DataFrame:
        return m.sales_rows.filter(F.col(col) > 0).groupBy(F.lit(kind).alias("kind"), "article_idx").agg(F.count("*").alias("n"))

    return reshape.union_rows(branch("sale", "qty_sold"), branch("return", "qty_return"))


@query("u03_except", """
    SELECT article_idx, supplier_idx FROM sales_row WHERE qty_sold > 0 EXCEPT SELECT article_idx, supplier_idx FROM sales_row WHERE qty_return > 0""")
def _(m: Mart) -> DataFrame:
    keys = ["article_idx", "supplier_idx"]
    return reshape.minus(
        m.sales_rows.filter(F.col("qty_sold") > 0).select(*keys), m.sales_rows.filter(F.col("qty_return") > 0).select(*keys)
    )


@query("u04_padded_union", """
    SELECT store_idx, sum(a)::DOUBLE AS system_cash, sum(b)::DOUBLE AS counted, sum(c)::DOUBLE AS settled FROM (
        SELECT store_idx, amount AS a, 0 AS b, 0 AS c FROM receipt WHERE tender_id = 1
        UNION ALL SELECT store_idx, 0, amount, 0 FROM counting UNION ALL SELECT store_idx, 0, 0, amount FROM bank)
    GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    cash = m.receipts.filter(F.col("tender_id") == 1).groupBy("store_idx").agg(F.sum("amount").alias("system_cash"))
    counted = m.counts.groupBy("store_idx").agg(F.sum("amount").alias("counted"))
    settled = m.bank_settlements.groupBy("store_idx").agg(F.sum("amount").alias("settled"))
    return reshape.padded_union_sum([cash, counted, settled], ["store_idx"], ["system_cash", "counted", "settled"])


@query("u05_measures_as_rows", """
    WITH t AS (SELECT lev1_id, sum(sales_amount + return_amount)::DOUBLE AS revenue, sum(qty_sold - qty_return)::DOUBLE AS qty
               FROM sales_row JOIN article USING (article_idx) GROUP BY lev1_id)
    SELECT lev1_id, '1 Revenue' AS measure, revenue AS value FROM t UNION ALL SELECT lev1_id, '2 Quantity', qty FROM t
    UNION ALL SELECT lev1_id, '3 Price', revenue / nullif(qty, 0) FROM t""")
def _(m: Mart) -> DataFrame:
    groups = m.sales_rows.join(m.articles, "article_idx").groupBy("lev1_id").agg(
        net_amount_sum().alias("revenue"), net_qty_sum().alias("qty")
    )
    price = safe_div(F.col("revenue"), F.col("qty"), "null")
    return reshape.measures_as_rows(
        groups, ["lev1_id"], {"1 Revenue": {"value": F.col("revenue")}, "2 Quantity": {"value": F.col("qty")}, "3 Price": {"value": price}}
    )


@query("u06_ledger_lines", """
    WITH t AS (SELECT store_idx, sum(amount) AS total, sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END) AS cash,
                      sum(CASE WHEN tender_id <> 1 THEN amount ELSE 0 END) AS other FROM receipt GROUP BY store_idx)
    SELECT store_idx, 0::DOUBLE AS debit_amount, '' AS debit_text, total::DOUBLE AS credit_amount, 'Sales' AS credit_text FROM t
    UNION ALL SELECT store_idx, cash::DOUBLE, 'Cash', 0, '' FROM t UNION ALL SELECT store_idx, other::DOUBLE, 'Other', 0, '' FROM t""")
def _(m: Mart) -> DataFrame:
    tender = F.col("tender_id")
    totals = m.receipts.groupBy("store_idx").agg(
        F.sum("amount").alias("total"), *agg.conditional_sums({"cash": tender == 1, "other": tender != 1}, "amount")
    )
    return reshape.ledger_lines(totals, ["store_idx"], {"Sales": "total"}, {"Cash": "cash", "Other": "other"})


@query("u07_filled_categories", """
    WITH g AS (SELECT article_idx, CASE WHEN price_type = 0 THEN 'Single' ELSE 'MixMatch' END AS kind, sum(sales_amount) AS sales
               FROM sales_row GROUP BY ALL),
         k AS (SELECT DISTINCT article_idx FROM g)
    SELECT k.article_idx, c.kind, g.sales::DOUBLE AS sales FROM k CROSS JOIN (VALUES ('Single'), ('MixMatch')) c(kind)
    LEFT JOIN g ON g.article_idx = k.article_idx AND g.kind = c.kind""")
def _(m: Mart) -> DataFrame:
    kind = F.when(F.col("price_type") == 0, F.lit("Single")).otherwise(F.lit("MixMatch")).alias("kind")
    grouped = m.sales_rows.groupBy("article_idx", kind).agg(F.sum("sales_amount").alias("sales"))
    return reshape.fill_categories(grouped, ["article_idx"], "kind", ["Single", "MixMatch"])
