"""Join shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.functions.keys import receipt_head, receipt_line
from tillroll.functions.money import net_amount_sum, net_qty_sum, safe_div, signed
from tillroll.operators import joins
from tillroll.sources.mart import Mart


@query("j01_star_join", """
    SELECT supplier_name, lev1_name, sum(qty_sold - qty_return)::DOUBLE AS qty, sum(sales_amount + return_amount)::DOUBLE AS revenue
    FROM sales_row JOIN article USING (article_idx) JOIN supp USING (supplier_idx) GROUP BY supplier_name, lev1_name""")
def _(m: Mart) -> DataFrame:
    rows = m.sales_rows.join(m.articles, "article_idx").join(m.suppliers, "supplier_idx")
    return rows.groupBy("supplier_name", "lev1_name").agg(net_qty_sum().alias("qty"), net_amount_sum().alias("revenue"))


@query("j02_left_join", """
    SELECT a.article_id, a.article_name, l.linked_idx AS linked_article, l.link_qty::DOUBLE AS link_qty
    FROM article a LEFT JOIN article_link l ON l.master_idx = a.article_idx""")
def _(m: Mart) -> DataFrame:
    a, links = m.articles, m.article_links
    return a.join(links, a["article_idx"] == links["master_idx"], "left").select(
        "article_id", "article_name", F.col("linked_idx").alias("linked_article"), "link_qty"
    )


def bank_by_day(m: Mart) -> DataFrame:
    return m.bank_settlements.groupBy("store_idx", "sale_date", "sub_tender_id").agg(
        F.sum("transactions").alias("bank_count"), F.sum("amount").alias("bank_amount")
    )


def till_by_day(m: Mart) -> DataFrame:
    return m.receipts.filter(F.col("tender_id").isin(3, 5) & F.col("order_status").isin("F", "O")).groupBy(
        "store_idx", "sale_date", "sub_tender_id"
    ).agg(F.count("*").alias("till_count"), F.sum("amount").alias("till_amount"))


@query("j03_full_join", """
    WITH e AS (SELECT store_idx, sale_date, sub_tender_id, sum(transactions) AS bank_count, sum(amount) AS bank_amount
               FROM bank GROUP BY ALL),
         r AS (SELECT store_idx, sale_date, sub_tender_id, count(*) AS till_count, sum(amount) AS till_amount
               FROM receipt WHERE tender_id IN (3, 5) AND order_status IN ('F', 'O') GROUP BY ALL)
    SELECT coalesce(e.store_idx, r.store_idx) AS store_idx, coalesce(e.sale_date, r.sale_date)::VARCHAR AS sale_date,
           coalesce(e.sub_tender_id, r.sub_tender_id) AS sub_tender_id, bank_count::BIGINT AS bank_count,
           bank_amount::DOUBLE AS bank_amount, till_count, till_amount::DOUBLE AS till_amount
    FROM e FULL JOIN r ON e.store_idx = r.store_idx AND e.sale_date = r.sale_date AND e.sub_tender_id = r.sub_tender_id""")
def _(m: Mart) -> DataFrame:
    return joins.full_on(bank_by_day(m), till_by_day(m), ("store_idx", "sale_date", "sub_tender_id"))


@query("j04_full_chain", """
    WITH e AS (SELECT store_idx, date_trunc('month', sale_date)::DATE AS mon, till_id, sum(amount) AS settled FROM bank GROUP BY ALL),
         r AS (SELECT store_idx, date_trunc('month', sale_date)::DATE AS mon, till_id, sum(amount) AS registered
               FROM receipt WHERE tender_id = 1 GROUP BY ALL),
         c AS (SELECT store_idx, date_trunc('month', sale_date)::DATE AS mon, till_id, sum(amount) AS currency
               FROM receipt WHERE tender_id = 8 GROUP BY ALL)
    SELECT coalesce(e.store_idx, r.store_idx, c.store_idx) AS store_idx, coalesce(e.mon, r.mon, c.mon)::VARCHAR AS month_start,
           coalesce(e.till_id, r.till_id, c.till_id) AS till_id, settled::DOUBLE AS settled, registered::DOUBLE AS registered,
           currency::DOUBLE AS currency
    FROM e FULL JOIN r ON e.store_idx = r.store_idx AND e.mon = r.mon AND e.till_id = r.till_id
    FULL JOIN c ON c.store_idx = coalesce(e.store_idx, r.store_idx) AND c.mon = coalesce(e.mon, r.mon)
               AND c.till_id = coalesce(e.till_id, r.till_id)""")
def _(m: Mart) -> DataFrame:
    keys = ("store_idx", "month_start", "till_id")
    month = F.trunc("sale_date", "month").alias("month_start")

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("store_idx", month, "till_id").agg(F.sum("amount").alias(name))

    receipts = m.receipts
    return joins.full_chain(
        [
            part(m.bank_settlements, "settled"),
            part(receipts.filter(F.col("tender_id") == 1), "registered"),
            part(receipts.filter(F.col("tender_id") == 8), "currency"),
        ],
        keys,
    )


@query("j05_always_one_row", """
    SELECT (SELECT min(sale_date)::VARCHAR FROM receipt WHERE tender_id = 8) AS first_currency_day,
           (SELECT count(*) FROM receipt WHERE tender_id = 8) AS currency_receipts,
           (SELECT min(log_date)::VARCHAR FROM payment WHERE store_idx = 99) AS first_log_day,
           (SELECT count(*) FROM payment WHERE store_idx = 99) AS log_rows""")
def _(m: Mart) -> DataFrame:
    money = m.receipts.filter(F.col("tender_id") == 8).agg(F.min("sale_date").alias("d"), F.count("*").alias("n"))
    log = m.payments.filter(F.col("store_idx") == 99).agg(F.min("log_date").alias("d"), F.count("*").alias("n"))
    return joins.single_row({"money": money, "log": log}, m.articles).select(
        F.col("money.d").alias("first_currency_day"),
        F.col("money.n").alias("currency_receipts"),
        F.col("log.d").alias("first_log_day"),
        F.col("log.n").alias("log_rows"),
    )


@query("j06_scalar_totals", """
    SELECT lev1_id, revenue::DOUBLE AS revenue, (SELECT sum(sales_amount + return_amount) FROM sales_row)::DOUBLE AS total_revenue,
           revenue::DOUBLE / (SELECT sum(sales_amount + return_amount) FROM sales_row)::DOUBLE AS share
    FROM (SELECT lev1_id, sum(sales_amount + return_amount) AS revenue
          FROM sales_row JOIN article USING (article_idx) GROUP BY lev1_id)""")
def _(m: Mart) -> DataFrame:
    per_article = m.sales_rows.groupBy("article_idx").agg(net_amount_sum().alias("revenue"))
    groups = per_article.join(m.articles, "article_idx").groupBy("lev1_id").agg(F.sum("revenue").alias("revenue"))
    totals = groups.agg(F.sum("revenue").alias("revenue"))
    return joins.with_totals(groups, totals).select(
        "lev1_id", "revenue", F.col("totals.revenue").alias("total_revenue"),
        safe_div(F.col("revenue"), F.col("totals.revenue"), "null").alias("share"),
    )


@query("j07_left_anti", """
    SELECT article_id, article_name FROM article a
    WHERE NOT EXISTS (SELECT 1 FROM sales_row s WHERE s.article_idx = a.article_idx
                      AND s.sale_date >= DATE '2001-07-01' AND s.sale_date <= DATE '2001-08-01')""")
def _(m: Mart) -> DataFrame:
    import datetime as dt

    recent = m.sales_rows.filter(F.col("sale_date").between(dt.date(2001, 7, 1), dt.date(2001, 8, 1)))
    return m.articles.join(recent, "article_idx", "left_anti").select("article_id", "article_name")


@query("j08_left_semi", """
    SELECT receipt_id, cashier_idx, amount::DOUBLE AS amount FROM receipt
    WHERE receipt_id IN (SELECT receipt_id FROM sales_row WHERE reduction_id = 10 AND qty_return > 0)""")
def _(m: Mart) -> DataFrame:
    hits = m.sales_rows.filter((F.col("reduction_id") == 10) & (F.col("qty_return") > 0))
    return m.receipts.join(hits, "receipt_id", "left_semi").select("receipt_id", "cashier_idx", "amount")


@query("j09_either_key", """
    WITH item AS (SELECT DISTINCT reduction_id AS campaign, article_idx AS item_idx, lev2_id AS item_group
                  FROM sales_row JOIN article USING (article_idx) WHERE reduction_id IS NOT NULL)
    SELECT DISTINCT campaign, article_idx, article_name FROM item JOIN article a
      ON a.article_idx = item.item_idx OR a.lev2_id = item.item_group""")
def _(m: Mart) -> DataFrame:
    covered = m.sales_rows.filter(F.col("reduction_id").isNotNull()).select(
        F.col("reduction_id").alias("campaign"), F.col("article_idx").alias("item_idx")
    ).distinct()
    groups = covered.join(m.articles, F.col("item_idx") == F.col("article_idx")).select(
        "campaign", F.lit(None).cast("bigint").alias("item_idx"), F.col("lev2_id").alias("item_group")
    ).filter(F.col("item_group").isNotNull()).distinct()
    items = covered.withColumn("item_group", F.lit(None).cast("string")).union(groups)
    return joins.either_key(
        items, m.articles, ("item_idx", "article_idx"), ("item_group", "lev2_id")
    ).select("campaign", "article_idx", "article_name").distinct()


@query("j10_value_in_columns", """
    SELECT store_id, count(*) AS receipts FROM store JOIN receipt USING (store_idx)
    WHERE 'CA' IN (lev1_region_no, lev2_region_no, lev1_legal_no, lev1_chain_no, lev1_district_no, store_id)
       OR 'L3' IN (lev1_region_no, lev2_region_no, lev1_legal_no, lev1_chain_no, lev1_district_no, store_id)
    GROUP BY store_id""")
def _(m: Mart) -> DataFrame:
    from tillroll.operators.filters import store_group

    chosen = store_group(m.stores, ["CA", "L3"], m.STORE_GROUP_COLUMNS)
    return m.receipts.join(chosen, "store_idx").groupBy("store_id").agg(F.count("*").alias("receipts"))


@query("j11_next_event", """
    SELECT order_no, tracking_no, picker, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS started_at,
           strftime((SELECT min_by(p.created_at, p.tracking_no) FROM order_event p WHERE p.order_no = s.order_no AND p.status = 50
                     AND p.tracking_no > s.tracking_no), '%Y-%m-%d %H:%M:%S') AS stopped_at
    FROM order_event s WHERE status = 40""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.picking import start_stop_pairs

    return start_stop_pairs(m.order_events).select(
        "order_no", "tracking_no", "picker", F.col("created_at").alias("started_at"), "stopped_at"
    )


@query("j12_latest_before", """
    SELECT article_idx, sale_date::VARCHAR AS sale_date, cost_amount::DOUBLE AS cost_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY article_idx ORDER BY sale_date DESC, receipt_idx DESC, cost_amount DESC) AS rn
        FROM sales_row WHERE sale_date <= DATE '2000-06-30') WHERE rn = 1""")
def _(m: Mart) -> DataFrame:
    import datetime as dt

    rows = m.sales_rows.filter(F.col("sale_date") <= dt.date(2000, 6, 30))
    return joins.latest_before(
        rows, ["article_idx"], ["sale_date", "receipt_idx"], ["sale_date", "cost_amount"]
    )


@query("j13_self_join", """
    SELECT a.order_no, a.line_no, sum(b.line_price - a.line_price)::DOUBLE AS price_diff, count(*) AS pairs
    FROM order_line a JOIN order_line b ON a.order_no = b.order_no AND a.link_no = b.link_no
    WHERE NOT a.is_substitute AND b.is_substitute AND b.line_price > a.line_price GROUP BY a.order_no, a.line_no""")
def _(m: Mart) -> DataFrame:
    a = m.order_lines.filter(~F.col("is_substitute")).select("order_no", "line_no", "link_no", "line_price")
    b = m.order_lines.filter("is_substitute").select("order_no", "link_no", F.col("line_price").alias("new_price"))
    diff = F.col("new_price") - F.col("line_price")
    return a.join(b, ["order_no", "link_no"]).filter(diff > 0).groupBy("order_no", "line_no").agg(
        F.sum(diff).alias("price_diff"), F.count("*").alias("pairs")
    )


@query("j14_parent_join", """
    WITH lev AS (SELECT DISTINCT lev2_id AS node, lev2_name AS node_name, lev1_id AS parent FROM article WHERE lev2_id IS NOT NULL),
         top AS (SELECT DISTINCT lev1_id AS node, lev1_name AS node_name FROM article)
    SELECT lev.node_name AS sub_category, top.node_name AS category FROM lev JOIN top ON top.node = lev.parent""")
def _(m: Mart) -> DataFrame:
    child = m.articles.filter(F.col("lev2_id").isNotNull()).select(
        F.col("lev2_name").alias("sub_category"), F.col("lev1_id").alias("parent")
    ).distinct()
    parent = m.articles.select(F.col("lev1_id").alias("parent"), F.col("lev1_name").alias("category")).distinct()
    return child.join(parent, "parent").select("sub_category", "category")


@query("j15_derived_key", """
    SELECT s.receipt_idx % 1000 AS line_no, r.till_id, count(*) AS row_count, sum(s.sales_amount)::DOUBLE AS sales_amount
    FROM sales_row s JOIN receipt r ON s.receipt_idx // 1000 = r.receipt_id GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    rows = m.sales_rows.select(
        receipt_head("receipt_idx").alias("receipt_id"), receipt_line("receipt_idx").alias("line_no"), "sales_amount"
    )
    return rows.join(m.receipts, "receipt_id").groupBy("line_no", "till_id").agg(
        F.count("*").alias("row_count"), F.sum("sales_amount").alias("sales_amount")
    )


@query("j16_first_match", """
    SELECT p.payment_no, coalesce(a.supplier_name, b.supplier_name) AS matched_name
    FROM payment p LEFT JOIN supp a ON a.supplier_idx = p.detail AND a.is_current
    LEFT JOIN (SELECT supplier_store_idx, max(supplier_name) AS supplier_name FROM supp GROUP BY 1) b
      ON b.supplier_store_idx = p.store_idx""")
def _(m: Mart) -> DataFrame:
    direct = m.suppliers.filter("is_current").select(F.col("supplier_idx").alias("k1"), "supplier_name")
    by_store = m.suppliers.groupBy(F.col("supplier_store_idx").alias("k2")).agg(F.max("supplier_name").alias("supplier_name"))
    return joins.first_match(
        m.payments.select("payment_no", "detail", "store_idx"),
        (direct, "detail", "k1"), (by_store, "store_idx", "k2"), "supplier_name", "matched_name",
    ).select("payment_no", "matched_name")


@query("j17_fallback_key", """
    SELECT a.article_id, sum(c.counted_qty * coalesce(l.link_qty, 1))::DOUBLE AS counted_qty
    FROM count_line c LEFT JOIN article_link l ON l.master_idx = c.article_idx
    JOIN article a ON a.article_idx = coalesce(l.linked_idx, c.article_idx) GROUP BY a.article_id""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.stock import resolve_links

    lines = resolve_links(m.count_lines, m.article_links)
    return lines.join(m.articles, "article_idx").groupBy("article_id").agg(
        F.sum(F.col("counted_qty") * F.col("link_qty")).alias("counted_qty")
    )


@query("j18_preaggregated_branches", """
    WITH s AS (SELECT store_idx, sale_date, sum(sales_amount + return_amount) AS sales FROM receipt_row GROUP BY ALL),
         t AS (SELECT store_idx, sale_date, sum(amount) AS paid FROM receipt GROUP BY ALL),
         b AS (SELECT store_idx, sale_date, sum(amount) AS settled FROM bank GROUP BY ALL)
    SELECT s.store_idx, s.sale_date::VARCHAR AS sale_date, sales::DOUBLE AS sales, coalesce(paid, 0)::DOUBLE AS paid,
           coalesce(settled, 0)::DOUBLE AS settled
    FROM s LEFT JOIN t ON t.store_idx = s.store_idx AND t.sale_date = s.sale_date
    LEFT JOIN b ON b.store_idx = s.store_idx AND b.sale_date = s.sale_date""")
def _(m: Mart) -> DataFrame:
    day = ["store_idx", "sale_date"]
    sales = m.receipt_rows.groupBy(*day).agg(net_amount_sum().alias("sales"))
    paid = m.receipts.groupBy(*day).agg(F.sum("amount").alias("paid"))
    settled = m.bank_settlements.groupBy(*day).agg(F.sum("amount").alias("settled"))
    return sales.join(paid, day, "left").join(settled, day, "left").fillna(0, ["paid", "settled"])


@query("j19_difference", """
    WITH t AS (SELECT lev1_id, sum(qty_sold - qty_return) AS qty, sum(sales_amount + return_amount) AS revenue
               FROM receipt_row JOIN article USING (article_idx) GROUP BY lev1_id),
         c AS (SELECT lev1_id, sum(received_qty) AS qty, sum(delivered_amount) AS revenue
               FROM order_line JOIN collected USING (order_no) JOIN article USING (article_idx)
               WHERE status = 60 AND flight_direction = 'A' GROUP BY lev1_id)
    SELECT lev1_id, (t.qty - coalesce(c.qty, 0))::DOUBLE AS qty, (t.revenue - coalesce(c.revenue, 0))::DOUBLE AS revenue
    FROM t LEFT JOIN c USING (lev1_id)""")
def _(m: Mart) -> DataFrame:
    everything = m.receipt_rows.join(m.articles, "article_idx").groupBy("lev1_id").agg(
        net_qty_sum().alias("qty"), net_amount_sum().alias("revenue")
    )
    paid = m.collected_orders.filter((F.col("status") == 60) & (F.col("flight_direction") == "A")).select("order_no")
    collected = m.order_lines.join(paid, "order_no").join(m.articles, "article_idx").groupBy("lev1_id").agg(
        F.sum("received_qty").alias("qty"), F.sum("delivered_amount").alias("revenue")
    )
    return joins.difference(everything, collected, ["lev1_id"], ["qty", "revenue"])


@query("j20_bridge", """
    WITH bridge AS (SELECT tender_id, sel, sgn FROM (VALUES (1, 'Cash', 1), (8, 'Cash', 1), (3, 'Bank Cards', 1), (5, 'Bank Cards', 1),
                    (6, 'Account Credit', -1), (2, 'Vouchers', 1), (19, 'Vouchers', 1), (22, 'Mobile', 1)) v(tender_id, sel, sgn))
    SELECT sel AS selection, store_idx, sum(amount * sgn)::DOUBLE AS amount FROM receipt JOIN bridge USING (tender_id) GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.reconciliation import tender_bridge

    rows = m.receipts.join(tender_bridge(m.spark), "tender_id")
    return rows.groupBy("selection", "store_idx").agg(F.sum(signed("amount", "sign")).alias("amount"))
