"""Cashier operations and master data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.functions.labels import AGE_CHECK_APPROVED, AGE_CHECK_REFUSED
from tillroll.plans import cashiers, masterdata
from tillroll.plans.calendar import Period
from tillroll.sources.mart import AS_OF, EVENTS_AS_OF, Mart


def _labels(col: str, table: dict) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in table.items())
    return f"CASE {col} {whens} END"


_THIRD_PARTY = """
    SELECT store_idx, till_id, payment_no AS receipt_no, date_key, strftime(logged_at, '%H:%M') AS "time", detail AS scheme_no,
           (CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END)::DOUBLE AS amount,
           CASE WHEN event_type = 'purchase' AND amount <> 0 THEN 'Success' ELSE 'Failure' END AS state
    FROM payment WHERE event_type IN ('purchase', 'error')"""


@query("r25_third_party_payments", _THIRD_PARTY)
def _(m: Mart) -> DataFrame:
    return cashiers.third_party_payments(m.payments)


@query("r25_third_party_last_ten_days", _THIRD_PARTY + " AND log_date BETWEEN DATE '2024-01-21' AND DATE '2024-01-31'")
def _(m: Mart) -> DataFrame:
    period = Period("R", unit="D", start=-10, duration=11)
    return cashiers.third_party_payments(m.payments, period=period, as_of=EVENTS_AS_OF)


@query("r27_branch_price_list", """
    SELECT article_id, article_name, lev2_name, coalesce(nullif(retail_price, 0), 0)::DOUBLE AS sales_price FROM article
    WHERE lev2_id IS NOT NULL AND lower(lev1_name) LIKE '%medium%'""")
def _(m: Mart) -> DataFrame:
    return masterdata.branch_price_list(m.articles, "Medium")


def store_infos(m: Mart) -> DataFrame:
    """Store attributes as key/value rows, from the till log."""
    return m.payments.select("store_idx", F.concat(F.lit("INFO_"), F.col("event_type")).alias("key"), F.lpad(F.col("detail").cast("string"), 2, "0").alias("value"))


@query("r28_store_attributes", """
    WITH i AS (SELECT store_idx, max(CASE WHEN event_type = 'view' THEN lpad(CAST(detail AS VARCHAR), 2, '0') END) AS INFO_view,
                      max(CASE WHEN event_type = 'click' THEN lpad(CAST(detail AS VARCHAR), 2, '0') END) AS INFO_click,
                      max(CASE WHEN event_type = 'absent' THEN '' END) AS INFO_absent FROM payment GROUP BY store_idx)
    SELECT store_id, store_name, lev1_region_name, INFO_view, INFO_click, INFO_absent FROM store JOIN i USING (store_idx)""")
def _(m: Mart) -> DataFrame:
    return masterdata.store_attributes(m.stores, store_infos(m), ["INFO_view", "INFO_click", "INFO_absent"])


def supplier_infos(m: Mart) -> DataFrame:
    """Supplier attributes as key/value rows: largest article, busiest VAT rate."""
    facts = m.sales_rows.groupBy("supplier_idx").agg(
        F.max("article_idx").cast("string").alias("TOP_ARTICLE"), F.max("vat_group").cast("string").alias("MAX_VAT"),
        F.min("sale_date").cast("string").alias("FIRST_DAY"),
    )
    return facts.unpivot("supplier_idx", ["TOP_ARTICLE", "MAX_VAT", "FIRST_DAY"], "key", "value")


@query("r29_supplier_attributes", """
    SELECT supplier_id, supplier_name, store_name AS home_store, CAST(x.top_article AS VARCHAR) AS TOP_ARTICLE, CAST(x.max_vat AS VARCHAR) AS MAX_VAT,
           CAST(x.first_day AS VARCHAR) AS FIRST_DAY
    FROM supp LEFT JOIN store ON store_idx = supplier_store_idx
    LEFT JOIN (SELECT supplier_idx, max(article_idx) AS top_article, max(vat_group) AS max_vat, min(sale_date) AS first_day FROM sales_row GROUP BY 1) x
      USING (supplier_idx)""")
def _(m: Mart) -> DataFrame:
    return masterdata.supplier_attributes(m.suppliers, supplier_infos(m), m.stores, ["TOP_ARTICLE", "MAX_VAT", "FIRST_DAY"])


@query("r30_age_check_summary", """
    SELECT cashier_idx, cashier_name, count(CASE WHEN approved THEN 1 END) AS approved_no, count(CASE WHEN NOT approved THEN 1 END) AS refused_no,
           count(*) AS total_no, count(CASE WHEN approved THEN 1 END)::DOUBLE / count(*)::DOUBLE * 100 AS approved_share,
           count(CASE WHEN NOT approved THEN 1 END)::DOUBLE / count(*)::DOUBLE * 100 AS refused_share
    FROM age_check GROUP BY cashier_idx, cashier_name""")
def _(m: Mart) -> DataFrame:
    return cashiers.age_check_summary(m.age_checks)


_CHECK_ROWS = """SELECT store_idx, log_date::VARCHAR AS log_date, strftime(logged_at, '%H:%M') AS log_time, cashier_name, till_id, payment_no AS receipt_no,
    amount::DOUBLE AS amount, reason_no::BIGINT AS reason_no, {label} AS reason_text FROM age_check WHERE {cond}"""


@query("r31_age_checks_approved", _CHECK_ROWS.format(label=_labels("reason_no", AGE_CHECK_APPROVED), cond="approved"))
def _(m: Mart) -> DataFrame:
    return cashiers.age_check_rows(m.age_checks, approved=True)


@query("r31_age_checks_refused", _CHECK_ROWS.format(label=_labels("reason_no", AGE_CHECK_REFUSED), cond="NOT approved"))
def _(m: Mart) -> DataFrame:
    return cashiers.age_check_rows(m.age_checks, approved=False)


@query("r32_article_list", """
    WITH s AS (SELECT *, coalesce(campaign_id, combination_id, reduction_id) AS campaign_no FROM sales_row),
    running AS (SELECT campaign_no FROM s WHERE campaign_no IS NOT NULL GROUP BY campaign_no
                HAVING DATE '2001-08-01' BETWEEN min(sale_date) AND max(sale_date)),
    c AS (SELECT article_idx, string_agg(no, '| ' ORDER BY no) AS campaigns FROM (SELECT DISTINCT article_idx, lpad(CAST(campaign_no AS VARCHAR), 2, '0') AS no FROM s
          WHERE campaign_no IN (SELECT campaign_no FROM running) AND sale_date >= DATE '2000-01-01') GROUP BY article_idx)
    SELECT article_id, replace(article_name, ',', '|') AS article_name, gtin, retail_price::DOUBLE AS sales_price, a.f::VARCHAR AS assortment_from,
           a.t::VARCHAR AS assortment_to, coalesce(q.qty, 0)::DOUBLE AS in_stock_qty, coalesce(campaigns, '') AS campaigns
    FROM article LEFT JOIN (SELECT article_idx, min(sale_date) AS f, max(sale_date) AS t FROM sales_row GROUP BY 1) a USING (article_idx)
    LEFT JOIN (SELECT article_idx, sum(qty * sign) AS qty FROM stock_move GROUP BY 1) q USING (article_idx) LEFT JOIN c USING (article_idx)""")
def _(m: Mart) -> DataFrame:
    return masterdata.article_list(m.articles, m.sales_rows, m.stock_moves, as_of=AS_OF, since=dt.date(2000, 1, 1))


@query("r79_age_control", """
    WITH s AS (SELECT cashier_idx, cashier_name, count(*) AS limited_articles FROM receipt_row JOIN article USING (article_idx) WHERE age_limit > 0 GROUP BY ALL),
    c AS (SELECT cashier_idx, cashier_name, count(CASE WHEN approved AND reason_no = 1 THEN 1 END) AS clearly_old_enough,
                 count(CASE WHEN approved THEN 1 END) AS approved_no, count(CASE WHEN NOT approved THEN 1 END) AS refused_no,
                 count(CASE WHEN approved AND reason_no = 7 THEN 1 END) AS approved_by_fingerprint FROM age_check GROUP BY ALL)
    SELECT * FROM c JOIN s USING (cashier_idx, cashier_name) WHERE limited_articles > 0 OR refused_no > 0""")
def _(m: Mart) -> DataFrame:
    return cashiers.age_control(m.receipt_rows, m.articles, m.age_checks)


_BAGS = """bag AS (SELECT cashier_idx, cashier_name, sum(CASE WHEN lev1_id = 'SMALL' THEN qty_sold - qty_return ELSE 0 END) AS bags,
    count(DISTINCT receipt_id) AS customers FROM receipt_row JOIN article USING (article_idx) GROUP BY ALL
    HAVING count(CASE WHEN lev1_id = 'SMALL' THEN 1 END) > 0)"""
_BAG_RATIO = "bags::DOUBLE / coalesce(nullif(customers::DOUBLE, 0), 1)"


@query("r80_bags_per_customer", f"WITH {_BAGS} SELECT cashier_idx, cashier_name, bags::DOUBLE AS bags, customers, {_BAG_RATIO} AS bags_per_customer FROM bag")
def _(m: Mart) -> DataFrame:
    return cashiers.bags_per_customer(m.receipt_rows, m.articles, bag_group="SMALL")


_DEPOSIT = """s AS (SELECT cashier_idx, cashier_name, sum(sales_amount + return_amount) AS revenue_incl_vat,
        sum(CASE WHEN article_type_id = 130 THEN sales_amount ELSE 0 END) AS deposit_sold,
        sum(CASE WHEN article_type_id = 130 THEN return_amount ELSE 0 END) AS deposit_returned FROM receipt_row JOIN article USING (article_idx) GROUP BY ALL),
    mr AS (SELECT cashier_idx, cashier_name, count(*) AS manual_returns, sum(amount) AS manual_amount FROM accumulation WHERE accumulation_id = 7 GROUP BY ALL),
    lo AS (SELECT cashier_idx, cashier_name, sum(amount) AS lottery_paid FROM payment WHERE event_type = 'purchase' GROUP BY ALL),
    dep AS (SELECT cashier_idx, cashier_name, coalesce(revenue_incl_vat, 0) AS revenue_incl_vat, coalesce(deposit_sold, 0) AS deposit_sold,
        coalesce(deposit_returned, 0) AS deposit_returned, coalesce(manual_returns, 0) AS manual_returns, coalesce(manual_amount, 0) AS manual_amount,
        coalesce(lottery_paid, 0) AS lottery_paid FROM s FULL JOIN mr USING (cashier_idx, cashier_name) FULL JOIN lo USING (cashier_idx, cashier_name))"""
_DEPOSIT_OUT = """cashier_idx, cashier_name, revenue_incl_vat::DOUBLE AS revenue_incl_vat, deposit_sold::DOUBLE AS deposit_sold,
    deposit_returned::DOUBLE AS deposit_returned, manual_returns::DOUBLE AS manual_returns, manual_amount::DOUBLE AS manual_amount,
    lottery_paid::DOUBLE AS lottery_paid, coalesce((deposit_sold + deposit_returned)::DOUBLE / nullif(revenue_incl_vat::DOUBLE, 0), 0) AS deposit_share"""


def _deposit(m: Mart) -> DataFrame:
    lottery = m.payments.filter(F.col("event_type") == "purchase").select("cashier_idx", "cashier_name", "amount")
    return cashiers.bottle_deposit(m.receipt_rows, m.articles, m.accumulations, lottery)


@query("r81_bottle_deposit", f"WITH {_DEPOSIT} SELECT {_DEPOSIT_OUT} FROM dep")
def _(m: Mart) -> DataFrame:
    return _deposit(m)


@query("r81_bottle_deposit_with_bags", f"""
    WITH {_DEPOSIT}, {_BAGS} SELECT {_DEPOSIT_OUT}, {_BAG_RATIO} AS bags_per_customer FROM dep LEFT JOIN bag USING (cashier_idx, cashier_name)""")
def _(m: Mart) -> DataFrame:
    bags = cashiers.bags_per_customer(m.receipt_rows, m.articles, bag_group="SMALL")
    return cashiers.with_bags(_deposit(m), bags)


@query("r82_bottle_lottery", """
    SELECT sum(CASE WHEN trans_type = 90306 THEN amount ELSE 0 END)::DOUBLE AS used_for_lottery,
           sum(CASE WHEN trans_type = 90305 AND amount < 100 THEN amount ELSE 0 END)::DOUBLE AS gains_small,
           sum(CASE WHEN trans_type = 90305 AND amount >= 100 THEN amount ELSE 0 END)::DOUBLE AS gains_large,
           sum(CASE WHEN trans_type = 90305 AND still_open AND age < 15 THEN amount ELSE 0 END)::DOUBLE AS unclaimed_recent,
           sum(CASE WHEN trans_type = 90305 AND still_open AND age >= 15 THEN amount ELSE 0 END)::DOUBLE AS unclaimed_old
    FROM (SELECT *, DATE '2024-01-31' - log_date AS age, NOT EXISTS (SELECT 1 FROM bottle p WHERE p.trans_type = 90307 AND p.voucher_no = b.voucher_no
          AND p.log_date >= b.log_date) AS still_open FROM bottle b)""")
def _(m: Mart) -> DataFrame:
    return cashiers.bottle_lottery(m.bottle_receipts, as_of=EVENTS_AS_OF, large=100, days=15)


@query("r83_exceptions", """
    SELECT cashier_idx, cashier_name, sum(CASE WHEN accumulation_id = 1 THEN amount ELSE 0 END)::DOUBLE AS sales_amount,
           sum(CASE WHEN accumulation_id = 11 THEN amount ELSE 0 END)::DOUBLE AS return_amount, count(CASE WHEN accumulation_id = 5 THEN 1 END) AS corrections,
           sum(CASE WHEN accumulation_id = 5 THEN amount ELSE 0 END)::DOUBLE AS corrections_amount, count(CASE WHEN accumulation_id = 10 THEN 1 END) AS canceled,
           sum(CASE WHEN accumulation_id = 10 THEN amount ELSE 0 END)::DOUBLE AS canceled_amount, count(CASE WHEN accumulation_id = 19 THEN 1 END) AS price_checks,
           count(CASE WHEN accumulation_id = 13 THEN 1 END) AS parked
    FROM accumulation GROUP BY cashier_idx, cashier_name""")
def _(m: Mart) -> DataFrame:
    return cashiers.exceptions(m.accumulations)


_KEY_FIGURES = """r AS (SELECT cashier_idx, cashier_name, receipt_id, sum(sales_amount + return_amount) AS amount,
        sum(CASE WHEN is_third_party THEN sales_amount + return_amount ELSE 0 END) AS third_amount,
        sum(CASE WHEN NOT is_third_party THEN qty_sold + qty_return ELSE 0 END) AS own_items,
        sum(CASE WHEN NOT is_third_party AND length(gtin) > 6 THEN qty_sold + qty_return ELSE 0 END) AS own_scannable,
        sum(CASE WHEN NOT is_third_party AND length(gtin) > 6 AND line_status = 'F' THEN qty_sold + qty_return ELSE 0 END) AS own_scanned,
        bool_or(is_third_party) AS has_third, bool_and(is_third_party) AS only_third FROM receipt_row JOIN article USING (article_idx) GROUP BY ALL),
    key_figure AS (SELECT cashier_idx, cashier_name, sum(amount) AS total, sum(third_amount) AS third, count(*) - count(CASE WHEN only_third THEN 1 END) AS customers,
        count(CASE WHEN has_third THEN 1 END) AS third_customers, sum(own_items) AS items, sum(own_scannable) AS scannable, sum(own_scanned) AS scanned FROM r GROUP BY ALL)"""
_KEY_OUT = """cashier_idx, cashier_name, total::DOUBLE AS total, (total - third)::DOUBLE AS article_sales, key_figure.customers AS customers,
    coalesce((total - third)::DOUBLE / nullif(key_figure.customers::DOUBLE, 0), 0) AS sales_per_customer, coalesce(scannable::DOUBLE / nullif(items::DOUBLE, 0), 0) AS scannable_share,
    coalesce(scanned::DOUBLE / nullif(scannable::DOUBLE, 0), 0) AS scanned_share, third::DOUBLE AS third_party_sales, third_customers AS third_party_customers,
    coalesce(third::DOUBLE / nullif(third_customers::DOUBLE, 0), 0) AS third_party_per_customer"""


@query("r84_key_figures", f"WITH {_KEY_FIGURES} SELECT {_KEY_OUT} FROM key_figure")
def _(m: Mart) -> DataFrame:
    return cashiers.key_figures(m.receipt_rows, m.articles)


@query("r84_key_figures_with_bags", f"""
    WITH {_KEY_FIGURES}, {_BAGS} SELECT {_KEY_OUT}, bags::DOUBLE / coalesce(nullif(bag.customers::DOUBLE, 0), 1) AS bags_per_customer
    FROM key_figure LEFT JOIN bag USING (cashier_idx, cashier_name)""")
def _(m: Mart) -> DataFrame:
    bags = cashiers.bags_per_customer(m.receipt_rows, m.articles, bag_group="SMALL")
    return cashiers.with_bags(cashiers.key_figures(m.receipt_rows, m.articles), bags)


@query("r85_returns_by_cashier", """
    WITH f AS (SELECT *, qty_return > 0 AS returned, qty_return > 0 AND length(gtin) <= 6 AS generic FROM receipt_row JOIN article USING (article_idx))
    SELECT cashier_idx, cashier_name, sum(sales_amount + return_amount)::DOUBLE AS revenue_incl_vat,
           count(DISTINCT CASE WHEN returned THEN receipt_id END) AS return_receipts, sum(qty_return)::DOUBLE AS returned_qty,
           (-sum(return_amount))::DOUBLE AS return_amount, count(DISTINCT CASE WHEN generic THEN receipt_id END) AS generic_receipts,
           sum(CASE WHEN generic THEN qty_return ELSE 0 END)::DOUBLE AS generic_qty, sum(CASE WHEN generic THEN return_amount ELSE 0 END)::DOUBLE AS generic_amount,
           coalesce((-sum(return_amount))::DOUBLE / nullif(sum(sales_amount)::DOUBLE, 0), 0) AS return_share
    FROM f GROUP BY cashier_idx, cashier_name""")
def _(m: Mart) -> DataFrame:
    return cashiers.returns_by_cashier(m.receipt_rows, m.articles)
