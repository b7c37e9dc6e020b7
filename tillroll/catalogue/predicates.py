"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.functions.labels import FLIGHT_TYPE, TRAVEL_TYPE, label_of
from tillroll.functions.money import net_amount_sum, net_qty_sum, sum_if
from tillroll.operators import filters as flt
from tillroll.operators.payments import classify_payments
from tillroll.plans.calendar import Period
from tillroll.plans.masterdata import hierarchy_nodes
from tillroll.sources.inline import inline_table
from tillroll.sources.mart import AS_OF, Mart


def _sales_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        net_qty_sum().alias("qty"), net_amount_sum().alias("revenue"), F.count("*").alias("row_count")
    )


_SUMS = """sum(qty_sold - qty_return)::DOUBLE AS qty, sum(sales_amount + return_amount)::DOUBLE AS revenue,
           count(*) AS row_count"""


@query("p01_optional_filters", f"""
    SELECT article_idx, {_SUMS} FROM sales_row WHERE supplier_idx = 7 GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    rows = flt.when_set(m.sales_rows, "supplier_idx", 7)
    rows = flt.when_set(rows, "line_status", None)
    return _sales_by(flt.when_set(rows, "line_status", " "), "article_idx")


@query("p02_list_parameter", f"""
    SELECT lev1_id, lev2_id, {_SUMS} FROM sales_row JOIN article USING (article_idx)
    WHERE lev1_id IN ('PROMO', 'LARGE') GROUP BY lev1_id, lev2_id""")
def _(m: Mart) -> DataFrame:
    articles = flt.in_list(m.articles, "lev1_id", "PROMO, LARGE,,")
    return _sales_by(m.sales_rows.join(articles, "article_idx"), "lev1_id", "lev2_id")


@query("p03_store_group", f"""
    SELECT store_idx, store_name, {_SUMS} FROM receipt_row JOIN store USING (store_idx)
    WHERE lev1_region_no IN ('1', 'D4', '7') OR lev1_district_no IN ('1', 'D4', '7') OR store_id IN ('1', 'D4', '7')
    GROUP BY store_idx, store_name""")
def _(m: Mart) -> DataFrame:
    chosen = flt.store_group(m.stores, "1,D4,7", m.STORE_GROUP_COLUMNS).select("store_idx", "store_name")
    return _sales_by(m.receipt_rows.join(chosen, "store_idx"), "store_idx", "store_name")


@query("p04_period_range", f"""
    SELECT date_key, {_SUMS} FROM sales_row
    WHERE sale_date BETWEEN DATE '1996-02-29' AND DATE '1998-03-31' GROUP BY date_key""")
def _(m: Mart) -> DataFrame:
    period = Period("D", dt.date(1996, 2, 29), dt.date(1998, 3, 31))
    return _sales_by(flt.in_period(m.sales_rows, "sale_date", period, AS_OF), "date_key")


@query("p04_period_year_to_date", f"""
    SELECT date_key, {_SUMS} FROM sales_row
    WHERE sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-08-01' GROUP BY date_key""")
def _(m: Mart) -> DataFrame:
    return _sales_by(flt.in_period(m.sales_rows, "sale_date", Period("Y", ytd=-1), AS_OF), "date_key")


@query("p04_period_relative", f"""
    SELECT 'W' AS unit, date_key, {_SUMS} FROM sales_row
    WHERE sale_date BETWEEN date_trunc('week', DATE '2001-08-01') - INTERVAL 13 WEEK
                        AND date_trunc('week', DATE '2001-08-01') - INTERVAL 1 DAY GROUP BY date_key
    UNION ALL SELECT 'M', date_key, {_SUMS} FROM sales_row
    WHERE sale_date >= DATE '2001-05-01' AND sale_date < DATE '2001-08-01' GROUP BY date_key
    UNION ALL SELECT 'Q', date_key, {_SUMS} FROM sales_row
    WHERE sale_date >= DATE '2001-04-01' AND sale_date < DATE '2001-10-01' GROUP BY date_key
    UNION ALL SELECT 'Y', date_key, {_SUMS} FROM sales_row
    WHERE year(sale_date) IN (1999, 2000) GROUP BY date_key
    UNION ALL SELECT 'D', date_key, {_SUMS} FROM sales_row
    WHERE sale_date BETWEEN DATE '2001-07-22' AND DATE '2001-07-31' GROUP BY date_key""")
def _(m: Mart) -> DataFrame:
    spans = {"W": (-13, 13), "M": (-3, 3), "Q": (-1, 2), "Y": (-2, 2), "D": (-10, 10)}
    parts = []
    for unit, (start, duration) in spans.items():
        period = Period("R", unit=unit, start=start, duration=duration)
        rows = flt.in_period(m.sales_rows, "sale_date", period, AS_OF)
        parts.append(_sales_by(rows.withColumn("unit", F.lit(unit)), "unit", "date_key"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("p05_weekday_mask", f"""
    SELECT isodow(sale_date) AS weekday, {_SUMS} FROM sales_row
    WHERE isodow(sale_date) IN (1, 3, 7) GROUP BY isodow(sale_date)""")
def _(m: Mart) -> DataFrame:
    from tillroll.functions.weeks import weekday_no

    flags = (True, False, True, False, False, False, True)
    rows = flt.on_weekdays(m.sales_rows, "sale_date", flags)
    return _sales_by(rows.withColumn("weekday", weekday_no("sale_date")), "weekday")


@query("p06_direction", """
    SELECT t AS report_type, store_idx, count(*) AS receipts, sum(amount)::DOUBLE AS amount
    FROM receipt CROSS JOIN (VALUES (0), (1), (2), (3)) v(t)
    WHERE t = 0 OR (t = 1 AND origin_code = 'D') OR (t = 2 AND origin_code = 'A')
       OR (t = 3 AND coalesce(origin_code, '') = '')
    GROUP BY t, store_idx""")
def _(m: Mart) -> DataFrame:
    parts = [
        flt.in_direction(m.receipts, t).groupBy(F.lit(t).alias("report_type"), "store_idx")
        .agg(F.count("*").alias("receipts"), F.sum("amount").alias("amount"))
        for t in range(4)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("p07_id_range", f"""
    SELECT lev2_id, {_SUMS} FROM sales_row JOIN article USING (article_idx)
    WHERE coalesce(TRY_CAST(replace(lev2_id, 'Brand#', '') AS BIGINT), -1) <= 12 GROUP BY lev2_id""")
def _(m: Mart) -> DataFrame:
    numbered = m.articles.withColumn("group_no", F.regexp_replace("lev2_id", "^Brand#", ""))
    kept = flt.id_between(numbered, "group_no", None, 12)
    return _sales_by(m.sales_rows.join(kept, "article_idx"), "lev2_id")


@query("p08_value_ranges", f"""
    SELECT brand_id, lev1_id, {_SUMS} FROM sales_row JOIN article USING (article_idx)
    WHERE brand_id >= 'Brand#12' AND brand_id <= 'Brand#20' AND (lev3_id >= '35' OR lev3_id IS NULL)
    GROUP BY brand_id, lev1_id""")
def _(m: Mart) -> DataFrame:
    kept = flt.value_between(m.articles, "brand_id", "Brand#12", "Brand#20")
    kept = flt.value_between(kept, "lev3_id", "35", None)
    return _sales_by(m.sales_rows.join(kept, "article_idx"), "brand_id", "lev1_id")


@query("p09_current_version", f"""
    SELECT supplier_id, supplier_name, {_SUMS} FROM sales_row JOIN supp USING (supplier_idx)
    WHERE is_current GROUP BY supplier_id, supplier_name""")
def _(m: Mart) -> DataFrame:
    current = flt.current_version(m.suppliers)
    return _sales_by(m.sales_rows.join(current, "supplier_idx"), "supplier_id", "supplier_name")


@query("p10_current_only_switch", """
    SELECT 1 AS only_current, count(*) AS suppliers, sum(balance)::DOUBLE AS balance FROM supp WHERE is_current
    UNION ALL SELECT 0, count(*), sum(balance)::DOUBLE FROM supp""")
def _(m: Mart) -> DataFrame:
    parts = [
        flt.current_only(m.suppliers, on).agg(F.count("*").alias("suppliers"), F.sum("balance").alias("balance"))
        .select(F.lit(int(on)).alias("only_current"), "*")
        for on in (True, False)
    ]
    return parts[0].unionByName(parts[1])


@query("p11_known_members", """
    SELECT s.supplier_idx, u.supplier_name, count(*) AS row_count
    FROM sales_row s LEFT JOIN supp u ON u.supplier_idx = s.supplier_idx AND u.supplier_idx >= 0
    WHERE s.article_idx >= 0 GROUP BY s.supplier_idx, u.supplier_name""")
def _(m: Mart) -> DataFrame:
    named = flt.known_members(m.suppliers, "supplier_idx").select("supplier_idx", "supplier_name")
    rows = flt.known_members(m.sales_rows, "article_idx")
    return rows.join(named, "supplier_idx", "left").groupBy("supplier_idx", "supplier_name").agg(
        F.count("*").alias("row_count")
    )


@query("p12_excluded_groups", f"""
    SELECT lev1_id, lev3_id, {_SUMS} FROM sales_row JOIN article USING (article_idx)
    WHERE NOT is_third_party AND article_type_id NOT IN (130, 132) AND (lev3_id IS NULL OR lev3_id NOT IN ('31', '44'))
    GROUP BY lev1_id, lev3_id""")
def _(m: Mart) -> DataFrame:
    kept = m.articles.filter(~F.col("is_third_party"))
    kept = flt.exclude(flt.exclude(kept, "article_type_id", (130, 132)), "lev3_id", ("31", "44"))
    return _sales_by(m.sales_rows.join(kept, "article_idx"), "lev1_id", "lev3_id")


@query("p13_split_key_interval", """
    SELECT date_key, tender_id, count(*) AS payments, sum(amount)::DOUBLE AS amount FROM payment
    WHERE (date_key = 20240105 AND time_key >= 930) OR (date_key = 20240121 AND time_key <= 1745)
       OR (date_key > 20240105 AND date_key < 20240121)
    GROUP BY date_key, tender_id""")
def _(m: Mart) -> DataFrame:
    rows = flt.between_moments(m.payments, "date_key", "time_key", (20240105, 930), (20240121, 1745), at_col="logged_at")
    return rows.groupBy("date_key", "tender_id").agg(F.count("*").alias("payments"), F.sum("amount").alias("amount"))


@query("p14_campaign_list", f"""
    SELECT price_type, {_SUMS} FROM sales_row
    WHERE campaign_id IN (2, 3) OR combination_id = 6 OR reduction_id = 9 GROUP BY price_type""")
def _(m: Mart) -> DataFrame:
    rows = flt.in_campaigns(m.sales_rows, "2,3,6,9", ("campaign_id", "combination_id", "reduction_id"))
    return _sales_by(rows, "price_type")


@query("p15_price_type", """
    SELECT line_status, sum(CASE WHEN list_amount = sales_amount THEN 1 ELSE 0 END)::BIGINT AS normal_rows,
           sum(CASE WHEN list_amount <> sales_amount THEN 1 ELSE 0 END)::BIGINT AS offer_rows,
           sum(CASE WHEN price_type IN (8, 9) THEN discount_amount ELSE 0 END)::DOUBLE AS downprice_amount
    FROM sales_row WHERE qty_sold > 0 GROUP BY line_status""")
def _(m: Mart) -> DataFrame:
    normal = F.col("list_amount") == F.col("sales_amount")
    return m.sales_rows.filter(F.col("qty_sold") > 0).groupBy("line_status").agg(
        F.count_if(normal).alias("normal_rows"),
        F.count_if(~normal).alias("offer_rows"),
        sum_if(F.col("price_type").isin(8, 9), F.col("discount_amount")).alias("downprice_amount"),
    )


@query("p16_label_match", f"""
    SELECT article_idx, {_SUMS} FROM sales_row JOIN article USING (article_idx)
    WHERE 'Brand#7-Group Brand#7' IN (lev1_id || '-' || lev1_name, lev2_id || '-' || lev2_name, lev3_id || '-' || lev3_name)
    GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    pairs = [("lev1_id", "lev1_name"), ("lev2_id", "lev2_name"), ("lev3_id", "lev3_name")]
    kept = m.articles.filter(flt.matches_label(pairs, "Brand#7-Group Brand#7"))
    return _sales_by(m.sales_rows.join(kept, "article_idx"), "article_idx")


@query("p17_code_labels", """
    SELECT CASE origin_code WHEN 'D' THEN 'Departure' WHEN 'A' THEN 'Arrival' ELSE 'Extra' END AS flight_type,
           CASE origin_code WHEN 'D' THEN 'DEP' WHEN 'A' THEN 'ARR' ELSE 'EXT' END AS travel_type,
           count(*) AS receipts
    FROM receipt GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return m.receipts.groupBy(
        label_of("origin_code", FLIGHT_TYPE, "Extra").alias("flight_type"),
        label_of("origin_code", TRAVEL_TYPE, "EXT").alias("travel_type"),
    ).agg(F.count("*").alias("receipts"))


@query("p18_branch_search", """
    SELECT DISTINCT lev2_id AS node_id, lev1_id AS parent_id FROM article
    WHERE lev2_id IS NOT NULL AND lower(lev1_name) LIKE '%prom%'""")
def _(m: Mart) -> DataFrame:
    nodes = hierarchy_nodes(m.articles)
    return flt.branch_members(nodes, "Prom").select("node_id", "parent_id")


@query("p19_leaf_level", f"""
    SELECT CASE num_levels WHEN 1 THEN lev1_id WHEN 2 THEN lev2_id WHEN 3 THEN lev3_id END AS leaf_id, {_SUMS}
    FROM sales_row JOIN article USING (article_idx) GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    leaf = flt.leaf_level("num_levels", ("lev1_id", "lev2_id", "lev3_id")).alias("leaf_id")
    leaves = m.articles.select("article_idx", leaf)
    return _sales_by(m.sales_rows.join(leaves, "article_idx"), "leaf_id")


@query("p20_active_campaigns", """
    SELECT price_type, min(sale_date)::VARCHAR AS valid_from, max(sale_date)::VARCHAR AS valid_to FROM sales_row
    WHERE price_type > 0 GROUP BY price_type HAVING DATE '2001-08-01' BETWEEN min(sale_date) AND max(sale_date)""")
def _(m: Mart) -> DataFrame:
    spans = m.sales_rows.filter(F.col("price_type") > 0).groupBy("price_type").agg(
        F.min("sale_date").alias("valid_from"), F.max("sale_date").alias("valid_to")
    )
    return spans.filter(flt.active_on(AS_OF))


@query("p21_receipt_status", """
    SELECT receipt_status, count(*) AS receipts, sum(amount)::DOUBLE AS amount FROM receipt
    WHERE receipt_status IN (1, 5) GROUP BY receipt_status""")
def _(m: Mart) -> DataFrame:
    return flt.counted_receipts(m.receipts).groupBy("receipt_status").agg(
        F.count("*").alias("receipts"), F.sum("amount").alias("amount")
    )


# The payment lines of the till log and their rules, restated.
PAYMENT_LINES_SQL = """
    l AS (
        SELECT *, detail < 90 AS host_ok, CASE WHEN sub_tender_id = 1 THEN 'Manually' ELSE 'Automatically' END AS method, sub_tender_id = 3 AS is_refund,
          CASE WHEN detail < 60 THEN 'Tender' WHEN detail < 80 THEN 'TenderChange' WHEN detail < 90 THEN 'PaidIn' ELSE 'PaidOut' END AS line_type,
          CASE WHEN event_type = 'view' THEN 'Cash' WHEN event_type = 'click' THEN 'CreditDebit' WHEN event_type = 'purchase' THEN 'Mobile'
               WHEN event_type = 'signup' THEN 'GiftCard' WHEN detail < 5 THEN 'Ikano' WHEN detail < 10 THEN 'Retain24In' WHEN detail < 15 THEN 'Retain24Out'
               WHEN detail < 20 THEN 'TypiskNorskDiscount' WHEN detail < 25 THEN 'TypiskNorskReturn' WHEN detail < 30 THEN 'VRExt:CashHandlingSystem'
               WHEN detail < 35 THEN 'CashHandlingSystem' WHEN detail < 40 THEN 'ChainCard' WHEN detail < 45 THEN 'Bitcoin' ELSE 'CustomerAccount' END AS tender_type,
          CASE WHEN receipt_status = 5 THEN 'PostVoided' ELSE 'Finished' END AS status, CASE WHEN sub_tender_id = 2 THEN 10.5 END AS foreign_rate,
          CASE WHEN sub_tender_id = 2 AND detail % 2 = 0 THEN 'EUR' WHEN sub_tender_id = 2 THEN 'NOK' END AS foreign_currency,
          CASE WHEN event_type = 'signup' AND detail < 8 THEN 98 + detail END AS internal_id,
          event_type = 'view' AND detail BETWEEN 90 AND 94 AS is_deposit, event_type = 'view' AND detail >= 95 AS is_withdrawal
        FROM payment),
    classified AS (
        SELECT * EXCLUDE (tender_id),
          CASE WHEN internal_id IS NOT NULL THEN internal_id WHEN tender_type = 'Cash' AND foreign_rate IS NULL THEN 1
               WHEN tender_type = 'Cash' AND foreign_currency <> 'NOK' THEN 8 WHEN tender_type = 'Cash' THEN -4
               WHEN tender_type = 'CreditDebit' AND NOT host_ok THEN 5 WHEN tender_type = 'CreditDebit' AND method = 'Automatically' THEN 3
               WHEN tender_type = 'CreditDebit' THEN 14 WHEN tender_type = 'Mobile' THEN 22 WHEN tender_type = 'GiftCard' THEN 2
               WHEN tender_type = 'CustomerAccount' THEN 6 WHEN tender_type = 'Ikano' THEN 16 WHEN tender_type = 'Retain24In' THEN 17
               WHEN tender_type = 'Retain24Out' THEN 18 WHEN tender_type = 'TypiskNorskDiscount' THEN 20 WHEN tender_type = 'TypiskNorskReturn' THEN 21
               WHEN tender_type LIKE '%CashHandlingSystem' THEN 9 WHEN tender_type = 'ChainCard' THEN 150 ELSE -4 END AS tender_id,
          CASE WHEN internal_id >= 100 THEN CASE internal_id WHEN 101 THEN 20801 WHEN 102 THEN 20802 END
               WHEN is_deposit THEN CASE detail % 5 WHEN 0 THEN 30111 WHEN 1 THEN 30112 WHEN 2 THEN 30113 ELSE 21304 END
               WHEN is_withdrawal THEN CASE detail % 5 WHEN 0 THEN 30110 WHEN 1 THEN 30115 WHEN 2 THEN 30116 WHEN 3 THEN 30114 ELSE 21304 END
               WHEN line_type = 'Tender' AND tender_type = 'Cash' THEN 20101 WHEN line_type = 'TenderChange' AND tender_type = 'Cash' THEN 21301
               WHEN line_type = 'Tender' AND tender_type = 'CashHandlingSystem' THEN 20102
               WHEN tender_type = 'CustomerAccount' THEN 20202 WHEN tender_type = 'Ikano' THEN 20206
               WHEN tender_type = 'CreditDebit' AND NOT host_ok THEN 20301 WHEN tender_type = 'CreditDebit' AND method = 'Automatically' THEN 20303
               WHEN tender_type = 'CreditDebit' THEN 20302 WHEN tender_type IN ('GiftCard', 'Retain24In') THEN 20702 WHEN tender_type = 'Mobile' THEN 20401
               WHEN tender_type IN ('TypiskNorskDiscount', 'TypiskNorskReturn') THEN 20710
               WHEN line_type = 'PaidIn' THEN 20104 WHEN line_type = 'PaidOut' THEN 21304 ELSE -3 END AS trans_type,
          CASE WHEN status = 'PostVoided' THEN -1 ELSE 1 END *
          CASE WHEN line_type = 'TenderChange' AND tender_type = 'Cash' THEN -abs(amount)
               WHEN line_type = 'Tender' AND tender_type = 'CashHandlingSystem' THEN abs(amount)
               WHEN line_type IN ('Tender', 'TenderChange') AND is_refund THEN -amount ELSE amount END AS signed_amount
        FROM l)"""

_PAYMENT_RULES_SQL = f"""
    WITH {PAYMENT_LINES_SQL}
    SELECT line_type, tender_type, status, tender_id::BIGINT AS tender_id, trans_type::BIGINT AS trans_type, count(*) AS line_count, sum(signed_amount)::DOUBLE AS signed_amount
    FROM classified GROUP BY line_type, tender_type, status, tender_id, trans_type"""


def payment_lines(m: Mart) -> DataFrame:
    """Raw payment lines of the till log, before they are classified."""
    k, event, sub = F.col("detail"), F.col("event_type"), F.col("sub_tender_id")
    types = {"view": "Cash", "click": "CreditDebit", "purchase": "Mobile", "signup": "GiftCard"}
    rare = ("Ikano", "Retain24In", "Retain24Out", "TypiskNorskDiscount", "TypiskNorskReturn", "VRExt:CashHandlingSystem", "CashHandlingSystem", "ChainCard", "Bitcoin")
    other = F.coalesce(F.get(F.array(*[F.lit(t) for t in rare]), F.floor(k / 5).cast("int")), F.lit("CustomerAccount"))
    answers = F.array(*[F.lit(a) for a in ("OK", "FlagError", "Error", "NoCash", "Timeout")])
    return m.payments.select(
        "payment_no", "store_idx", "till_id", "cashier_idx", "cashier_name", "logged_at", "date_key", "time_key", "amount",
        F.when(k < 60, "Tender").when(k < 80, "TenderChange").when(k < 90, "PaidIn").otherwise("PaidOut").alias("line_type"),
        F.coalesce(label_of("event_type", types), other).alias("tender_type"),
        F.when(F.col("receipt_status") == 5, "PostVoided").otherwise("Finished").alias("status"),
        (k < 90).alias("host_authorized"),
        F.when(sub == 1, "Manually").otherwise("Automatically").alias("authorization_method"),
        (sub == 3).alias("is_refund"),
        F.when(sub == 2, F.lit("10.50").cast("decimal(6,2)")).alias("foreign_rate"),
        F.lit("NOK").alias("currency"),
        F.when((sub == 2) & (k % 2 == 0), "EUR").when(sub == 2, "NOK").alias("foreign_currency"),
        F.when((event == "signup") & (k < 8), 98 + k).cast("int").alias("internal_tender_id"),
        ((event == "view") & k.between(90, 94)).alias("is_deposit"),
        ((event == "view") & (k >= 95)).alias("is_withdrawal"),
        F.get(answers, (k % 5).cast("int")).alias("deposit_result"),
    )


def classified_lines(m: Mart) -> DataFrame:
    """The payment lines by the rules, with the tenders that the chain has added."""
    custom = inline_table(m.spark, {"tender_type": ["ChainCard", "Ikano"], "custom_tender_id": [150, 999]})
    own = inline_table(m.spark, {"internal_tender_id": [101, 102], "own_trans_type": [20801, 20802]})
    return classify_payments(payment_lines(m), custom, own)


@query("p22_payment_classes", _PAYMENT_RULES_SQL)
def _(m: Mart) -> DataFrame:
    return classified_lines(m).groupBy("line_type", "tender_type", "status", "tender_id", "trans_type").agg(
        F.count("*").alias("line_count"), F.sum("signed_amount").alias("signed_amount")
    )
