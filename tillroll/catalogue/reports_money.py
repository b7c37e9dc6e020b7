"""Payments, settlements, reconciliation and finance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.predicates import PAYMENT_LINES_SQL, classified_lines
from tillroll.catalogue.registry import query
from tillroll.plans import finance, reconciliation as rec, settlements
from tillroll.plans.calendar import Period
from tillroll.sources.scratch import scratch_path
from tillroll.sources.mart import AS_OF, Mart

_CARD = "CASE sub_tender_id WHEN 1 THEN 'BankAxept' WHEN 2 THEN 'Visa' WHEN 3 THEN 'MasterCard' WHEN 4 THEN 'AmericanExpress' WHEN 9 THEN 'Maestro' ELSE 'N/A' END"
_HOME = "amount * CASE WHEN exchange_rate = 0 THEN 1 ELSE exchange_rate END"
_ZNR = "CAST(strftime(sale_date, '%Y%m') AS INTEGER)"


def _sum_if(cond: str, value: str, name: str) -> str:
    return f"sum(CASE WHEN {cond} THEN {value} ELSE 0 END)::DOUBLE AS {name}"


@query("r08_reconciliation_summary", """
    WITH v AS (SELECT store_idx, sale_date, """ + ", ".join(
        f"{_sum_if(f'vat_group = {g}', 'sales_excl_vat + return_excl_vat', f'revenue_{g}')}, {_sum_if(f'vat_group = {g}', 'sales_vat + return_vat', f'vat_{g}')}"
        for g in (0, 5, 8)) + f""" FROM receipt_row GROUP BY ALL),
    t AS (SELECT store_idx, sale_date, sum(amount)::DOUBLE AS revenue_incl_vat, {_sum_if("tender_id IN (1, 8)", "amount", "cash")},
                 {_sum_if("tender_id = 3", "amount", "payment_card")}, {_sum_if("tender_id = 5", "amount", "payment_card_reserve")}
          FROM receipt GROUP BY ALL)
    SELECT v.* EXCLUDE (sale_date), v.sale_date::VARCHAR AS sale_date, t.* EXCLUDE (store_idx, sale_date), {_ZNR.replace('sale_date', 'v.sale_date')} AS znr
    FROM v JOIN t ON t.store_idx = v.store_idx AND t.sale_date = v.sale_date""")
def _(m: Mart) -> DataFrame:
    return rec.reconciliation_summary(m.receipt_rows, m.receipts, m.system_totals)


# -- payments and settlements -----------------------------------------------------------------


@query("r53_payment_lines", f"""
    WITH {PAYMENT_LINES_SQL}
    SELECT payment_no, store_idx, till_id, cashier_name, date_key, strftime(logged_at, '%H:%M') AS payment_time, tender_id::BIGINT AS tender_id,
           trans_type::BIGINT AS trans_type, signed_amount::DOUBLE AS signed_amount, CASE line_type WHEN 'PaidIn' THEN 113 WHEN 'PaidOut' THEN 114 ELSE 12 END AS transaction_kind
    FROM classified""")
def _(m: Mart) -> DataFrame:
    line = F.col("line_type")
    return classified_lines(m).select(
        "payment_no", "store_idx", "till_id", "cashier_name", "date_key", F.date_format("logged_at", "HH:mm").alias("payment_time"),
        "tender_id", "trans_type", "signed_amount", F.when(line == "PaidIn", 113).when(line == "PaidOut", 114).otherwise(12).alias("transaction_kind"),
    )


_LINES = """SELECT store_idx, {znr} AS znr, CASE tender_id WHEN 1 THEN '1900' WHEN 3 THEN '1920' WHEN 5 THEN '1925' WHEN 6 THEN '1500' WHEN 8 THEN '1905' END AS debit_account,
           '' AS credit_account, 0 AS vat_rate, sum(amount) AS debit_amount, 0 AS credit_amount FROM receipt WHERE {cond} GROUP BY ALL
    UNION ALL SELECT store_idx, {znr}, '', '3000', 0, 0, sum(amount) FROM receipt WHERE {cond} GROUP BY ALL"""
_NEW = _LINES.format(znr=_ZNR, cond="TRUE")
_STORED = _LINES.format(znr=_ZNR, cond="NOT (order_status = 'P' AND tender_id = 8 AND year(sale_date) < 1998) AND sale_date < DATE '2001-06-01'")
_REVISION = f"""
    WITH n AS ({_NEW}), o AS ({_STORED}),
    changed AS (SELECT store_idx, znr FROM ((SELECT * FROM n EXCEPT ALL SELECT * FROM o) UNION ALL (SELECT * FROM o EXCEPT ALL SELECT * FROM n)) GROUP BY ALL)"""
_LINE_OUT = "debit_account, credit_account, vat_rate::BIGINT AS vat_rate, debit_amount::DOUBLE AS debit_amount, credit_amount::DOUBLE AS credit_amount"


def _revision(m: Mart) -> settlements.SettlementStore:
    """The settlements of an earlier day, stored, and then those of today."""
    foreign = (F.col("order_status") == "P") & (F.col("tender_id") == 8) & (F.year("sale_date") < 1998)
    before = m.receipts.filter(~foreign & (F.col("sale_date") < F.lit(dt.date(2001, 6, 1))))
    store = settlements.SettlementStore(m.spark, f"{scratch_path(m.spark)}-settlements")
    store.commit(settlements.settlement_lines(before))
    store.commit(settlements.settlement_lines(m.receipts))
    return store


@query("r54_settlement_revision", f"""{_REVISION}
    SELECT store_idx, znr, {_LINE_OUT}, 1::BIGINT AS revision FROM o WHERE (store_idx, znr) NOT IN (SELECT store_idx, znr FROM changed)
    UNION ALL SELECT store_idx, znr, {_LINE_OUT}, CASE WHEN (store_idx, znr) IN (SELECT store_idx, znr FROM o) THEN 2 ELSE 1 END
    FROM n WHERE (store_idx, znr) IN (SELECT store_idx, znr FROM changed)""")
def _(m: Mart) -> DataFrame:
    return _revision(m).current()


@query("r54_settlement_archive", f"""{_REVISION}
    SELECT store_idx, znr, {_LINE_OUT}, 1::BIGINT AS revision FROM o WHERE (store_idx, znr) IN (SELECT store_idx, znr FROM changed)""")
def _(m: Mart) -> DataFrame:
    return _revision(m).archive()


# Fixed values of the mapping: accounts by tender, VAT rate and department; open columns fit everything.
POSTING_RULES = {
    "rule_no": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    "kind": ["payment"] * 5 + ["sale"] * 5 + ["difference"],
    "tender_id": [None, 1, 3, 5, 8] + [None] * 6,
    "vat_rate": [None] * 6 + [0, None, 8, 8, None],
    "department": [None] * 7 + ["PROMO", None, "PROMO", None],
    "account": ["1999", "1900", "1920", "1925", "1905", "3000", "3100", "3500", "3008", "3508", "7999"],
}


@query("r54_posted_lines", f"""
    WITH p AS (SELECT store_idx, {_ZNR} AS znr, CASE tender_id WHEN 1 THEN '1900' WHEN 3 THEN '1920' WHEN 5 THEN '1925' WHEN 8 THEN '1905' ELSE '1999' END AS debit_account,
        sum(amount) AS debit FROM receipt GROUP BY ALL),
    s AS (SELECT store_idx, {_ZNR} AS znr, lev1_id AS department, vat_group, sum(sales_amount + return_amount) AS credit,
        CASE WHEN vat_group = 8 AND lev1_id = 'PROMO' THEN '3508' WHEN vat_group = 8 THEN '3008' WHEN vat_group = 0 AND lev1_id <> 'PROMO' THEN '3100'
             WHEN vat_group = 0 THEN '3100' WHEN lev1_id = 'PROMO' THEN '3500' ELSE '3000' END AS credit_account
        FROM receipt_row JOIN article USING (article_idx) GROUP BY store_idx, 2, lev1_id, vat_group),
    gap AS (SELECT store_idx, znr, sum(v) AS v FROM (SELECT store_idx, znr, debit AS v FROM p UNION ALL SELECT store_idx, znr, -credit FROM s) GROUP BY ALL)
    SELECT store_idx, znr, '' AS department, debit_account, '' AS credit_account, 0::BIGINT AS vat_rate, debit::DOUBLE AS debit_amount, 0::DOUBLE AS credit_amount FROM p
    UNION ALL SELECT store_idx, znr, department, '', credit_account, vat_group, 0, credit::DOUBLE FROM s
    UNION ALL SELECT store_idx, znr, '', CASE WHEN v < 0 THEN '7999' ELSE '' END, CASE WHEN v > 0 THEN '7999' ELSE '' END, 0,
        greatest(-v, 0)::DOUBLE, greatest(v, 0)::DOUBLE FROM gap WHERE v <> 0""")
def _(m: Mart) -> DataFrame:
    shape = "rule_no int, kind string, tender_id int, vat_rate int, department string, account string"
    rules = m.spark.createDataFrame(list(zip(*POSTING_RULES.values(), strict=True)), shape)
    return settlements.posted_lines(settlements.postings(m.receipts, m.receipt_rows, m.articles), rules)


@query("r55_debit_equals_credit", f"""
    SELECT store_idx, znr, sum(debit_amount)::DOUBLE AS debit, sum(credit_amount)::DOUBLE AS credit,
           (sum(debit_amount) = sum(credit_amount))::BIGINT AS approved FROM ({_NEW}) GROUP BY store_idx, znr""")
def _(m: Mart) -> DataFrame:
    return settlements.debit_equals_credit(settlements.settlement_lines(m.receipts))


_APPROVAL = """
    WITH t AS (SELECT store_idx, znr, sum(amount) AS reconciled FROM system_total GROUP BY ALL),
    r AS (SELECT store_idx, {znr} AS znr, sum(amount) AS tenders FROM receipt WHERE receipt_status IN (1, 5) GROUP BY ALL)
    SELECT store_idx, znr, reconciled::DOUBLE AS reconciled, coalesce(tenders, 0)::DOUBLE AS tenders, (coalesce(tenders, 0) - reconciled)::DOUBLE AS difference,
           (coalesce(tenders, 0) = reconciled)::BIGINT AS approved FROM t LEFT JOIN r USING (store_idx, znr)"""


@query("r55_tenders_by_register", _APPROVAL.format(znr=_ZNR))
def _(m: Mart) -> DataFrame:
    return settlements.tenders_equal_reconciliation(m.receipts, m.system_totals, total_type=1)


@query("r55_tenders_by_till", _APPROVAL.format(znr=_ZNR))
def _(m: Mart) -> DataFrame:
    return settlements.tenders_equal_reconciliation(m.receipts, m.system_totals, total_type=4)


@query("r55_tenders_by_cashier", _APPROVAL.format(znr=_ZNR))
def _(m: Mart) -> DataFrame:
    return settlements.tenders_equal_reconciliation(m.receipts, m.system_totals, total_type=2)


# -- accounts ---------------------------------------------------------------------------------

_BRANCHES = f"""
    WITH g AS (SELECT * FROM receipt_row JOIN article USING (article_idx)),
    s AS (SELECT store_idx, sale_date,
            sum(CASE WHEN lev1_id NOT IN ('STANDARD', 'ECONOMY') AND vat_group < 3 THEN sales_amount + return_amount ELSE 0 END) AS sales_low,
            sum(CASE WHEN lev1_id NOT IN ('STANDARD', 'ECONOMY') AND vat_group BETWEEN 3 AND 5 THEN sales_amount + return_amount ELSE 0 END) AS sales_mid,
            sum(CASE WHEN lev1_id NOT IN ('STANDARD', 'ECONOMY') AND vat_group > 5 THEN sales_amount + return_amount ELSE 0 END) AS sales_high,
            sum(CASE WHEN lev1_id NOT IN ('STANDARD', 'ECONOMY') THEN sales_excl_vat + return_excl_vat ELSE 0 END) AS net_revenue,
            sum(CASE WHEN lev1_id NOT IN ('STANDARD', 'ECONOMY') THEN sales_amount + return_amount ELSE 0 END) AS gross_revenue,
            sum(CASE WHEN lev1_id = 'STANDARD' THEN sales_amount + return_amount ELSE 0 END) AS gaming,
            sum(CASE WHEN lev1_id = 'ECONOMY' THEN sales_amount + return_amount ELSE 0 END) AS gift_cards FROM g GROUP BY ALL),
    p AS (SELECT store_idx, sale_date, sum(CASE WHEN tender_id IN (1, 9) THEN {_HOME} ELSE 0 END) AS cash,
            sum(CASE WHEN tender_id = 6 THEN {_HOME} ELSE 0 END) AS credit, sum(CASE WHEN tender_id IN (3, 5, 14) THEN {_HOME} ELSE 0 END) AS bank,
            {", ".join(f"sum(CASE WHEN tender_id IN (3, 5, 14) AND sub_tender_id = {c} THEN {_HOME} ELSE 0 END) AS card_{c}" for c in (1, 2, 3, 4, 9))}
          FROM receipt GROUP BY ALL),
    k AS (SELECT store_idx, znr, sum(amount) AS amount FROM (SELECT *, row_number() OVER (PARTITION BY store_idx, znr, till_id, tender_id ORDER BY count_no DESC) AS rn
            FROM counting WHERE tender_id IN (1, 9)) WHERE rn = 1 GROUP BY ALL),
    c AS (SELECT store_idx, sale_date, sum(k.amount) AS counted_cash FROM k JOIN
            (SELECT store_idx, znr, max(last_date) AS sale_date FROM system_total GROUP BY ALL) x USING (store_idx, znr) GROUP BY ALL),
    l AS (SELECT store_idx, business_date AS sale_date, sum(amount) AS lottery FROM payment WHERE event_type = 'purchase' GROUP BY ALL),
    b AS (SELECT s.*, coalesce(cash, 0) AS cash, coalesce(credit, 0) AS credit, coalesce(bank, 0) AS bank,
            {", ".join(f"coalesce(card_{c}, 0) AS card_{c}" for c in (1, 2, 3, 4, 9))}, coalesce(counted_cash, 0) AS counted_cash, coalesce(lottery, 0) AS lottery
          FROM s LEFT JOIN p ON p.store_idx = s.store_idx AND p.sale_date = s.sale_date LEFT JOIN c ON c.store_idx = s.store_idx AND c.sale_date = s.sale_date
          LEFT JOIN l ON l.store_idx = s.store_idx AND l.sale_date = s.sale_date)"""


def _branches(m: Mart) -> DataFrame:
    counted = rec.counted_cash_by_day(m.counts, m.system_totals)
    return rec.daily_branches(m.receipt_rows, m.receipts, counted, rec.lottery_by_day(m.payments), m.articles)


def _ledger(text: str, value: str, debit: bool) -> str:
    amounts = f"({value})::DOUBLE AS debit_amount, '{text}' AS debit_text, 0::DOUBLE AS credit_amount, '' AS credit_text" if debit else (
        f"0::DOUBLE AS debit_amount, '' AS debit_text, ({value})::DOUBLE AS credit_amount, '{text}' AS credit_text")
    return f"SELECT store_idx, sale_date::VARCHAR AS sale_date, {amounts} FROM b"


_DEBITS = {"Account sales": "credit", "Lottery": "lottery", "Bank card": "card_1", "Visa": "card_2", "MasterCard": "card_3",
           "American Express": "card_4", "Maestro": "card_9", "Night safe": "counted_cash"}
_CREDITS = {"Cash difference": "counted_cash - cash", "Sales high VAT": "sales_high", "Sales medium VAT": "sales_mid",
            "Sales low VAT": "sales_low", "Gaming": "gaming", "Gift cards": "gift_cards"}
_INTERIM = " + ".join(_DEBITS.values()) + " - (" + " + ".join(_CREDITS.values()) + ")"


@query("r56_account_lines", _BRANCHES + " UNION ALL ".join(
    [_ledger("Interim", _INTERIM, False)] + [_ledger(t, v, False) for t, v in _CREDITS.items()] + [_ledger(t, v, True) for t, v in _DEBITS.items()]))
def _(m: Mart) -> DataFrame:
    return rec.account_lines(_branches(m))


@query("r57_monthly_account", f"""{_BRANCHES}
    SELECT store_idx, sale_date::VARCHAR AS sale_date, net_revenue::DOUBLE AS net_revenue, gross_revenue::DOUBLE AS gross_revenue, bank::DOUBLE AS bank,
           credit::DOUBLE AS credit, cash::DOUBLE AS cash, counted_cash::DOUBLE AS counted_cash, (counted_cash - cash)::DOUBLE AS cash_difference,
           gaming::DOUBLE AS gaming, lottery::DOUBLE AS lottery, gift_cards::DOUBLE AS gift_cards,
           (gross_revenue - (bank + credit) - (counted_cash + (counted_cash - cash) + gaming + lottery + gift_cards))::DOUBLE AS remaining FROM b""")
def _(m: Mart) -> DataFrame:
    return rec.monthly_account(_branches(m))


_BANK = """
    WITH e AS (SELECT store_idx, {card} AS card_name, sum(transactions)::BIGINT AS bank_count, sum(amount)::DOUBLE AS bank_amount FROM bank {bank_where} GROUP BY ALL),
    r AS (SELECT store_idx, {card} AS card_name, sum({home})::DOUBLE AS till_amount, count(DISTINCT receipt_id) AS till_count
          FROM receipt WHERE tender_id IN (3, 5, 14) {cond} GROUP BY ALL)
    SELECT coalesce(e.store_idx, r.store_idx) AS store_idx, coalesce(e.card_name, r.card_name) AS card_name, bank_count, bank_amount, till_amount, till_count
    FROM e FULL JOIN r ON e.store_idx = r.store_idx AND e.card_name = r.card_name"""


@query("r58_bank_against_register", _BANK.format(card=_CARD, home=_HOME, cond="", bank_where=""))
def _(m: Mart) -> DataFrame:
    return rec.bank_against_register(m.bank_settlements, m.receipts)


_COUNTERS = """count(CASE WHEN accumulation_id = 1 THEN 1 END) AS customers, count(CASE WHEN accumulation_id = 11 THEN 1 END) AS returns,
    sum(CASE WHEN accumulation_id = 11 THEN amount ELSE 0 END)::DOUBLE AS return_amount, count(CASE WHEN accumulation_id = 5 THEN 1 END) AS corrections,
    sum(CASE WHEN accumulation_id = 5 THEN amount ELSE 0 END)::DOUBLE AS correction_amount, count(CASE WHEN accumulation_id = 10 THEN 1 END) AS canceled,
    count(CASE WHEN accumulation_id = 19 THEN 1 END) AS price_checks, sum(CASE WHEN accumulation_id = 6 THEN amount ELSE 0 END)::DOUBLE AS discount"""


@query("r59_operations_by_day", f"SELECT log_date::VARCHAR AS log_date, store_idx, {_COUNTERS} FROM accumulation GROUP BY log_date, store_idx")
def _(m: Mart) -> DataFrame:
    return rec.operations_by_day(m.accumulations)


_VAT = """sum(sales_amount + return_amount)::DOUBLE AS sales_amount, sum(sales_vat + return_vat)::DOUBLE AS vat_amount,
    sum(sales_excl_vat + return_excl_vat)::DOUBLE AS sales_excl_vat"""


@query("r60_vat_by_store", f"SELECT store_idx, vat_group, {_VAT} FROM receipt_row GROUP BY store_idx, vat_group")
def _(m: Mart) -> DataFrame:
    return rec.vat_by_store(m.receipt_rows)


@query("r61_cash_settlement", f"""
    WITH s AS (SELECT store_idx, znr, sum(CASE WHEN tender_id IN (1, 2, 3, 5, 6, 8, 9, 14, 19, 22) THEN amount ELSE 0 END) AS total,
                 sum(CASE WHEN tender_id IN (1, 9) THEN amount ELSE 0 END) AS system_cash, sum(CASE WHEN tender_id IN (3, 5, 14) THEN amount ELSE 0 END) AS cards,
                 sum(CASE WHEN tender_id = 6 THEN amount ELSE 0 END) AS account, sum(CASE WHEN tender_id = 8 THEN amount ELSE 0 END) AS currency
               FROM system_total GROUP BY ALL),
    c AS (SELECT c.store_idx, c.znr, sum(amount) AS counted, sum(CASE WHEN tender_id IN (1, 9) THEN amount ELSE 0 END) AS counted_cash
          FROM counting c JOIN (SELECT store_idx, znr, max(count_no) AS count_no FROM counting GROUP BY ALL) x USING (store_idx, znr, count_no) GROUP BY ALL),
    g AS (SELECT store_idx, {_ZNR} AS znr, sum(sales_amount + return_amount) AS gaming FROM receipt_row JOIN article USING (article_idx)
          WHERE lev1_id = 'STANDARD' GROUP BY ALL)
    SELECT store_idx, znr, total::DOUBLE AS total, system_cash::DOUBLE AS system_cash, cards::DOUBLE AS cards, account::DOUBLE AS account,
           0::DOUBLE AS mobile, 0::DOUBLE AS vouchers, currency::DOUBLE AS currency, coalesce(counted, 0)::DOUBLE AS counted,
           coalesce(counted_cash, 0)::DOUBLE AS counted_cash, coalesce(gaming, 0)::DOUBLE AS gaming, (system_cash - coalesce(counted_cash, 0))::DOUBLE AS cash_deviation
    FROM s LEFT JOIN c USING (store_idx, znr) LEFT JOIN g USING (store_idx, znr)""")
def _(m: Mart) -> DataFrame:
    return rec.cash_settlement(m.system_totals, m.counts, rec.gaming_by_round(m.receipt_rows, m.articles))


@query("r62_gaming_amount", f"""
    SELECT store_idx, sum({_HOME.replace('amount', '(sales_amount + return_amount)', 1)})::DOUBLE AS gaming
    FROM receipt_row JOIN article USING (article_idx) WHERE lev1_id = 'STANDARD' GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    return rec.gaming_amount(m.receipt_rows, m.articles)


_LAST_COUNTS = """last_count AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_idx, znr, till_id, tender_id ORDER BY count_no DESC) AS rn
    FROM counting) WHERE rn = 1)"""


@query("r63_reconciliation_with_bag", f"""
    WITH {_LAST_COUNTS}, s AS (SELECT store_idx, znr, till_id, cashier_idx, cashier_name, sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END) AS cash
        FROM system_total GROUP BY ALL HAVING sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END) > 0),
    c AS (SELECT store_idx, znr, till_id, bag_id, {_sum_if("tender_id = 1", "amount", "counted_cash")}, {_sum_if("tender_id IN (3, 5)", "amount", "counted_cards")}
          FROM last_count GROUP BY ALL)
    SELECT store_idx, znr, till_id, cashier_name, cash::DOUBLE AS cash, bag_id, counted_cash, counted_cards FROM s LEFT JOIN c USING (store_idx, znr, till_id)""")
def _(m: Mart) -> DataFrame:
    return rec.reconciliation_with_bag(m.system_totals, m.counts)


@query("r64_payment_means", f"""
    SELECT store_id, store_name, lev1_region_name, {_sum_if("tender_id IN (1, 9)", _HOME, "cash")},
           {_sum_if("tender_id IN (3, 5, 14) AND sub_tender_id IN (1, 4)", _HOME, "bank_card")}, {_sum_if("tender_id = 3 AND sub_tender_id = 2", _HOME, "visa")},
           {_sum_if("tender_id = 3 AND sub_tender_id = 3", _HOME, "master_card")}, {_sum_if("tender_id = 3 AND sub_tender_id = 9", _HOME, "maestro")},
           {_sum_if("tender_id = 6", _HOME, "credit")}, {_sum_if("tender_id = 8", _HOME, "currency")}, 0::DOUBLE AS mobile
    FROM receipt JOIN store USING (store_idx) GROUP BY store_id, store_name, lev1_region_name""")
def _(m: Mart) -> DataFrame:
    return rec.payment_means(m.receipts, m.stores)


def _kinds(prefix: str = "") -> str:
    return ", ".join([
        _sum_if("tender_id = 1", "amount", f"{prefix}cash"), _sum_if("tender_id IN (3, 5)", "amount", f"{prefix}cards"),
        _sum_if("tender_id = 6", "amount", f"{prefix}account"), _sum_if("tender_id = 22", "amount", f"{prefix}mobile"),
        _sum_if("tender_id IN (2, 19)", "amount", f"{prefix}vouchers"), _sum_if("tender_id = 8", "amount", f"{prefix}currency"),
    ])


@query("r65_reconciliation_details", f"""
    WITH {_LAST_COUNTS}, s AS (SELECT store_idx, znr, till_id, sum(amount)::DOUBLE AS sales_amount, {_kinds()},
              sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END) AS exact_cash FROM system_total GROUP BY ALL),
    c AS (SELECT store_idx, znr, till_id, sum(CASE WHEN tender_id = 1 THEN amount ELSE 0 END) AS exact_counted, max(bag_id) AS bag_id FROM last_count GROUP BY ALL),
    k AS (SELECT store_idx, {_ZNR} AS znr, sum(amount)::DOUBLE AS total_sales, {_kinds("total_")} FROM receipt GROUP BY 1, 2),
    d AS (SELECT store_idx, CAST(strftime(business_date, '%Y%m') AS INTEGER) AS znr, till_id, sum(amount)::DOUBLE AS bottle_deposit FROM accumulation
          WHERE accumulation_id = 7 GROUP BY ALL)
    SELECT s.* EXCLUDE (exact_cash), bag_id, coalesce(exact_counted, 0)::DOUBLE AS counted_cash, (coalesce(exact_counted, 0) - exact_cash)::DOUBLE AS cash_deviation,
           coalesce(bottle_deposit, 0)::DOUBLE AS bottle_deposit, k.* EXCLUDE (store_idx, znr)
    FROM s LEFT JOIN c USING (store_idx, znr, till_id) LEFT JOIN d USING (store_idx, znr, till_id) LEFT JOIN k USING (store_idx, znr)""")
def _(m: Mart) -> DataFrame:
    return rec.reconciliation_details(m.system_totals, m.counts, m.receipts, m.accumulations)


@query("r66_accumulation_details", f"""
    WITH c AS (SELECT store_idx, till_id, cashier_idx, cashier_name, {_COUNTERS} FROM accumulation GROUP BY ALL),
    p AS (SELECT store_idx, till_id, cashier_idx, sum(amount)::DOUBLE AS sales_amount FROM receipt GROUP BY ALL)
    SELECT c.*, coalesce(p.sales_amount, 0) AS sales_amount FROM c LEFT JOIN p USING (store_idx, till_id, cashier_idx)""")
def _(m: Mart) -> DataFrame:
    return rec.accumulation_details(m.accumulations, m.receipts)


@query("r67_bag_totals", f"""
    WITH {_LAST_COUNTS}, p AS (SELECT bag_id, store_idx, znr, tender_id, sum(amount) AS amount FROM last_count WHERE tender_id IN (1, 8) GROUP BY ALL)
    SELECT bag_id, sum(amount)::DOUBLE AS amount, count(DISTINCT znr) AS rounds FROM p WHERE amount > 0 GROUP BY bag_id""")
def _(m: Mart) -> DataFrame:
    return rec.bag_totals(m.counts)


@query("r68_foreign_currency", f"""
    SELECT currency, exchange_rate::DOUBLE AS exchange_rate, sum(amount)::DOUBLE AS currency_amount, sum({_HOME})::DOUBLE AS home_amount
    FROM receipt WHERE tender_id = 8 GROUP BY currency, exchange_rate""")
def _(m: Mart) -> DataFrame:
    return rec.foreign_currency(m.receipts)


@query("r69_card_totals", _BANK.format(
    card=_CARD, home=_HOME, cond="AND receipt_status = 5 AND sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-01-31'",
    bank_where="WHERE sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-01-31'"))
def _(m: Mart) -> DataFrame:
    return rec.bank_against_register(
        m.bank_settlements, m.receipts, bounds=(dt.date(1999, 1, 1), dt.date(1999, 1, 31)), status=5
    )


@query("r70_receipt_date_range", """
    SELECT store_idx, znr, min(first_date)::VARCHAR AS first_day, max(last_date)::VARCHAR AS last_day FROM system_total GROUP BY store_idx, znr""")
def _(m: Mart) -> DataFrame:
    return rec.receipt_date_range(m.system_totals)


_PERIODS = """
    WITH c AS (SELECT DISTINCT store_idx, logged_at AS s FROM payment WHERE event_type = 'error' AND detail >= 90),
    p AS (SELECT * FROM (SELECT store_idx, s AS period_start, lead(s) OVER (PARTITION BY store_idx ORDER BY s) AS period_end FROM c) WHERE period_end IS NOT NULL)"""
_MOMENT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {1}"


def _periods(m: Mart) -> DataFrame:
    return finance.settlement_periods(m.payments, (F.col("event_type") == "error") & (F.col("detail") >= 90))


@query("r70_receipts_by_period", f"""{_PERIODS}
    SELECT p.store_idx, {_MOMENT.format('period_start', 'period_start')}, {_MOMENT.format('period_end', 'period_end')}, {_MOMENT.format('min(logged_at)', 'first_receipt')},
        {_MOMENT.format('max(logged_at)', 'last_receipt')}, count(logged_at) AS receipts, coalesce(sum(amount), 0)::DOUBLE AS amount
    FROM p LEFT JOIN payment r ON r.store_idx = p.store_idx AND r.logged_at >= period_start AND r.logged_at < period_end GROUP BY p.store_idx, period_start, period_end""")
def _(m: Mart) -> DataFrame:
    return finance.receipts_by_period(m.payments, _periods(m))


@query("x03_settlement_span", f"""{_PERIODS}
    SELECT store_idx, {_MOMENT.format('min(period_start)', 'span_start')}, {_MOMENT.format('max(period_end)', 'span_end')} FROM p
    WHERE period_end >= DATE '2024-01-10' AND period_end < DATE '2024-01-21' GROUP BY store_idx""")
def _(m: Mart) -> DataFrame:
    return finance.settlement_span(_periods(m), dt.date(2024, 1, 10), dt.date(2024, 1, 20))


@query("r71_vat_guarded", f"""
    SELECT store_idx, sale_date::VARCHAR AS sale_date, vat_group, {_VAT} FROM receipt_row
    WHERE (store_idx, sale_date) IN (SELECT store_idx, sale_date FROM bank) GROUP BY store_idx, sale_date, vat_group""")
def _(m: Mart) -> DataFrame:
    return rec.vat_guarded(m.receipt_rows, m.bank_settlements)


@query("r72_last_count_cashier", """
    SELECT store_idx, znr, count_no, counted_by, c_name AS cashier_name, bag_id FROM (SELECT *, row_number() OVER (PARTITION BY store_idx, znr
        ORDER BY count_no DESC, till_id DESC, tender_id DESC) AS rn FROM counting) JOIN customer ON c_custkey = counted_by WHERE rn = 1""")
def _(m: Mart) -> DataFrame:
    return rec.last_count_cashier(m.counts, m.users)


# -- finance report ---------------------------------------------------------------------------

EFT_SPAN = ((20240103, 600), (20240117, 1830))
TILL_SPAN = ((20240104, 0), (20240118, 1200))


def _span(span) -> str:
    (d1, t1), (d2, t2) = span
    return f"((date_key = {d1} AND time_key >= {t1}) OR (date_key = {d2} AND time_key <= {t2}) OR (date_key > {d1} AND date_key < {d2}))"


@query("r73_card_settlement", f"""
    WITH p AS (SELECT *, {_CARD} AS card_name FROM payment WHERE tender_id IN (3, 5, 14)),
    a AS (SELECT card_name, count(*) AS count_bank, sum(amount)::DOUBLE AS amount_bank FROM p GROUP BY 1),
    b AS (SELECT card_name, count(*) AS count_eft, sum(amount)::DOUBLE AS amount_eft FROM p WHERE receipt_status IN (1, 5) AND {_span(EFT_SPAN)} GROUP BY 1),
    c AS (SELECT card_name, count(*) AS count_till, sum(amount)::DOUBLE AS amount_till FROM p WHERE receipt_status IN (1, 5) AND {_span(TILL_SPAN)} GROUP BY 1)
    SELECT * FROM a FULL JOIN b USING (card_name) FULL JOIN c USING (card_name)""")
def _(m: Mart) -> DataFrame:
    return finance.card_settlement(m.payments, EFT_SPAN, TILL_SPAN)


@query("r74_pay_outs", f"""
    SELECT cashier_idx, cashier_name, count(*) AS pay_outs, sum(amount)::DOUBLE AS amount FROM payment
    WHERE tender_id = 1 AND receipt_status IN (1, 5) AND {_span(EFT_SPAN)} GROUP BY cashier_idx, cashier_name""")
def _(m: Mart) -> DataFrame:
    return finance.pay_outs(m.payments, EFT_SPAN)


@query("r75_finance_header", """
    SELECT (SELECT strftime(min(logged_at), '%Y-%m-%d %H:%M:%S') FROM payment WHERE tender_id IN (3, 5)) AS eft_first,
           (SELECT strftime(max(logged_at), '%Y-%m-%d %H:%M:%S') FROM payment WHERE tender_id IN (3, 5)) AS eft_last,
           (SELECT count(DISTINCT (store_idx, till_id)) FROM payment WHERE tender_id IN (3, 5)) AS eft_tills,
           (SELECT min(sale_date)::VARCHAR FROM receipt) AS sales_first, (SELECT max(sale_date)::VARCHAR FROM receipt) AS sales_last,
           (SELECT count(DISTINCT (store_idx, till_id)) FROM receipt) AS sales_tills,
           (SELECT count(DISTINCT (store_idx, cashier_name)) FROM receipt) AS sales_cashiers""")
def _(m: Mart) -> DataFrame:
    return finance.finance_header(m.payments, m.receipts)


@query("r76_report_period", """
    SELECT 'R' AS kind, min(sale_date)::VARCHAR AS date_from, max(sale_date)::VARCHAR AS date_to FROM receipt
    UNION ALL SELECT 'E', min(log_date)::VARCHAR, max(log_date)::VARCHAR FROM payment
    UNION ALL SELECT 'calendar', min(sale_date)::VARCHAR, max(sale_date)::VARCHAR FROM receipt WHERE sale_date >= DATE '2001-04-01' AND sale_date < DATE '2001-07-01'""")
def _(m: Mart) -> DataFrame:
    period = Period("R", unit="Q", start=-1, duration=1)
    parts = [
        finance.report_period(m.receipts, m.payments, kind, period, AS_OF).select(F.lit(name).alias("kind"), "*")
        for kind, name in (("R", "R"), ("E", "E"), (None, "calendar"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TENDERS = """SELECT CASE tender_id WHEN 22 THEN 'Mobile' WHEN 2 THEN 'Voucher' END AS tender_name, count(*) AS payments, sum(amount)::DOUBLE AS amount
    FROM payment WHERE tender_id IN ({ids}) AND receipt_status IN (1, 5) AND {span} GROUP BY 1"""


@query("r77_mobile_tenders", _TENDERS.format(ids="22", span=_span(EFT_SPAN)))
def _(m: Mart) -> DataFrame:
    return finance.tender_totals(m.payments, "Mobile", EFT_SPAN)


@query("r77_voucher_tenders", _TENDERS.format(ids="2, 19", span=_span(EFT_SPAN)))
def _(m: Mart) -> DataFrame:
    return finance.tender_totals(m.payments, "Vouchers", EFT_SPAN)


def _pivot_sql(keys: str, counted: bool, invoices: bool) -> str:
    count_cte = f""", k AS (SELECT {keys}, sum(amount) AS counted_cash FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, tender_id ORDER BY count_no DESC, amount DESC) AS rn
        FROM counting WHERE tender_id = 1) WHERE rn = 1 GROUP BY ALL)""" if counted else ""
    count_join = f" FULL JOIN k USING ({keys})" if counted else ""
    count_out = ", (coalesce(cash, 0) - coalesce(counted_cash, 0))::DOUBLE AS cash_difference" if counted else ""
    zero_out = ", 0 AS cash_difference" if counted else ""
    inv = f""" UNION ALL SELECT 'CIM' AS source, {keys}, 0, 0, sum(amount)::DOUBLE, 0, 0, 0, 0, sum(amount)::DOUBLE {zero_out.replace(' AS cash_difference', '')}
        FROM receipt_inv GROUP BY {keys}""" if invoices else ""
    inv_cte = f", receipt_inv AS (SELECT *, {_ZNR} AS znr FROM receipt WHERE tender_id = 6)" if invoices else ""
    return f"""
    WITH t AS (SELECT {keys}, sum(CASE WHEN tender_id IN (1, 8) THEN {_HOME} ELSE 0 END) AS cash, sum(CASE WHEN tender_id IN (3, 5) THEN {_HOME} ELSE 0 END) AS bank_cards,
                 sum(CASE WHEN tender_id = 6 THEN -({_HOME}) ELSE 0 END) AS account_credit FROM system_total GROUP BY {keys}),
    a AS (SELECT {keys}, sum(CASE WHEN accumulation_id = 7 THEN amount ELSE 0 END) AS bottle_deposit, sum(CASE WHEN accumulation_id = 13 THEN amount ELSE 0 END) AS expenses
          FROM (SELECT *, CAST(strftime(business_date, '%Y%m') AS INTEGER) AS znr FROM accumulation) WHERE accumulation_id IN (7, 13) GROUP BY {keys}){count_cte}{inv_cte}
    SELECT 'POS' AS source, {keys}, coalesce(cash, 0)::DOUBLE AS cash, coalesce(bank_cards, 0)::DOUBLE AS bank_cards, coalesce(account_credit, 0)::DOUBLE AS account_credit,
           0::DOUBLE AS vouchers, 0::DOUBLE AS mobile, coalesce(bottle_deposit, 0)::DOUBLE AS bottle_deposit, coalesce(expenses, 0)::DOUBLE AS expenses,
           (coalesce(cash, 0) + coalesce(bank_cards, 0) + coalesce(account_credit, 0))::DOUBLE AS total{count_out}
    FROM t FULL JOIN a USING ({keys}){count_join}{inv}"""


def _counters(m: Mart) -> DataFrame:
    return m.accumulations.withColumn("znr", F.year("business_date") * 100 + F.month("business_date"))


@query("r78_reconciliation_by_register", _pivot_sql("store_idx, znr, till_id", False, True))
def _(m: Mart) -> DataFrame:
    keys = ["store_idx", "znr", "till_id"]
    znr = (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr")
    invoices = m.receipts.filter(F.col("tender_id") == 6).groupBy("store_idx", znr, "till_id").agg(F.sum("amount").alias("amount"))
    return finance.reconciliation_pivot(m.system_totals, _counters(m), keys, store_invoices=invoices)


@query("r78_reconciliation_by_cashier", _pivot_sql("store_idx, znr, cashier_idx, cashier_name", False, False))
def _(m: Mart) -> DataFrame:
    keys = ["store_idx", "znr", "cashier_idx", "cashier_name"]
    return finance.reconciliation_pivot(m.system_totals, _counters(m), keys)


@query("r78_reconciliation_by_till", _pivot_sql("store_idx, znr, till_id", True, False))
def _(m: Mart) -> DataFrame:
    keys = ["store_idx", "znr", "till_id"]
    return finance.reconciliation_pivot(m.system_totals, _counters(m), keys, counted=finance.counted_cash(m.counts, keys))
