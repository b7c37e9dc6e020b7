"""Cashier operations: age checks, bags, bottle deposit, exceptions, key figures, returns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.labels import AGE_CHECK_APPROVED, AGE_CHECK_REFUSED, label_of
from tillroll.functions.money import net_amount_sum, safe_div, sum_each_if, sum_if, whole_amounts
from tillroll.operators import filters as flt
from tillroll.operators.reshape import padded_union_sum
from tillroll.plans.calendar import Period
from tillroll.plans.reconciliation import (
    ACC_BOTTLE_DEPOSIT, ACC_CANCELED, ACC_CORRECTIONS, ACC_CUSTOMERS, ACC_EXPENSES, ACC_PRICE_CHECKS, ACC_RETURNS,
)

CASHIER = ["cashier_idx", "cashier_name"]

# Bottle lottery transaction types.
LOTTERY_GAIN, LOTTERY_STAKE, LOTTERY_PAID = 90305, 90306, 90307


# -- age checks -------------------------------------------------------------------------------


def age_check_summary(checks: DataFrame) -> DataFrame:
    """Approved and refused checks per cashier with their shares in percent.  Both sides are counted
    in one pass, so no join multiplies them."""
    counts = checks.groupBy(*CASHIER).agg(
        F.count_if("approved").alias("approved_no"), F.count_if(~F.col("approved")).alias("refused_no"), F.count("*").alias("total_no")
    )
    return counts.select(
        *CASHIER, "approved_no", "refused_no", "total_no",
        (safe_div(F.col("approved_no"), F.col("total_no")) * 100).alias("approved_share"),
        (safe_div(F.col("refused_no"), F.col("total_no")) * 100).alias("refused_share"),
    )


def age_check_rows(checks: DataFrame, *, approved: bool) -> DataFrame:
    """Single checks with the text of their reason code."""
    table = AGE_CHECK_APPROVED if approved else AGE_CHECK_REFUSED
    chosen = checks.filter(F.col("approved") == approved)
    return chosen.select(
        "store_idx", "log_date", F.date_format("logged_at", "HH:mm").alias("log_time"), "cashier_name", "till_id",
        F.col("payment_no").alias("receipt_no"), "amount", "reason_no", label_of("reason_no", table).alias("reason_text"),
    )


def age_control(rows: DataFrame, articles: DataFrame, checks: DataFrame) -> DataFrame:
    """Age-limited articles sold per cashier beside the outcome of the checks."""
    limited = articles.filter(F.col("age_limit") > 0).select("article_idx")
    sold = rows.join(limited, "article_idx", "left_semi").groupBy(*CASHIER).agg(F.count("*").alias("limited_articles"))
    outcome = checks.groupBy(*CASHIER).agg(
        F.count_if(F.col("approved") & (F.col("reason_no") == 1)).alias("clearly_old_enough"),
        F.count_if("approved").alias("approved_no"),
        F.count_if(~F.col("approved")).alias("refused_no"),
        F.count_if(F.col("approved") & (F.col("reason_no") == 7)).alias("approved_by_fingerprint"),
    )
    joined = outcome.join(sold, CASHIER)
    return joined.filter((F.col("limited_articles") > 0) | (F.col("refused_no") > 0))


# -- bags -------------------------------------------------------------------------------------


def bags_per_customer(rows: DataFrame, articles: DataFrame, *, bag_group: str) -> DataFrame:
    """Carrier bags sold per customer and cashier; one pass over the sales."""
    is_bag = F.col("article_idx").isNotNull() & F.col("is_bag")
    whole, amounts = whole_amounts(rows)
    flagged = whole.join(articles.select("article_idx", (F.col("lev1_id") == bag_group).alias("is_bag")), "article_idx")
    per_cashier = amounts(flagged.groupBy(*CASHIER).agg(
        sum_each_if(is_bag, "qty_sold", -F.col("qty_return")).alias("bags"), F.count_if(is_bag).alias("bag_rows"), F.count_if(F.col("line_no") == 1).alias("customers")
    ), "bags")
    sold = per_cashier.filter(F.col("bag_rows") > 0).drop("bag_rows")
    return sold.withColumn("bags_per_customer", safe_div(F.col("bags"), F.col("customers"), "one"))


# -- bottle deposit ---------------------------------------------------------------------------


def bottle_deposit(rows: DataFrame, articles: DataFrame, counters: DataFrame, lottery: DataFrame) -> DataFrame:
    """Sales, deposit sold, deposit returned and lottery pay-outs per cashier."""
    deposit = articles.select("article_idx", (F.col("article_type_id") == 130).alias("is_deposit"))
    sales = rows.join(deposit, "article_idx").groupBy(*CASHIER).agg(
        net_amount_sum().alias("revenue_incl_vat"),
        sum_if(F.col("is_deposit"), "sales_amount").alias("deposit_sold"),
        sum_if(F.col("is_deposit"), "return_amount").alias("deposit_returned"),
    )
    manual = counters.filter(F.col("accumulation_id") == ACC_BOTTLE_DEPOSIT).groupBy(*CASHIER).agg(
        F.count("*").alias("manual_returns"), F.sum("amount").alias("manual_amount")
    )
    paid = lottery.groupBy(*CASHIER).agg(F.sum("amount").alias("lottery_paid"))
    measures = ["revenue_incl_vat", "deposit_sold", "deposit_returned", "manual_returns", "manual_amount", "lottery_paid"]
    out = padded_union_sum([sales, manual, paid], CASHIER, measures)
    share = safe_div(F.col("deposit_sold") + F.col("deposit_returned"), F.col("revenue_incl_vat"))
    return out.withColumn("deposit_share", share)


def with_bags(report: DataFrame, bags: DataFrame) -> DataFrame:
    """Add bags per customer to a cashier report."""
    return report.join(bags.select(*CASHIER, "bags_per_customer"), CASHIER, "left")


def bottle_lottery(tickets: DataFrame, *, as_of: dt.date, large: int = 1000, days: int = 90) -> DataFrame:
    """Stakes, gains by size, and unclaimed gains by age, as one row.

    A gain is open unless the same voucher was paid out on the day or later; the last pay-out per
    voucher comes from an aggregate next to the gains, not from a lookup per row.
    """
    kind = F.col("trans_type")
    per_voucher = tickets.groupBy("voucher_no", "log_date").agg(
        sum_if(kind == LOTTERY_STAKE, F.col("amount")).alias("stake"),
        sum_if((kind == LOTTERY_GAIN) & (F.col("amount") < large), F.col("amount")).alias("gain_small"),
        sum_if((kind == LOTTERY_GAIN) & (F.col("amount") >= large), F.col("amount")).alias("gain_large"),
    )
    paid = tickets.filter(kind == LOTTERY_PAID).groupBy("voucher_no").agg(F.max("log_date").alias("paid_on"))
    gain = F.col("gain_small") + F.col("gain_large")
    unclaimed = F.col("paid_on").isNull() | (F.col("paid_on") < F.col("log_date"))
    old = F.datediff(F.lit(as_of), "log_date") >= days
    return per_voucher.join(paid, "voucher_no", "left").agg(
        F.sum("stake").alias("used_for_lottery"), F.sum("gain_small").alias("gains_small"), F.sum("gain_large").alias("gains_large"),
        sum_if(unclaimed & ~old, gain).alias("unclaimed_recent"),
        sum_if(unclaimed & old, gain).alias("unclaimed_old"),
    )


# -- exceptions, key figures, returns ---------------------------------------------------------


def exceptions(counters: DataFrame) -> DataFrame:
    """Corrections, cancellations, parked and deleted receipts, age checks per cashier."""
    acc = F.col("accumulation_id")
    one = F.lit(1)
    return counters.groupBy(*CASHIER).agg(
        sum_if(acc == ACC_CUSTOMERS, "amount").alias("sales_amount"),
        sum_if(acc == ACC_RETURNS, "amount").alias("return_amount"),
        sum_if(acc == ACC_CORRECTIONS, one).alias("corrections"),
        sum_if(acc == ACC_CORRECTIONS, "amount").alias("corrections_amount"),
        sum_if(acc == ACC_CANCELED, one).alias("canceled"),
        sum_if(acc == ACC_CANCELED, "amount").alias("canceled_amount"),
        sum_if(acc == ACC_PRICE_CHECKS, one).alias("price_checks"),
        sum_if(acc == ACC_EXPENSES, one).alias("parked"),
    )


def key_figures(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Sales with and without third-party articles, customers, averages and scan rates per
    cashier."""
    dim = articles.select("article_idx", "is_third_party", (F.length("gtin") > 6).alias("scannable"))
    whole, amounts = whole_amounts(rows)
    flagged = whole.join(dim, "article_idx")
    third = F.col("is_third_party")
    scanned = F.col("scannable") & (F.col("line_status") == "F")
    per_receipt = flagged.groupBy(*CASHIER, "receipt_id").agg(
        net_amount_sum().alias("amount"), sum_each_if(third, "sales_amount", "return_amount").alias("third_amount"),
        sum_each_if(~third, "qty_sold", "qty_return").alias("own_items"),
        sum_each_if(~third & F.col("scannable"), "qty_sold", "qty_return").alias("own_scannable"),
        sum_each_if(~third & scanned, "qty_sold", "qty_return").alias("own_scanned"),
        F.max(third).alias("has_third"), F.min(third).alias("only_third"),
    )
    grouped = per_receipt.groupBy(*CASHIER).agg(
        F.sum("amount").alias("total"), F.sum("third_amount").alias("third_party_sales"),
        F.count("*").alias("receipts"), F.count_if("only_third").alias("only_third"), F.count_if("has_third").alias("third_party_customers"),
        F.sum("own_items").alias("own_items"), F.sum("own_scannable").alias("own_scannable"), F.sum("own_scanned").alias("own_scanned"),
    )
    grouped = amounts(grouped, "total", "third_party_sales", "own_items", "own_scannable", "own_scanned")
    customers = F.col("receipts") - F.col("only_third")
    own_sales = F.col("total") - F.col("third_party_sales")
    return grouped.select(
        *CASHIER, "total", own_sales.alias("article_sales"), customers.alias("customers"),
        safe_div(own_sales, customers).alias("sales_per_customer"),
        safe_div(F.col("own_scannable"), F.col("own_items")).alias("scannable_share"),
        safe_div(F.col("own_scanned"), F.col("own_scannable")).alias("scanned_share"),
        "third_party_sales", "third_party_customers",
        safe_div(F.col("third_party_sales"), F.col("third_party_customers")).alias("third_party_per_customer"),
    )


def returns_by_cashier(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Returns per cashier: receipts, articles, amount, share of sales, and those on short article
    codes."""
    dim = articles.select("article_idx", (F.length("gtin") <= 6).alias("generic"))
    whole, amounts = whole_amounts(rows)
    flagged = whole.join(dim, "article_idx")
    returned = F.col("qty_return") > 0
    generic = returned & F.col("generic")
    per_receipt = flagged.groupBy(*CASHIER, "receipt_id").agg(
        F.sum("sales_amount").alias("sales"), F.sum("return_amount").alias("returns"), F.sum("qty_return").alias("qty_return"),
        F.max(returned).alias("has_return"), F.max(generic).alias("has_generic"),
        sum_if(generic, "qty_return").alias("generic_qty"), sum_if(generic, "return_amount").alias("generic_amount"),
    )
    grouped = per_receipt.groupBy(*CASHIER).agg(
        F.sum(F.col("sales") + F.col("returns")).alias("revenue_incl_vat"), F.count_if("has_return").alias("return_receipts"),
        F.sum("qty_return").alias("returned_qty"), (-F.sum("returns")).alias("return_amount"), F.sum("sales").alias("sales"),
        F.count_if("has_generic").alias("generic_receipts"), F.sum("generic_qty").alias("generic_qty"),
        F.sum("generic_amount").alias("generic_amount"),
    )
    grouped = amounts(grouped, "revenue_incl_vat", "returned_qty", "return_amount", "sales", "generic_qty", "generic_amount")
    return grouped.withColumn("return_share", safe_div(F.col("return_amount"), F.col("sales"))).drop("sales")


# -- third-party payments ---------------------------------------------------------------------


def third_party_payments(payments: DataFrame, *, period: Period | None = None, as_of: dt.date | None = None) -> DataFrame:
    """Payments made for a third party, with success where an amount was booked."""
    rows = payments.filter(F.col("event_type").isin("purchase", "error"))
    if period is not None:
        rows = flt.in_period(rows, "log_date", period, as_of)
    amount = F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(F.lit(0))
    return rows.select(
        "store_idx", "till_id", F.col("payment_no").alias("receipt_no"), "date_key", F.date_format("logged_at", "HH:mm").alias("time"),
        F.col("detail").alias("scheme_no"), amount.alias("amount"), F.when(amount != 0, F.lit("Success")).otherwise(F.lit("Failure")).alias("state"),
    )
