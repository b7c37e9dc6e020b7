"""Finance report parts: card settlement, pay-outs, header, tenders, pivots by till."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.keys import moment
from tillroll.functions.labels import label_of
from tillroll.functions.money import in_home_currency, sum_if
from tillroll.operators import filters as flt
from tillroll.operators.aggregates import latest_rows, pivot_sums
from tillroll.operators.joins import full_on, in_periods, next_event, single_row
from tillroll.operators.reshape import union_rows
from tillroll.plans.calendar import Bounds, Period
from tillroll.plans.reconciliation import ACC_BOTTLE_DEPOSIT, ACC_EXPENSES, CARDS, tender_bridge, tender_is

Moment = tuple[int, int]

SELECTIONS = ("Cash", "Bank Cards", "Account Credit", "Vouchers", "Mobile")


def _column_name(selection: str) -> str:
    return selection.lower().replace(" ", "_")


def card_settlement(payments: DataFrame, eft_span: tuple[Moment, Moment], till_span: tuple[Moment, Moment]) -> DataFrame:
    """Card payments by card: all, in the bank's settlement span, in the tills' span.  All three are
    conditional sums of one scan; a card without payments in a span has no value there."""
    from tillroll.sources.mart import CARD_NAMES

    name = label_of("sub_tender_id", CARD_NAMES, "N/A").alias("card_name")

    def inside(span: tuple[Moment, Moment]) -> Column:
        first, last = (day * 10000 + time for day, time in span)
        return F.col("receipt_status").isin(*flt.COUNTED_STATUSES) & moment("date_key", "time_key").between(first, last)

    def source(cond: Column, suffix: str) -> list[Column]:
        return [F.nullif(F.count_if(cond), F.lit(0)).alias(f"count_{suffix}"), sum_if(cond, "amount", None).alias(f"amount_{suffix}")]

    return payments.filter(tender_is(CARDS)).groupBy(name).agg(
        F.count("*").alias("count_bank"), F.sum("amount").alias("amount_bank"), *source(inside(eft_span), "eft"), *source(inside(till_span), "till")
    )


def pay_outs(payments: DataFrame, span: tuple[Moment, Moment]) -> DataFrame:
    """Counted cash pay-outs per cashier in a span."""
    part = flt.between_moments(flt.counted_receipts(payments.filter(tender_is((1,)))), "date_key", "time_key", *span, at_col="logged_at")
    return part.groupBy("cashier_idx", "cashier_name").agg(F.count("*").alias("pay_outs"), F.sum("amount").alias("amount"))


def finance_header(payments: DataFrame, receipts: DataFrame) -> DataFrame:
    """One row, also without data: first and last transaction, tills and cashiers of the card log and
    of the receipts."""
    till = F.concat_ws(":", F.col("store_idx").cast("string"), F.col("till_id"))
    cashier = F.concat_ws(":", F.col("store_idx").cast("string"), F.col("cashier_name"))
    log = payments.filter(tender_is(CARDS)).agg(
        F.min("logged_at").alias("first_at"), F.max("logged_at").alias("last_at"), F.countDistinct(till).alias("tills")
    )
    sold = receipts.agg(
        F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"),
        F.countDistinct(till).alias("tills"), F.countDistinct(cashier).alias("cashiers"),
    )
    return single_row({"log": log, "sold": sold}, payments).select(
        F.col("log.first_at").alias("eft_first"), F.col("log.last_at").alias("eft_last"), F.col("log.tills").alias("eft_tills"),
        F.col("sold.first_day").alias("sales_first"), F.col("sold.last_day").alias("sales_last"),
        F.col("sold.tills").alias("sales_tills"), F.col("sold.cashiers").alias("sales_cashiers"),
    )


def report_period(receipts: DataFrame, payments: DataFrame, kind: str | None, period: Period, as_of: dt.date) -> DataFrame:
    """First and last day of a report: of the reconciled receipts, of the settlement log, or of the
    calendar period."""
    if kind == "R":
        return receipts.agg(F.min("sale_date").alias("date_from"), F.max("sale_date").alias("date_to"))
    if kind == "E":
        return payments.agg(F.min("log_date").alias("date_from"), F.max("log_date").alias("date_to"))
    first, last = period.bounds(as_of)
    inside = receipts.filter(F.col("sale_date").between(first, last))
    return inside.agg(F.min("sale_date").alias("date_from"), F.max("sale_date").alias("date_to"))


def settlement_periods(payments: DataFrame, is_closing: Column) -> DataFrame:
    """Per store the periods between one closing line of the log and the next, with date and time.  The period after the last
    closing has no end yet and is left out."""
    closings = payments.filter(is_closing).select("store_idx", "logged_at").distinct()
    numbered = closings.withColumn("_at", F.unix_micros(F.col("logged_at").cast("timestamp")))
    every = F.lit(True)
    ended = next_event(numbered, "store_idx", "_at", every, {"period_end": every}, "logged_at", (), 30 * 86_400_000_000)
    return ended.filter(F.col("period_end").isNotNull()).select("store_idx", F.col("logged_at").alias("period_start"), "period_end")


def receipts_by_period(payments: DataFrame, periods: DataFrame) -> DataFrame:
    """First and last receipt, number and amount per store and period; periods without receipts are kept."""
    lines = payments.select("store_idx", "logged_at", "amount")
    keys = ["store_idx", "period_start", "period_end"]
    sums = in_periods(lines, periods, ["store_idx"], "logged_at", "period_start", "period_end").groupBy(*keys).agg(
        F.min("logged_at").alias("first_receipt"), F.max("logged_at").alias("last_receipt"), F.count("*").alias("receipts"), F.sum("amount").alias("amount")
    )
    return periods.join(sums, keys, "left").fillna(0, ["receipts", "amount"])


def settlement_span(periods: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Per store the moments from the start of its first to the end of its last period that ends within the days."""
    ended = periods.filter((F.col("period_end") >= F.lit(first)) & (F.col("period_end") < F.lit(last + dt.timedelta(days=1))))
    return ended.groupBy("store_idx").agg(F.min("period_start").alias("span_start"), F.max("period_end").alias("span_end"))


def tender_totals(payments: DataFrame, selection: str, span: tuple[Moment, Moment]) -> DataFrame:
    """Count and amount per tender of one selection in a span."""
    from tillroll.sources.mart import TENDER_NAMES

    chosen = tender_bridge(payments.sparkSession).filter(F.col("selection") == selection).select("tender_id")
    part = flt.between_moments(flt.counted_receipts(payments), "date_key", "time_key", *span, at_col="logged_at")
    return part.join(chosen, "tender_id", "left_semi").groupBy(label_of("tender_id", TENDER_NAMES, "N/A").alias("tender_name")).agg(
        F.count("*").alias("payments"), F.sum("amount").alias("amount")
    )


# -- reconciliation by till, cashier or register ---------------------------------------------


def by_selection(totals: DataFrame, keys: list[str]) -> DataFrame:
    """System totals pivoted to one column per tender selection, signed and in home currency."""
    amount = in_home_currency("amount", "exchange_rate") * F.col("sign")
    signed = totals.join(tender_bridge(totals.sparkSession), "tender_id").withColumn("signed", amount)
    wide = pivot_sums(signed, keys, "selection", SELECTIONS, "signed")
    return wide.select(*keys, *[F.col(f"`{s}`").alias(_column_name(s)) for s in SELECTIONS])


def by_accumulation(counters: DataFrame, keys: list[str]) -> DataFrame:
    """Bottle deposit and expenses per key."""
    acc = F.col("accumulation_id")
    name = F.when(acc == ACC_BOTTLE_DEPOSIT, "bottle_deposit").when(acc == ACC_EXPENSES, "expenses")
    named = counters.withColumn("kind", name).filter(F.col("kind").isNotNull())
    return pivot_sums(named, keys, "kind", ("bottle_deposit", "expenses"), "amount")


def reconciliation_pivot(
    totals: DataFrame, counters: DataFrame, keys: list[str], *, counted: DataFrame | None = None, store_invoices: DataFrame | None = None
) -> DataFrame:
    """Tender selections and accumulations side by side, per register, cashier or till.  With
    ``counted`` (cash per key) the deviation of counted cash is added; ``store_invoices`` (amount
    per key) adds rows for purchases between stores."""
    wide = full_on(by_selection(totals, keys), by_accumulation(counters, keys), keys)
    numbers = [_column_name(s) for s in SELECTIONS] + ["bottle_deposit", "expenses"]
    if counted is not None:
        wide = full_on(wide, counted, keys)
        numbers = numbers + ["counted_cash"]
    wide = wide.fillna(0, numbers)
    total: Column = sum((F.col(_column_name(s)) for s in SELECTIONS[1:]), F.col("cash"))
    out = wide.withColumn("total", total).withColumn("source", F.lit("POS"))
    if counted is not None:
        out = out.withColumn("cash_difference", F.col("cash") - F.col("counted_cash")).drop("counted_cash")
    if store_invoices is None:
        return out
    zero = F.lit(0).cast("decimal(28,4)")
    amount = F.col("amount")
    rows = store_invoices.select(
        *keys,
        *[(amount if c in ("account_credit", "total") else F.lit("CIM") if c == "source" else zero).alias(c) for c in out.columns if c not in keys],
    )
    return union_rows(out, rows)


def counted_cash(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Cash of the last count per key."""
    last = latest_rows(counts.filter(tender_is((1,))), keys + ["tender_id"], ["count_no"], ["amount"])
    return last.groupBy(*keys).agg(F.sum("amount").alias("counted_cash"))


def spans_of(bounds: Bounds) -> tuple[Moment, Moment]:
    from tillroll.functions.keys import key_of

    return (key_of(bounds[0]), 0), (key_of(bounds[1]), 2359)
