"""Payment lines to tender, transaction type and signed amount.

The rules are ordered tables: the first rule that fits wins.  They become one CASE expression per
output column, evaluated inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Tender number by tender type, where nothing but the type decides.
TENDER_BY_TYPE = {
    "HouseAccount": 4,
    "CustomerAccount": 6,
    "Coupon": 23,
    "Mobile": 22,
    "GiftCard": 2,
    "StoreAccount": 10,
    "StoreAccountOut": 11,
    "Loyalty": 12,
    "BasketLotteryPrize": 15,
    "Ikano": 16,
    "Retain24In": 17,
    "Retain24Out": 18,
    "Voucher": 19,
    "TypiskNorskDiscount": 20,
    "TypiskNorskReturn": 21,
    "OnlinePayment": 24,
    "RecyclingLotteryPrize": 25,
    "PurchaseOrder": 26,
    "AccountsReceivable": 33,
    "AccountsPayable": 34,
    "CashPrize": 520,
}

# Transaction type by tender type, where nothing but the type decides.
TRANS_BY_TYPE = {
    "CustomerAccount": 20202,
    "Check": 20501,
    "Loyalty": 20501,
    "Ikano": 20206,
    "GiftCard": 20702,
    "Retain24In": 20702,
    "StoreAccountOut": 20704,
    "StoreAccount": 20705,
    "HouseAccount": 20201,
    "Coupon": 21102,
    "Mobile": 20401,
    "OnlinePayment": 21201,
    "Voucher": 20709,
    "TypiskNorskDiscount": 20710,
    "TypiskNorskReturn": 20710,
    "RecyclingLotteryPrize": 20906,
}

# The types that a pay-in or pay-out line comes before.
TRANS_AFTER_PAID = {"PurchaseOrder": 40303, "RXBagPayment": 20805, "CashPrize": 21001}

# Cash lines by line type; pay-ins and pay-outs without a typed tender.
CASH_TRANS = {"Tender": 20101, "TenderChange": 21301}
CASH_SYSTEM_TRANS = {"Tender": 20102, "TenderChange": 21302}
PAID_TRANS = {"PaidIn": 20104, "PaidOut": 21304}
UNKNOWN_TENDER, UNKNOWN_TRANS = -4, -3

# Lines of the cash machine, by what it answered.
DEPOSIT_TRANS = {"ok": 30111, "flagerror": 30112, "error": 30113}
WITHDRAWAL_TRANS = {"ok": 30110, "nocash": 30114, "flagerror": 30115, "error": 30116}

# Line types that can hold cash; the mark before types of an extension; the first internal number of
# a tender that a chain has added itself.
CASH_LINES = ("Tender", "TenderChange", "PaidIn", "PaidOut")
EXTENSION = "VRExt:"
FIRST_OWN_TENDER = 100


def first_rule(rules: Sequence[tuple[Column, int | Column]], default: int) -> Column:
    """Value of the first rule whose condition holds."""
    case = None
    for condition, value in rules:
        v = F.lit(value) if isinstance(value, int) else value
        case = F.when(condition, v) if case is None else case.when(condition, v)
    return case.otherwise(F.lit(default))


def _by_type(kind: Column, table: dict[str, int]) -> list[tuple[Column, int]]:
    return [(kind == name, number) for name, number in table.items()]


def tender_number() -> Column:
    """Expects, beside the columns of a payment line, ``custom_tender_id``: the number of a tender type that a chain has added."""
    kind = F.col("tender_type")
    card, cash = kind == "CreditDebit", (kind == "Cash") & F.col("line_type").isin(*CASH_LINES)
    none = F.lit("N/A")
    foreign = F.coalesce("currency", none) != F.coalesce("foreign_currency", none)
    rules: list[tuple[Column, int | Column]] = [
        (F.col("internal_tender_id").isNotNull(), F.col("internal_tender_id")),
        (cash & F.col("foreign_rate").isNull(), 1),
        (cash & foreign, 8),
        (card & ~F.col("host_authorized"), 5),
        (card & (F.col("authorization_method") == "Automatically"), 3),
        (card & (F.col("authorization_method") == "Manually"), 14),
        (F.replace(kind, F.lit(EXTENSION), F.lit("")) == "CashHandlingSystem", 9),
    ]
    rules += _by_type(kind, TENDER_BY_TYPE)
    return first_rule([*rules, (F.col("custom_tender_id").isNotNull(), F.col("custom_tender_id"))], UNKNOWN_TENDER)


def transaction_number() -> Column:
    """Expects, beside the columns of a payment line, ``own_trans_type``: the transaction type of a tender with an internal number of its own."""
    kind, line = F.col("tender_type"), F.col("line_type")
    card, answer = kind == "CreditDebit", F.lower("deposit_result")
    rules: list[tuple[Column, int | Column]] = [(F.col("internal_tender_id") >= FIRST_OWN_TENDER, F.col("own_trans_type"))]
    rules += [(F.col("is_deposit") & (answer == name), number) for name, number in DEPOSIT_TRANS.items()]
    rules += [(F.col("is_withdrawal") & (answer == name), number) for name, number in WITHDRAWAL_TRANS.items()]
    rules += [((line == name) & (kind == "Cash"), number) for name, number in CASH_TRANS.items()]
    rules += [((line == name) & (kind == "CashHandlingSystem"), number) for name, number in CASH_SYSTEM_TRANS.items()]
    rules += [
        (card & ~F.col("host_authorized"), 20301),
        (card & (F.col("authorization_method") == "Automatically"), 20303),
        (card & (F.col("authorization_method") == "Manually"), 20302),
    ]
    rules += _by_type(kind, TRANS_BY_TYPE)
    rules += [(line == name, number) for name, number in PAID_TRANS.items()]
    rules += _by_type(kind, TRANS_AFTER_PAID)
    return first_rule(rules, UNKNOWN_TRANS)


def signed_amount() -> Column:
    """Change and account withdrawals go out, refunds turn the sign, a voided receipt turns it
    again."""
    amount, kind, line = F.col("amount"), F.col("tender_type"), F.col("line_type")
    tendered = line.isin("Tender", "TenderChange")
    out = ((line == "TenderChange") & kind.isin("Cash", "CashHandlingSystem")) | kind.isin("StoreAccountOut")
    into = ((line == "Tender") & (kind == "CashHandlingSystem")) | (kind == "StoreAccount")
    value = (
        F.when(tendered & out, -F.abs(amount))
        .when(tendered & into, F.abs(amount))
        .when(tendered & F.col("is_refund"), -amount)
        .when(tendered | line.isin("PaidIn", "PaidOut"), amount)
        .otherwise(F.lit(0))
    )
    return F.when(F.col("status") == "PostVoided", -value).otherwise(value)


#: Columns that older tills don't send, with what stands for them: a rate is then taken for that of a foreign currency.
OPTIONAL = {"currency": "own", "foreign_currency": "foreign", "is_deposit": False, "is_withdrawal": False, "deposit_result": ""}


def classify_payments(lines: DataFrame, custom: DataFrame | None = None, own: DataFrame | None = None) -> DataFrame:
    """Payment lines with tender, transaction type and signed amount.

    custom: ``tender_type`` and ``custom_tender_id`` of types a chain has added; own: ``internal_tender_id`` and
    ``own_trans_type`` of tenders with internal numbers of their own.  Both are looked up by equal keys; a key that a table
    holds more than once counts with its smallest number, so lines are never multiplied.
    """
    full = lines.select("*", *[F.lit(value).alias(c) for c, value in OPTIONAL.items() if c not in lines.columns])
    for table, key, value in ((custom, "tender_type", "custom_tender_id"), (own, "internal_tender_id", "own_trans_type")):
        if table is None:
            full = full.withColumn(value, F.lit(None).cast("int"))
        else:
            full = full.join(table.groupBy(key).agg(F.min(value).alias(value)), key, "left")
    return full.select(
        *lines.columns,
        tender_number().cast("int").alias("tender_id"),
        transaction_number().cast("int").alias("trans_type"),
        signed_amount().alias("signed_amount"),
    )
