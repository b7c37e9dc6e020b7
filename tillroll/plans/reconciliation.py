"""Reconciliation of tills, cashiers, banks and accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.functions.labels import label_of
from tillroll.functions.money import in_home_currency, net_amount, net_amount_sum, sum_each_if, sum_if, whole_amounts
from tillroll.operators import filters as flt
from tillroll.operators.aggregates import conditional_sums, latest_rows
from tillroll.operators.joins import full_on
from tillroll.operators.reshape import ledger_lines, padded_union_sum
from tillroll.plans.calendar import Bounds, within
from tillroll.sources.inline import inline_table

# Tender selections with the sign their amounts count with.
TENDER_SELECTION = (
    ("Cash", 1, 1),
    ("Cash", 8, 1),
    ("Bank Cards", 3, 1),
    ("Bank Cards", 5, 1),
    ("Account Credit", 6, -1),
    ("Vouchers", 2, 1),
    ("Vouchers", 19, 1),
    ("Mobile", 22, 1),
)

# Tender numbers by report column.
CASH, CARDS, ACCOUNT, MOBILE, VOUCHERS, CURRENCY = (1, 9), (3, 5, 14), (6,), (22,), (2, 19), (8,)
ALL_PAYMENTS = (1, 2, 3, 5, 6, 8, 9, 14, 19, 22)

# Accumulation types of the till counters.
ACC_CUSTOMERS, ACC_CORRECTIONS, ACC_DISCOUNT, ACC_BOTTLE_DEPOSIT = 1, 5, 6, 7
ACC_CANCELED, ACC_RETURNS, ACC_EXPENSES, ACC_PRICE_CHECKS = 10, 11, 13, 19

# Fixed values of the mapping: gaming articles and gift cards by first-level group.
GAMING_GROUP, GIFT_CARD_GROUP = "STANDARD", "ECONOMY"


def tender_bridge(spark: SparkSession) -> DataFrame:
    """Tender to selection and sign; one row per pair, so joining it repeats a payment only where a
    tender really is in several selections."""
    selection, tender, sign = zip(*sorted(set(TENDER_SELECTION)))
    return inline_table(spark, {"selection": selection, "tender_id": tender, "sign": sign})


def tender_is(numbers: tuple[int, ...], col: str = "tender_id") -> Column:
    return F.col(col).isin(*numbers)


def home_amount() -> Column:
    return in_home_currency("amount", "exchange_rate")


# -- daily summaries --------------------------------------------------------------------------


def reconciliation_summary(rows: DataFrame, receipts: DataFrame, totals: DataFrame, *, vat_groups=(0, 5, 8)) -> DataFrame:
    """Per store and day: payments by kind and revenue by VAT rate, with the settlement number."""
    day = ["store_idx", "sale_date"]
    vat_sums = []
    for g in vat_groups:
        cond = F.col("vat_group") == g
        vat_sums += [
            sum_each_if(cond, "sales_excl_vat", "return_excl_vat").alias(f"revenue_{g}"),
            sum_each_if(cond, "sales_vat", "return_vat").alias(f"vat_{g}"),
        ]
    vat = rows.groupBy(*day).agg(*vat_sums)
    tender = receipts.groupBy(*day).agg(
        F.sum("amount").alias("revenue_incl_vat"),
        *conditional_sums(
            {"cash": tender_is((1, 8)), "payment_card": tender_is((3,)), "payment_card_reserve": tender_is((5,))}, "amount"
        ),
    )
    znr = totals.groupBy("store_idx", "znr").agg(F.max("last_date").alias("last_date"))
    number = (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr")
    numbered = tender.select("*", number).join(
        znr.select("store_idx", "znr", F.lit(1).alias("settled")), ["store_idx", "znr"], "left"
    )
    return vat.join(numbered, day).withColumn("znr", F.when(F.col("settled") == 1, F.col("znr"))).drop("settled")


def daily_branches(
    rows: DataFrame, receipts: DataFrame, counts: DataFrame, bottles: DataFrame, articles: DataFrame
) -> DataFrame:
    """Pre-aggregated branches per store and day, joined on the sales branch."""
    day = ["store_idx", "sale_date"]
    # Rows are summed by article and VAT group before they meet the article table.
    whole, amounts = whole_amounts(rows)
    names = ("sales_amount", "return_amount", "sales_excl_vat", "return_excl_vat")
    per_article = whole.groupBy(*day, "article_idx", "vat_group").agg(*[F.sum(n).alias(n) for n in names])
    grouped = per_article.join(articles.select("article_idx", "lev1_id"), "article_idx")
    plain = ~F.col("lev1_id").isin(GAMING_GROUP, GIFT_CARD_GROUP)
    vat = F.col("vat_group")
    amount = ("sales_amount", "return_amount")
    sales = grouped.groupBy(*day).agg(
        sum_each_if(plain & (vat < 3), *amount).alias("sales_low"),
        sum_each_if(plain & vat.between(3, 5), *amount).alias("sales_mid"),
        sum_each_if(plain & (vat > 5), *amount).alias("sales_high"),
        sum_each_if(plain, "sales_excl_vat", "return_excl_vat").alias("net_revenue"),
        sum_each_if(plain, *amount).alias("gross_revenue"),
        sum_each_if(F.col("lev1_id") == GAMING_GROUP, *amount).alias("gaming"),
        sum_each_if(F.col("lev1_id") == GIFT_CARD_GROUP, *amount).alias("gift_cards"),
    )
    sales = amounts(sales, "sales_low", "sales_mid", "sales_high", "net_revenue", "gross_revenue", "gaming", "gift_cards")
    cards = {
        "card_1": tender_is(CARDS) & (F.col("sub_tender_id") == 1),
        "card_2": tender_is(CARDS) & (F.col("sub_tender_id") == 2),
        "card_3": tender_is(CARDS) & (F.col("sub_tender_id") == 3),
        "card_4": tender_is(CARDS) & (F.col("sub_tender_id") == 4),
        "card_9": tender_is(CARDS) & (F.col("sub_tender_id") == 9),
    }
    paid = receipts.groupBy(*day).agg(
        *conditional_sums({"cash": tender_is(CASH), "credit": tender_is(ACCOUNT), "bank": tender_is(CARDS), **cards}, home_amount())
    )
    return (
        sales.join(paid, day, "left").join(counts, day, "left").join(bottles, day, "left")
    )


def counted_cash_by_day(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Counted cash per store on the last day of each settlement round: the latest count per till."""
    last = latest_rows(
        counts.filter(tender_is(CASH)), ["store_idx", "znr", "till_id", "tender_id"], ["count_no"], ["amount"]
    )
    closing = totals.groupBy("store_idx", "znr").agg(F.max("last_date").alias("sale_date"))
    return last.join(closing, ["store_idx", "znr"]).groupBy("store_idx", "sale_date").agg(F.sum("amount").alias("counted_cash"))


def lottery_by_day(payments: DataFrame) -> DataFrame:
    """Bottle-lottery pay-outs per store and day, on the business calendar of the receipts."""
    return payments.filter(F.col("event_type") == "purchase").groupBy("store_idx", F.col("business_date").alias("sale_date")).agg(
        F.sum("amount").alias("lottery")
    )


# Ledger texts by column.
CREDIT_LINES = {
    "Interim": "interim",
    "Cash difference": "cash_difference",
    "Sales high VAT": "sales_high",
    "Sales medium VAT": "sales_mid",
    "Sales low VAT": "sales_low",
    "Gaming": "gaming",
    "Gift cards": "gift_cards",
}
DEBIT_LINES = {
    "Account sales": "credit",
    "Lottery": "lottery",
    "Bank card": "card_1",
    "Visa": "card_2",
    "MasterCard": "card_3",
    "American Express": "card_4",
    "Maestro": "card_9",
    "Night safe": "counted_cash",
}


def account_lines(branches: DataFrame) -> DataFrame:
    """Debit and credit lines per store and day.  The interim line is what makes the credit side
    equal the debit side."""
    numbers = [c for c in branches.columns if c not in ("store_idx", "sale_date")]
    filled = branches.fillna(0, numbers)
    debit = sum((F.col(c) for c in DEBIT_LINES.values()), F.lit(0))
    known_credit = sum((F.col(c) for t, c in CREDIT_LINES.items() if t != "Interim"), F.lit(0))
    full = filled.withColumn("cash_difference", F.col("counted_cash") - F.col("cash"))
    full = full.withColumn("interim", debit - known_credit)
    return ledger_lines(full, ["store_idx", "sale_date"], CREDIT_LINES, DEBIT_LINES)


def monthly_account(branches: DataFrame) -> DataFrame:
    """Revenue, payments, counted cash and the remaining difference per store and day."""
    numbers = [c for c in branches.columns if c not in ("store_idx", "sale_date")]
    b = branches.fillna(0, numbers)
    cash_difference = F.col("counted_cash") - F.col("cash")
    rest = (
        F.col("gross_revenue") - (F.col("bank") + F.col("credit"))
        - (F.col("counted_cash") + cash_difference + F.col("gaming") + F.col("lottery") + F.col("gift_cards"))
    )
    return b.select(
        "store_idx", "sale_date", "net_revenue", "gross_revenue", "bank", "credit", "cash", "counted_cash",
        cash_difference.alias("cash_difference"), "gaming", "lottery", "gift_cards", rest.alias("remaining"),
    )


def vat_by_store(rows: DataFrame, *, keys=("store_idx", "vat_group")) -> DataFrame:
    return rows.groupBy(*keys).agg(
        net_amount_sum().alias("sales_amount"), net_amount_sum("sales_vat", "return_vat").alias("vat_amount"),
        net_amount_sum("sales_excl_vat", "return_excl_vat").alias("sales_excl_vat"),
    )


def vat_guarded(rows: DataFrame, approved: DataFrame) -> DataFrame:
    """VAT per store, day and rate, only for days with an approved reconciliation."""
    guarded = rows.join(approved.select("store_idx", "sale_date"), ["store_idx", "sale_date"], "left_semi")
    return vat_by_store(guarded, keys=("store_idx", "sale_date", "vat_group"))


# -- bank against register --------------------------------------------------------------------


def bank_against_register(bank: DataFrame, receipts: DataFrame, *, bounds: Bounds | None = None, status: int | None = None) -> DataFrame:
    """Card totals of the bank beside those of the tills; a card known to one side only stays."""
    from tillroll.sources.mart import CARD_NAMES

    if bounds is not None:
        bank, receipts = bank.filter(within("sale_date", bounds)), receipts.filter(within("sale_date", bounds))
    name = label_of("sub_tender_id", CARD_NAMES, "N/A").alias("card_name")
    till = flt.when_set(receipts.filter(tender_is(CARDS)), "receipt_status", status)
    registered = till.groupBy("store_idx", name).agg(
        F.sum(home_amount()).alias("till_amount"), F.countDistinct("receipt_id").alias("till_count")
    )
    settled = bank.groupBy("store_idx", name).agg(F.sum("transactions").alias("bank_count"), F.sum("amount").alias("bank_amount"))
    return full_on(settled, registered, ["store_idx", "card_name"])


def foreign_currency(receipts: DataFrame) -> DataFrame:
    """Foreign amounts per currency and rate, with their home value."""
    return receipts.filter(tender_is(CURRENCY)).groupBy("currency", "exchange_rate").agg(
        F.sum("amount").alias("currency_amount"), F.sum(home_amount()).alias("home_amount")
    )


def payment_means(receipts: DataFrame, stores: DataFrame) -> DataFrame:
    """Payments per store by means, in home currency."""
    sub = F.col("sub_tender_id")
    cases = {
        "cash": tender_is(CASH),
        "bank_card": tender_is(CARDS) & sub.isin(1, 4),
        "visa": tender_is((3,)) & (sub == 2),
        "master_card": tender_is((3,)) & (sub == 3),
        "maestro": tender_is((3,)) & (sub == 9),
        "credit": tender_is(ACCOUNT),
        "currency": tender_is(CURRENCY),
        "mobile": tender_is(MOBILE),
    }
    per_store = receipts.groupBy("store_idx").agg(*conditional_sums(cases, home_amount()))
    return per_store.join(stores.select("store_idx", "store_id", "store_name", "lev1_region_name"), "store_idx").drop("store_idx")


def gaming_amount(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Gaming sales per store in home currency."""
    games = articles.filter(F.col("lev1_id") == GAMING_GROUP).select("article_idx")
    amount = in_home_currency(net_amount(), F.col("exchange_rate"))
    return rows.join(games, "article_idx", "left_semi").groupBy("store_idx").agg(F.sum(amount).alias("gaming"))


# -- counters ---------------------------------------------------------------------------------


def counter_sums() -> list[Column]:
    acc = F.col("accumulation_id")
    one = F.lit(1)
    return [
        sum_if(acc == ACC_CUSTOMERS, one).alias("customers"),
        sum_if(acc == ACC_RETURNS, one).alias("returns"),
        sum_if(acc == ACC_RETURNS, "amount").alias("return_amount"),
        sum_if(acc == ACC_CORRECTIONS, one).alias("corrections"),
        sum_if(acc == ACC_CORRECTIONS, "amount").alias("correction_amount"),
        sum_if(acc == ACC_CANCELED, one).alias("canceled"),
        sum_if(acc == ACC_PRICE_CHECKS, one).alias("price_checks"),
        sum_if(acc == ACC_DISCOUNT, "amount").alias("discount"),
    ]


def operations_by_day(counters: DataFrame) -> DataFrame:
    return counters.groupBy("log_date", "store_idx").agg(*counter_sums())


def accumulation_details(counters: DataFrame, payments: DataFrame) -> DataFrame:
    """Counters beside the sales of each till and cashier."""
    keys = ["store_idx", "till_id", "cashier_idx"]
    per_counter = counters.groupBy(*keys, "cashier_name").agg(*counter_sums())
    paid = payments.groupBy(*keys).agg(F.sum("amount").alias("sales_amount"))
    return per_counter.join(paid, keys, "left").fillna(0, ["sales_amount"])


# -- rounds, counts and bags ------------------------------------------------------------------

ROUND = ["store_idx", "znr", "till_id"]


def bag_of(store: str, count: str) -> Column:
    """Every count of a store goes into a bag of its own."""
    return F.concat_ws("-", F.lit("B"), F.col(store).cast("string"), F.col(count).cast("string"))


def last_counts(counts: DataFrame) -> DataFrame:
    """The latest manual count per round, till and tender."""
    last = latest_rows(counts, ROUND + ["tender_id"], ["count_no"], ["count_no", "amount", "counted_by"])
    return last.withColumn("bag_id", bag_of("store_idx", "count_no"))


def _tender_columns(prefix: str = "") -> list[Column]:
    cases = {
        f"{prefix}cash": tender_is((1,)), f"{prefix}cards": tender_is((3, 5)), f"{prefix}account": tender_is(ACCOUNT),
        f"{prefix}mobile": tender_is(MOBILE), f"{prefix}vouchers": tender_is(VOUCHERS), f"{prefix}currency": tender_is(CURRENCY),
    }
    return conditional_sums(cases, "amount")


def cash_settlement(totals: DataFrame, counts: DataFrame, gaming: DataFrame) -> DataFrame:
    """Monthly settlement per store: system totals by kind, counted cash of the last count, gaming,
    and the deviation between system cash and counted cash."""
    keys = ["store_idx", "znr"]
    system = totals.groupBy(*keys).agg(
        *conditional_sums(
            {
                "total": tender_is(ALL_PAYMENTS), "system_cash": tender_is(CASH), "cards": tender_is(CARDS),
                "account": tender_is(ACCOUNT), "mobile": tender_is(MOBILE), "vouchers": tender_is(VOUCHERS),
                "currency": tender_is(CURRENCY),
            },
            "amount",
        )
    )
    last_no = F.max(F.struct("count_no", "amount", "cash"))
    per_count = counts.groupBy(*keys, "count_no").agg(
        F.sum("amount").alias("amount"), sum_if(tender_is(CASH), F.col("amount")).alias("cash")
    )
    counted = per_count.groupBy(*keys).agg(last_no.alias("last")).select(
        *keys, F.col("last.amount").alias("counted"), F.col("last.cash").alias("counted_cash")
    )
    measures = ["total", "system_cash", "cards", "account", "mobile", "vouchers", "currency", "counted", "counted_cash", "gaming"]
    out = padded_union_sum([system, counted, gaming], keys, measures)
    return out.withColumn("cash_deviation", F.col("system_cash") - F.col("counted_cash"))


def gaming_by_round(rows: DataFrame, articles: DataFrame) -> DataFrame:
    games = articles.filter(F.col("lev1_id") == GAMING_GROUP).select("article_idx")
    znr = (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr")
    return rows.join(games, "article_idx", "left_semi").groupBy("store_idx", znr).agg(net_amount_sum().alias("gaming"))


def reconciliation_with_bag(totals: DataFrame, counts: DataFrame) -> DataFrame:
    """System cash per round, till and cashier beside the counted cash and bag of the last count."""
    system = totals.groupBy(*ROUND, "cashier_idx", "cashier_name").agg(*_tender_columns())
    counted = last_counts(counts).groupBy(*ROUND, "bag_id").agg(
        sum_if(tender_is((1,)), "amount").alias("counted_cash"), sum_if(tender_is((3, 5)), "amount").alias("counted_cards")
    )
    return (
        system.filter(F.col("cash") > 0).join(counted, ROUND, "left")
        .select(*ROUND, "cashier_name", "cash", "bag_id", "counted_cash", "counted_cards")
    )


def reconciliation_details(totals: DataFrame, counts: DataFrame, receipts: DataFrame, counters: DataFrame) -> DataFrame:
    """System amounts by kind per round and till, bottle deposit, counted cash and deviation, and the
    key figures of the store in the same round."""
    system = totals.groupBy(*ROUND).agg(F.sum("amount").alias("sales_amount"), *_tender_columns())
    counted = last_counts(counts).groupBy(*ROUND).agg(
        sum_if(tender_is((1,)), "amount").alias("counted_cash"), F.max("bag_id").alias("bag_id")
    )
    znr = (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr")
    key = receipts.groupBy("store_idx", znr).agg(F.sum("amount").alias("total_sales"), *_tender_columns("total_"))
    day = F.col("business_date")
    deposit = counters.filter(F.col("accumulation_id") == ACC_BOTTLE_DEPOSIT).groupBy(
        "store_idx", (F.year(day) * 100 + F.month(day)).alias("znr"), "till_id"
    ).agg(F.sum("amount").alias("bottle_deposit"))
    return (
        system.join(counted, ROUND, "left").join(deposit, ROUND, "left").join(key, ["store_idx", "znr"], "left")
        .fillna(0, ["counted_cash", "bottle_deposit"])
        .withColumn("cash_deviation", F.col("counted_cash") - F.col("cash"))
    )


def bag_totals(counts: DataFrame) -> DataFrame:
    """Cash per bag over the last counts and the number of rounds in the bag."""
    cash = last_counts(counts).filter(tender_is((1, 8)))
    per_round = cash.groupBy("bag_id", "store_idx", "znr", "tender_id").agg(F.sum("amount").alias("amount"))
    return per_round.filter(F.col("amount") > 0).groupBy("bag_id").agg(
        F.sum("amount").alias("amount"), F.countDistinct("znr").alias("rounds")
    )


def receipt_date_range(totals: DataFrame) -> DataFrame:
    """First and last receipt day per store and round."""
    return totals.groupBy("store_idx", "znr").agg(F.min("first_date").alias("first_day"), F.max("last_date").alias("last_day"))


def last_count_cashier(counts: DataFrame, users: DataFrame) -> DataFrame:
    """Who made the last count of a round, and the bag it went into."""
    latest = latest_rows(counts, ["store_idx", "znr"], ["count_no", "till_id", "tender_id"], ["count_no", "counted_by"])
    names = users.select(F.col("cashier_idx").alias("counted_by"), "cashier_name")
    return latest.join(names, "counted_by").withColumn("bag_id", bag_of("store_idx", "count_no"))
