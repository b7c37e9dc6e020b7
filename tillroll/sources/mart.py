"""Retail frames over the supplied tables.

One fixed mapping from the generic order tables to the retail star: orders are receipts, order lines
are receipt rows, nations are stores, parts are articles, events are the timestamped till log.
Every method returns a lazy projection, so a report that touches three columns scans three columns,
and frames that need no store never join to the receipt head.  No join here carries a broadcast
hint: Spark broadcasts a dimension only while its size estimate is under the session threshold and
shuffles it otherwise, and adaptive execution splits a hot key.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillroll.functions.keys import date_key, receipt_row_key, time_key
from tillroll.functions.labels import label_of
from tillroll.functions.money import WHOLE, cents, dec, from_cents, percent_of
from tillroll.operators.aggregates import dealt, pieces_of
from tillroll.sources.scratch import shared_folder

# The last business day of the order tables and of the event log; "today" for relative periods.
AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# From the days of the event log to the business days of the receipts: both end on the same day.
LOG_DAYS_AHEAD = (EVENTS_AS_OF - AS_OF).days

# What tells the lines of a receipt apart; only equal lines are interchangeable.
LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

# Fixed values of the mapping.
TENDER_OF_PRIORITY = {"1": 1, "2": 3, "3": 5, "4": 6, "5": 8}
SUB_TENDER_OF_TILL = {"BUILDING": 1, "HOUSEHOLD": 2, "FURNITURE": 3, "AUTOMOBILE": 4}
STATUS_OF_ORDER = {"F": 1, "O": 5}
CURRENCY_OF_TILL = {"BUILDING": "EUR", "HOUSEHOLD": "USD", "FURNITURE": "GBP", "AUTOMOBILE": "SEK"}
TENDER_OF_EVENT = {"view": 1, "click": 3, "purchase": 22, "signup": 2, "error": 5}
TENDER_NAMES = {
    1: "Cash", 2: "Voucher", 3: "Bank card", 5: "Reserve card", 6: "Account", 8: "Currency", 22: "Mobile",
}
CARD_NAMES = {1: "BankAxept", 2: "Visa", 3: "MasterCard", 4: "AmericanExpress", 9: "Maestro"}


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Scan one table."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def line_number(*within: Column | str) -> Column:
    """Number of a line in its receipt, from 1, without gaps or ties.  Plans that don't read it don't
    compute it; a receipt is as long as it is, so no partition of the window grows with the data."""
    return F.row_number().over(Window.partitionBy("l_orderkey", *within).orderBy(*LINE_ORDER))


class Mart:
    """Retail frames over one table directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.directory, name)

    def _stored(self, make, table: str, rows: str):
        """A stored rollup of these tables, brought up to date if their files have changed."""
        from tillroll.plans.rollups import file_token
        from tillroll.sources.published import Conflict

        place = hashlib.sha256(self.directory.encode()).hexdigest()[:16]
        rollup = make(self.spark, f"{shared_folder(self.spark).rstrip('/')}/tillroll-rollups/{make.__name__}-{place}")
        token = file_token(self.table(table))
        try:
            rollup.refresh(getattr(self, rows), token)
        except Conflict:  # another session has refreshed it meanwhile
            rollup.refresh(getattr(self, rows), token)
        return rollup

    @cached_property
    def sales_rollup(self):
        from tillroll.plans.rollups import sales_rollup

        return self._stored(sales_rollup, "lineitem", "sales_facts")

    @cached_property
    def desk_rollup(self):
        from tillroll.plans.rollups import desk_rollup

        return self._stored(desk_rollup, "orders", "receipts")

    # -- dimensions ---------------------------------------------------------------------------

    @cached_property
    def articles(self) -> DataFrame:
        size = F.col("p_size")
        levels = F.when(size <= 10, 1).when(size <= 30, 2).otherwise(3)
        key_text = F.col("p_partkey").cast("string")
        return self.table("part").select(
            F.col("p_partkey").alias("article_idx"),
            key_text.alias("article_id"),
            F.col("p_name").alias("article_name"),
            F.when(size <= 25, key_text)
            .otherwise(F.concat(F.lit("70"), F.lpad(key_text, 11, "0")))
            .alias("gtin"),
            F.col("p_type").alias("lev1_id"),
            F.concat(F.lit("Type "), F.col("p_type")).alias("lev1_name"),
            F.when(levels >= 2, F.col("p_brand")).alias("lev2_id"),
            F.when(levels >= 2, F.concat(F.lit("Group "), F.col("p_brand"))).alias("lev2_name"),
            F.when(levels >= 3, size.cast("string")).alias("lev3_id"),
            F.when(levels >= 3, F.concat(F.lit("Size "), size.cast("string"))).alias("lev3_name"),
            levels.alias("num_levels"),
            F.col("p_brand").alias("brand_id"),
            (F.col("p_type") == "PROMO").alias("is_third_party"),
            F.when(F.col("p_type") == "SMALL", 130).otherwise(1).alias("article_type_id"),
            F.when(F.col("p_type") == "LARGE", 18).otherwise(0).alias("age_limit"),
            F.col("p_size").cast("decimal(8,2)").alias("unit_amount"),
            F.when(F.col("p_type") == "MEDIUM", F.lit("L")).otherwise(F.lit("PCS")).alias("unit_name"),
            dec("p_retailprice").alias("retail_price"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        number = F.col("n_nationkey").cast("string")
        region_no = F.col("n_regionkey").cast("string")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            F.col("n_nationkey").alias("store_idx"),
            number.alias("store_id"),
            F.col("n_name").alias("store_name"),
            region_no.alias("lev1_region_no"),
            F.col("r_name").alias("lev1_region_name"),
            F.concat(F.lit("R"), region_no, F.lit("S"), number).alias("lev2_region_no"),
            F.concat(F.lit("L"), region_no).alias("lev1_legal_no"),
            F.concat(F.lit("C"), F.substring("r_name", 1, 1)).alias("lev1_chain_no"),
            F.concat(F.lit("D"), F.right("n_name", F.lit(1))).alias("lev1_district_no"),
            F.concat(F.lit("EN"), F.lpad(number, 2, "0")).alias("airport"),
        )

    STORE_GROUP_COLUMNS = (
        "lev1_region_no", "lev2_region_no", "lev1_legal_no", "lev1_chain_no", "lev1_district_no", "store_id",
    )

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("supplier_idx"),
            F.col("s_suppkey").cast("string").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("s_nationkey").alias("supplier_store_idx"),
            (F.col("s_acctbal") >= 0).alias("is_current"),
            dec("s_acctbal").alias("balance"),
        )

    @cached_property
    def users(self) -> DataFrame:
        """Cashiers, each at home in one store and one till."""
        return self.table("customer").select(
            F.col("c_custkey").alias("cashier_idx"),
            F.col("c_name").alias("cashier_name"),
            F.col("c_nationkey").alias("store_idx"),
            F.col("c_mktsegment").alias("till_id"),
        )

    # -- receipts -----------------------------------------------------------------------------

    @cached_property
    def sales_rows(self) -> DataFrame:
        """Receipt rows without the receipt head: article, supplier, quantities and amounts.

        ``line_no`` is unique in its receipt and each receipt has a line 1: that line counts the customer.

        A returned row keeps its quantity positive in ``qty_return`` and its amounts negative in
        ``return_*``.
        """
        # Numbered before any column is renamed: the exchange by order then serves the join with the receipts too.
        raw = self.table("lineitem").withColumn("line_no", line_number()).select(
            F.col("l_orderkey").alias("receipt_id"),
            "line_no",
            F.col("l_shipdate").cast("date").alias("sale_date"),
            F.col("l_partkey").alias("article_idx"),
            F.col("l_suppkey").alias("supplier_idx"),
            F.col("l_linestatus").alias("line_status"),
            (F.col("l_returnflag") == "R").alias("_returned"),
            cents("l_quantity").alias("_qty"),
            cents("l_extendedprice").alias("_price"),
            cents("l_discount").cast("int").alias("price_type"),
            cents("l_tax").cast("int").alias("vat_group"),
        )
        # One step per derived amount: each is computed once per row, whichever columns are read.
        priced = raw.withColumn("_gross", percent_of(F.col("_price"), 100 - F.col("price_type")))
        taxed = priced.withColumn("_vat", percent_of(F.col("_gross"), F.col("vat_group")))
        returned, campaign = F.col("_returned"), F.col("price_type")
        qty, price, gross, vat = F.col("_qty"), F.col("_price"), F.col("_gross"), F.col("_vat")

        def sold(whole: Column) -> Column:
            return F.when(~returned, whole).otherwise(0)

        def back(whole: Column) -> Column:
            return F.when(returned, whole).otherwise(0)

        amounts = {
            "qty_sold": sold(qty),
            "qty_return": back(qty),
            "list_amount": sold(price),
            "sales_amount": sold(gross),
            "return_amount": back(-gross),
            "sales_excl_vat": sold(gross - vat),
            "return_excl_vat": back(vat - gross),
            "sales_vat": sold(vat),
            "return_vat": back(-vat),
            "discount_amount": sold(price - gross),
            "cost_amount": F.when(returned, -percent_of(price, 70)).otherwise(percent_of(price, 70)),
        }
        return taxed.select(
            "receipt_id",
            "line_no",
            receipt_row_key("receipt_id", "line_no").alias("receipt_idx"),
            "sale_date",
            date_key("sale_date").alias("date_key"),
            "article_idx",
            "supplier_idx",
            "line_status",
            *[from_cents(whole).alias(name) for name, whole in amounts.items()],
            "vat_group",
            "price_type",
            F.when(campaign.between(1, 4), campaign).alias("campaign_id"),
            F.when(campaign.between(5, 7), campaign).alias("combination_id"),
            F.when(campaign >= 8, campaign).alias("reduction_id"),
            # The same amounts in whole hundredths, for sums (see ``whole_amounts``).
            *[whole.alias(f"{WHOLE}{name}") for name, whole in amounts.items()],
        )

    @cached_property
    def sales_facts(self) -> DataFrame:
        """Receipt rows without the numbers that are derived from their order in the receipt."""
        return self.sales_rows.drop("line_no", "receipt_idx")

    @cached_property
    def _heads(self) -> DataFrame:
        """Receipt heads as far as the orders tell."""
        orders = self.table("orders")
        day = F.col("o_orderdate").cast("date")
        tender = label_of(F.substring("o_orderpriority", 1, 1), TENDER_OF_PRIORITY)
        status = F.col("o_orderstatus")
        return orders.select(
            F.col("o_orderkey").alias("receipt_id"),
            F.col("o_custkey").alias("cashier_idx"),
            day.alias("sale_date"),
            date_key(day).alias("date_key"),
            F.col("o_orderdate").alias("sold_at"),
            status.alias("order_status"),
            label_of(status, STATUS_OF_ORDER, F.lit(2)).alias("receipt_status"),
            tender.alias("tender_id"),
            dec("o_totalprice").alias("amount"),
            F.when(status == "O", F.lit("D"))
            .when(status == "F", F.lit("A"))
            .when(F.col("o_orderpriority") != "1-URGENT", F.lit(""))
            .alias("origin_code"),
            F.concat(F.lit("X"), F.substring("o_orderpriority", 1, 1)).alias("connected_airport"),
        )

    def _at_tills(self, heads: DataFrame) -> DataFrame:
        """Heads, or sums of heads by cashier and tender, with what the cashier's till adds."""
        till = F.col("till_id")
        foreign = F.col("tender_id") == 8
        rate = (
            F.when(~foreign, F.lit("1.00"))
            .when(till == "BUILDING", F.lit("11.50"))
            .when(till == "HOUSEHOLD", F.lit("10.50"))
            .when(till == "FURNITURE", F.lit("13.25"))
            .when(till == "AUTOMOBILE", F.lit("0.98"))
            .otherwise(F.lit("0.00"))
            .cast("decimal(6,2)")
        )
        store_no = F.lpad(F.col("store_idx").cast("string"), 3, "0")
        return heads.join(self.users, "cashier_idx").select(
            *heads.columns,
            "cashier_name",
            "store_idx",
            "till_id",
            label_of("till_id", SUB_TENDER_OF_TILL, F.lit(9)).alias("sub_tender_id"),
            F.when(foreign, label_of("till_id", CURRENCY_OF_TILL, "DKK")).otherwise(F.lit("NOK")).alias("currency"),
            rate.alias("exchange_rate"),
            F.concat(F.substring("till_id", 1, 2), store_no).alias("flight_no"),
            F.concat(F.lit("EN"), F.substring(store_no, 2, 2)).alias("local_airport"),
        )

    @cached_property
    def receipts(self) -> DataFrame:
        """Receipt heads with store, till, cashier, payment and flight link."""
        return self._at_tills(self._heads)

    @cached_property
    def receipt_rows(self) -> DataFrame:
        """Receipt rows with their head; dated by the receipt."""
        rows = self.sales_rows.drop("sale_date", "date_key")
        return rows.join(self.receipts, "receipt_id")

    # -- collected orders ---------------------------------------------------------------------

    @cached_property
    def collected_orders(self) -> DataFrame:
        """Receipts that were ordered ahead and collected (paid by card)."""
        status = F.when(F.col("order_status") == "F", 60).when(F.col("order_status") == "O", 50).otherwise(20)
        return self.receipts.filter(F.col("tender_id") == 3).select(
            F.col("receipt_id").alias("order_no"),
            "store_idx",
            "cashier_idx",
            "cashier_name",
            F.col("sold_at").alias("collect_start"),
            F.col("sale_date").alias("collect_date"),
            status.alias("status"),
            "flight_no",
            F.col("origin_code").alias("flight_direction"),
            F.col("amount").alias("actual_amount"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        """Picked lines.  A line that was returned replaced an ordered article: it carries a
        substituted price.  ``link_no`` links one to one: the n-th substitute of an order replaced its
        n-th other line."""
        price, qty = cents("l_extendedprice"), cents("l_quantity")
        short = F.col("l_linestatus") == "O"
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_no"),
            line_number().alias("line_no"),
            line_number(F.col("l_returnflag") == "R").alias("link_no"),
            F.col("l_partkey").alias("article_idx"),
            F.col("l_suppkey").alias("supplier_idx"),
            from_cents(qty).alias("ordered_qty"),
            from_cents(F.when(short, qty - F.col("l_linenumber") * 100).otherwise(qty)).alias("received_qty"),
            from_cents(price).alias("line_price"),
            from_cents(percent_of(price, 100 - cents("l_discount"))).alias("delivered_amount"),
            F.when(F.col("l_returnflag") == "R", 60)
            .when(F.col("l_returnflag") == "A", 10)
            .otherwise(80)
            .alias("line_status"),
            (F.col("l_returnflag") == "R").alias("is_substitute"),
        )

    # -- the till log -------------------------------------------------------------------------

    @cached_property
    def till_events(self) -> DataFrame:
        """Timestamped log lines without the cashier's store."""
        return self.table("events").select(
            F.col("event_id").alias("event_no"),
            F.col("ts").alias("logged_at"),
            F.col("ts").cast("date").alias("log_date"),
            F.date_sub(F.col("ts").cast("date"), LOG_DAYS_AHEAD).alias("business_date"),
            F.col("user_id").alias("cashier_idx"),
            "event_type",
            dec("value").alias("amount"),
            F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("detail"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Payment lines with date and time keys."""
        k = F.col("detail")
        return self.till_events.join(self.users, "cashier_idx").select(
            F.col("event_no").alias("payment_no"),
            "logged_at",
            "log_date",
            "business_date",
            date_key("log_date").alias("date_key"),
            time_key("logged_at").alias("time_key"),
            "cashier_idx",
            "cashier_name",
            "store_idx",
            "till_id",
            "event_type",
            "detail",
            "amount",
            label_of("event_type", TENDER_OF_EVENT).alias("tender_id"),
            F.when(k < 25, 1).when(k < 50, 2).when(k < 75, 3).otherwise(9).alias("sub_tender_id"),
            F.when(k < 80, 1).when(k < 90, 5).otherwise(2).alias("receipt_status"),
        )

    @cached_property
    def age_checks(self) -> DataFrame:
        """Age checks: a signup line is an approval, an error line a refusal."""
        k = F.col("detail")
        approved = F.col("event_type") == "signup"
        return self.payments.filter(F.col("event_type").isin("signup", "error")).select(
            "payment_no", "logged_at", "log_date", "cashier_idx", "cashier_name", "store_idx", "till_id", "amount",
            approved.alias("approved"),
            F.when(approved, F.floor(k / 13) + 1).otherwise(F.floor(k / 9) + 50).cast("int").alias("reason_no"),
        )

    @cached_property
    def accumulations(self) -> DataFrame:
        """Counter lines of the tills by accumulation type."""
        low = F.col("detail") < 50
        kind = F.col("event_type")
        acc = (
            F.when(kind == "purchase", 1)
            .when(kind == "error", 5)
            .when(kind == "click", F.when(low, 7).otherwise(6))
            .when(kind == "signup", F.when(low, 11).otherwise(19))
            .otherwise(F.when(low, 10).otherwise(13))
        )
        return self.payments.select(
            "store_idx", "till_id", "cashier_idx", "cashier_name", "log_date", "business_date", "amount", acc.alias("accumulation_id")
        )

    @cached_property
    def order_events(self) -> DataFrame:
        """Order status log: one order per cashier and day; 40 starts picking, 50 ends it,
        60 confirms a line."""
        status = label_of("event_type", {"view": 40, "purchase": 50, "click": 60}, F.lit(20))
        return self.till_events.select(
            F.concat_ws("-", F.col("cashier_idx").cast("string"), date_key("log_date").cast("string")).alias("order_no"),
            F.col("event_no").alias("tracking_no"),
            F.col("logged_at").alias("created_at"),
            F.col("log_date"),
            status.alias("status"),
            F.concat(F.lit("P"), F.floor(F.col("detail") / 25).cast("string")).alias("picker"),
            "amount",
        )

    @cached_property
    def bottle_receipts(self) -> DataFrame:
        """Bottle-return lottery lines: 90305 gain, 90306 stake, 90307 pay-out."""
        kind = label_of("event_type", {"view": 90305, "click": 90306, "purchase": 90307})
        return self.till_events.filter(F.col("event_type").isin("view", "click", "purchase")).select(
            (F.col("cashier_idx") * 100 + F.col("detail")).alias("voucher_no"),
            "cashier_idx",
            "log_date",
            kind.alias("trans_type"),
            "amount",
        )

    # -- stock --------------------------------------------------------------------------------

    @cached_property
    def stock_moves(self) -> DataFrame:
        """Stock adjustments at the supplying store: 1 sale, 2 registered loss, 51 count,
        52 count difference."""
        flag = F.col("l_returnflag")
        kind = (
            F.when(flag == "N", 1)
            .when(flag == "R", 51)
            .otherwise(F.when(F.col("l_linestatus") == "F", 2).otherwise(52))
        )
        price = cents("l_extendedprice")
        rows = self.table("lineitem").select(
            F.col("l_shipdate").cast("date").alias("adj_date"),
            F.col("l_partkey").alias("article_idx"),
            F.col("l_suppkey").alias("supplier_idx"),
            kind.alias("type_no"),
            F.col("l_linenumber").alias("reason_no"),
            F.when(F.col("l_linenumber") <= 4, -1).otherwise(1).alias("sign"),
            dec("l_quantity").alias("qty"),
            from_cents(percent_of(price, 70)).alias("cost_amount"),
            from_cents(price).alias("sales_value"),
        )
        homes = self.suppliers.select("supplier_idx", F.col("supplier_store_idx").alias("store_idx"))
        return rows.join(homes, "supplier_idx")

    @cached_property
    def count_lines(self) -> DataFrame:
        """Stock count lines; a count is a calendar month."""
        rows = self.table("lineitem").select(
            (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("count_no"),
            F.col("l_partkey").alias("article_idx"),
            F.col("l_suppkey").alias("supplier_idx"),
            dec("l_quantity").alias("in_stock_qty"),
            from_cents(cents("l_quantity") - (F.col("l_linenumber") - 4) * 100).alias("counted_qty"),
            F.when(F.col("l_linestatus") == "F", 80).otherwise(70).alias("line_status"),
        )
        homes = self.suppliers.select("supplier_idx", F.col("supplier_store_idx").alias("store_idx"))
        return rows.join(homes, "supplier_idx").drop("supplier_idx")

    @cached_property
    def article_links(self) -> DataFrame:
        """Packs: a large article counts as six of the article before it."""
        return self.table("part").filter((F.col("p_size") > 45) & (F.col("p_partkey") > 0)).select(
            F.col("p_partkey").alias("master_idx"),
            (F.col("p_partkey") - 1).alias("linked_idx"),
            F.lit(6).cast("decimal(4,0)").alias("link_qty"),
        )

    # -- reconciliation -----------------------------------------------------------------------

    @cached_property
    def system_totals(self) -> DataFrame:
        """Till totals per settlement round (store and month), till, cashier and tender.

        Heads are summed by cashier before they meet the cashiers; one exchange by cashier serves the sums, the join and
        groupings by cashier after it.
        """
        keys = ("cashier_idx", "znr", "tender_id")
        heads = self._heads.withColumn("znr", F.year("sale_date") * 100 + F.month("sale_date"))
        sums = dealt(heads, pieces_of(heads, *keys), "cashier_idx").groupBy(*keys).agg(
            F.sum("amount").alias("amount"),
            F.count("*").alias("transactions"),
            F.min("sale_date").alias("first_date"),
            F.max("sale_date").alias("last_date"),
        )
        return self._at_tills(sums).groupBy("store_idx", "znr", "till_id", "cashier_idx", "cashier_name", "tender_id", "exchange_rate").agg(
            F.sum("amount").cast("decimal(22,2)").alias("amount"),
            F.sum("transactions").alias("transactions"),
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
        )

    @cached_property
    def counts(self) -> DataFrame:
        """Manual counts of a settlement round: the line number is the count number."""
        rows = self.table("lineitem").select(
            F.col("l_orderkey").alias("receipt_id"),
            F.col("l_linenumber").alias("count_no"),
            dec("l_extendedprice").alias("counted"),
        )
        heads = self.receipts.select("receipt_id", "sale_date", "store_idx", "till_id", "tender_id", "cashier_idx")
        znr = F.year("sale_date") * 100 + F.month("sale_date")
        return (
            rows.join(heads, "receipt_id")
            .groupBy("store_idx", znr.alias("znr"), "till_id", "tender_id", "count_no")
            .agg(F.sum("counted").alias("amount"), F.max("cashier_idx").alias("counted_by"))
        )

    @cached_property
    def bank_settlements(self) -> DataFrame:
        """Card payments as the bank saw them: per store, day and card."""
        return (
            self.receipts.filter(F.col("tender_id").isin(3, 5) & F.col("order_status").isin("F", "P"))
            .groupBy("store_idx", "till_id", "tender_id", "sub_tender_id", "sale_date")
            .agg(F.count("*").alias("transactions"), F.sum("amount").alias("amount"))
        )
