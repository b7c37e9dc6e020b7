"""Settlement lines with revisions, and the checks that approve them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.operators.filters import COUNTED_STATUSES
from tillroll.sources.published import Published

LINE_KEY = ["store_idx", "znr"]
LINE_COLUMNS = ["store_idx", "znr", "debit_account", "credit_account", "vat_rate", "debit_amount", "credit_amount"]

# Fixed values of the mapping: ledger account by tender, and the sales account.
TENDER_ACCOUNTS = {1: "1900", 3: "1920", 5: "1925", 6: "1500", 8: "1905"}
SALES_ACCOUNT = "3000"


def settlement_lines(receipts: DataFrame) -> DataFrame:
    """Grouped settlement lines per store and round: one debit line per tender, one credit line with
    the sales, from one pass over the receipts."""
    from tillroll.functions.labels import label_of

    dated = receipts.select("store_idx", (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr"), "tender_id", "amount")
    keys = [F.col("store_idx"), F.col("znr"), F.col("tender_id")]
    sums = dated.groupingSets([keys, keys[:2]], *keys).agg(F.sum("amount").alias("_amount"), F.grouping("tender_id").alias("_all"))
    credit, zero = F.col("_all") == 1, F.lit(0).cast("decimal(22,2)")
    amount = F.col("_amount").cast("decimal(22,2)")
    return sums.select(
        "store_idx", "znr",
        F.when(credit, "").otherwise(label_of("tender_id", TENDER_ACCOUNTS, "1999")).alias("debit_account"),
        F.when(credit, SALES_ACCOUNT).otherwise("").alias("credit_account"),
        F.lit(0).alias("vat_rate"),
        F.when(credit, zero).otherwise(amount).alias("debit_amount"), F.when(credit, amount).otherwise(zero).alias("credit_amount"),
    )


# -- posting rules ----------------------------------------------------------------------------

#: What a rule may ask of a posting.  A rule that leaves one open (NULL) fits every value of it.
RULE_COLUMNS = ("tender_id", "vat_rate", "department")


def postings(receipts: DataFrame, rows: DataFrame, articles: DataFrame) -> DataFrame:
    """What a settlement posts, per store and round: payments by tender, sales by VAT rate and department, and the
    difference of the two, which the sales don't explain.

    Rows are summed by article before they meet the article table, receipts by tender.
    """
    znr = (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr")
    none = F.lit(None)
    paid = receipts.groupBy("store_idx", znr, "tender_id").agg(F.sum("amount").alias("amount"))
    paid = paid.select("store_idx", "znr", F.lit("payment").alias("kind"), "tender_id", none.cast("int").alias("vat_rate"), none.cast("string").alias("department"), "amount")
    per_article = rows.groupBy("store_idx", znr, "article_idx", "vat_group").agg((F.sum("sales_amount") + F.sum("return_amount")).alias("amount"))
    sold = per_article.join(articles.select("article_idx", F.col("lev1_id").alias("department")), "article_idx", "left")
    sold = sold.groupBy("store_idx", "znr", "vat_group", "department").agg(F.sum("amount").alias("amount"))
    sold = sold.select("store_idx", "znr", F.lit("sale").alias("kind"), none.cast("int").alias("tender_id"), F.col("vat_group").alias("vat_rate"), "department", "amount")
    both = paid.unionByName(sold).withColumn("amount", F.col("amount").cast("decimal(24,2)"))
    gap = both.groupBy(*LINE_KEY).agg(F.sum(F.when(F.col("kind") == "payment", F.col("amount")).otherwise(-F.col("amount"))).alias("amount"))
    rest = gap.filter(F.col("amount") != 0).select(
        *LINE_KEY, F.lit("difference").alias("kind"), none.cast("int").alias("tender_id"), none.cast("int").alias("vat_rate"),
        none.cast("string").alias("department"), F.col("amount").cast("decimal(24,2)").alias("amount"),
    )
    return both.unionByName(rest)


def account_of(found: DataFrame, rules: DataFrame) -> DataFrame:
    """The postings with the account of the most specific rule that fits; of equally specific ones the lowest rule number.

    rules: rule_no, kind, the three of ``RULE_COLUMNS`` and account.  Each different combination in the postings asks for
    itself with every choice of open columns, which makes the match a join of equal keys.
    """
    different = found.select("kind", *RULE_COLUMNS).distinct()
    choices = different.select("kind", *RULE_COLUMNS, F.explode(F.sequence(F.lit(0), F.lit((1 << len(RULE_COLUMNS)) - 1))).alias("_open"))
    asked = [F.when(F.col("_open").bitwiseAND(1 << k) == 0, F.col(c)).alias(f"_{c}") for k, c in enumerate(RULE_COLUMNS)]
    choices = choices.select("*", *asked).alias("c")
    given = rules.select(F.col("kind").alias("_kind"), "rule_no", "account", *[F.col(c).alias(f"rule_{c}") for c in RULE_COLUMNS])
    fits = (F.col("kind") == F.col("_kind")) & F.expr(" AND ".join(f"_{c} <=> rule_{c}" for c in RULE_COLUMNS))
    specific = F.size(F.filter(F.array(*[F.col(f"rule_{c}").cast("string") for c in RULE_COLUMNS]), lambda x: x.isNotNull()))
    best = choices.join(given, fits).groupBy("kind", *RULE_COLUMNS).agg(F.min_by("account", F.struct(-specific, F.col("rule_no"))).alias("account"))
    named = best.select(F.col("kind").alias("_kind"), *[F.col(c).alias(f"_{c}") for c in RULE_COLUMNS], "account")
    same = (F.col("kind") == F.col("_kind")) & F.expr(" AND ".join(f"{c} <=> _{c}" for c in RULE_COLUMNS))
    return found.join(named, same, "left").select(*found.columns, F.coalesce("account", F.lit("?")).alias("account"))


def posted_lines(found: DataFrame, rules: DataFrame) -> DataFrame:
    """Settlement lines by the posting rules: payments to the debit side, sales to the credit side, a difference to the side
    that balances the two; amounts of one account, VAT rate and department are one line."""
    amount, zero = F.col("amount"), F.lit(0).cast("decimal(24,2)")
    debit = (F.col("kind") == "payment")
    credit_amount = F.when(F.col("kind") == "sale", amount).when((F.col("kind") == "difference") & (amount > 0), amount).otherwise(zero)
    debit_amount = F.when(debit, amount).when((F.col("kind") == "difference") & (amount < 0), -amount).otherwise(zero)
    sided = account_of(found, rules).select(
        *LINE_KEY, F.coalesce("department", F.lit("")).alias("department"),
        F.when(debit | ((F.col("kind") == "difference") & (amount < 0)), F.col("account")).otherwise("").alias("debit_account"),
        F.when(debit | ((F.col("kind") == "difference") & (amount < 0)), "").otherwise(F.col("account")).alias("credit_account"),
        F.coalesce("vat_rate", F.lit(0)).alias("vat_rate"), debit_amount.alias("debit_amount"), credit_amount.alias("credit_amount"),
    )
    return sided.groupBy(*LINE_KEY, "department", "debit_account", "credit_account", "vat_rate").agg(
        F.sum("debit_amount").cast("decimal(24,2)").alias("debit_amount"), F.sum("credit_amount").cast("decimal(24,2)").alias("credit_amount")
    )


# -- revisions --------------------------------------------------------------------------------


def changed_settlements(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Settlements whose lines differ from what is stored, comparing whole lines with their
    multiplicity: counts per line are subtracted in one aggregation over both sides."""
    both = new.select(*LINE_COLUMNS, F.lit(1).alias("_n")).unionByName(stored.select(*LINE_COLUMNS, F.lit(-1).alias("_n")))
    per_line = both.groupBy(*LINE_COLUMNS).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    return per_line.select(*LINE_KEY).distinct()


def revise(new: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines to store and lines to archive.

    Unchanged settlements keep their lines and revision.  A changed one gets the new lines under the
    next revision, its old lines go to the archive.  A settlement seen for the first time starts
    with revision 1.
    """
    changed = changed_settlements(new, stored)
    revisions = stored.groupBy(*LINE_KEY).agg(F.max("revision").alias("_last"))
    kept = stored.join(changed, LINE_KEY, "left_anti").select(*LINE_COLUMNS, "revision")
    archived = stored.join(changed, LINE_KEY, "left_semi").select(*LINE_COLUMNS, "revision")
    fresh = (
        new.join(changed, LINE_KEY, "left_semi").join(revisions, LINE_KEY, "left")
        .select(*LINE_COLUMNS, (F.coalesce("_last", F.lit(0)) + 1).alias("revision"))
    )
    return kept.unionByName(fresh), archived


class SettlementStore:
    """Settlements as they were settled, with every earlier revision.

    Lines are only ever added.  An index has one row per settlement: its revision and a fingerprint of
    its lines that does not depend on their order.  A commit compares fingerprints in one join, writes the lines of
    changed settlements and a new index, and publishes both as one version; if another commit came first, it gets
    ``Conflict`` and nothing of it is seen.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._versions = Published(spark, self.folder)

    def version(self) -> int:
        return self._versions.version()

    @staticmethod
    def fingerprints(lines: DataFrame) -> DataFrame:
        """Per settlement: number of lines, and two sums over hashes of whole lines."""
        line = F.xxhash64(*[F.col(c).cast("string") for c in sorted(lines.columns)])
        return lines.groupBy(*LINE_KEY).agg(F.count("*").alias("n"), F.bit_xor(line).alias("mark_a"), F.sum(F.pmod(line, F.lit(1 << 24))).alias("mark_b"))

    def commit(self, lines: DataFrame, base: int | None = None) -> int:
        """Makes these the current lines; returns the new version.  ``base``: the version this is based on, by default the last.

        Unchanged settlements keep their revision.  Changed ones get the next, new ones 1.  A settlement that has no lines
        any more goes on in the index without lines, so it takes up its count of revisions if it comes back.
        """
        base = self.version() if base is None else base
        state = self._versions.read(base)
        name = f"v{base + 1:010d}-{uuid.uuid4().hex}"
        lines.write.parquet(f"{self.folder}/draft/{name}")
        drafted = self.spark.read.schema(lines.schema).parquet(f"{self.folder}/draft/{name}")
        new = self.fingerprints(drafted).select(*LINE_KEY, F.col("n").alias("_n"), F.col("mark_a").alias("_a"), F.col("mark_b").alias("_b"))
        met = self.index(base).join(new, LINE_KEY, "full")
        now = F.coalesce("_n", F.lit(0)).alias("n")
        same = F.coalesce((F.col("n") == F.coalesce("_n", F.lit(0))) & F.col("mark_a").eqNullSafe(F.col("_a")) & F.col("mark_b").eqNullSafe(F.col("_b")), F.lit(False))
        index = met.select(*LINE_KEY, (F.coalesce("revision", F.lit(0)) + F.when(same, 0).otherwise(1)).alias("revision"), now, F.col("_a").alias("mark_a"), F.col("_b").alias("mark_b"), (~same).alias("changed"))
        index.write.parquet(f"{self.folder}/index/{name}")
        changed = self.spark.read.schema(index.schema).parquet(f"{self.folder}/index/{name}").filter("changed AND n > 0").select(*LINE_KEY, "revision")
        drafted.join(changed, LINE_KEY).write.parquet(f"{self.folder}/lines/{name}")
        return self._versions.publish(base, {"index": f"index/{name}", "lines": [*state.get("lines", []), f"lines/{name}"]})

    def index(self, version: int | None = None) -> DataFrame:
        state = self._versions.read(version)
        shape = "store_idx int, znr int, revision int, n bigint, mark_a bigint, mark_b bigint, changed boolean"
        if not state:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(f"{self.folder}/{state['index']}")

    def _lines(self, condition: str) -> DataFrame:
        state = self._versions.read()
        lines = self.spark.read.parquet(*[f"{self.folder}/{f}" for f in state["lines"]])
        index = self.index().select(*LINE_KEY, F.col("revision").alias("_current"), "n")
        return lines.join(index, LINE_KEY).filter(condition).select(*lines.columns)

    def current(self) -> DataFrame:
        return self._lines("revision = _current AND n > 0")

    def archive(self) -> DataFrame:
        """Lines of replaced revisions."""
        return self._lines("revision < _current")


# -- approval ---------------------------------------------------------------------------------


def debit_equals_credit(lines: DataFrame) -> DataFrame:
    """Debit and credit per settlement and whether they agree."""
    sums = lines.groupBy(*LINE_KEY).agg(F.sum("debit_amount").alias("debit"), F.sum("credit_amount").alias("credit"))
    return sums.withColumn("approved", (F.col("debit") == F.col("credit")).cast("int"))


# How a reconciliation is made, by total type.
TOTAL_TYPES = {1: "till_id", 2: "cashier_idx", 4: "till_id"}


def tenders_equal_reconciliation(receipts: DataFrame, totals: DataFrame, *, total_type: int) -> DataFrame:
    """Counted receipts against reconciled totals per store and round, over the tills or cashiers
    that were reconciled."""
    unit = TOTAL_TYPES[total_type]
    znr = (F.year("sale_date") * 100 + F.month("sale_date")).alias("znr")
    listed = totals.select("store_idx", "znr", unit).distinct()
    counted = receipts.filter(F.col("receipt_status").isin(*COUNTED_STATUSES)).select("store_idx", znr, unit, "amount")
    tenders = counted.join(listed, ["store_idx", "znr", unit], "left_semi").groupBy(*LINE_KEY).agg(F.sum("amount").alias("tenders"))
    reconciled = totals.groupBy(*LINE_KEY).agg(F.sum("amount").alias("reconciled"))
    joined = reconciled.join(tenders, LINE_KEY, "left").fillna(0, ["tenders"])
    return joined.withColumn("difference", F.col("tenders") - F.col("reconciled")).withColumn(
        "approved", (F.col("difference") == 0).cast("int")
    )
