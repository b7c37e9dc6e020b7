"""Stored daily and monthly aggregates, kept up to date month by month.

A rollup holds its rows per day and, merged from these, per month, each month in folders of its own; both are written
in one job from one exchange of the rows.
Which folders are current, and what the source looked like when they were made, is one published
version: readers see all of a refresh or nothing of it, and of two refreshes that start from one version one
is refused.  A period is answered from the months it holds whole and from the days at its edges;
the source is not read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.functions.money import WHOLE
from tillroll.plans.calendar import month_end, within
from tillroll.plans.sales import reduce_to, regroup
from tillroll.sources.published import Published

Step = Callable[..., DataFrame]

#: Rows of a month that are aggregated together; a month of more is dealt to several pieces by its ``spread`` keys.
PIECE_ROWS = 100_000


def month_of(day: Column | str) -> Column:
    return F.year(day) * 100 + F.month(day)


def file_token(df: DataFrame) -> str:
    """Changes whenever a file of the frame's tables is added, replaced or removed."""
    spark = df.sparkSession
    conf, path_of = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    digest = hashlib.sha256()
    for name in sorted(df.inputFiles()):
        path = path_of(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        digest.update(f"{name} {status.getLen()} {status.getModificationTime()}\n".encode())
    return digest.hexdigest()


class Rollup:
    """One stored rollup.

    ``daily(rows, *keys)`` aggregates source rows and ``merge(rolled, *keys)`` aggregates what is aggregated
    already; both add keys of their own to those given.  ``day`` is the source's date column.

    ``spread`` names keys of both steps whose groups are about as many as the rows.  The rows are then exchanged once, by month and
    piece, before they are aggregated: every task holds the groups of some pieces, however large the source's files
    are.  Without it, map tasks aggregate first, which suits few groups.
    """

    def __init__(self, spark: SparkSession, folder: str, daily: Step, merge: Step, day: str = "sale_date", spread: Sequence[str] = ()):
        self.spark, self.folder, self.day, self._spread = spark, folder.rstrip("/"), day, tuple(spread)
        self._daily, self._merge = daily, merge
        self._versions = Published(spark, self.folder)

    def refresh(self, rows: DataFrame, token: str | None = None) -> list[int]:
        """Brings the months up to date whose source rows have changed; returns them (YYYYMM).

        A month's rows are summed up in a number of rows and two sums over hashes of whole rows, in one scan;
        only months for which these differ from the stored ones are aggregated again.  With a
        ``token`` (see ``file_token``) equal to the stored one not even that is done.
        """
        base = self._versions.version()
        state = self._versions.read(base)
        if token is not None and token == state.get("token"):
            return []
        row = F.xxhash64(*[c for c in rows.columns if not c.startswith(WHOLE)])  # hundredths say nothing new
        dated = rows.withColumn("month_key", month_of(self.day)).filter(F.col("month_key").isNotNull())
        name = f"v{base + 1:010d}-{uuid.uuid4().hex}"
        dated.groupBy("month_key").agg(
            F.count("*").alias("n"), F.bit_xor(row).alias("a"), F.sum(F.pmod(row, F.lit(1 << 24))).alias("b"),
            F.min(self.day).cast("date").alias("first_day"), F.max(self.day).cast("date").alias("last_day"),
        ).coalesce(1).write.partitionBy("month_key").parquet(f"{self.folder}/marks/{name}")  # one row for each month
        marks = self._marks(f"marks/{name}")
        known = self._marks(state["marks"]) if state else marks.limit(0)
        changed = marks.select("month_key", "n", "a", "b").exceptAll(known.select("month_key", "n", "a", "b")).select("month_key", "n")
        types = state.get("types", {})
        if not changed.isEmpty():
            types = self._write(dated, changed, name)
        new, before = self._months(f"rolled/{name}/grain=daily"), state.get("months", {})
        months = {m: {"folder": name, "rolled": True} if m in new else before[m] for m in self._months(f"marks/{name}")}
        if new or months.keys() != before.keys() or token != state.get("token"):
            days = marks.agg(F.min("first_day").alias("first"), F.max("last_day").alias("last")).first()
            covers = [str(days["first"]), str(days["last"])] if months else []
            self._versions.publish(base, {"token": token, "marks": f"marks/{name}", "months": months, "covers": covers, "types": types})
        return [int(m) for m in new]

    def _months(self, name: str) -> list[str]:
        """The months a folder has rows of."""
        return [f.split("=")[1] for f in self._versions.children(name) if f.startswith("month_key=")]

    def _marks(self, name: str) -> DataFrame:
        shape = "n bigint, a bigint, b bigint, first_day date, last_day date, month_key int"
        return self.spark.read.schema(shape).parquet(f"{self.folder}/{name}")

    def _write(self, dated: DataFrame, changed: DataFrame, name: str) -> dict[str, str]:
        """Aggregates the changed months by day and by month; returns the types of the rows by day."""
        if self._spread:
            sizes = changed.select("month_key", F.ceil(F.col("n") / PIECE_ROWS).cast("int").alias("_pieces"))
            piece = F.pmod(F.xxhash64(*self._spread), F.col("_pieces")).cast("int")
            rows = dated.join(sizes, "month_key").withColumn("_piece", piece).drop("_pieces")
            keys = ("month_key", "_piece")
            rows = rows.repartition(sizes.agg(F.sum("_pieces")).first()[0], *keys)
        else:
            rows, keys = dated.join(changed, "month_key", "left_semi"), ("month_key",)
        daily = self._daily(rows, *keys, self.day)
        monthly = self._merge(daily, *keys)
        both = daily.withColumn("grain", F.lit("daily")).unionByName(monthly.withColumn("grain", F.lit("monthly")), allowMissingColumns=True).drop("_piece")
        # A piece is a file; otherwise one file for each month, more for months with many rows.
        both = both if self._spread else both.hint("rebalance", "grain", "month_key")
        both.write.partitionBy("grain", "month_key").parquet(f"{self.folder}/rolled/{name}")
        return {c: t for c, t in daily.dtypes if c not in ("month_key", "_piece")}

    def _place(self, state: dict, grain: str, month: str) -> str:
        """The folder of a month's rows by day or by month; both had folders of their own once."""
        entry = state["months"][month]
        place = f"rolled/{entry['folder']}/grain={grain}" if entry.get("rolled") else f"{grain}/{entry['folder']}"
        return f"{self.folder}/{place}/month_key={month}"

    def _read(self, grain: str, places: list[str], types: dict[str, str]) -> DataFrame:
        rows = self.spark.read.parquet(*places)
        if grain == "monthly":
            return rows.drop(self.day)
        return rows.select(*[F.col(c).cast(types.get(c, t)) for c, t in rows.dtypes])

    def between(self, first: dt.date, last: dt.date) -> DataFrame:
        """The rollup's rows, without day and month, that together make up the period, first and last day included."""
        state = self._versions.read()
        if not state.get("covers"):
            raise ValueError("the rollup holds nothing yet")
        begin, end = (dt.date.fromisoformat(d) for d in state["covers"])
        if first < begin.replace(day=1) or last > month_end(end):
            raise ValueError(f"the rollup covers {begin} to {end} only")
        whole, edges, month = [], [], first.replace(day=1)
        while month <= last:
            key, after = f"{month:%Y%m}", month_end(month) + dt.timedelta(days=1)
            if key in state["months"]:
                inside = first <= month and after - dt.timedelta(days=1) <= last
                (whole if inside else edges).append(key)
            month = after
        parts, types = [], state.get("types", {})
        if whole:
            parts.append(self._read("monthly", [self._place(state, "monthly", m) for m in whole], types))
        if edges:
            days = self._read("daily", [self._place(state, "daily", m) for m in edges], types)
            parts.append(days.filter(within(self.day, (first, last))).drop(self.day))
        if not parts:  # a month of the cover without rows
            parts.append(self._read("monthly", [self._place(state, "monthly", next(iter(state["months"])))], types).limit(0))
        columns = parts[0].columns
        out = parts[0]
        for other in parts[1:]:
            out = out.unionByName(other.select(*columns))
        return out


# -- the rollups of the reports ---------------------------------------------------------------

_SALES_KEYS = ("article_idx", "supplier_idx", "price_type")


def sales_rollup(spark: SparkSession, folder: str) -> Rollup:
    """Sales measures per article, supplier and price type."""
    return Rollup(spark, folder, lambda rows, *keys: reduce_to(rows, *keys, *_SALES_KEYS), lambda rolled, *keys: regroup(rolled, *keys, *_SALES_KEYS), spread=_SALES_KEYS)


#: Registers of a sketch, as a power of two: a standard error of about 0.4 per cent; up to some thousand values it is exact
#: but for chance collisions.
SKETCH_BITS = 16


def desk_rollup(spark: SparkSession, folder: str) -> Rollup:
    """Receipts per store, and sketches of their different cashiers, which can be united over any period."""
    def daily(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys, "store_idx").agg(F.count("*").alias("receipts"), F.hll_sketch_agg("cashier_idx", F.lit(SKETCH_BITS)).alias("cashiers"))

    def merge(rolled: DataFrame, *keys: str) -> DataFrame:
        return rolled.groupBy(*keys, "store_idx").agg(F.sum("receipts").alias("receipts"), F.hll_union_agg("cashiers").alias("cashiers"))

    return Rollup(spark, folder, daily, merge)


def desks_between(rollup: Rollup, first: dt.date, last: dt.date) -> DataFrame:
    """Receipts and different cashiers per store in a period, the latter estimated from the united sketches."""
    united = rollup.between(first, last).groupBy("store_idx").agg(F.sum("receipts").alias("receipts"), F.hll_union_agg("cashiers").alias("_cashiers"))
    return united.select("store_idx", "receipts", F.hll_sketch_estimate("_cashiers").alias("cashiers"))
