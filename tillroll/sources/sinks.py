"""Exports: delimited files, text reports, one folder per store, revisioned settlements.

Writers keep the partitioning of the frame.  A file per store comes from one job partitioned by
store, not from a loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.plans.settlements import revise


def export_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    """Delimited files, as many as the frame has partitions."""
    df.write.mode("overwrite").options(sep=sep, header=header, emptyValue="", nullValue="").csv(path)


def export_name(store: str, day: dt.date, prefix: str = "sales", suffix: str = "csv") -> str:
    """File name from store and date."""
    return f"{prefix}_{store}_{day:%Y%m%d}.{suffix}"


def export_per_store(df: DataFrame, path: str, sep: str = ";", store: str = "store_id", pieces: int = 1) -> None:
    """One folder per store that has rows.

    Rows are shuffled by store and a piece number, so a store with most of the rows is written by
    ``pieces`` tasks.  The piece is a hash of the row: a task that is run again puts every row where
    it was before.
    """
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces)) if pieces > 1 else F.lit(0)
    (
        df.withColumn("_piece", piece).repartition(store, "_piece").drop("_piece")
        .write.mode("overwrite").partitionBy(store).options(sep=sep, header=True).csv(path)
    )


def write_report_lines(lines: DataFrame, path: str) -> None:
    """Text reports, one folder per store.  The lines of one week stay together in one file: header
    first, then detail lines in descending order, then the sum line."""
    ordered = lines.repartition("store_idx", "week").sortWithinPartitions("store_idx", "week", "part", F.desc("line"))
    ordered.select("store_idx", "line").write.mode("overwrite").partitionBy("store_idx").text(path)


def write_revision(new: DataFrame, stored: DataFrame, current_path: str, archive_path: str) -> DataFrame:
    """Store the current settlement lines under a new path and append replaced lines to the
    archive.  The stored frame is not overwritten in place, so a failed job loses nothing."""
    current, archived = revise(new, stored)
    current.write.mode("errorifexists").parquet(current_path)
    archived.write.mode("append").parquet(archive_path)
    return new.sparkSession.read.parquet(current_path)
