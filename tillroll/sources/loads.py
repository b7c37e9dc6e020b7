"""Incremental loads and guards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def incremental_append(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have yet."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def enrich_orders(new_orders: DataFrame, infos: DataFrame, tracking: DataFrame, *, paid_status: int, open_from: int, skip: int) -> DataFrame:
    """Finished orders with their flight attributes and payment time.

    ``infos`` holds key/value rows per order; orders without both flight keys are not loaded.
    """
    flight = infos.groupBy("order_no").agg(
        F.max(F.when(F.col("key") == "FlightNumber", F.col("value"))).alias("flight_no"),
        F.max(F.when(F.col("key") == "FlightDirection", F.col("value"))).alias("flight_direction"),
    ).filter(F.col("flight_no").isNotNull() & F.col("flight_direction").isNotNull())
    paid = tracking.filter(F.col("status") == paid_status).groupBy("order_no").agg(F.min("created_at").alias("paid_at"))
    done = new_orders.filter((F.col("status") >= open_from) & (F.col("status") != skip))
    return done.join(flight, "order_no").join(paid, "order_no")


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """Empty result with a schema, for calls without their mandatory parameters."""
    return spark.createDataFrame([], schema)


def with_parameter(report: Callable[[Any], DataFrame], value: Any) -> DataFrame:
    """The report for a value; without one an empty frame of the same columns, for which nothing is read."""
    made = report(value)
    return made if value is not None else empty_like(made.sparkSession, made.schema)


def guard_exists(df: DataFrame, approved: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows only for the keys that exist in the reference frame."""
    return df.join(approved.select(*keys), list(keys), "left_semi")
