"""Small constant tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def inline_table(spark: SparkSession, columns: Mapping[str, Sequence]) -> DataFrame:
    """A constant table that is part of the plan.

    The optimizer knows its exact size and so picks the join by that size; a frame made from Python
    rows has no size and would be shuffled against the fact.
    """
    return spark.createDataFrame(pa.table({name: list(values) for name, values in columns.items()}))
