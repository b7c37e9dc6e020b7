"""Registration of queries and the common output types."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillroll.catalogue.frames_sql import with_frames
from tillroll.sources.mart import Mart


@dataclass(frozen=True)
class Query:
    name: str
    program: Callable[[Mart], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return plain_types(self.program(Mart(spark, directory)))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(program: Callable[[Mart], DataFrame]) -> Callable[[Mart], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, program, with_frames(sql) if sql else None)
        return program

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, fixed-point as double, dates and times as text: types that read the
    same from every engine."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.BooleanType):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)
