"""The till log as a stream, under the same mapping as the batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.sources.mart import Mart


class LiveMart(Mart):
    """A mart whose event log is read as files arrive."""

    def __init__(self, spark, directory: str, pattern: str = "events.parquet", files_per_batch: int | None = None):
        super().__init__(spark, directory)
        self.pattern = pattern
        self.files_per_batch = files_per_batch

    def table(self, name: str) -> DataFrame:
        if name != "events":
            return super().table(name)
        shape = self.spark.read.option("pathGlobFilter", self.pattern).parquet(self.directory).schema
        reader = self.spark.readStream.schema(shape).option("pathGlobFilter", self.pattern)
        if self.files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.parquet(self.directory)
