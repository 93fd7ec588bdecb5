"""Incremental ingest: files that arrive are read once, and each batch is merged into the snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def arrivals(spark: SparkSession, path: str, schema: StructType | str, form: str = "parquet", files: int = 100) -> DataFrame:
    """A stream of the files that land in a folder, so many in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(path)


def unique_within(stream: DataFrame, time: str, keys: list[str], delay: str = "3 days") -> DataFrame:
    """The first row of a key within the watermark's delay; state older than that is dropped.

    Windows of sources overlap, so most repetitions are near. What comes later still is the merge's business, which
    drops nothing for being late.
    """
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def per_day(stream: DataFrame, time: str, delay: str = "3 days") -> DataFrame:
    """(day, n): rows per day of their own time, a day being closed when the watermark has passed it."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.groupBy(F.window(time, "1 day")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), "n")


def add_days(saved: DataFrame | None, batch: DataFrame, time: str) -> DataFrame:
    """(day, n) with the rows of a batch added, however late they are."""
    now = batch.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return now if saved is None else saved.unionByName(now).groupBy("day").agg(F.sum("n").alias("n"))


class Snapshots:
    """Versions of a table under one folder. A version is complete once its commit file is there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def current(self) -> int:
        """The newest complete version, 0 if there is none."""
        at, fs = self._fs(f"{self.path}/v=*/_SUCCESS")
        found = [int(str(f.getPath()).rsplit("v=", 1)[1].split("/")[0]) for f in fs.globStatus(at) or []]
        return max(found, default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        version = self.current() if version is None else version
        return self.spark.read.parquet(f"{self.path}/v={version}") if version else None

    def publish(self, df: DataFrame, version: int) -> None:
        """Write one version. A version that is there already is left alone, so a repeated batch changes nothing."""
        if version > self.current():
            df.write.mode("overwrite").parquet(f"{self.path}/v={version}")


def merge_stream(stream: DataFrame, table: Snapshots, merge: Callable[[DataFrame | None, DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Merge what has arrived, batch by batch, and stop; each batch makes the version of its number."""

    def each(batch: DataFrame, number: int) -> None:
        table.publish(merge(table.read(number) if number else None, batch), number + 1)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
