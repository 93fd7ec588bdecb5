"""What several operators of this package share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: blank, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: The largest table, in rows, that an operator broadcasts after having counted it.
BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, as ``spark.checkpoint.dir`` names it.

    Only where it is unset, as in tests, a folder of this machine takes its place.
    """
    at = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not at:
        at = tempfile.mkdtemp(prefix="quillwort-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/quillwort/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives the loss of executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*used: DataFrame) -> None:
    """Delete what ``store`` wrote, when no later result reads it, and the shuffle files of queries that are over.

    Spark deletes those once the driver has collected the garbage that refers to them, which it is asked to do here.
    """
    for df in used:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    sweep(used[0].sparkSession)


def sweep(spark: SparkSession) -> None:
    """Have the shuffle files of queries that are over deleted. What the first round lets go of, the second one finds."""
    for wait in (0.5, 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(wait)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound an Arrow batch of whole texts. A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The lower-cased words of a text; an empty array for null or blank text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPACE), "")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``part``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
