"""Folders that all executors share, and files that tasks open themselves."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a narrow table (keys and counts) up to which it may be broadcast.
BROADCAST_ROWS = 200_000


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`. Only in local mode, where the driver is
    the only machine, a new folder is made where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[[^,]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder in one of the session's own, which goes when the driver ends."""
    own = f"{checkpoint_folder(spark)}/runloom-{spark.sparkContext.applicationId}"
    at = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(at)
    files.deleteOnExit(at)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Written to the shared folder; the plan starts from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if it has few rows: they are fetched once, and the
    plan goes on from them. Beyond the bound no more than it is fetched; `df` is then
    cut, and Spark joins it by a shuffle."""
    found = df.limit(rows + 1).toArrow()
    if found.num_rows > rows:
        return cut(df)
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))


def with_places(ordered: DataFrame, name: str) -> DataFrame:
    """Rows in the order in which they come, with their place from 1. They are written
    once; a row's place is its number in its partition and the rows of those before."""
    rows = cut(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = checked_broadcast(sizes.select("_part", before.alias("_before")))  # a row for each partition
    place = F.col("_before") + F.col("_id") - F.shiftleft("_part", 33) + 1
    return rows.withColumn("_part", part).join(starts, "_part").select(*ordered.columns, place.alias(name))


def opened(path: str):
    """pyarrow's file system for a path of Spark's, and the path in it: local and
    mounted folders, HDFS, S3 and GCS."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def reachable(path: str) -> bool:
    """Whether tasks can open files under a path themselves."""
    try:
        return opened(path) is not None
    except Exception:  # pyarrow raises various errors for schemes that it doesn't know
        return False
