"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the only separators of words in the contracts.
SPACE = r"[\x20\x09-\x0D]"

#: Rows of a narrow table (keys and counts) up to which it may be broadcast.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's. Only in local mode, where the
    driver is the only machine, a new one is made where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[[^,]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there, so that
    a lost executor costs a read and not the whole plan."""
    _with_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(df: DataFrame, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{_with_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of `shared_folder` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def quoted(columns) -> list[str]:
    """Column names as they can be selected, whatever characters are in them."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]


#: Stands for a null id inside Python batches, where a null would turn ids to floats.
NO_ID = (1 << 63) - 1


def id_of(name: str = "doc_id") -> Column:
    """An id as a long; `NO_ID` for null. `given_id` turns it back."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID)).alias(name)


def given_id(name: str = "doc_id") -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: its maximal runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once, wherever `body` uses it. A
    plain column may be inlined by the optimiser into a lambda, and is then
    worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(sizes: Column, run: int = 512) -> Column:
    """For each of an array's numbers the sum of those before it. Sums are taken
    inside runs and over runs, as an array that grows is copied at each step: the
    copies then add up to the array's length times that of a run."""

    def walk(numbers: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out"))
        return F.aggregate(numbers, start, step, lambda acc: acc["out"])

    def over(all_: Column) -> Column:
        runs = F.when(F.size(all_) > 0, F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / run).cast("int"))).otherwise(F.array().cast("array<int>"))
        part = lambda k: F.slice(all_, k * run + 1, F.lit(run))
        total = lambda k: F.aggregate(part(k), F.lit(0).cast("long"), lambda a, x: a + x)
        bases = walk(F.transform(runs, total))
        return F.flatten(F.zip_with(runs, bases, lambda k, base: F.transform(walk(part(k)), lambda x: x + base)))

    return let(F.transform(sizes, lambda x: x.cast("long")), over)


def unit(*columns) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if it has few rows. `df` should be cut already,
    as it is counted here. Beyond the bound Spark joins it by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

