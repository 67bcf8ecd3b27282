"""Counts that follow the reads as they land.

Reads are a folder of Parquet that grows, partitioned by nothing that matters here.
Each micro-batch is counted by the landed file that a row comes from, FASTQ file, lane
and barcode, and appended. A landed file never changes, and its counts are always the
same: if it is counted again, after a replay or with a new checkpoint, one of its
counts is taken, so nothing counts twice.

What was appended is folded, every so many batches, into a snapshot: counts by file and
lane, counts by lane and barcode, and the names of the landed files in it. A new
snapshot is written beside the old one, and becomes the current one by the renaming of
one small file over another; then the appended files that are in it are deleted. After
a crash between any two of these steps the counts are the same: a snapshot that no
name points to is not read, and appended counts of landed files that a snapshot knows
are left out. So reading the counts costs a snapshot and what came since, not all history;
only the names of landed files are kept of that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("file", "lane", "barcode")
COUNTS = "landed string, file string, lane int, barcode string, n long"
SNAPSHOT = {"files": "file string, lane int, n long", "barcodes": "lane int, barcode string, n long", "landed": "landed string"}


def count_batch(batch: DataFrame) -> DataFrame:
    """landed (the Parquet file that rows are read from), file, lane, barcode, n. What the
    reads lack is null."""
    keys = [F.col(k) if k in batch.columns else F.lit(None).cast("string").alias(k) for k in KEYS]
    return batch.select("landed", *keys).groupBy("landed", *KEYS).agg(F.count("*").alias("n"))


def follow(spark: SparkSession, source: str, schema, target: str, checkpoint: str, once: bool = True, compact_every: int = 50):
    """Starts the stream; with `once` it ends when all that is there is counted. Every
    `compact_every` batches what was appended becomes a snapshot."""
    reads = spark.readStream.schema(schema).parquet(source).select("*", F.col("_metadata.file_path").alias("landed"))

    def land(batch: DataFrame, batch_id: int) -> None:
        count_batch(batch).write.mode("append").parquet(f"{target}/new")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, target)

    writer = reads.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def current(spark: SparkSession, target: str) -> str | None:
    """The folder of the current snapshot."""
    fs, at = _path(spark, f"{target}/current")
    if not fs.exists(at):
        return None
    return f"{target}/{spark.read.text(at.toString()).first()[0]}"


def _point(spark: SparkSession, target: str, name: str) -> None:
    """Makes a snapshot the current one, in one step."""
    fs, fresh = _path(spark, f"{target}/.current-{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(name.encode()))
    out.close()
    jvm = spark._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    _, at = _path(spark, f"{target}/current")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fresh, at, over)


def _snapshot(spark: SparkSession, folder: str | None, part: str) -> DataFrame:
    schema = SNAPSHOT[part]
    return spark.createDataFrame([], schema) if folder is None else spark.read.schema(schema).parquet(f"{folder}/{part}")


def _appended(spark: SparkSession, target: str) -> DataFrame:
    fs, at = _path(spark, f"{target}/new")
    return spark.read.schema(COUNTS).parquet(at.toString()) if fs.exists(at) else spark.createDataFrame([], COUNTS)


def _fresh(spark: SparkSession, appended: DataFrame, folder: str | None) -> DataFrame:
    """Appended counts of landed files that the snapshot doesn't know, each once."""
    rows = appended.join(_snapshot(spark, folder, "landed"), "landed", "left_anti")
    return rows.groupBy("landed", *KEYS).agg(F.max("n").alias("n"))


def _together(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.groupBy(*keys).agg(F.sum("n").alias("n"))).groupBy(*keys).agg(F.sum("n").alias("n"))


def compact(spark: SparkSession, target: str) -> None:
    """Folds what was appended into a new snapshot. One process at a time does so: the
    one that appends."""
    old, appended = current(spark, target), _appended(spark, target)
    taken = appended.inputFiles()
    if not taken:
        return
    fresh, name = _fresh(spark, appended, old), f"snapshot-{uuid.uuid4().hex}"
    _together(_snapshot(spark, old, "files"), fresh, ["file", "lane"]).write.parquet(f"{target}/{name}/files")
    _together(_snapshot(spark, old, "barcodes"), fresh, ["lane", "barcode"]).write.parquet(f"{target}/{name}/barcodes")
    _snapshot(spark, old, "landed").union(fresh.select("landed").distinct()).write.parquet(f"{target}/{name}/landed")
    _point(spark, target, name)
    _drop(spark, target, taken, {old, f"{target}/{name}"})


def _drop(spark: SparkSession, target: str, taken: list[str], kept: set) -> None:
    """Deletes appended files, and all snapshots but the current one and the one before
    it, which may still be read."""
    for file in taken:
        fs, at = _path(spark, file)
        fs.delete(at, True)
    fs, at = _path(spark, target)
    names = {x.rpartition("/")[2] for x in kept if x}
    for status in fs.listStatus(at):
        if status.getPath().getName().startswith("snapshot-") and status.getPath().getName() not in names:
            fs.delete(status.getPath(), True)


def _counted(spark: SparkSession, target: str, part: str, keys: list[str]) -> DataFrame:
    folder = current(spark, target)
    return _together(_snapshot(spark, folder, part), _fresh(spark, _appended(spark, target), folder), keys)


def counted(spark: SparkSession, target: str) -> DataFrame:
    """Reads so far by file and lane: the snapshot and what came since."""
    return _counted(spark, target, "files", ["file", "lane"]).withColumnRenamed("n", "n_reads")


def counted_barcodes(spark: SparkSession, target: str) -> DataFrame:
    """Barcodes so far, by lane."""
    return _counted(spark, target, "barcodes", ["lane", "barcode"])
