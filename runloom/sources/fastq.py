"""FASTQ files: reading, counting, checking, sums, inventory and the demultiplexed sink.

Spark lists the files without their contents; they are read in pieces (`pieces`), so
that a large file is no task's alone, in Arrow batches. What a task holds does not grow
with a file's size. Records are never looked for by `@`, which quality lines may start
with, too. Where tasks can't open a path (a store that only Spark's readers know),
contents come as `binaryFile` rows, of 2 GB at most. Land the reads as Parquet once and
work from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import illumina_attrs
from . import pieces as P
from .shared import checked_broadcast, cut

READS = "file string, read_idx long, header string, sequence string, quality string"


def header_parts(header: Column) -> dict[str, Column]:
    """Lane, number in the pair, barcode and the key that pairs share."""
    form = r"^@[^: ]*:[^: ]*:[^: ]*:([0-9]+):[^ ]*(?: ([0-9]):[^:]*:[^:]*:(.*))?$"
    part = lambda i: F.nullif(F.regexp_extract(header, form, i), F.lit(""))
    return {
        "lane": part(1).cast("int"), "read_number": part(2).cast("int"), "barcode": F.replace(part(3), F.lit("-"), F.lit("+")),
        "name_key": F.regexp_extract(header, "^@([^ ]*)", 1),
    }


def inventory(spark: SparkSession, path: str, pattern: str = "*.fastq*") -> DataFrame:
    """path, size_bytes, modified. File contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def _rows(file: str, number: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    files = pa.array([file]).take(pa.array([0] * batch.num_rows, pa.int32()))
    return pa.RecordBatch.from_arrays([files, pa.array(range(number, number + batch.num_rows), pa.int64()), *batch.columns], ["file", "read_idx", *batch.schema.names])


def _placed(files: DataFrame, piece: int | None) -> DataFrame:
    """Pieces with the number of their first line, and their line ends."""
    dealt = P.dealt(files, piece)
    counted = cut(P.with_first_lines(P.line_counts(dealt)))
    return dealt.join(checked_broadcast(counted), ["file", "no"])


def heads(spark: SparkSession, path: str, pattern: str = "*.fastq*", n: int = 1) -> DataFrame:
    """The first reads of each file. No more of a file is read than they take."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("file").to_pylist(), b.column("content"), strict=True):
                with P.source(file, content.as_py()) as raw:
                    kind, number = P.kind_of(raw.read(P.HEAD)), 0
                    raw.seek(0)
                    for batch in P.records(P.chunks(raw, kind, 0, None, P.HEAD_CHUNK), 0, n):
                        yield _rows(file, number, batch)
                        number += batch.num_rows

    files = P.files_of(spark, path, pattern)
    tasks = max(1, min(files.count(), 16 * spark.sparkContext.defaultParallelism))
    found = files.select("file", "content").repartition(tasks, "file").mapInArrow(read, READS)
    return found.withColumns(header_parts(F.col("header")))


def read_fastq(spark: SparkSession, path: str, pattern: str = "*.fastq*", limit: int | None = None, piece: int | None = None) -> DataFrame:
    """The reads of all files; with `limit`, the first of each file. `piece` is how many
    bytes of a file a task reads at least."""
    if limit is not None:
        return heads(spark, path, pattern, limit)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.to_pylist():
                if p["error"]:
                    raise ValueError(p["error"])
                for number, batch in P.read_piece(p):
                    yield _rows(p["file"], number, batch)

    found = _placed(P.files_of(spark, path, pattern), piece).mapInArrow(read, READS)
    return found.withColumns(header_parts(F.col("header")))


def count_reads(spark: SparkSession, path: str, pattern: str = "*.fastq*", piece: int | None = None) -> DataFrame:
    """file, n_reads, whole (false where lines don't make up records): line ends are
    counted, in pieces, and nothing is parsed."""
    counted = P.with_first_lines(P.line_counts(P.dealt(P.files_of(spark, path, pattern), piece)))
    # The file's last line counts without a line end, too.
    sums = counted.groupBy("file").agg(F.sum("n_lines").alias("n"), F.max_by("open", "no").cast("int").alias("open"), F.min("error").alias("error"))
    lines = F.col("n") + F.col("open")
    return sums.select("file", F.floor(lines / 4).alias("n_reads"), (F.col("error").isNull() & (lines % 4 == 0)).alias("whole"))


def check_fastq(spark: SparkSession, path: str, pattern: str = "*.fastq*", index_reads: bool = False, piece: int | None = None) -> DataFrame:
    """file, ok, error (the first): whether all of a file can be read. Files of index
    reads, by their names, are left out unless asked for. Spark lists no files without
    a single byte."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.to_pylist():
                error = p["error"]
                try:
                    for _ in () if error else P.read_piece(p):
                        pass
                except P.ERRORS as e:
                    error = str(e) or type(e).__name__
                yield pa.RecordBatch.from_pylist([{"file": p["file"], "no": p["no"], "error": error}], pa.schema([("file", pa.string()), ("no", pa.int64()), ("error", pa.string())]))

    files = P.files_of(spark, path, pattern)
    if not index_reads:
        files = files.filter(~illumina_attrs(F.col("file"))["is_index_read"])
    found = _placed(files, piece).mapInArrow(check, "file string, no long, error string")
    first = F.min_by("error", F.when(F.col("error").isNotNull(), F.col("no")))
    return found.groupBy("file").agg(first.alias("error")).select("file", F.col("error").isNull().alias("ok"), "error")


def checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, md5: summed up chunk by chunk."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["file"], b["content"], strict=True):
                total = hashlib.md5(usedforsecurity=False)
                with P.source(file, content) as raw:
                    while chunk := raw.read(P.CHUNK):
                        total.update(chunk)
                yield pd.DataFrame({"file": [file], "md5": [total.hexdigest()]})

    files = P.files_of(spark, path, pattern).select("file", "content")
    return files.repartition(max(1, min(files.count(), 16 * spark.sparkContext.defaultParallelism)), "file").mapInPandas(digest, "file string, md5 string")


def joined_checksums(spark: SparkSession, path: str, pattern: str, name: Column) -> DataFrame:
    """name, md5 of the texts of a name's files (a column of `file`), unpacked, one after
    the other in the order of their numbers: summed up chunk by chunk, nothing is held."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        row = lambda: pa.RecordBatch.from_pydict({"name": [last], "md5": [total.hexdigest()]})
        for b in batches:
            for named, file, content in zip(b.column("name").to_pylist(), b.column("file").to_pylist(), b.column("content"), strict=True):
                if total is not None and named != last:
                    yield row()
                if total is None or named != last:
                    last, total = named, hashlib.md5(usedforsecurity=False)
                with P.source(file, content.as_py()) as raw:
                    kind = P.PLAIN if P.kind_of(raw.read(P.HEAD)) == P.PLAIN else P.GZIP
                    raw.seek(0)
                    for data, _ in P.chunks(raw, kind, 0, None):
                        total.update(data)
        if total is not None:
            yield row()

    files = P.files_of(spark, path, pattern).select(name.alias("name"), "file", "content")
    names = files.select("name").distinct().count()
    dealt = files.repartition(max(1, min(names, 16 * spark.sparkContext.defaultParallelism)), "name")
    return dealt.sortWithinPartitions("name", F.length("file"), "file").mapInArrow(digest, "name string, md5 string")


def first_read_numbers(reads: DataFrame) -> DataFrame:
    """The read number in each file's first header."""
    return reads.groupBy("file").agg(F.min_by("read_number", "read_idx").alias("read_number"))


def as_text(reads: DataFrame, *keep: str) -> DataFrame:
    """FASTQ text of reads with header, sequence and quality: column `value`."""
    return reads.select(*keep, F.concat_ws("\n", "header", "sequence", F.lit("+"), "quality").alias("value"))


def write_split(reads: DataFrame, path: str, keys: list[str], order: list[str] | None = None, spread: int = 32, rows_a_file: int = 5_000_000) -> None:
    """Parquet with a folder for each value of `keys`. Reads are dealt out by the keys
    and a hash of the read, so that a value with many reads, as `undetermined` has, is
    written by `spread` tasks, in files of a bounded size, each in order."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in reads.columns]), F.lit(spread))
    dealt = reads.withColumn("_part", part).repartition(*keys, "_part").drop("_part")
    dealt.sortWithinPartitions(*keys, *(order or [])).write.option("maxRecordsPerFile", rows_a_file).partitionBy(*keys).parquet(path)


def write_demultiplexed(assigned: DataFrame, path: str, **options) -> None:
    """A folder for each assigned barcode and read number; reads in their order."""
    order = [c for c in ("file", "read_idx") if c in assigned.columns]
    write_split(assigned, path, ["assigned", "read_number"], order, **options)


def write_fastq(reads: DataFrame, path: str, name: Column, order: list[str] | None = None, packed: bool = True) -> None:
    """FASTQ files `<name>_001.fastq.gz`, … in the folder `path`. Reads are dealt out by
    ranges of name and order (file and place, if nothing else is said), so that a name
    with many reads is written by many tasks, and its files, one after the other,
    are its reads in order."""
    from .fastq_sink import FastqFiles

    reads.sparkSession.dataSource.register(FastqFiles)
    order = [c for c in ("file", "read_idx") if c in reads.columns] if order is None else order
    text = ("header", "sequence", "quality")  # shuffled once, also where the order has them
    by = [c if c in text else f"_o{i}" for i, c in enumerate(order)]
    rows = reads.select(name.alias("name"), *text, *[F.col(c).alias(n) for c, n in zip(order, by, strict=True) if c not in text])
    dealt = rows.repartitionByRange("name", *by).sortWithinPartitions("name", *by).select("name", *text)
    dealt.write.format("fastq_files").mode("append").option("path", path).option("compression", "gzip" if packed else "none").save()


def write_demultiplexed_fastq(assigned: DataFrame, path: str, **options) -> None:
    """A set of files for each assigned barcode and read number."""
    name = F.concat_ws("_", F.replace("assigned", F.lit("+"), F.lit("-")), F.concat(F.lit("R"), F.col("read_number").cast("string")))
    write_fastq(assigned, path, name, **options)
