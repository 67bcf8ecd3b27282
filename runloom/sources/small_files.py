"""Plain small files of a mounted folder, listed and opened by tasks.

Spark's file sources list into the driver, plan every file there, and set up a reader
for each: generated code, a status, a copy of what is configured and a line in the log,
many times what opening costs. Here a file costs a row of its path and the opening.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut

#: Rows and bytes of a batch.
BATCH, BATCH_BYTES = 1024, 1 << 25
#: Bytes that are read in the time in which a file is opened.
OPENING = 1 << 17
#: Tasks for each core that list folders.
LISTERS_A_CORE = 4
LISTED = pa.schema([("place", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())])
TEXTS = pa.schema([("file", pa.string()), ("content", pa.binary())])
#: Characters that Spark's paths don't escape; of those beyond ASCII, spaces and controls are.
ESCAPED = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]')


def folder_of(spark: SparkSession, path: str, pattern: str) -> str | None:
    """The local folder that Spark's readers would list; None where they have to do it:
    in other stores, for wildcards in a path, for patterns of more than `*` and `?`."""
    if re.search(r"[*?\[\]{}\\]", path) or re.search(r"[\[\]{}\\]", pattern):
        return None
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = files.makeQualified(at).toUri()
    place = uri.getPath()
    return place if uri.getScheme() == "file" and os.path.isdir(place) else None


def spark_path(place: str) -> str:
    """A local file's path as Spark gives it."""
    return "file:" + ESCAPED.sub(lambda m: quote(m[0], safe=""), place)


def hidden(name: str, folder: bool) -> bool:
    """Names that Spark's readers pass over, of files and of folders."""
    if folder and name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(place: str, pattern: str) -> Iterator[tuple[str, int, bool]]:
    """Folders in a folder, and its files of the pattern that are not empty."""
    with os.scandir(place) as found:
        for e in found:
            if hidden(e.name, e.is_dir()):
                continue
            if e.is_dir():
                yield e.path, 0, True
            elif fnmatchcase(e.name, pattern) and (length := e.stat().st_size):
                yield e.path, length, False


def _below(place: str, pattern: str) -> Iterator[tuple[str, int, bool]]:
    todo = [place]
    while todo:
        for entry in _entries(todo.pop(), pattern):
            if entry[2]:
                todo.append(entry[0])
            else:
                yield entry


def _batches(rows: Iterator[tuple], schema: pa.Schema, size=lambda row: 0) -> Iterator[pa.RecordBatch]:
    some, n = [], 0
    for row in rows:
        # A batch is closed before it grows too large: a column holds 2 GB at most.
        if some and (len(some) == BATCH or n + size(row) > BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema, strict=True)], schema=schema)
            some, n = [], 0
        some.append(row)
        n += size(row)
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema, strict=True)], schema=schema)


def listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """place, length of the files below a folder. One task lists what lies in the folder
    itself, the folders in it are dealt out. Listed once, to the shared folder, so that
    all that is derived has the same files."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _batches((e for place in b.column("place").to_pylist() for e in _entries(place, pattern)), LISTED)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for b in batches:
                for place, length, inside in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    yield from _below(place, pattern) if inside else [(place, length, inside)]

        return _batches(entries(), LISTED)

    root = spark.range(0, 1, 1, 1).select(F.lit(folder).alias("place"))
    columns = "place string, length long, folder boolean"
    dealt = root.mapInArrow(top, columns).repartition(LISTERS_A_CORE * spark.sparkContext.defaultParallelism)
    return cut(dealt.mapInArrow(rest, columns).select("place", "length"))


def read(files: DataFrame, tasks: int) -> DataFrame:
    """file (as Spark gives it), text of listed files, by so many tasks."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            for b in batches:
                for place in b.column("place").to_pylist():
                    with open(place, "rb") as f:
                        yield spark_path(place), f.read()

        return _batches(texts(), TEXTS, lambda row: len(row[1]))

    found = files.select("place").repartition(tasks).mapInArrow(opened, "file string, content binary")
    return found.select("file", F.col("content").cast("string").alias("text"))
