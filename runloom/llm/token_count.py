"""Token counts by scanning flat token files for end-of-document identifiers.

A token file is a run of unsigned ids with an end id after each document, and no
index. Files are listed by Spark and cut into blocks of a fixed number of ids; a
task reads its blocks by range, so a file of any size is read by many tasks, in
bounded memory. Each block is searched by numpy for end ids on its own; what
crosses blocks is stitched by a prefix scan over the blocks' short summaries:
documents ended before, tokens before, and the place of the last end before. The
scan has two steps, inside runs of blocks and over the runs of a file, so that one
large file is no task's alone.

`count_tokens` writes the files itself, one for each task's attempt, and lists them
in a table that Spark commits: only files of attempts that count are read. Files
are opened by pyarrow, which reaches local and mounted folders, HDFS, S3 and GCS.

Defined results: a null or empty text has 0 tokens; a special token's string in a
text is plain text, which leaves the end id free; very long texts span blocks;
repeated rows, equal and null ids are documents of their own; ids after the last
end of a file are a document that is not closed; empty files and tables give an
empty result; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import checked_broadcast, cut, given_id, id_of, shared_folder, text_of

END, BLOCK, RUN, TASK_BYTES = 50_256, 1 << 18, 1_024, 1 << 25
WRITTEN = "path string, doc_no long, doc_id long"


def opened(path: str):
    """pyarrow's file system for a path of Spark's, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def write_token_files(docs: DataFrame, path: str) -> DataFrame:
    """Writes one flat file of unsigned 16-bit ids for each task to the folder
    `path`, and beside them a table of path, doc_no and doc_id: the documents in the
    order written. It says nothing of lengths or places."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        file, written, end = f"{path}/ids-{task.partitionId()}-{task.taskAttemptId()}.bin", 0, np.array([END], "<u2")
        fs, place = opened(file)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(place) as out:
            for b in batches:
                for text in b["text"]:
                    out.write(np.append(tokens.encode(text, plain=True).astype("<u2"), end).tobytes())
                yield pd.DataFrame({"path": file, "doc_no": written + np.arange(len(b)), "doc_id": b["doc_id"]})
                written += len(b)

    rows = docs.select(id_of(), text_of().alias("text")).mapInPandas(write, WRITTEN)
    rows.write.parquet(f"{path}-list")
    return docs.sparkSession.read.schema(WRITTEN).parquet(f"{path}-list")


def flat_blocks(spark: SparkSession, files: DataFrame, block: int = BLOCK, dtype: str = "<u2") -> DataFrame:
    """path, length (in bytes) of flat files -> file_id, path, no, ids (bytes): their
    blocks, read by range. `listed(spark, folder)` gives the files of a folder."""
    step = block * np.dtype(dtype).itemsize

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, rows in b.groupby("path"):
                fs, place = opened(path)
                with fs.open_input_file(place) as f:
                    for no in rows["no"].tolist():
                        yield pd.DataFrame({"file_id": rows["file_id"].iloc[:1], "path": path, "no": no, "ids": [f.read_at(step, no * step)]})

    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("length") / step) - 1))
    starts = files.filter("length > 0").select(F.xxhash64("path").alias("file_id"), "path", numbers.alias("no"))
    tasks = max(1, -(-(starts.count() * step) // TASK_BYTES))
    return starts.repartition(tasks, "file_id", "no").mapInPandas(read, "file_id long, path string, no long, ids binary")


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path, length of the files in a folder. Contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def prefixes(narrow: DataFrame, run: int = RUN) -> DataFrame:
    """file_id, no, size, n_ends, last_end (null: none) of blocks -> file_id, no, and
    before the block: base (ids), ended (documents), open (where the document that
    it begins in begins)."""
    rows = narrow.withColumn("run", F.floor(F.col("no") / run))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda x, w: F.coalesce(F.sum(x).over(w), F.lit(0))
    inside = before("file_id", "run").orderBy("no")
    rows = rows.withColumns({"_base": so_far("size", inside), "_ended": so_far("n_ends", inside)})
    rows = rows.withColumn("_last", F.max(F.col("_base") + F.col("last_end")).over(inside))
    runs = rows.groupBy("file_id", "run").agg(
        F.sum("size").alias("size"), F.sum("n_ends").alias("n"), F.max(F.col("_base") + F.col("last_end")).alias("last")
    )
    over = before("file_id").orderBy("run")
    runs = runs.withColumns({"_rbase": so_far("size", over), "_rended": so_far("n", over)})
    runs = runs.withColumn("_rlast", F.max(F.col("_rbase") + F.col("last")).over(over)).select("file_id", "run", "_rbase", "_rended", "_rlast")
    last = F.greatest(F.col("_rbase") + F.col("_last"), F.col("_rlast"))
    return rows.join(runs, ["file_id", "run"]).select(
        "file_id", "no", (F.col("_rbase") + F.col("_base")).alias("base"), (F.col("_rended") + F.col("_ended")).alias("ended"),
        F.coalesce(last + 1, F.lit(0)).alias("open"),
    )


def scan(blocks: DataFrame, end: int = END, dtype: str = "<u2", run: int = RUN) -> DataFrame:
    """file_id, no, ids of flat files -> file_id, doc_no (from 0), start (in ids of
    the file), n_tokens, closed."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [np.frombuffer(x, dtype) for x in b["ids"]]
            yield pd.DataFrame({"file_id": b["file_id"], "no": b["no"], "size": [len(x) for x in found], "ends": [np.flatnonzero(x == end) for x in found]})

    summary = cut(blocks.select("file_id", "no", "ids").mapInPandas(search, "file_id long, no long, size long, ends array<long>"))
    narrow = summary.select("file_id", "no", "size", F.size("ends").alias("n_ends"), F.try_element_at("ends", F.lit(-1)).alias("last_end"))
    placed = summary.join(checked_broadcast(cut(prefixes(narrow, run))), ["file_id", "no"])
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + 1)
    closed = placed.select("file_id", "base", "ended", "open", F.posexplode("ends").alias("i", "at"), "ends").select(
        "file_id", (F.col("ended") + F.col("i")).cast("long").alias("doc_no"), start.alias("start"),
        (F.col("base") + F.col("at") - start).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    # What follows the last end of a file: of its last block, all that is behind it.
    n = F.size("ends")
    tail_start = F.when(n > 0, F.col("base") + F.try_element_at("ends", F.lit(-1)) + 1).otherwise(F.col("open"))
    ending = placed.select("file_id", "no", (F.col("ended") + n).cast("long").alias("doc_no"), tail_start.alias("start"), (F.col("base") + F.col("size")).alias("stop"))
    lasts = ending.groupBy("file_id").agg(F.max_by(F.struct("doc_no", "start", "stop"), "no").alias("x"))
    tails = lasts.select("file_id", "x.doc_no", "x.start", F.expr("x.stop - x.start AS n_tokens"), F.lit(False).alias("closed")).filter("n_tokens > 0")
    return closed.unionByName(tails)


def count_tokens(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, file_id, start, n_tokens of each row, from flat files of its tokens."""
    spark, folder = docs.sparkSession, shared_folder(docs, "tokens")
    names = write_token_files(docs, folder).withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    if names.isEmpty():
        return names.select(given_id(), F.lit(0).cast("long").alias("file_id"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"))
    files = listed(spark, folder).withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    files = files.join(checked_broadcast(cut(names.select("path").distinct())), "path", "left_semi")
    found = scan(flat_blocks(spark, files, block)).filter("closed")
    names = names.select(F.xxhash64("path").alias("file_id"), "doc_no", given_id())
    return names.join(found, ["file_id", "doc_no"]).select("doc_id", "file_id", "start", "n_tokens")
