"""Sequence lengths, masking, base qualities and series for plots.

Each is a histogram first; quantiles are places in it, so rows are counted once
and then only lengths or scores are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import barcodes as B
from ..sources.shared import checked_broadcast


def length_histogram(reads: DataFrame, by=("file",)) -> DataFrame:
    s = F.col("sequence")
    return reads.groupBy(*by, F.length(s).alias("length")).agg(
        F.count("*").alias("n"), F.count(F.when(B.is_masked(s), 1)).alias("n_masked"), F.count(F.when(B.is_padded(s), 1)).alias("n_padded")
    )


def value_at(histogram: DataFrame, by, value: str, n: str, place: Column, name: str, inclusive: bool) -> DataFrame:
    """The least value whose running count reaches `place` (inclusive), or holds
    the 0-based place (not inclusive). `place` may refer to `_total`."""
    running = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = histogram.withColumns({"_cum": F.sum(n).over(running), "_total": F.sum(n).over(Window.partitionBy(*by))})
    reached = F.col("_cum") >= place if inclusive else F.col("_cum") > place
    return rows.groupBy(*by).agg(F.min(F.when(reached, F.col(value))).alias(name))


def length_stats(reads: DataFrame, by=("file",)) -> DataFrame:
    h = length_histogram(reads, by)
    running = Window.partitionBy(*by).orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumns({"_cum": F.sum("n").over(running), "_total": F.sum("n").over(Window.partitionBy(*by))})
    middle = F.floor(F.col("_total") / 2)
    out = h.groupBy(*by).agg(
        F.sum("n").alias("n_reads"), F.sum("n_masked").alias("n_masked"), F.sum("n_padded").alias("n_padded"),
        F.min("length").alias("min_length"), F.max("length").alias("max_length"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean_length"),
        F.min(F.when(F.col("_cum") >= middle, F.col("length"))).alias("median_length"),
    )
    return out.withColumns({f"frac_{k}": B.percent(F.col(f"n_{k}"), F.col("n_reads")) for k in ("masked", "padded")})


def length_records(reads: DataFrame, by: str = "file") -> DataFrame:
    """One row for each file, as its JSON record has it: statistics and the three
    distributions, whose keys are texts there."""
    names = {"n_reads": "nreads", "n_masked": "nreads_masked", "n_padded": "nreads_padded", "frac_masked": "frac_reads_masked", "frac_padded": "frac_reads_padded"}
    stats = length_stats(reads, (by,)).withColumnsRenamed({by: "fastq", **names})
    entry = lambda n: F.map_from_entries(F.collect_list(F.when(F.col(n) > 0, F.struct(F.col("length").cast("string").alias("k"), F.col(n).alias("v")))))
    dists = {"seq_lengths_dist": "n", "seq_lengths_masked_dist": "n_masked", "seq_lengths_padded_dist": "n_padded"}
    maps = length_histogram(reads, (by,)).groupBy(F.col(by).alias("fastq")).agg(*[entry(n).alias(d) for d, n in dists.items()])
    return stats.join(maps, "fastq")


def collated(stats: DataFrame, file: str = "file") -> DataFrame:
    """The columns of the collated table, ordered by file."""
    names = {"min_length": "min", "max_length": "max", "mean_length": "mean", "n_reads": "nreads", "n_masked": "masked", "n_padded": "padded", "frac_masked": "masked_frac", "frac_padded": "padded_frac"}
    return stats.select(F.col(file).alias("fastq"), *[F.col(k).alias(v) for k, v in names.items()]).orderBy("fastq")


def write_collated(table: DataFrame, path: str) -> None:
    """Tab-separated, with a header: a line for each file, so one part is enough."""
    table.coalesce(1).sortWithinPartitions("fastq").write.option("sep", "\t").option("header", True).csv(path)


def length_ranges(reads: DataFrame, by: str) -> DataFrame:
    """Least and greatest length for each kind of read, and over all (null)."""
    return reads.rollup(by).agg(F.min(F.length("sequence")).alias("min_length"), F.max(F.length("sequence")).alias("max_length"), F.count("*").alias("n_reads"))


SCORES = 128


def quality_histogram(reads: DataFrame, by=("file",)) -> DataFrame:
    """by, position (from 1), score, n. A batch of reads is counted at once, so no row
    is made for a base, and a task sends on its sums only."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, part in b.groupby(list(by), dropna=False):
                sizes = part["quality"].str.len().to_numpy()
                scores = np.frombuffer("".join(part["quality"]).encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33
                place = np.arange(len(scores)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                n = np.bincount(place * SCORES + scores.clip(0, SCORES - 1))
                at = np.flatnonzero(n)
                out = pd.DataFrame({"position": at // SCORES + 1, "score": at % SCORES, "n": n[at]})
                for name, value in zip(by, key, strict=True):
                    out.insert(0, name, None if pd.isna(value) else value)
                yield out

    rows = reads.select(*by, "quality").filter(F.length("quality") > 0)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    parts = rows.mapInPandas(count, f"{kinds}, position int, score int, n long")
    return parts.groupBy(*by, "position", "score").agg(F.sum("n").alias("n"))


def quality_stats(reads: DataFrame, by=("file",)) -> DataFrame:
    """Mean and quantiles of the scores at each position: the values at the 0-based
    places n//2, half of that, both together, n//10 and n - n//10 (n - 1 at most)."""
    keys = [*by, "position"]
    running = Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    h = quality_histogram(reads, by).withColumns({"_cum": F.sum("n").over(running), "_t": F.sum("n").over(Window.partitionBy(*keys))})
    half, tenth = F.floor(F.col("_t") / 2), F.floor(F.col("_t") / 10)
    quarter = F.floor(half / 2)
    last = F.col("_t") - 1
    places = {"median": half, "q25": quarter, "q75": half + quarter, "p10": tenth, "p90": F.col("_t") - tenth}
    at = lambda p: F.min(F.when(F.col("_cum") > F.least(p, last), F.col("score")))
    return h.groupBy(*keys).agg((F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean"), *[at(p).alias(k) for k, p in places.items()])


def _with_top(series: DataFrame, of: str) -> DataFrame:
    """With the greatest value of each series: one small row for each, found by
    partial aggregates and brought to the rows, which stay where they are."""
    tops = series.groupBy(F.col("series").alias("_s")).agg(F.max(of).alias("_top"))
    return series.join(checked_broadcast(tops), F.col("series").eqNullSafe(F.col("_s")), "left").drop("_s")


def rebinned(series: DataFrame, width: int) -> DataFrame:
    """series, x, y -> mean, least and greatest y in `width` bins, to the nearest
    integer with halves up; as it is if x doesn't go beyond the width."""
    place = F.when(F.col("_top") > width, F.floor(F.col("x").cast("double") / F.col("_top") * (width - 1) + 0.5)).otherwise(F.col("x"))
    rows = _with_top(series, "x").withColumn("bin", place.cast("long"))
    return rows.groupBy("series", "bin").agg(F.avg("y").alias("mean_y"), F.min("y").alias("min_y"), F.max("y").alias("max_y"))


def rescaled(series: DataFrame, height: float) -> DataFrame:
    return _with_top(series, "y").withColumn("scaled", F.when(F.col("_top") > height, F.col("y") / F.col("_top") * height).otherwise(F.col("y"))).drop("_top")


def stacked(rows: DataFrame, by: str, order: str, value: str, length: int) -> DataFrame:
    """Segments of a bar of the given length: where each begins and ends."""
    running = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(value).over(Window.partitionBy(by))
    end = F.sum(value).over(running) / total * length
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.col(value) / total * length)
