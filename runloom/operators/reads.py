"""Operators on read tables: trimming and concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import checked_broadcast


def trimmed(reads: DataFrame, ranges: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Reads of the read numbers in `ranges` (read_number, first, last: bases from 1,
    both included) are cut to them; other reads are kept as they are. With `samples`
    (project, sample), as of `registry.biological_samples`, only reads of those stay."""
    if samples is not None:
        reads = reads.join(checked_broadcast(samples.select("project", "sample").distinct()), ["project", "sample"], "left_semi")
    given = checked_broadcast(ranges.select("read_number", F.col("first").alias("_first"), F.col("last").alias("_last")))
    found = reads.join(given, "read_number", "left")
    cut = lambda c: F.when(F.col("_first").isNull(), F.col(c)).otherwise(F.substring(F.col(c), F.col("_first"), F.col("_last") - F.col("_first") + 1))
    return found.withColumns({c: cut(c) for c in ("sequence", "quality")}).select(*reads.columns)


def concatenated(*tables: DataFrame) -> DataFrame:
    """Read sets one after the other; a lane column is dropped, as of merged lanes."""
    return reduce(DataFrame.unionByName, [t.drop("lane") for t in tables])
