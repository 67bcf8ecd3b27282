"""Best-fit packing by hierarchical residuals.

Documents become pieces of at most `room` tokens. Each partition packs its pieces
best-fit, largest first. That leaves it one bin at most that is no more than half
full (a second one's first piece would have fitted into it), and two bins that are
more than half full never fit together. So those over half full are done, and the
half-empty ones are items of the next level of a tree: groups of `fan_in` of them are
packed best-fit, largest first, which leaves one half-empty bin a group again, until
one group is left. It also gets those nearly full bins that its items fit into; which
fills these have is told by counts of bins for each fill. So no task sees all pieces
or all bins, whatever their sizes and however many they are.

Rows keep flat columns: a bin's number, and a piece's place in it. Bins' numbers
come from step, partition and order, and rows are sorted before they are packed,
so a task that runs again gives the same bins.

Defined results: a null text counts as empty and has the end id alone; a special
token's string in a text becomes its id, as the library's plain call has it; very
long texts are cut into as many pieces as it takes; repeated rows, equal and null ids
are pieces of their own; other columns are left out; an empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import checked_broadcast, cut, given_id, id_of, text_of

ROOM, LEAF, END, FAN_IN = 2048, 50_000, 0, 4_096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, room: int = ROOM, model: str | None = None, ranks: str | None = None) -> DataFrame:
    """Token pieces of each row; only documents longer than `room` are cut, the
    first piece is then the shorter one. Null ids are told by `NO_ID`."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].tolist(), b["text"].tolist(), strict=True):
                ids = np.append(tokens.encode(text, model, ranks), np.uint32(END)).astype("<u4")
                first = len(ids) if len(ids) <= room else len(ids) % room or room
                data, start, stop, k = memoryview(ids.tobytes()), 0, first, 0
                while start < len(ids):
                    rows.append((doc, k, start, stop - start, zlib.crc32(data[4 * start : 4 * stop])))
                    start, stop, k = stop, stop + room, k + 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(id_of(), text_of().alias("text")).mapInPandas(make, PIECES)


def best_fit(sizes: np.ndarray, room: int) -> np.ndarray:
    """The bin of each size, in the order given. The open bins' residuals are bits
    of a number; the lowest bit at or above a size is the tightest fit."""
    waiting: dict[int, list[int]] = {}
    bits, bins, out = 0, 0, np.empty(len(sizes), np.int64)
    for k, size in enumerate(sizes.tolist()):
        fits = bits >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            held = waiting[left]
            bin_ = held.pop()
            if not held:
                bits ^= 1 << left
        else:
            left, bin_ = room, bins
            bins += 1
        out[k] = bin_
        if left > size:
            held = waiting.setdefault(left - size, [])
            if not held:
                bits |= 1 << (left - size)
            held.append(bin_)
    return out


def _packer(room: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        rows = rows.iloc[np.lexsort((rows["ids_crc32"], rows["piece"], rows["doc_id"]))].reset_index(drop=True)
        length = rows["length"].to_numpy()
        largest_first = np.argsort(-length, kind="stable")
        bin_ = np.empty(len(length), np.int64)
        bin_[largest_first] = best_fit(length[largest_first], room)
        order = np.argsort(bin_, kind="stable")
        rows, bin_, length = rows.iloc[order], bin_[order], length[order]
        total = np.cumsum(length) - length
        first = np.searchsorted(bin_, bin_, "left")
        base = TaskContext.get().partitionId() << 32
        yield rows.assign(bin=bin_ + base, offset=total - total[first], fill=np.bincount(bin_, weights=length).astype(np.int64)[bin_])

    return pack


def takers(fills: dict[int, int], room: int) -> dict[int, int]:
    """Numbers of bins by fill -> of those over half full, how many by fill the
    half-empty ones go into, largest first and best-fit."""
    fresh = {room - f: n for f, n in fills.items() if room // 2 < f < room}
    bits, used, need = sum(1 << left for left in fresh), Counter(), Counter()
    for size in sorted((f for f in fills if f <= room // 2), reverse=True):
        for _ in range(fills[size]):
            fits = bits >> size
            left = size + (fits & -fits).bit_length() - 1 if fits else room
            if used[left]:
                used[left] -= 1
            elif fresh.get(left):
                fresh[left] -= 1
                need[room - left] += 1
            if not used[left] and not fresh.get(left):
                bits &= ~(1 << left)
            if left > size:
                used[left - size] += 1
                bits |= 1 << (left - size)
    return dict(need)


def _merger(room: int, level: int):
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        for group, bins in pd.concat(held, ignore_index=True).groupby("group"):
            bins = bins.sort_values(["fill", "bin"], ascending=[False, True])
            fill = bins["fill"].to_numpy()
            into = best_fit(fill, room)
            order = np.argsort(into, kind="stable")
            into, fill = into[order], fill[order]
            total, full = np.cumsum(fill) - fill, np.bincount(into, weights=fill).astype(np.int64)
            first = np.searchsorted(into, into, "left")
            # A merged bin is known by its first member: a bin is in one merge of a level at most.
            yield pd.DataFrame({"bin": bins["bin"].to_numpy()[order], "into": bins["bin"].to_numpy()[order][first], "base": total - total[first], "fill": full[into]})

    return merge


def merges(packed: DataFrame, room: int, fan_in: int = FAN_IN) -> DataFrame:
    """bin, into, base: the bins that are merged, and where their rows begin."""
    bins = cut(packed.filter("offset = 0").select("bin", "fill"))  # a piece has one token at least
    half = F.col("fill") <= room // 2
    open_, moved, level = bins.filter(half), None, 0
    while True:
        groups = -(-open_.count() // fan_in)
        if groups <= 1:
            break
        grouped = open_.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)))
        here = cut(grouped.repartition(groups, "group").mapInPandas(_merger(room, level), "bin long, into long, base long, fill long"))
        moved = _then(moved, here)
        open_ = here.filter(half & (F.col("bin") == F.col("into"))).select("bin", "fill")
        level += 1
    need = takers({r["fill"]: r["count"] for r in bins.filter(~half).groupBy("fill").count().collect()} | {r["fill"]: r["count"] for r in open_.groupBy("fill").count().collect()}, room)
    if need:
        wanted = F.broadcast(packed.sparkSession.createDataFrame(sorted(need.items()), "fill long, n long"))
        rank = F.row_number().over(Window.partitionBy("fill").orderBy("bin"))
        taken = bins.filter(~half).join(wanted, "fill").withColumn("rank", rank).filter((F.col("rank") <= max(need.values())) & (F.col("rank") <= F.col("n")))
        open_ = open_.unionByName(taken.select("bin", "fill"))
    last = open_.withColumn("group", F.lit(0)).repartition(1, "group").mapInPandas(_merger(room, level), "bin long, into long, base long, fill long")
    return _then(moved, cut(last)).select("bin", "into", "base")


def _then(moved: DataFrame | None, here: DataFrame) -> DataFrame:
    """What the levels so far have moved, followed by another level."""
    if moved is None:
        return here
    next_ = here.select(F.col("bin").alias("into"), F.col("into").alias("_into"), F.col("base").alias("_base"))
    on = moved.join(next_, "into", "left").select("bin", F.coalesce("_into", "into").alias("into"), (F.col("base") + F.coalesce("_base", F.lit(0))).alias("base"))
    return cut(on.unionByName(here.join(moved, "bin", "left_anti").select("bin", "into", "base")))


def pack(items: DataFrame, room: int = ROOM, leaf: int = LEAF, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset. `items` should be cut."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"]
    full = items.filter(F.col("length") == room).select(
        "*", (F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62))).alias("bin"), F.lit(0).cast("long").alias("offset")
    )
    todo = items.filter(F.col("length") < room)
    parts = max(1, -(-todo.count() // leaf))
    packed = todo.repartition(parts, "doc_id", "piece").mapInPandas(_packer(room), f"{PIECES}, bin long, offset long, fill long")
    packed = cut(packed.select(*columns, "fill"))
    if parts > 1:
        moved = checked_broadcast(cut(merges(packed, room, fan_in)))
        packed = packed.join(moved, "bin", "left").withColumns(
            {"offset": F.col("offset") + F.coalesce("base", F.lit(0)), "bin": F.coalesce("into", "bin")}
        )
    out = full.select(columns).unionByName(packed.select(columns))
    return out.withColumns({"doc_id": given_id()}).withColumnRenamed("bin", "sequence_id")


def pack_documents(docs: DataFrame, room: int = ROOM, **options) -> DataFrame:
    return pack(cut(pieces(docs, room)), room, **options)
