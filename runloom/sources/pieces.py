"""FASTQ files in pieces, so that many tasks read one file.

A plain file is cut into byte ranges wherever they fall. A blocked gzip file (BGZF:
members of 64 KB at most, each of which says its compressed size) is cut likewise; a
piece has the members that begin in its range, the first of which is found by its
header and told from chance by the header that has to follow it; where a piece's
members end, the next one's have to begin. Any other gzip file is one piece, streamed.

Pieces are read twice. First their line ends are counted, nothing is parsed; a prefix
scan over a file's pieces gives the number of each piece's first line, and with it,
modulo 4, where records begin. A record belongs to the piece in which the line end
before it lies. Then records are cut out of the bytes by numpy and Arrow, all lines
of a chunk at once; a piece reads on behind its end until its last record is whole.
So rows are the same however a file is cut.
"""

from __future__ import annotations

import gzip
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import opened, reachable

PLAIN, BLOCKED, GZIP = 0, 1, 2
#: Bytes of a piece, and at least, bytes that are read at once, rows in a batch.
PIECE, LEAST, CHUNK, BATCH = 1 << 25, 1 << 21, 1 << 22, 1 << 16
#: Bytes of a file's beginning that are read at once.
HEAD_CHUNK = 1 << 16
#: A member's first 16 bytes, but for time, system and the 2 bytes before the mark of the size.
MEMBER = (b"\x1f\x8b\x08\x04", b"\x06\x00BC\x02\x00")
HEAD = 18

PIECES = "file string, kind int, no long, start long, stop long, content binary"
COUNTED = "file string, no long, n_lines long, open boolean, first long, after long, error string"
ERRORS = (ValueError, EOFError, OSError, zlib.error)


def _member_size(head: bytes) -> int:
    """The compressed size of the blocked member that begins here; 0 if none does."""
    known = len(head) >= HEAD and head[:4] == MEMBER[0] and head[10:16] == MEMBER[1]
    return struct.unpack("<H", head[16:18])[0] + 1 if known else 0


def source(file: str, content) -> io.BufferedIOBase:
    if content is not None:
        return io.BytesIO(content)
    fs, place = opened(file)
    return io.BufferedReader(fs.open_input_file(place), 1 << 18)


def kind_of(head: bytes) -> int:
    return BLOCKED if _member_size(head) else GZIP if head[:2] == b"\x1f\x8b" else PLAIN


def first_member(raw, start: int, stop: int) -> int | None:
    """Where the first blocked member of a range begins. What looks like one counts if
    another one, or the end of the file, follows it."""
    end = raw.seek(0, io.SEEK_END)
    while start < stop:
        raw.seek(start)
        data = raw.read(1 << 16)
        at = data.find(MEMBER[0])
        if at < 0:
            if len(data) < 4:
                return None
            start += len(data) - 3
            continue
        start += at
        raw.seek(start)
        size = _member_size(raw.read(HEAD))
        if size and start < stop:
            raw.seek(start + size)
            if start + size == end or _member_size(raw.read(HEAD)):
                return start
        start += 1
    return None


def chunks(raw, kind: int, start: int, stop: int | None, most: int | None = None, members: list | None = None) -> Iterator[tuple[bytes, bool]]:
    """Text from a piece's first byte to the end of the file, and whether it is the
    piece's own, some megabytes (or `most` bytes) at a time. Text of a blocked member is
    of the piece in which the member begins; `members` takes the places of those."""
    most = most or CHUNK
    if kind == GZIP:
        stream = gzip.GzipFile(fileobj=raw)
        while data := stream.read(most):
            yield data, True
    elif kind == PLAIN:
        raw.seek(start)
        while data := raw.read(most if stop is None or start >= stop else min(most, stop - start)):
            yield data, stop is None or start < stop
            start += len(data)
    else:
        at = first_member(raw, start, stop) if start else 0
        while at is not None:
            raw.seek(at)
            texts, size, inside = [], 0, stop is None or at < stop
            # Behind the piece's end only what its last record still needs is wanted.
            while size < (most if inside else 1) and (stop is None or (at < stop) == inside):
                head = raw.read(HEAD)
                if not head:
                    at = None
                    break
                length = _member_size(head)
                if not length:
                    raise ValueError("not a blocked gzip member")
                if members is not None and inside:
                    members += (at, at + length)
                texts.append(zlib.decompress(head + raw.read(length - HEAD), wbits=31))
                size += len(texts[-1])
                at += length
            if size:
                yield b"".join(texts), inside


def files_of(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """file, length, content: null where tasks open the file themselves."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    content = F.lit(None).cast("binary").alias("content") if reachable(path) else F.col("content")
    return files.select(F.col("path").alias("file"), "length", content)


def dealt(files: DataFrame, piece: int | None = None) -> DataFrame:
    """The pieces of files, dealt out over as many tasks as there are cores, or more where
    files are large; without a size, so that few small files have a piece for each core."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = []
            for file, content in zip(b.column("file").to_pylist(), b.column("content"), strict=True):
                with source(file, content.as_py()) as raw:
                    kinds.append(kind_of(raw.read(HEAD)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kinds, pa.int32())], [*b.schema.names, "kind"])

    n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    spark = files.sparkSession
    cores = spark.sparkContext.defaultParallelism
    piece = piece or max(LEAST, min(PIECE, size // cores))
    looked = files.repartition(max(1, min(n, cores)), "file").mapInArrow(look, "file string, length long, content binary, kind int")
    whole = (F.col("kind") == GZIP) | F.col("content").isNotNull()
    last = F.when(whole, F.lit(0)).otherwise(F.greatest(F.ceil(F.col("length") / piece) - 1, F.lit(0)))
    pieces = looked.withColumn("no", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    stop = F.when(~whole, F.least((F.col("no") + 1) * piece, F.col("length")))
    pieces = pieces.select("file", "kind", "no", (F.col("no") * piece).alias("start"), stop.cast("long").alias("stop"), "content")
    # By bytes, so that small pieces are no tasks of their own.
    return pieces.repartition(max(1, min(cores, n + size // piece), -(-size // (4 * max(piece, PIECE)))), "file", "no")


def line_counts(pieces: DataFrame) -> DataFrame:
    """file, no, n_lines (line ends), open (the last byte is none), first and after (where
    its blocked members begin and end), error of each piece."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for p in b.to_pylist():
                n, last, error, members = 0, b"\n", None, []
                try:
                    with source(p["file"], p["content"]) as raw:
                        for data, own in chunks(raw, p["kind"], p["start"], p["stop"], None, members):
                            if not own:
                                break
                            n, last = n + data.count(b"\n"), data[-1:]
                except ERRORS as e:
                    error = str(e) or type(e).__name__
                rows.append({"file": p["file"], "no": p["no"], "n_lines": n, "open": last != b"\n", "first": min(members, default=None), "after": max(members, default=None), "error": error})
            yield pa.RecordBatch.from_pylist(rows, COUNTS)

    return pieces.mapInArrow(count, COUNTED)


COUNTS = pa.schema([("file", pa.string()), ("no", pa.int64()), ("n_lines", pa.int64()), ("open", pa.bool_()), ("first", pa.int64()), ("after", pa.int64()), ("error", pa.string())])


def with_first_lines(counted: DataFrame) -> DataFrame:
    """The number of each piece's first line: a prefix scan over a file's pieces. Members
    that don't follow each other are an error."""
    before = Window.partitionBy("file").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("first") != F.coalesce(F.last("after", ignorenulls=True).over(before), F.lit(0))
    error = F.coalesce("error", F.when(gap, "not a blocked gzip member"))
    return counted.withColumns({"line": F.coalesce(F.sum("n_lines").over(before), F.lit(0)), "error": error}).drop("first", "after")


def _cut(data: bytes, lines: np.ndarray, strict: bool) -> pa.RecordBatch:
    """header, sequence and quality of records: `lines` are the places of the line ends,
    four for each."""
    if not data.isascii():
        data = data[: lines[-1] + 1].decode("utf-8", "replace").encode()
        lines = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts = np.append(0, lines + 1)
    text = pa.LargeStringArray.from_buffers(len(lines), pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data))
    header, sequence, plus, quality = (pc.ascii_rtrim(text.take(pa.array(np.arange(k, len(lines), 4))), "\r\n") for k in range(4))
    if strict:
        view = np.frombuffer(data, np.uint8)
        good = (view[starts[:-1:4]] == ord("@")) & (view[starts[2:-1:4]] == ord("+"))
        good &= pc.equal(pc.binary_length(sequence), pc.binary_length(quality)).to_numpy(zero_copy_only=False)
        if not good.all():
            raise ValueError(f"not a record: {header[int(good.argmin())].as_py()[:80]}")
    return pa.RecordBatch.from_arrays([x.cast(pa.string()) for x in (header, sequence, quality)], ["header", "sequence", "quality"])


def records(texts: Iterator[tuple[bytes, bool]], skip: int, wanted: int | None) -> Iterator[pa.RecordBatch]:
    """Records after `skip` line ends: `wanted` of them, or all. The last one wanted may
    be no record but the end of the file."""
    rest, left = b"", None if wanted is None else 4 * wanted
    for data, _ in texts:
        data = rest + data
        lines = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        if skip:
            if len(lines) < skip:
                skip, rest = skip - len(lines), b""
                continue
            data = data[lines[skip - 1] + 1 :]
            lines, skip = lines[skip:] - lines[skip - 1] - 1, 0
        n = len(lines) // 4 * 4
        n = n if left is None else min(n, left)
        at = 0
        for k in range(0, n, 4 * BATCH):
            part = lines[k : min(k + 4 * BATCH, n)]
            yield _cut(data[at : part[-1] + 1], part - at, True)
            at = int(part[-1]) + 1
        rest = data[at:]
        left = None if left is None else left - n
        if left == 0:
            return
    if skip or not rest:
        return
    # What the file ends with has no line end.
    rest = rest if rest.endswith(b"\n") else rest + b"\n"
    lines = np.flatnonzero(np.frombuffer(rest, np.uint8) == 10)
    if len(lines) % 4:
        raise ValueError("a record is cut off")
    yield _cut(rest, lines, True)


def first_record(line: int, no: int) -> int:
    """The number of the first line that begins a record of a piece."""
    return 0 if no == 0 else (line // 4 + 1) * 4


def read_piece(p: dict) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The number of the first read, and records, of a piece with `line` and `n_lines`."""
    first = first_record(p["line"], p["no"])
    wanted = (p["line"] + p["n_lines"]) // 4 - first // 4 + 1
    if wanted <= 0:
        return
    number = first // 4
    with source(p["file"], p["content"]) as raw:
        for batch in records(chunks(raw, p["kind"], p["start"], p["stop"]), first - p["line"], wanted):
            yield number, batch
            number += batch.num_rows
