"""FASTQ text as a sink: `df.write.format("fastq_files")` of name, header, sequence and
quality.

A task writes the reads of each name to a file of its own attempt; rows come in the
order in which they are to be written. When all tasks are done the files that count
get their places: `<name>_001.fastq.gz`, `_002`, in the order of the tasks, so that
those of a name, one after the other, are its reads in order. Files of lost or repeated
attempts are never named. Each is a gzip member of its own, or more, and gzip files may
be joined end to end. A file `_SUCCESS` says that all are there.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .shared import opened

COLUMNS = ("name", "header", "sequence", "quality")


@dataclass
class Written(WriterCommitMessage):
    """The files of a task: number, name, place."""

    files: list[tuple[int, int, str, str]]


class FastqWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.packed = options["path"].rstrip("/"), options.get("compression", "gzip") == "gzip"
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def _text(self, batch: pa.RecordBatch) -> bytes:
        large, sign = pa.large_string(), lambda x: pa.scalar(x, pa.large_string())
        header, sequence, quality = (batch.column(c).cast(large) for c in COLUMNS[1:])
        lines = pc.binary_join_element_wise(header, sequence, sign("+"), quality, sign("\n"))
        return "\n".join([*lines.to_pylist(), ""]).encode()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task, written, last, out = TaskContext.get(), [], None, None
        fs, folder = opened(f"{self.temporary}/{task.partitionId()}-{task.taskAttemptId()}")
        fs.create_dir(folder, recursive=True)
        try:
            for batch in iterator:
                names = batch.column("name").to_pylist()
                at = 0
                while at < len(names):
                    end = at
                    while end < len(names) and names[end] == names[at]:
                        end += 1
                    if names[at] != last or out is None:
                        if out is not None:
                            out.close()
                        last, place = names[at], f"{folder}/{len(written)}"
                        stream = fs.open_output_stream(place, compression=None)
                        out = gzip.GzipFile(fileobj=stream, mode="wb", compresslevel=4, mtime=0) if self.packed else stream
                        out = _Both(out, stream)
                        written.append((task.partitionId(), len(written), last, place))
                    out.write(self._text(batch.slice(at, end - at)))
                    at = end
        finally:
            if out is not None:
                out.close()
        return Written(written)

    def commit(self, messages: list) -> None:
        fs, folder = opened(self.path)
        numbers: dict[str, int] = {}
        for _, _, name, place in sorted(f for m in messages if m is not None for f in m.files):
            numbers[name] = numbers.get(name, 0) + 1
            fs.move(place, f"{folder}/{name}_{numbers[name]:03d}.fastq{'.gz' if self.packed else ''}")
        self.abort(messages)
        fs.create_dir(folder, recursive=True)
        fs.open_output_stream(f"{folder}/_SUCCESS").close()

    def abort(self, messages: list) -> None:
        fs, place = opened(self.temporary)
        fs.create_dir(place, recursive=True)  # there is none where no task had a row
        fs.delete_dir(place)


class _Both:
    """A stream, and the one below it that it doesn't close itself."""

    def __init__(self, upper, lower):
        self.write, self.streams = upper.write, (upper, lower)

    def close(self) -> None:
        for s in dict.fromkeys(self.streams):
            s.close()


class FastqFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_files"

    def writer(self, schema, overwrite: bool) -> FastqWriter:
        if not set(COLUMNS) <= {f.name for f in schema.fields}:
            raise ValueError(f"reads need the columns {', '.join(COLUMNS)}")
        return FastqWriter(dict(self.options))
