"""Word sequences that repeat: fixed-block anchors, probed by every rolling window.

Of a document's words the non-overlapping blocks of (window + 1) // 2 words are the
reference blocks: any window holds one of its own document's. The index holds their
hashes; every rolling window of a block's size, of every document, probes it. A
block that no other place holds can't be in a repeated window. A window around a
block that was hit is a candidate; its hash over all its words is looked up among
the candidates of the others. Runs of repeated windows are the maximal exact
repeats, so a group of copies is never taken apart into pairs.

Texts are written to the shared folder once. Index, probes and candidates are
exchanged as sorted numbers, one array for each file and range of hashes, in which
each hash stands once and says whether it has several places: a passage that all
documents hold is one number in each file's array. Answers are written by file, and
tasks open those of the file at hand. A range's task holds as many numbers as
`RANGE_BYTES` of text have words.

Block hashes have 32 bits besides their range's, for a false hit costs a candidate
only. Windows are told apart by 64 bits and their range's, which are other bits.

Defined results: a null or blank text has no words; a text of fewer words than a
window loses none; of equal rows every window repeats, so all words go; a window may
overlap its own copy in one text; ids, null and repeated ones too, are handed on and
never compared; a very long text is hashed in stretches, but its words' hashes have
to fit a task; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_id, id_of, shared_folder, text_of
from .token_count import opened

WINDOW = 35
#: Bytes of text that are hashed at once, that a range of hashes stands for, words that a task collects before it hands on.
STRETCH, CHUNK_BYTES, RANGE_BYTES, COLLECTED = 1 << 20, 1 << 22, 1 << 22, 1 << 21
#: Odd multipliers of two independent hashes.
FIRST, SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@cache
def _powers(multiplier: int, n: int) -> np.ndarray:
    found = np.full(n, multiplier, np.uint64)
    found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts: where each text's begin, and hashes of them."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        space = SPACES[self.data]
        self.starts = np.flatnonzero(~space & np.append(True, space[:-1]))
        self.ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
        borders = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.bounds = np.searchsorted(self.starts, borders)
        self.sizes = np.diff(self.bounds)
        self.place = np.arange(len(self.starts)) - np.repeat(self.bounds[:-1], self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.place

    def hashed(self, multiplier: int) -> np.ndarray:
        """A hash of each word, a polynomial of its bytes."""
        out, i = np.empty(len(self.starts), np.uint64), 0
        back = pow(multiplier, -1, 1 << 64)
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + STRETCH)))
            part = self.data[self.starts[i] : self.ends[j - 1]]
            n = max(STRETCH, len(part))
            sums = np.append(np.uint64(0), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(multiplier, n)[: len(part)]))
            a, b = self.starts[i:j] - self.starts[i], self.ends[i:j] - self.starts[i]
            out[i:j] = _mixed((sums[b] - sums[a]) * _powers(back, n)[a])
            i = j
        return out


def rolled(words: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """The hash of every run of `width` words, by doubling."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    times = lambda n: np.uint64(pow(multiplier, n, 1 << 64))
    out, have, part, size = None, 0, words, 1
    while True:
        if width & size:
            n = len(words) - have - size + 1
            out = part[:n] if out is None else out[:n] * times(size) + part[have : have + n]
            have += size
        if size * 2 > width:
            return _mixed(out)
        part = part[:-size] * times(size) + part[size:]
        size *= 2


def _packed(numbers: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane: those of the high
    bytes are mostly zeros, which Spark's codec takes away."""
    steps = np.diff(numbers, prepend=numbers.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _unpacked(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list, list[bytes]]]:
    """file, ids, texts: rows of a file that follow each other, some megabytes."""
    for b in batches:
        at = 0
        files, sizes = b["file"].to_numpy(), b["text"].map(len).to_numpy()
        while at < len(b):
            end, size = at, 0
            while end < len(b) and files[end] == files[at] and (end == at or size + sizes[end] <= CHUNK_BYTES):
                size += sizes[end]
                end += 1
            yield int(files[at]), b["doc_id"].iloc[at:end].tolist(), b["text"].iloc[at:end].tolist()
            at = end


def _collected(batches: Iterator[pd.DataFrame], keys_of, hand_on) -> Iterator[pd.DataFrame]:
    """`hand_on(file, keys)` of what `keys_of(file, words)` gives, put together for as
    many chunks of a file as are not too many."""
    file, held, size = None, [], 0
    for at, _, texts in _chunks(batches):
        if held and (at != file or size > COLLECTED):
            yield hand_on(file, *map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
        file = at
        found = keys_of(file, Words(texts))
        held.append(found)
        size += len(found[0])
    if held:
        yield hand_on(file, *map(np.concatenate, zip(*held, strict=True)))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    n = len(keys[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _ends(at: np.ndarray, n: int) -> np.ndarray:
    """Where runs of n rows end."""
    return np.append(at[1:], n)[: len(at)]


def _spans(at: np.ndarray, n: int) -> list[tuple[int, int]]:
    return list(zip(at.tolist(), _ends(at, n).tolist(), strict=True))


def _by_range(file: int, ranges: np.ndarray, numbers: np.ndarray, **flags: np.ndarray) -> pd.DataFrame:
    """One row for each range; numbers are sorted inside ranges."""
    at = _runs(ranges)
    spans = _spans(at, len(ranges))
    rows = {"range": ranges[at].astype(np.int64), "file": file, "numbers": [_packed(numbers[a:b]) for a, b in spans]}
    return pd.DataFrame(rows | {k: [np.packbits(v[a:b]).tobytes() for a, b in spans] for k, v in flags.items()})


PROBES = "range long, file long, numbers binary, several binary, block binary"
CANDIDATES = "range long, file long, numbers binary, several binary"
ANSWERS = "file long, range long, numbers binary"


def probes(texts: DataFrame, size: int, bits: int) -> DataFrame:
    """Of every file the hashes of all rolling windows of a block's size, each once,
    with marks: several places, a reference block."""

    def keys_of(_: int, words: Words) -> tuple[np.ndarray]:
        found = rolled(words.hashed(FIRST), size, FIRST)
        n = len(found)
        keys = found >> np.uint64(64 - 32 - bits)
        keys = keys << np.uint64(1) | (words.place[:n] % size == 0).astype(np.uint64)
        return (keys[words.left[:n] >= size],)

    def hand_on(file: int, keys: np.ndarray) -> pd.DataFrame:
        keys = np.sort(keys)
        own = keys >> np.uint64(1)
        at = _runs(own)
        last = _ends(at, len(own)) - 1
        own = own[at]
        return _by_range(file, own >> np.uint64(32), own.astype(np.uint32), several=last > at, block=(keys[last] & np.uint64(1)).astype(bool))

    return texts.mapInPandas(lambda batches: _collected(batches, keys_of, hand_on), PROBES)


def candidates(texts: DataFrame, hits: str, window: int, size: int, bits: int) -> DataFrame:
    """Of every file the hashes of windows around blocks that were hit."""

    def keys_of(file: int, words: Words) -> tuple[np.ndarray, np.ndarray]:
        known, _ = answers(hits, file, True)
        first = words.hashed(FIRST) if len(known) else np.empty(0, np.uint64)
        if len(first) < window or not len(known):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        blocks = rolled(first, size, FIRST) >> np.uint64(64 - 32 - bits)
        n = len(first) - window + 1
        # The next reference block of the window's own document, from each start on.
        own = np.arange(n) + -words.place[:n] % size
        starts = np.flatnonzero((words.left[:n] >= window) & _known(known, blocks)[own])
        if not len(starts):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        return rolled(first, window, FIRST)[starts], rolled(words.hashed(SECOND), window, SECOND)[starts] >> np.uint64(64 - bits)

    def hand_on(file: int, numbers: np.ndarray, ranges: np.ndarray) -> pd.DataFrame:
        order = np.lexsort((numbers, ranges))
        numbers, ranges = numbers[order], ranges[order]
        at = _runs(ranges, numbers)
        several = _ends(at, len(numbers)) - at > 1
        return _by_range(file, ranges[at], numbers[at], several=several)

    return texts.mapInPandas(lambda batches: _collected(batches, keys_of, hand_on), CANDIDATES)


def repeated(rows: DataFrame, blocks: bool) -> DataFrame:
    """Of each range the numbers with two places or more, for each file that holds
    them; with `blocks` those of reference blocks, for the files that hold the block."""
    dtype = np.uint32 if blocks else np.uint64

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        numbers = [_unpacked(x, dtype) for x in group["numbers"]]
        sizes = [len(x) for x in numbers]
        bits = lambda c: np.concatenate([_bits(x, n) for x, n in zip(group[c], sizes, strict=True)])
        files, own = np.unique(group["file"].to_numpy(), return_inverse=True)
        number, file, places = np.concatenate(numbers), np.repeat(own, sizes), bits("several") + 1
        order = np.argsort(number, kind="stable")
        at = _runs(number[order])
        found = np.repeat(np.add.reduceat(places[order], at) > 1, _ends(at, len(number)) - at)
        taken = order[found]
        if blocks:
            taken = taken[bits("block")[taken]]
        taken = taken[np.argsort(file[taken], kind="stable")]
        number, file = number[taken], file[taken]
        at = _runs(file)
        rows = [number[a:b].astype(np.uint64).tobytes() for a, b in _spans(at, len(file))]
        return pd.DataFrame({"file": files[file[at]], "range": group["range"].iloc[0], "numbers": rows})

    return rows.groupBy("range").applyInPandas(meet, ANSWERS)


def written_by_file(found: DataFrame, folder: str) -> str:
    found.repartition("file").write.partitionBy("file").parquet(folder)
    return folder


#: What the task's last file was answered.
_held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}


def answers(folder: str, file: int, blocks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers of a file's answers and their ranges; of blocks the numbers with
    their range in front."""
    from pyarrow import parquet
    from pyarrow.fs import FileSelector

    if (folder, file) not in _held:
        fs, place = opened(f"{folder}/file={file}")
        names = [f.path for f in fs.get_file_info(FileSelector(place, allow_not_found=True)) if f.path.endswith(".parquet")]
        rows = [(r, np.frombuffer(x, np.uint64)) for n in names for r, x in zip(*parquet.ParquetFile(fs.open_input_file(n)).read(["range", "numbers"]).to_pydict().values(), strict=True)]
        numbers = np.concatenate([np.empty(0, np.uint64), *[x for _, x in rows]])
        ranges = np.repeat(np.array([r for r, _ in rows], np.uint64), [len(x) for _, x in rows])
        if blocks:
            numbers = ranges << np.uint64(32) | numbers
        order = np.argsort(numbers)
        _held.clear()
        _held[folder, file] = numbers[order], ranges[order]
    return _held[folder, file]


def _known(known: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
    return known[at] == numbers


def removed(texts: DataFrame, windows: str, window: int, bits: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept, first, end (of the runs of removed words)."""

    def covered(file: int, words: Words) -> np.ndarray:
        n = len(words.starts) - window + 1
        known, ranges = answers(windows, file)
        out = np.zeros(len(words.starts) + 1, np.int64)
        if n > 0 and len(known):
            numbers, other = rolled(words.hashed(FIRST), window, FIRST), rolled(words.hashed(SECOND), window, SECOND)
            at = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
            starts = np.flatnonzero((known[at] == numbers) & (ranges[at] == other >> np.uint64(64 - bits)) & (words.left[:n] >= window))
            out[starts] += 1
            out[starts + window] -= 1
        return np.cumsum(out[:-1]) > 0

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for file, ids, texts in _chunks(batches):
            words = Words(texts)
            gone, rows = covered(file, words), []
            for doc_id, text, a, b in zip(ids, texts, words.bounds, words.bounds[1:], strict=False):
                mask, found = gone[a:b], text.split()
                borders = np.flatnonzero(np.diff(mask, prepend=False, append=False)) if mask.any() else np.empty(0, np.int64)
                kept = itertools.compress(found, ~mask) if len(borders) else found
                rows.append((doc_id, int(b - a), int(mask.sum()), b" ".join(kept), borders[::2], borders[1::2]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept", "first", "end"])

    return texts.mapInPandas(judge, "doc_id long, n_words long, n_removed long, kept binary, first array<long>, end array<long>")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the other words, joined by one space), spans
    (first and end of each run of words that went). A word goes if a window of
    `window` words of its document that covers it starts anywhere else too."""
    spark, folder, size = docs.sparkSession, shared_folder(docs, "repeats"), (window + 1) // 2
    docs.select(id_of(), text_of().cast("binary").alias("text")).write.option("compression", "zstd").parquet(f"{folder}/texts")
    texts = spark.read.schema("doc_id long, text binary").parquet(f"{folder}/texts")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, (total // RANGE_BYTES).bit_length())
    texts = texts.select("doc_id", "text", F.xxhash64(F.col("_metadata.file_name")).alias("file"))
    hits = written_by_file(repeated(probes(texts, size, bits), True), f"{folder}/hits")
    found = written_by_file(repeated(candidates(texts, hits, window, size, bits), False), f"{folder}/windows")
    spans = F.arrays_zip("first", "end").alias("spans")
    return removed(texts, found, window, bits).select(given_id(), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"), spans)


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
