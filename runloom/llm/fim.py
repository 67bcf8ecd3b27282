"""Fill-in-the-middle: a text's units are cut at two places and put in another order.

A unit is a run of letters A-Z, or any other code point. A text's UTF-8 bytes are cut
into blocks of a fixed size; a Fenwick tree over the blocks keeps how many units and
how many code points begin in them. A descent by powers of two leads to the block in
which a unit begins, and on its way sums up the code points before it; only that
block is then looked through for the boundary. Blocks are counted a stretch at a
time, so that what is held besides the text and its output does not grow with it.

Draws are taken from a SHA-256 of the seed and the id, so a rerun gives the same, in
whatever order rows come.

Defined results: a null text is empty; an empty text, and one that holds a mark,
stays plain, whatever was drawn; repeated rows are rewritten alike; a null id draws
as an id without digits; a text of one unit may have two empty parts; an empty table
gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import given_id, id_of, let, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes in a block of the tree, bytes that are counted at once, bytes of texts in a batch of output.
BLOCK, STRETCH, BATCH_BYTES = 1 << 10, 1 << 20, 1 << 23
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


def _begins(data: np.ndarray, at: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """For the bytes from `at` to `stop`: whether a unit, a code point begins there."""
    part = data[max(at - 1, 0) : stop]
    letter = ((part | 32) - np.uint8(97)) < 26
    before = np.append(False, letter[:-1])
    own = 1 if at else 0
    points = (part[own:] & 0xC0) != 0x80
    return points & ~(letter[own:] & before[own:]), points


class BlockTree:
    """Units and code points of a text by blocks of its bytes, as a Fenwick tree."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.data, self.block = np.frombuffer(text, np.uint8), block
        self.blocks = -(-len(text) // block)
        sums, stretch = np.zeros((self.blocks + 1, 2), np.int64), max(1, STRETCH // block) * block
        for at in range(0, len(text), stretch):
            stop = min(at + stretch, len(text))
            borders = np.arange(0, stop - at, block)
            for kind, begins in enumerate(_begins(self.data, at, stop)):
                sums[1 + at // block : 1 + at // block + len(borders), kind] = np.add.reduceat(begins, borders, dtype=np.int64)
        sums = np.cumsum(sums, axis=0)
        self.units, self.points = sums[-1].tolist()
        node = np.arange(self.blocks + 1)
        self.tree = (sums - sums[node - (node & -node)]).tolist()

    def place(self, unit: int) -> tuple[int, int]:
        """Byte and code point at which a unit, from 0, begins; the end for the number
        of units."""
        if unit >= self.units:
            return len(self.data), self.points
        at, points, step = 0, 0, 1 << self.blocks.bit_length()
        while step:
            if at + step <= self.blocks and self.tree[at + step][0] <= unit:
                at += step
                unit -= self.tree[at][0]
                points += self.tree[at][1]
            step >>= 1
        start = at * self.block
        begins, leads = _begins(self.data, start, min(start + self.block, len(self.data)))
        inside = int(np.flatnonzero(begins)[unit])
        return start + inside, points + int(np.count_nonzero(leads[:inside]))


def rewritten(text: bytes, form: str, first: int, second: int, block: int = BLOCK) -> tuple[int, int, int, bytes]:
    """Units; code points of prefix and middle (-1 in a plain text); the output. The
    cuts are the two draws modulo the units and one."""
    tree = BlockTree(text, block)
    if form == "plain":
        return tree.units, -1, -1, text
    a, b = sorted((first % (tree.units + 1), second % (tree.units + 1)))
    (at, before), (to, until) = tree.place(a), tree.place(b)
    p, s, m = (x.encode() for x in MARKS)
    ends = (p + text[:at], s + text[to:])
    return tree.units, before, until - before, b"".join((*(ends if form == "psm" else ends[::-1]), m, text[at:to]))


def draws(seed: int) -> list[Column]:
    """Four numbers of 32 bits for a row's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, suffix_first: int = 20, block: int = BLOCK) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output.
    Of a hundred texts `rate` are rewritten, and of a hundred of those `suffix_first`
    have the suffix in front."""
    h1, h2, h3, h4 = draws(seed)
    text = text_of()
    plain = (F.length(text) == 0) | (h3 % 100 >= rate)
    for mark in MARKS:
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for b in batches:
            rows, size = [], 0
            for doc_id, text, form, first, second in zip(*(b[c] for c in ("doc_id", "text", "form", "first", "second")), strict=True):
                n, prefix, middle, output = rewritten(text, form, first, second, block)
                rows.append((doc_id, n, form, prefix, middle, output))
                size += len(output)
                if size > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    rows = docs.select(id_of(), text.cast("binary").alias("text"), form.alias("form"), h1.alias("first"), h2.alias("second"))
    given = lambda c: F.nullif(F.col(c), F.lit(-1).cast("long")).alias(c)
    return rows.mapInPandas(rewrite, SCHEMA).select(given_id(), "n", "form", given("prefix_chars"), given("middle_chars"), F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone. A rewritten text holds no mark, and no
    mark begins where another ends, so the three marks part the output."""
    parts = let(F.split(output, "<[PSM]>", 4), lambda x: F.when(form == "psm", F.concat(x[1], x[3], x[2])).otherwise(F.concat(x[2], x[3], x[1])))
    return F.when(form == "plain", output).otherwise(parts)


def digests(rewritten_: DataFrame) -> DataFrame:
    """With digests of the outputs and of the texts that they are read back to."""
    text = restored(F.col("output"), F.col("form"))
    return rewritten_.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    )
