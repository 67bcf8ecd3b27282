"""Column expressions over barcodes and reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def letters(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda x: x != "")


def _differences(a: Column, b: Column, unequal) -> Column:
    pairs = F.zip_with(letters(a), letters(b), lambda x, y: unequal(x, y).cast("int"))
    return F.aggregate(pairs, F.lit(0), lambda total, x: total + x)


def hamming(a: Column, b: Column) -> Column:
    """Places that differ; null if the lengths do."""
    return F.when(F.length(a) == F.length(b), _differences(a, b, lambda x, y: x != y))


def hamming_truncated(a: Column, b: Column) -> Column:
    """Over the length of the shorter one."""
    n = F.least(F.length(a), F.length(b))
    return _differences(F.substring(a, F.lit(1), n), F.substring(b, F.lit(1), n), lambda x, y: x != y)


def hamming_with_n(a: Column, b: Column) -> Column:
    """N matches nothing, not even N."""
    return F.when(F.length(a) == F.length(b), _differences(a, b, lambda x, y: (x != y) | (x == "N") | (y == "N")))


def matches(barcode: Column, reference: Column, mismatches: int | Column) -> Column:
    """Dual barcodes are split at `+`; each index may differ in so many places."""
    a, b = F.split(barcode, r"\+"), F.split(reference, r"\+")
    limit = F.lit(mismatches) if isinstance(mismatches, int) else mismatches
    near = F.zip_with(a, b, lambda x, y: F.coalesce(hamming_with_n(x, y) <= limit, F.lit(False)))
    return (F.size(a) == F.size(b)) & F.forall(near, lambda x: x)


def plain(barcode: Column) -> Column:
    """Without the separators of dual barcodes."""
    return F.regexp_replace(barcode, "[+-]", "")


def barcode_length(barcode: Column) -> Column:
    return F.length(plain(barcode))


def pool_id(barcode: Column) -> Column:
    return barcode.rlike("^SI-[A-Z0-9]+-[A-Z0-9]+$")


def is_valid(barcode: Column) -> Column:
    return barcode.rlike("^[ATGC]*$") | pool_id(barcode)


def plate_index(barcode: Column) -> Column:
    return barcode.rlike("^SI-(GA|NA|TT|TS)-[A-H](1[0-2]|[1-9])$")


def masked_shape(barcode: Column) -> Column:
    """ACGT to N; a pool identifier to its own mark."""
    return F.when(pool_id(barcode), F.lit("__10X__")).otherwise(F.translate(barcode, "ACGT", "NNNN"))


def length_label(barcode: Column) -> Column:
    return F.array_join(F.transform(F.split(barcode, "-"), lambda x: F.length(x).cast("string")), "x")


def trimmed_inline(sequence: Column, quality: Column, n: int) -> dict[str, Column]:
    """The first n bases become the barcode; sequence and quality lose them."""
    after = lambda c: F.substring(c, F.lit(n + 1), F.length(c))
    return {"barcode": F.substring(sequence, 1, n), "sequence": after(sequence), "quality": after(quality)}


def subsequence(sequence: Column, start: int, end: int) -> Column:
    """From `start` (1 for the first base) to `end`, both included."""
    return F.substring(sequence, start, end - start + 1)


def unpadded(sequence: Column) -> Column:
    return F.btrim(sequence, F.lit("N"))


def is_masked(sequence: Column) -> Column:
    """All N; a read without bases counts as masked."""
    return F.length(unpadded(sequence)) == 0


def is_padded(sequence: Column) -> Column:
    """N at an end, but not masked."""
    kept = F.length(unpadded(sequence))
    return (kept > 0) & (kept < F.length(sequence))


def pieces(index: Column, n: int) -> Column:
    """The index cut into n pieces of about the same size, as an array of (k, piece)."""
    size = F.length(index)
    at = lambda i: F.floor(size * i / n).cast("int")
    return F.array(*[F.struct(F.lit(i).alias("k"), F.substring(index, at(i) + 1, at(i + 1) - at(i)).alias("piece")) for i in range(n)])


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))
