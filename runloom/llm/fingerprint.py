"""Canonical exact digests of documents.

A text is put into canonical form (Unicode compatibility composition, case
folding, white space runs to one space, ends trimmed) and hashed by XXH64 under
two seeds, 128 bits in all. Rows with equal digests form a bucket; inside a
bucket with several rows the canonical bytes themselves are compared, by their
least and greatest value, which Spark reduces before the shuffle. If texts in a
bucket differ, the SHA-256 of the canonical text is added to the fingerprint, so
that fingerprints are equal exactly if the canonical texts are.

Defined results: a null text counts as empty; very long texts are hashed whole;
repeated rows are rows of their own with equal fingerprints; rows with equal ids are
ordered by a hash of their texts, then by text; null ids come last; other columns
are left out, or kept by `keep`; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, checked_broadcast, cut, given_id, id_of, shared_folder, text_of

#: The two seeds' labels.
SEEDS = ("canonical-a", "canonical-b")


def canonical(text: Column) -> Column:
    """ASCII texts are composed already; for others the ICU library that Spark
    brings along for collations composes and folds them."""
    icu = lambda name, x: F.call_function("java_method", F.lit("com.ibm.icu." + name[0]), F.lit(name[1]), x, F.lit(True))
    folded = icu(("lang.UCharacter", "foldCase"), icu(("text.Normalizer", "compose"), text))
    whole = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(icu(("text.Normalizer", "compose"), folded))
    return F.trim(F.regexp_replace(whole, r"[\s\p{Z}\x1c-\x1f\x85]+", " "))


def digest(canon: Column) -> Column:
    """32 hexadecimal digits."""
    parts = [F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), canon))), 16, "0") for seed in SEEDS]
    return F.concat(*parts)


def confusable(rows: DataFrame) -> DataFrame:
    """The digests that rows with different canonical texts share. `rows`, read twice,
    has `digest` and `canon`. Almost always an empty table. Digests alone are counted
    first; only texts of buckets with several rows are compared, by their least and
    greatest bytes, which each task sums up before the shuffle."""
    shared = cut(rows.groupBy("digest").count().filter("count > 1").select("digest"))
    return (
        rows.join(checked_broadcast(shared), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("canon").alias("low"), F.max("canon").alias("high"))
        .filter("low <> high")
        .select("digest")
    )


def settled(rows: DataFrame, canon: str, digest_: str, mixed_up: DataFrame, out: str) -> DataFrame:
    """Adds `out`: the digest, or, for confusable ones, also the SHA-256 of the
    canonical text. However many those are, none is left out: beyond the bound of a
    broadcast Spark joins them by a shuffle."""
    if mixed_up.isEmpty():
        return rows.withColumn(out, F.col(digest_))
    told = checked_broadcast(mixed_up.select(F.col("digest").alias(digest_), F.lit(True).alias("_mixed")))
    longer = F.concat(digest_, F.lit("-"), F.sha2(canon, 256))
    return rows.join(told, digest_, "left").withColumn(out, F.when(F.col("_mixed"), longer).otherwise(F.col(digest_))).drop("_mixed")


def written(rows: DataFrame, name: str) -> DataFrame:
    """`rows`, written to the shared folder, compressed and by columns."""
    path = shared_folder(rows, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fingerprints(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The columns `keep` and `fingerprint`, for each row. Texts are put into
    canonical form once and kept in the shared folder."""
    rows = docs.select(*keep, canonical(text_of(text)).alias("_c")).withColumn("_d", digest(F.col("_c")))
    rows = written(rows, "canonical")
    mixed_up = cut(confusable(rows.select(F.col("_d").alias("digest"), F.col("_c").alias("canon"))))
    return settled(rows, "_c", "_d", mixed_up, "fingerprint").select(*keep, "fingerprint")


def duplicate_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fingerprint, first_id (the least id of the group), n_copies. The
    groups are counted before they are joined, so a large one is one row."""
    marked = cut(fingerprints(docs, text))
    groups = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
    return marked.join(groups, "fingerprint")


def rank_in(bounds: list[int], x: Column) -> Column:
    """How many of the sorted `bounds` lie below x, by binary search; 0 for null."""
    known = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.get(known, at + s - 1) < x, at + s).otherwise(at)
    )


def with_next(docs: DataFrame, rows_a_part: int = 2_000, most_parts: int = 1 << 16) -> DataFrame:
    """doc_id, text, canon (its canonical form), next_text, next_canon: of the text
    that follows in descending doc_id (after the last: the first).

    Ids are dealt into ranges at quantiles; an id that alone fills ranges is dealt
    over several by its texts' hashes. Each range also gets the first row of the next
    range that has one, at its end, and a window looks one row ahead. So no window
    spans the table or a repeated id, no text is broadcast, texts are shuffled once
    and put into canonical form once, after the shuffle."""
    ids = docs.select(id_of())
    n = ids.count()
    each = max(rows_a_part, -(-n // most_parts))
    parts = max(1, n // each)
    points = [i / parts for i in range(1, parts)]
    hot = cut(ids.groupBy("doc_id").count().filter(F.col("count") > 2 * each))  # two for each range at most
    found = set(ids.agg(F.percentile_approx("doc_id", points, 10 * parts)).first()[0] or ()) if points else set()
    found |= {r["doc_id"] for r in hot.collect()}
    rows = docs.select(id_of(), text_of().alias("text")).withColumn("_o", F.pmod(F.xxhash64("text"), F.lit(1 << 31)))
    # An id that is a bound is the greatest of its range: a hot id's ranges come first, the rest of its range after them.
    share = F.floor(F.col("_o") * F.ceil(F.col("count") / each) / F.lit(float(1 << 31))).cast("int")
    rows = rows.join(checked_broadcast(hot), "doc_id", "left").withColumn("_sub", F.coalesce(share, F.lit(1 << 30))).drop("count")
    rows = rows.withColumn("_part", (rank_in(sorted(found), F.col("doc_id")) if found else F.lit(0)).cast("int")).withColumn("_last", F.lit(False))
    # Null ids are `NO_ID`, the greatest, but come last: their ranges are numbered below all others.
    rows = rows.withColumn("_part", F.when(F.col("doc_id") == NO_ID, F.lit(-1)).otherwise(F.col("_part")))
    order = F.struct(-F.col("doc_id"), F.col("_o"), F.col("text"))
    heads = cut(rows.groupBy("_part", "_sub").agg(F.min_by("text", order).alias("text")))
    # Numbers of ranges only: a small window and a small table.
    whole = Window.orderBy(F.desc("_part"), "_sub")
    back = heads.select("_part", "_sub", F.lag("_part").over(whole).alias("p"), F.lag("_sub").over(whole).alias("s"))
    last = [F.last(x).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for x in ("_part", "_sub")]
    back = back.select("_part", "_sub", F.coalesce("p", last[0]).alias("p"), F.coalesce("s", last[1]).alias("s"))
    ends = heads.join(F.broadcast(back), ["_part", "_sub"]).select(
        F.lit(NO_ID).alias("doc_id"), "text", F.lit(0).cast("long").alias("_o"), F.col("s").alias("_sub"), F.col("p").alias("_part"), F.lit(True).alias("_last")
    )
    dealt = rows.unionByName(ends).repartition("_part", "_sub").withColumn("canon", canonical(F.col("text")))
    inside = Window.partitionBy("_part", "_sub").orderBy("_last", F.desc("doc_id"), "_o", "text")
    ahead = {f"next_{c}": F.lead(c).over(inside) for c in ("text", "canon")}
    return dealt.withColumns(ahead).filter(~F.col("_last")).select(given_id(), "text", "canon", *ahead)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document with its edited text: its last floor(n/2) code points are
    replaced by the first as many (or all) of the next document."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    return with_next(docs).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """The contract's columns for each document. Likeness is that of exact digests: 1
    if they and the bytes that they stand for are equal, else 0."""
    pairs = edited_pairs(docs).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.col("canon").alias("a"),
        canonical(F.col("edited")).alias("b"), (F.col("canon") == F.col("next_canon")).cast("double").alias("near_next"),
    )
    rows = written(pairs.withColumns({"da": digest(F.col("a")), "db": digest(F.col("b"))}), "edits")
    both = rows.select(F.inline(F.array(*[F.struct(F.col(f"d{x}").alias("digest"), F.col(x).alias("canon")) for x in "ab"])))
    mixed_up = cut(confusable(both))
    rows = settled(settled(rows, "a", "da", mixed_up, "fingerprint"), "b", "db", mixed_up, "edited_fingerprint")
    near = (F.col("fingerprint") == F.col("edited_fingerprint")).cast("double").alias("near_edited")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near, "near_next")
