"""Toxicity by class-conditional Kneser-Ney models.

A text is a run of characters, with white space and punctuation folded to one space.
For each class, toxic and ordinary, the probability of a character given the three
before it is that of interpolated Kneser-Ney: its discounted share of the class's
counts, plus the mass so freed times the probability given two characters before,
and so on down to one character and to nothing. The lower orders are continuation
counts (in how many different contexts a run of characters occurs) over both classes
together: the shared backoff. So an expression that is rare in a class, or unseen,
has what the classes share, weighed by how open the class's context is. Discounts
come from the numbers of windows that are counted once and twice, for each class and
each order. A text's score compares its two log-likelihoods per character,
calibrated by a logistic curve on training rows that its counts have not seen. (To
add the counts of those rows afterwards was tried: it moves the ratios away from the
curve, and with few labels a third of the ordinary texts were called toxic.)

Words alone are too sparse here: toxic words of one language share beginnings,
and most occur seldom. Bigrams of words were tried and found a twentieth of the
held-out toxic texts, single words about seven tenths, these expressions over
eight tenths.

A window of four characters is a 64-bit number of its own, so nothing is hashed and
no two windows are confused. All counts are Spark tables over all training rows; the
model is one of them, a log-ratio for each window and each context, and grows with
the corpus. Up to `MODEL_ROWS` rows it is sent to the executors as sorted arrays;
beyond, the texts' distinct windows are joined to it by a shuffle, with the same
result.

Defined results: null and empty texts get the curve's value at 0, near the share
of toxic rows; very long texts are read whole, piece by piece; repeated rows are
scored alike, and so are rows with equal or null ids; documents without a label, or
with a null one, teach nothing; of a document's contradicting labels the greater
counts; without training rows of both classes every score is 0; other columns are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, given_id, id_of, text_of

BETWEEN = re.compile(r"\W+")
ORDER, CHARACTERS = 4, 1 << 16
#: Characters that are looked at at once, for bounded memory.
CHUNK = 1_000_000
CURVE_BINS, CURVE_RANGE = 4_000, 4.0
#: Labels (a number and a mark each) that are sent to the texts; beyond, texts are shuffled to them.
LABEL_ROWS = 2_000_000
#: Windows and contexts (a number and a log-ratio each) that are sent to the executors.
MODEL_ROWS = 4_000_000


def windows(text: str) -> Iterator[np.ndarray]:
    """A text's windows of four characters, as numbers, in pieces of bounded size."""
    folded = f" {BETWEEN.sub(' ', text.lower())} ".replace("  ", " ")
    chars = np.frombuffer(folded.encode("utf-16-le", "surrogatepass"), "<u2")
    for at in range(0, len(chars) - ORDER + 1, CHUNK):
        part = chars[at : at + CHUNK + ORDER - 1].astype(np.uint64)
        n = len(part) - ORDER + 1
        key = part[:n]
        for i in range(1, ORDER):
            key = (key << np.uint64(16)) | part[i : n + i]
        yield key


def of_texts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of several texts and each one's text, in runs of bounded size."""
    held, owner, size = [], [], 0
    for k, text in enumerate(texts):
        for w in windows(text):
            held.append(w)
            owner.append(np.full(len(w), k))
            size += len(w)
            if size > CHUNK:
                yield np.concatenate(held), np.concatenate(owner)
                held, owner, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owner)


def count(rows: DataFrame) -> DataFrame:
    """text, toxic (0 or 1) -> key, n0, n1: how often each window is in the texts of
    each class. A task sums up its batches before they are shuffled."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for toxic, part in b.groupby("toxic"):
                for found, _ in of_texts(part["text"].tolist()):
                    key, n = np.unique(found, return_counts=True)
                    yield pd.DataFrame({"key": key.view(np.int64), "toxic": int(toxic), "n": n})

    parts = rows.mapInPandas(partial, "key long, toxic int, n long")
    return cut(parts.groupBy("key").agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]))


def discount(n: Column) -> Column:
    """Of the numbers of things that are counted once and twice; a half if neither is."""
    once, twice = F.count_if(n == 1), F.count_if(n == 2)
    return F.coalesce(F.try_divide(once.cast("double"), once + 2 * twice), F.lit(0.5))


class Model(NamedTuple):
    """Log-ratios, toxic to ordinary: of each window that was seen in either class,
    and of a window that was not, by its context. Other contexts have 0."""

    windows: DataFrame
    contexts: DataFrame


def _backed(counts: DataFrame, key: str, bits: int, lower: DataFrame | None) -> DataFrame:
    """key (a window's last characters) and n (its continuation count) -> key, p: its
    probability given all but the last character. `lower` has key and p of the order
    below; without it the backoff is the same for every character."""
    ctx = F.shiftrightunsigned(key, 16)
    by_ctx = counts.groupBy(ctx.alias("_ctx")).agg(F.sum("n").alias("_total"), F.count("*").alias("_types"))
    rows = counts.withColumn("_ctx", ctx).crossJoin(F.broadcast(counts.agg(discount(F.col("n")).alias("_D")))).join(by_ctx, "_ctx")
    if lower is None:
        back = F.lit(1.0 / CHARACTERS)
    else:
        rows = rows.withColumn("_low", F.col(key).bitwiseAND(F.lit((1 << bits - 16) - 1))).join(lower.select(F.col(key).alias("_low"), F.col("p").alias("_p")), "_low")
        back = F.col("_p")
    p = (F.greatest(F.col("n") - F.col("_D"), F.lit(0.0)) + F.col("_D") * F.col("_types") * back) / F.col("_total")
    return rows.select(key, p.alias("p"))


def model(rows: DataFrame) -> Model | None:
    """The model from the windows' counts; None if a class has none."""
    seen = rows.agg(*[f(F.when(F.col(n) > 0, F.col(n))) for n in ("n0", "n1") for f in (F.sum, discount)]).first()
    if not seen[0] or not seen[2]:
        return None
    discounts = (float(seen[1]), float(seen[3]))
    # Continuation counts: each order's distinct runs, by their last characters.
    tail = lambda df, bits: df.select(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    three = cut(tail(rows, 48))
    two = cut(tail(three, 32))
    lower = _backed(two, "key", 32, _backed(tail(two, 16), "key", 16, None))
    shared = _backed(three, "key", 48, cut(lower)).withColumnRenamed("key", "_tail").withColumnRenamed("p", "_shared")
    # Weights of the backoff by context, for each class; 1 where the class never had it.
    weigh = lambda n, d: F.coalesce(d * F.count_if(F.col(n) > 0) / F.nullif(F.sum(n), F.lit(0)), F.lit(1.0))
    contexts = rows.groupBy(F.shiftrightunsigned("key", 16).alias("ctx")).agg(
        *[F.sum(f"n{c}").alias(f"total{c}") for c in (0, 1)], *[weigh(f"n{c}", discounts[c]).alias(f"w{c}") for c in (0, 1)]
    )
    contexts = cut(contexts)
    p = lambda c: F.coalesce(F.greatest(F.col(f"n{c}") - discounts[c], F.lit(0.0)) / F.nullif(f"total{c}", F.lit(0)), F.lit(0.0)) + F.col(f"w{c}") * F.col("_shared")
    joined = rows.withColumns({"ctx": F.shiftrightunsigned("key", 16), "_tail": F.col("key").bitwiseAND(F.lit((1 << 48) - 1))}).join(contexts, "ctx").join(shared, "_tail")
    return Model(cut(joined.select("key", F.log(p(1) / p(0)).alias("r"))), cut(contexts.select(F.col("ctx").alias("key"), F.log(F.col("w1") / F.col("w0")).alias("r"))))


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    got = df.toArrow()  # counted before
    key, r = got["key"].to_numpy().view(np.uint64), got["r"].to_numpy()
    order = np.argsort(key)
    return key[order], r[order]


def look_up(found: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The value of each key; not a number where the table has none."""
    keys, values = table
    if not len(keys):
        return np.full(len(found), np.nan)
    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    return np.where(keys[at] == found, values[at], np.nan)


def ratios(texts: list[str], seen, contexts) -> np.ndarray:
    """Log-likelihood per character, toxic less ordinary; 0 without any window."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for found, owner in of_texts(texts):
        r = look_up(found, seen)
        new = np.flatnonzero(np.isnan(r))
        r[new] = np.nan_to_num(look_up(found[new] >> np.uint64(16), contexts))
        total += np.bincount(owner, weights=r, minlength=len(texts))
        n += np.bincount(owner, minlength=len(texts))
    return total / np.maximum(n, 1)


def rated(rows: DataFrame, m: Model, keep: dict[str, str], most: int = MODEL_ROWS) -> DataFrame:
    """The columns `keep` (name to type) and `ratio` for each row of `rows`."""
    if m.windows.count() + m.contexts.count() <= most:
        sent = rows.sparkSession.sparkContext.broadcast((_arrays(m.windows), _arrays(m.contexts)))

        def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b[list(keep)].assign(ratio=ratios(b["text"].tolist(), *sent.value))

        return rows.select(*keep, "text").mapInPandas(rate, ", ".join(f"{k} {v}" for k, v in keep.items()) + ", ratio double")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a, x, text in zip(b["_a"], b["_b"], b["text"], strict=True):
                for found in windows(text):
                    key, n = np.unique(found, return_counts=True)
                    yield pd.DataFrame({"_a": a, "_b": x, "key": key.view(np.int64), "n": n})

    # Equal texts are one; a piece of a very long text may repeat another piece's windows, so pieces are summed up by task first.
    known = rows.select(*keep, "text", F.xxhash64("text").alias("_a"), F.xxhash64(F.lit("2"), "text").alias("_b"))
    found = known.select("_a", "_b", "text").mapInPandas(emit, "_a long, _b long, key long, n long")
    seen = m.windows.select("key", F.col("r").alias("_w"))
    contexts = m.contexts.select(F.col("key").alias("_ctx"), F.col("r").alias("_c"))
    joined = found.withColumn("_ctx", F.shiftrightunsigned("key", 16)).join(seen, "key", "left").join(contexts, "_ctx", "left")
    # A repeated text adds as much to both sums.
    ratio = (F.sum(F.col("n") * F.coalesce("_w", "_c", F.lit(0.0))) / F.sum("n")).alias("_r")
    told = joined.groupBy("_a", "_b").agg(ratio)
    return known.join(told, ["_a", "_b"], "left").select(*keep, F.coalesce("_r", F.lit(0.0)).alias("ratio"))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit_curve(at: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from a histogram with rising `at`. It
    crosses 1/2 where most rows are judged rightly; short texts have ratios far
    out, which would pull a free curve away from there. The slope has the least
    log-loss."""
    right = np.concatenate(([ones.sum()], ones.sum() - np.cumsum(ones) + np.cumsum(n - ones)))
    best = np.flatnonzero(right == right.max())
    ends = np.concatenate(([at[0] - 0.1], (at[1:] + at[:-1]) / 2, [at[-1] + 0.1]))
    middle = float(ends[best[len(best) // 2]])

    def loss(slope: float) -> float:
        z = np.clip(slope * (at - middle), -30, 30)
        return float((n * np.log1p(np.exp(z)) - ones * z).sum())

    slope = min((2.0**k for k in range(-2, 13)), key=loss)
    return slope, -slope * middle


def curve(held: DataFrame, m: Model, most: int = MODEL_ROWS) -> tuple[float, float]:
    """text, toxic of rows that the model has not counted -> slope and offset, from a
    histogram of a fixed number of bins."""
    at = F.round(F.least(F.greatest(F.col("ratio") / CURVE_RANGE, F.lit(-1.0)), F.lit(1.0)) * CURVE_BINS).cast("long")
    tally = rated(held, m, {"toxic": "int"}, most).groupBy(at.alias("bin")).agg(F.sum("toxic").alias("ones"), F.count("*").alias("n"))
    found = tally.toArrow().to_pandas().sort_values("bin")
    if not len(found):
        return 1.0, 0.0
    return fit_curve(found["bin"].to_numpy(float) * CURVE_RANGE / CURVE_BINS, found["ones"].to_numpy(float), found["n"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame, most: int = MODEL_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`. Rows with fold 0
    teach nothing; fold 1 sets the curve; the others are counted."""
    marks = labels.filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter(fold(F.col("doc_id")) > 0)
    marks = checked_broadcast(cut(marks), LABEL_ROWS)
    known = docs.select("doc_id", text_of().alias("text")).join(marks, "doc_id").select("text", "toxic", (fold(F.col("doc_id")) == 1).alias("held"))
    made = model(count(known.filter("NOT held").select("text", "toxic")))
    out = lambda df, z: df.select(given_id(), z.alias("score"))
    texts = docs.select(id_of(), text_of().alias("text"))
    if made is None:
        scored = out(texts, F.lit(0.0))
    else:
        slope, offset = curve(known.filter("held"), made, most)
        z = F.greatest(F.least(F.lit(slope) * F.col("ratio") + offset, F.lit(500.0)), F.lit(-500.0))
        scored = out(rated(texts, made, {"doc_id": "long"}, most), 1 / (1 + F.exp(-z)))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
