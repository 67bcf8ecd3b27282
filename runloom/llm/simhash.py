"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in Arrow batches. Equal ones become one class. Classes
within the radius are found exactly: of radius + 1 blocks of bits, two such
fingerprints share at least one, so only classes with a block in common meet. At
a large radius blocks are too short to prune; then either all classes are one
bucket, or, with `bands`, the buckets are keys made of least hashes (MinHash):
texts of Jaccard similarity s share one of b keys of r hashes with probability
1 - (1 - s^r)^b, 0.9996 at s = 0.8. Buckets with the same members are compared once.
Inside a block's bucket the fingerprints are cut into tiles by population count;
pairs of tiles whose counts differ by more than the radius are skipped, the
others are compared by numpy's exclusive-or and bit counts. A bucket of any size
is dealt out as pairs of tiles, so none is gathered whole. A pair of tiles gives
a spanning forest of its links, nearest first, not all of them: at most one row
for each fingerprint, and no component is lost. Components are then found by star
contraction, with each round cut to the shared folder.

Where links are verified, texts with equal sets of shingles are a class, whatever
their fingerprints, and a link is a pair whose sets have the Jaccard similarity
asked for, counted exactly. Only sets of classes that meet others are made, and
they are brought to the units; the rows' sizes bound the tiles then.

Defined results: a null text counts as empty; texts without words have
fingerprint zero and are linked like any other; very long texts are read whole, in
bounded memory; repeated rows are linked; rows with equal ids are rows of their
own; of a component's rows with the least id all count as first (ties are settled by
`drop_near_duplicates`); null ids count as the greatest; other columns, whatever
their names, are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, checked_broadcast, cut, given_id, id_of, quoted, text_of

SEED = 42
TILE = 8_192
#: Tiles that a bucket of bands is dealt into, and rows in the least of them.
SPREAD, FINE = 8, 256
#: Pairs that are tried at once, for bounded memory.
PAIRS = 1 << 13
#: Shingles that count as much as a row in a tile: 8,192 rows hold 32 MB of them.
SHINGLES_A_ROW = 512
NODE = "struct<d:bigint,f:bigint>"


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of all shingles, repeats included. Bytes are lower-cased for A-Z
    only and split at ASCII white space only, as the contract wants."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


#: Bins of hashes by their top bits, see `Sets.may`.
BINS = 512


class Sets:
    """Sorted sets of hashes, as bytes, and which pairs have a Jaccard similarity of
    `least` or more."""

    def __init__(self, sets: list[bytes], least: float):
        self.sets, self.least = [np.frombuffer(x, np.uint64) for x in sets], least
        self.size = np.array([len(x) for x in self.sets], np.int64)
        self.counts = None

    def may(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """False only for pairs that are surely less alike: hashes in common can't be
        more than the lesser set, nor than the lesser counts of all bins together."""
        if self.counts is None:
            kind = np.uint16 if self.size.max() < 1 << 16 else np.uint32
            self.counts = np.stack([np.bincount((x >> np.uint64(55)).astype(np.int64), minlength=BINS).astype(kind) for x in self.sets])
        out = self._reach(i, j, np.minimum(self.size[i], self.size[j]))
        i, j = i[out], j[out]
        out[out] = self._reach(i, j, np.minimum(self.counts[i], self.counts[j]).sum(1, dtype=np.int64))
        return out

    def _reach(self, i: np.ndarray, j: np.ndarray, common: np.ndarray) -> np.ndarray:
        return common / np.maximum(1, self.size[i] + self.size[j] - common) >= self.least

    def hold(self, i: int, j: int) -> bool:
        a, b = (self.sets[i], self.sets[j]) if self.size[i] <= self.size[j] else (self.sets[j], self.sets[i])
        if not len(a) or len(a) < self.least * len(b) - 1:
            return len(b) == 0
        at = np.searchsorted(b, a)
        common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
        return common / (len(a) + len(b) - common) >= self.least


#: Keys of a text, and least hashes in each.
BANDS, IN_BAND = 20, 5
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, (BANDS, IN_BAND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Each factor times the hashes is another order of them; a key mixes the least
    in IN_BAND orders. Texts without shingles have the same keys."""
    least = np.full(FACTORS.size, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1 << 12):
        least = np.minimum(least, (hashes[i : i + (1 << 12), None] * FACTORS.reshape(1, -1)).min(0))
    return (least.reshape(FACTORS.shape) * FACTORS[::-1]).sum(1, dtype=np.uint64).view(np.int64)


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits of XXH3 of a set of hashes, sorted."""
    return xxhash.xxh3_128_digest(hashes.tobytes(), SEED)


def fingerprints(docs: DataFrame, shingle: int = 4, sets: bool = False, banded: bool = False) -> DataFrame:
    """doc_id, f (the 64 bits as a signed number), and, if wanted, t, a hash of the
    text, g and w, the digest and the size of the shingle set, and k, the keys of the
    bands."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prints, digests, sizes, keys = [], [], [], []
            for text in b["text"]:
                hashes = shingle_hashes(text, shingle)
                prints.append(fingerprint(hashes))
                distinct = np.unique(hashes) if sets else hashes[:0]
                digests.append(set_digest(distinct) if sets else b"")
                sizes.append(len(distinct))
                keys.append(band_keys(hashes) if banded else [])
            yield pd.DataFrame({"doc_id": b["doc_id"], "t": b["t"], "f": np.array(prints, np.int64), "g": digests, "w": sizes, "k": keys})

    texts = docs.select(id_of(), text_of().alias("text")).withColumn("t", F.xxhash64("text"))
    made = texts.mapInPandas(make, "doc_id long, t long, f long, g binary, w long, k array<long>").withColumns({"doc_id": given_id()})
    return made.drop(*([] if sets else ["t", "g", "w"]), *([] if banded else ["k"]))


def shingle_sets(docs: DataFrame, shingle: int, wanted: DataFrame) -> DataFrame:
    """c, h: the set of each wanted class (c, d, t, g), taken from a row with the id
    d and the hash t whose set has the digest g."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c, g, text in zip(b["c"].tolist(), b["g"], b["text"], strict=True):
                distinct = np.unique(shingle_hashes(text, shingle))
                if set_digest(distinct) == bytes(g):
                    rows.append((c, distinct.tobytes()))
            yield pd.DataFrame(rows, columns=["c", "h"])

    texts = docs.select(id_of().alias("d"), text_of().alias("text")).withColumn("t", F.xxhash64("text"))
    found = texts.join(checked_broadcast(wanted), ["d", "t"]).select("c", "g", "text").mapInPandas(make, "c long, h binary")
    return found.dropDuplicates(["c"])


def blocks_of(f: Column, n: int) -> Column:
    """The n blocks of bits, as an array of (block, key)."""
    cuts = [64 * i // n for i in range(n + 1)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(f, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("key"))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
    )


def met_in_bands(classes: DataFrame) -> DataFrame:
    """The classes' columns but k, with block and key, for each bucket of bands that
    several classes share. Of buckets with the same members one is left: their
    numbers of members and two sums over hashes of the members are equal."""
    keyed = classes.select("c", F.posexplode("k").alias("block", "key"))
    size = keyed.groupBy("block", "key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("c")).alias("x"), F.bit_xor(F.xxhash64(F.lit(SEED), "c")).alias("y"))
    shared = size.filter("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("block", "key")).alias("b")).select("b.block", "b.key")
    met = keyed.join(checked_broadcast(cut(shared)), ["block", "key"], "left_semi")
    return classes.drop("k").join(met, "c")


def into_units(classes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """The classes' columns (but k), and a unit to compare in: block, key, t, u (t <= u: two
    tiles, or one with itself), and side (0: the row is of tile t). A row counts as
    one in a tile, or with w, the size of its set, as more."""
    n, have = min(64, radius + 1), [c for c in classes.columns if c != "k"]
    if "k" in classes.columns:
        rows = cut(met_in_bands(classes))
    elif n * 2.0 ** (-64 / n) >= 1:  # the blocks' buckets hold more pairs than the whole
        rows = classes.select("*", F.lit(0).alias("block"), F.lit(0).cast("long").alias("key"))
    else:
        rows = classes.select("*", F.inline(blocks_of(F.col("f"), n)))
    weight = F.sum(F.lit(1) + F.floor(F.col("w") / SHINGLES_A_ROW)) if "w" in have else F.count("*")
    # A bucket of bands is a group of near copies: a large one is dealt out finely, in about SPREAD tiles.
    least = min(tile, FINE) if "k" in classes.columns else tile
    cells = F.least(F.lit(tile), F.greatest(F.lit(least), F.ceil(F.col("n") / SPREAD))).cast("long").alias("cells")
    large = cut(rows.groupBy("block", "key").agg(weight.alias("n")).filter(F.col("n") > least).select("block", "key", cells))
    alone = [F.lit(0).alias(c) for c in ("t", "u", "side")]
    if large.isEmpty():
        return rows.select(*have, "block", "key", *alone)
    marked = checked_broadcast(large)
    small = rows.join(marked, ["block", "key"], "left_anti").select(*have, "block", "key", *alone)
    rows = rows.join(marked, ["block", "key"]).withColumn("pop", F.bit_count("f"))
    # A row's tile: its place in its bucket, ordered by population count and a hash.
    by_pop = rows.groupBy("block", "key", "cells", "pop").agg(weight.alias("n"))
    before = F.expr("coalesce(sum(n) OVER (PARTITION BY block, key ORDER BY pop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    by_pop = checked_broadcast(cut(by_pop.withColumn("before", before)))
    place = F.col("before") + F.pmod(F.xxhash64("c"), F.col("n"))
    tile_of = lambda x: F.floor(x / F.col("cells")).cast("int")
    tiled = rows.join(by_pop.drop("cells"), ["block", "key", "pop"]).withColumn("tile", tile_of(place))
    reach = F.sequence(tile_of(F.col("before")), tile_of(F.col("before") + F.col("n") - 1))
    spans = by_pop.select("block", "key", "pop", F.explode(reach).alias("tile"))
    spans = cut(spans.groupBy("block", "key", "tile").agg(F.min("pop").alias("low"), F.max("pop").alias("high")))
    one, other = spans.alias("a"), spans.alias("b")
    near = (
        (F.col("a.block") == F.col("b.block")) & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.low") <= F.col("b.high") + radius) & (F.col("b.low") <= F.col("a.high") + radius)
    )
    partners = one.join(other, near).select("a.block", "a.key", "a.tile", F.col("b.tile").alias("with"))
    partners = checked_broadcast(cut(partners))
    dealt = tiled.join(partners, ["block", "key", "tile"]).select(
        *have, "block", "key", F.least("tile", "with").alias("t"), F.greatest("tile", "with").alias("u"),
        (F.col("tile") > F.col("with")).cast("int").alias("side"),
    )
    return small.unionByName(dealt)


def forest(a: np.ndarray, b: np.ndarray | None, radius: int, holds=None, cells: int = 1 << 20, surely=None) -> list[tuple[int, int]]:
    """A spanning forest of the links within `a`, or between `a` and `b`: places in
    a, and in b (or a). Both sorted by population count. `holds(i, j)` tells which
    pairs of places are links indeed; only such make the forest, so none is lost
    for a pair that isn't one. `surely(i, j)` tells the same of one pair; it is asked
    only while the two are not connected otherwise."""
    same, b = b is None, a if b is None else b
    pa, pb = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    shift = 0 if same else len(a)
    label = np.arange(len(a) + (0 if same else len(b)))
    edges: list[tuple[int, int]] = []
    step = max(1, cells // max(1, len(b)))
    for c0 in range(0, len(a), step):
        c1 = min(len(a), c0 + step)
        lo, hi = np.searchsorted(pb, pa[c0] - radius, "left"), np.searchsorted(pb, pa[c1 - 1] + radius, "right")
        hi = min(hi, c1) if same else hi
        away = np.bitwise_count(a[c0:c1, None] ^ b[None, lo:hi])
        i, j = np.nonzero(away <= radius)
        if not len(i):
            continue
        d, i, j = away[i, j], i + c0, j + lo
        open_ = (label[i] != label[j + shift]) & ((j < i) if same else True)
        i, j, d = i[open_], j[open_], d[open_]
        if holds is not None and len(i):
            true = np.concatenate([holds(i[k : k + PAIRS], j[k : k + PAIRS]) for k in range(0, len(i), PAIRS)])
            i, j, d = i[true], j[true], d[true]
        if not len(i):
            continue
        nearest = np.argsort(d, kind="stable")
        i, j = i[nearest], j[nearest]
        for k in range(0, len(i), len(i) if surely is None else PAIRS):
            pi, pj = (i, j) if surely is None else (i[k : k + PAIRS], j[k : k + PAIRS])
            x, y = label[pi], label[pj + shift]
            if surely is None:
                _, first = np.unique(np.minimum(x, y) * len(label) + np.maximum(x, y), return_index=True)
            else:
                first = np.flatnonzero(x != y)
            root: dict[int, int] = {}

            def find(v: int) -> int:
                while (w := root.get(v, v)) != v:
                    root[v] = root.get(w, w)
                    v = w
                return v

            for k in np.sort(first).tolist():
                u, v = find(int(x[k])), find(int(y[k]))
                if u != v and (surely is None or surely(int(pi[k]), int(pj[k]))):
                    root[max(u, v)] = min(u, v)
                    edges.append((int(pi[k]), int(pj[k])))
            if root:
                moved = np.array(sorted(root))
                to = np.array([find(int(v)) for v in moved])
                table = np.arange(len(label))
                table[moved] = to
                label = table[label]
    return edges


def units_in(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by `names`, unit by unit, whatever the batches' borders."""
    rest = None
    for batch in batches:
        b = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(b):
            continue
        keys = b[names].to_numpy()
        borders = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        starts = [0, *borders.tolist()]
        for s, e in zip(starts, starts[1:], strict=False):
            yield b.iloc[s:e]
        rest = b.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def links(classes: DataFrame, radius: int, tile: int = TILE, verified: float | None = None, sets=None) -> DataFrame:
    """c (a number), d, f of classes -> a, b: nodes within the radius, enough of them
    to connect all that are. With `verified`, only nodes count whose shingle sets
    have that Jaccard similarity or more; `sets(wanted)` gives the sets of classes."""
    names = ["block", "key", "t", "u"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[np.ndarray] = []
        for unit in units_in(batches, names):
            if len(unit) < 2:
                continue
            d, c, f, side = unit["d"].to_numpy(), unit["c"].to_numpy(), unit["f"].to_numpy(), unit["side"].to_numpy()
            bits = f.view(np.uint64)
            order = np.lexsort((c, f, np.bitwise_count(bits), side))
            d, c, bits = d[order], c[order], bits[order]
            na = int((side == 0).sum())
            one = unit["t"].iat[0] == unit["u"].iat[0]
            may, hold, shift = None, None, 0 if one else na
            if verified is not None:
                held = Sets(unit["h"].iloc[order].tolist(), verified)
                hold = lambda i, j, held=held, shift=shift: held.hold(i, j + shift)
                if len(unit) > 32:
                    may = lambda i, j, held=held, shift=shift: held.may(i, j + shift)
            if one:
                found = forest(bits, None, radius, may, surely=hold)
            else:
                found = [(i, j + na) for i, j in forest(bits[:na], bits[na:], radius, may, surely=hold)] if 0 < na < len(bits) else []
            if found:
                i, j = np.array(found).T
                out.append(np.stack([d[i], c[i], d[j], c[j]], 1))
            if sum(map(len, out)) > 50_000:
                yield pd.DataFrame(np.concatenate(out), columns=["ad", "ac", "bd", "bc"])
                out = []
        if out:
            yield pd.DataFrame(np.concatenate(out), columns=["ad", "ac", "bd", "bc"])

    dealt, have = into_units(classes.drop("g", "t"), radius, tile), ["c", "d", "f"]
    if verified is not None:
        dealt = cut(dealt)
        wanted = classes.join(dealt.select("c").distinct(), "c", "left_semi").select("c", "d", "t", "g")
        dealt, have = dealt.join(sets(cut(wanted)), "c"), [*have, "h"]
    dealt = dealt.select(*have, *names, "side").repartition(*names).sortWithinPartitions(*names)
    pairs = dealt.mapInPandas(compare, "ad long, ac long, bd long, bc long")
    node = lambda x: F.struct(F.col(f"{x}d").alias("d"), F.col(f"{x}c").alias("c")).alias(x)
    return pairs.select(node("a"), node("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """a, b (any orderable type) -> node, root: the least node of its component,
    for nodes that have an edge. Alternating large and small stars; a hub's edges
    are rows, never a list."""
    e = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct())
    state = lambda x: tuple(x.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
    last = state(e)
    while last[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = out.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = out.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = cut(moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        now = state(e)
        if now == last:
            break
        last = now
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)


def cluster(docs: DataFrame, shingle: int = 4, radius: int = 4, tile: int = TILE, verified: float | None = None, bands: bool = False) -> DataFrame:
    """doc_id, f, component_id (the least doc_id that can be reached) and, with
    `verified`, g, for each row; and `first`: whether the row is of the class and
    has the id that stand for its component. Null ids count as the greatest.

    With `verified`, only links between texts whose shingle sets have that Jaccard
    similarity or more count (see `Sets`). With `bands`, only classes that share a
    key of a band are compared: for radii that blocks of bits can't prune."""
    marked = cut(fingerprints(docs, shingle, sets=verified is not None, banded=bands))
    of_class = "f" if verified is None else "g"
    id_ = id_of()
    least = F.min(F.struct(id_.alias("d"), *[x for x in marked.columns if x not in ("doc_id", of_class)])).alias("least")
    classes = marked.groupBy(of_class).agg(F.count("*").alias("n"), least).select(of_class, "n", "least.*")
    classes = cut(classes.withColumn("c", F.col("f") if verified is None else F.monotonically_increasing_id()))
    edges = links(classes.drop("n"), radius, tile, verified, lambda wanted: shingle_sets(docs, shingle, wanted))
    roots = components(edges).select(F.col("node.c").alias("c"), F.col("root.d").alias("r"), F.col("root.c").alias("_rc"))
    # Only classes with several rows or links have to be told anything.
    told = classes.join(roots, "c", "left").filter("n > 1 OR r IS NOT NULL")
    told = told.select(of_class, F.coalesce("r", "d").alias("r"), F.coalesce(F.col("_rc") == F.col("c"), F.lit(True)).alias("root"))
    rows = marked.select("doc_id", "f", *{of_class} - {"f"}).join(checked_broadcast(cut(told)), of_class, "left")
    component = F.coalesce(F.nullif("r", F.lit(NO_ID)), "doc_id")
    first = F.coalesce("root", F.lit(True)) & (F.col("r").isNull() | (id_ == F.col("r")))
    return rows.select("doc_id", "f", *{of_class} - {"f"}, component.alias("component_id"), first.alias("first"))


def _set_digests(text: Column, shingle: int) -> Column:
    @F.pandas_udf("binary")
    def digests(texts: pd.Series) -> pd.Series:
        return pd.Series([set_digest(np.unique(shingle_hashes(t, shingle))) for t in texts], dtype=object)

    return digests(text)


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 24, verified: float = 0.8, bands: bool = True) -> DataFrame:
    """The rows of `docs`, of each group the one with the least doc_id only.

    Two texts with a Jaccard similarity of 0.8 differ in about 10 of 64 bits, one
    in ten such pairs in more than 15; the radius leaves room. Blocks of bits can't
    prune at that radius, so texts meet by bands; links are verified where they are
    found. Without `bands` all texts are compared with all, tile by tile, and only
    population counts prune.

    Rows are told apart by id where ids are unique. Rows that share an id, or have
    none, are told apart by id and shingle set: such with different texts are
    documents of their own; of such with equal sets one is kept, the one with the
    least hash of its columns. Columns may have any names: a row is one value until
    the end."""
    found = cut(cluster(docs, shingle, radius, verified=verified, bands=bands))
    have = quoted(docs.columns)
    again = checked_broadcast(cut(found.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_d"))))
    gone = cut(found.filter("NOT first AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_d")).distinct())
    rows = docs.select(F.struct(*have).alias("_row"), F.col("doc_id").alias("_i"))
    kept = rows.join(checked_broadcast(gone), F.expr("_i = _d"), "left_anti").join(again, F.expr("_i <=> _d"), "left_anti").select("_row.*")
    if again.isEmpty():
        return kept
    rows = docs.select(F.struct(*have).alias("_row"), F.col("doc_id").alias("_i"), text_of().alias("_t"))
    shared = rows.join(again, F.expr("_i <=> _d"), "left_semi")
    firsts = found.filter("first").join(again, F.expr("doc_id <=> _d"), "left_semi").select(F.col("doc_id").alias("_d"), F.col("g").alias("_g")).distinct()
    shared = shared.select("_row", "_i", _set_digests(F.col("_t"), shingle).alias("_h"), F.xxhash64("_t", F.to_json("_row")).alias("_o"))
    shared = shared.join(checked_broadcast(cut(firsts)), F.expr("_i <=> _d AND _h = _g"), "left_semi")
    once = shared.groupBy("_i", "_h").agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")
    return kept.unionByName(once).select(*have)


def hexed(f: Column) -> Column:
    return F.lpad(F.lower(F.hex(f)), 16, "0")
