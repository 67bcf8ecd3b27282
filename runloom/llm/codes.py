"""Vector codes by parts, learned in integers: each part of a vector is named by the
nearest entry of its position's codebook.

Vectors are dealt into chunks. In a chunk each part position has a metric tree,
made middle-out: about as many anchors as the square root of its points are chosen,
each the point that is furthest from its own anchor, and takes over the points that
are nearer to it (those less than half as far from their anchor as the two anchors
are from each other need no look); anchors' balls are merged upwards, two by two,
those that give the smallest ball first, and are made in the same way inside. A
ball keeps its points' sum and number.

To assign, a ball inherits the entries that its parent could not rule out, and rules
out those that are further than the nearest one for every point that it may hold.
With one entry left, the ball is wholly owned: its sum and number are all that a
round needs, and no point is looked at. Leaves look at their points. Distances of
balls are floating numbers, with slack towards keeping entries; those of points
are exact integers, so the result is that of comparing all. Trees are built once,
written to the shared folder and read by each round; tasks add up what they own, and
only codebooks come to the driver.

Defined results: vectors that are null, or hold null or non-finite components, are
dropped; so are those with another number of components than the first one kept. A
number of components that the parts don't divide is cut as evenly as can be; a part
without components has code 0. Components are held to 2 ** 24 on either side. The
first entries are the vectors of the smallest ids, nulls last, ties by components;
with fewer vectors there are fewer entries. Repeated ids are vectors of their own;
equal vectors get equal codes. An empty table gives an empty result; other columns
are left out.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, given_id, id_of

PARTS, ENTRIES, ROUNDS, SCALE, LIMIT = 16, 64, 2, 256, 1 << 24
#: Points of a leaf, components of a chunk.
LEAF, CHUNK_CELLS = 32, 1 << 18
CHUNK = "ids array<long>, labels array<string>, trees binary"
SUMS = "part int, entry int, n long, sums array<long>"
CODES = "vec_id long, label string, code string, error long"


def borders(size: int, parts: int) -> list[int]:
    return [size * k // parts for k in range(parts + 1)]


def _anchors(points: np.ndarray, most: int) -> np.ndarray:
    """The anchor, by number, of each point."""
    owner = np.zeros(len(points), np.int64)
    pivots = [0]
    away = np.sqrt(((points - points[0]) ** 2).sum(1))
    while len(pivots) < most:
        new = int(away.argmax())
        if away[new] == 0:
            break
        between = np.sqrt(((points[pivots] - points[new]) ** 2).sum(1))
        look = np.flatnonzero(2 * away > between[owner])
        d = np.sqrt(((points[look] - points[new]) ** 2).sum(1))
        nearer = d < away[look]
        owner[look[nearer]], away[look[nearer]] = len(pivots), d[nearer]
        pivots.append(new)
    return owner


class BallTree:
    """Balls over the points of a chunk: an anchors hierarchy."""

    FIELDS = ("order", "points", "children", "first", "last", "sums", "centres", "radii")

    def __init__(self, points: np.ndarray):
        self._real, self._children = points.astype(np.float64), []
        self._members: list[np.ndarray | None] = []
        root = self._made(np.arange(len(points)))
        n = len(self._children)
        self.children = np.array(self._children).reshape(n, 2)
        self.first, self.last, order = np.zeros(n, np.int64), np.zeros(n, np.int64), []
        stack, size = [(root, False)], 0
        while stack:
            node, done = stack.pop()
            a, b = self._children[node]
            if done:
                self.first[node], self.last[node] = self.first[a], self.last[b]
            elif a < 0:
                order.append(self._members[node])
                self.first[node], self.last[node] = size, size + len(order[-1])
                size = int(self.last[node])
            else:
                stack += [(node, True), (b, False), (a, False)]
        self.order = np.concatenate(order)
        self.points = points[self.order]
        so_far = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(self.points, axis=0)])
        self.sums = so_far[self.last] - so_far[self.first]
        self.centres = self.sums / (self.last - self.first)[:, None]
        far = lambda i: ((self.points[self.first[i] : self.last[i]] - self.centres[i]) ** 2).sum(1).max()
        self.radii = np.sqrt([far(i) for i in range(n)]) * (1 + 1e-9) + 1e-9
        # The root first: numbers are turned round.
        turned = n - 1 - np.arange(n)
        self.children = np.where(self.children < 0, -1, n - 1 - self.children)[turned]
        for f in ("first", "last", "sums", "centres", "radii"):
            setattr(self, f, getattr(self, f)[turned])
        del self._real, self._members, self._children

    def _node(self, children: tuple[int, int], members: np.ndarray | None) -> int:
        self._children.append(children)
        self._members.append(members)
        return len(self._children) - 1

    def _made(self, members: np.ndarray) -> int:
        if len(members) <= LEAF:
            return self._node((-1, -1), members)
        owner = _anchors(self._real[members], round(len(members) ** 0.5))
        n = int(owner.max()) + 1
        if n == 1:
            return self._node((-1, -1), members)
        groups = [members[owner == k] for k in range(n)]
        nodes = [self._made(g) for g in groups]
        number = np.array([len(g) for g in groups], float)
        centre = np.array([self._real[g].mean(0) for g in groups])
        radius = np.array([np.sqrt(((self._real[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre, strict=True)])
        cost = np.array([self._together(k, number, centre, radius) for k in range(n)])
        np.fill_diagonal(cost, np.inf)
        node = nodes[0]
        for _ in range(n - 1):
            a, b = divmod(int(cost.argmin()), n)
            node = nodes[a] = self._node((nodes[a], nodes[b]), None)
            radius[a] = cost[a, b]
            centre[a] = (number[a] * centre[a] + number[b] * centre[b]) / (number[a] + number[b])
            number[a] += number[b]
            gone = np.isinf(cost[a])
            cost[b], cost[:, b] = np.inf, np.inf
            new = self._together(a, number, centre, radius)
            new[gone] = np.inf
            new[[a, b]] = np.inf
            cost[a], cost[:, a] = new, new
        return node

    @staticmethod
    def _together(k: int, number: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The radius of the ball around ball k and each other."""
        apart, share = np.sqrt(((centre - centre[k]) ** 2).sum(1)), number / (number + number[k])
        return np.maximum(apart * share + radius[k], apart * (1 - share) + radius)

    def assigned(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each point's nearest entry, and the number and sum of each entry's points."""
        n, size = entries.shape
        real, seen = entries.astype(np.float64), {}
        apart = np.sqrt(((real[:, None] - real[None]) ** 2).sum(2))
        code, counts, sums = np.empty(len(self.order), np.int64), np.zeros(n, np.int64), np.zeros((n, size), np.int64)
        # Of equal entries only the first can be the nearest.
        firsts = np.array([seen.setdefault(tuple(e), k) == k for k, e in enumerate(entries.tolist())])
        nodes, left = np.zeros(1, np.int64), firsts[None]
        while len(nodes):
            d = np.where(left, ((self.centres[nodes][:, None] - real[None]) ** 2).sum(2), np.inf)
            best = d.argmin(1)
            least = d[np.arange(len(nodes)), best][:, None]
            reach = 2 * self.radii[nodes][:, None] * apart[best] + 1e-6 + 1e-12 * (d + least)
            left = left & ~(d - least > reach)
            owned = left.sum(1) == 1
            for node, entry in zip(nodes[owned].tolist(), best[owned].tolist(), strict=True):
                a, b = self.first[node], self.last[node]
                code[self.order[a:b]] = entry
                counts[entry] += b - a
                sums[entry] += self.sums[node]
            leaf = ~owned & (self.children[nodes, 0] < 0)
            for node, may in zip(nodes[leaf].tolist(), left[leaf], strict=True):
                a, b, entry = self.first[node], self.last[node], np.flatnonzero(may)
                points = self.points[a:b]
                near = entry[((points[:, None] - entries[entry][None]) ** 2).sum(2).argmin(1)]
                code[self.order[a:b]] = near
                np.add.at(counts, near, 1)
                np.add.at(sums, near, points)
            inner = ~owned & ~leaf
            nodes, left = self.children[nodes[inner]].ravel(), np.repeat(left[inner], 2, axis=0)
        return code, counts, sums


def _written(trees: list[BallTree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{f}{k}": getattr(t, f) for k, t in enumerate(trees) for f in BallTree.FIELDS})
    return out.getvalue()


def _read(data: bytes, parts: int) -> list[BallTree]:
    with np.load(io.BytesIO(data)) as found:
        trees = []
        for k in range(parts):
            tree = BallTree.__new__(BallTree)
            for f in BallTree.FIELDS:
                setattr(tree, f, found[f"{f}{k}"])
            trees.append(tree)
    return trees


def whole(vector: Column) -> Column:
    """No vector of nulls or of components that are not finite."""
    bad = lambda x: x.isNull() | ~(F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def integers(vector: Column) -> Column:
    held = lambda x: F.greatest(F.least(F.floor(x.cast("double") * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    return F.transform(vector, held)


def chunks(vectors: DataFrame, size: int, parts: int) -> DataFrame:
    """vec_id, label, v (integers) -> the chunks and the trees of their parts."""
    rows, at = max(256, CHUNK_CELLS // max(size, 1)), borders(size, parts)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def built() -> pd.DataFrame:
            b = pd.concat(held, ignore_index=True)
            cells = np.array(b["v"].tolist(), np.int64).reshape(len(b), size)
            trees = [BallTree(cells[:, i:j]) for i, j in zip(at, at[1:], strict=False)]
            return pd.DataFrame({"ids": [b["vec_id"].to_numpy()], "labels": [b["label"].tolist()], "trees": [_written(trees)]})

        for b in batches:
            for k in range(0, len(b), rows):
                held.append(b.iloc[k : k + rows])
                n += len(held[-1])
                if n >= rows:
                    yield built()
                    held, n = [], 0
        if held:
            yield built()

    return vectors.mapInPandas(build, CHUNK)


def owned(trees: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """part, entry, n, sums: what each task's balls and points give to each entry."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, sums = [np.zeros(len(c), np.int64) for c in codebooks], [np.zeros(c.shape, np.int64) for c in codebooks]
        for b in batches:
            for data in b["trees"]:
                for k, (tree, entries) in enumerate(zip(_read(data, len(codebooks)), codebooks, strict=True)):
                    _, n, s = tree.assigned(entries)
                    counts[k] += n
                    sums[k] += s
        found = [(k, e, int(n), s.tolist()) for k in range(len(codebooks)) for e, (n, s) in enumerate(zip(counts[k], sums[k], strict=True)) if n]
        yield pd.DataFrame(found, columns=["part", "entry", "n", "sums"])

    return trees.select("trees").mapInPandas(add_up, SUMS)


def moved(trees: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round: each entry the mean of its parts, rounded down."""
    widest = max(c.shape[1] for c in codebooks)
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(widest)]
    out = [c.copy() for c in codebooks]
    # Bounded: a row for each part position and entry.
    for r in owned(trees, codebooks).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        out[r.part][r.entry] = [r[f"s{i}"] // r.n for i in range(out[r.part].shape[1])]
    return out


def encoded(trees: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits for each part), error."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, labels, data in zip(b["ids"], b["labels"], b["trees"], strict=True):
                codes, error = np.empty((len(ids), len(codebooks)), np.uint8), np.zeros(len(ids), np.int64)
                for k, (tree, entries) in enumerate(zip(_read(data, len(codebooks)), codebooks, strict=True)):
                    code, _, _ = tree.assigned(entries)
                    codes[:, k] = code
                    error[tree.order] += ((tree.points - entries[code[tree.order]]) ** 2).sum(1)
                yield pd.DataFrame({"vec_id": ids, "label": labels, "code": [c.tobytes().hex() for c in codes], "error": error})

    return trees.mapInPandas(encode, CODES)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label (as text), code, error, label_error, codebooks_sha256 of all
    vectors kept. At most 256 entries have two hex digits."""
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits tells 256 entries apart")
    kept = vectors.filter(whole(F.col("embedding"))).select(id_of("vec_id"), F.col("label").cast("string").alias("label"), integers(F.col("embedding")).alias("v"))
    # Bounded by the number of entries; ids that are null are the largest number.
    first = [r.v for r in kept.orderBy("vec_id", "v").limit(1).collect()]
    size = len(first[0]) if first else 0
    kept = kept.filter(F.size("v") == size)
    start = [r.v for r in kept.orderBy("vec_id", "v").limit(entries).collect()]
    start = np.array(start, np.int64).reshape(len(start), size)
    codebooks = [start[:, i:j] for i, j in zip(borders(size, parts), borders(size, parts)[1:], strict=False)]
    trees = cut(chunks(kept, size, parts))
    for _ in range(rounds if len(start) else 0):
        codebooks = moved(trees, codebooks)
    digest = hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()
    found = cut(encoded(trees, codebooks))
    of_label = checked_broadcast(cut(found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))))
    rows = found.join(of_label, F.col("label").eqNullSafe(F.col("_label")))
    return rows.select(given_id("vec_id"), "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
