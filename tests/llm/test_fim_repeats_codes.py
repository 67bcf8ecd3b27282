"""Fill-in-the-middle, repeated windows and vector codes against brute force, with
nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from runloom.llm import codes, fim, repeats

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)
LONG = "".join(random.Random(1).choice(["word ", "é", "𝔘", "\n", "Ab", "7"]) for _ in range(200_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "one two. 𝔘 three"), (5, "a <P> mark"), (5, "a <P> mark"), (6, LONG), (None, "<S <M <P> no id"), (8, "x"), (9, "<<S"), (9, "<<S"), (10, "word " * 40), (10, "word " * 40)]
CLASHES = ("n", "form", "output", "file", "first", "second", "range", "numbers", "kept", "end", "spans", "v", "trees", "code", "error", "_label", "ids", "a.b", "x`y")


def with_clashes(df):
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES if c not in df.columns])


@pytest.fixture(scope="module")
def odd(spark):
    return with_clashes(spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3))


# Fill-in-the-middle


def rewritten(doc_id, text):
    text, units = text or "", UNIT.findall(text or "")
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return (n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("block", [7, fim.BLOCK])
def test_fill_in_middle_as_by_plain_lists(odd, block):
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fim.fill_in_middle(odd, block=block).collect()), key=str)
    assert got == sorted(((i, *rewritten(i, t)) for i, t in TEXTS), key=str)
    assert fim.fill_in_middle(odd.limit(0)).count() == 0


def test_texts_are_restored_from_output_and_form(odd):
    rows = fim.fill_in_middle(odd, rate=100, suffix_first=50)
    got = sorted(((r.doc_id, r.text) for r in rows.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()), key=str)
    assert got == sorted(((i, t or "") for i, t in TEXTS), key=str)
    assert {r.form for r in rows.select("form").collect()} == {"plain", "psm", "spm"}


def test_blocks_lead_to_every_unit():
    rand = random.Random(3)
    for _ in range(300):
        text = "".join(rand.choice("abZ .\né𝔘ß9\x00") for _ in range(rand.randrange(60)))
        units, block = UNIT.findall(text), rand.choice([1, 2, 3, 5, 8, 64])
        tree = fim.BlockTree(text.encode(), block)
        assert (tree.units, tree.points) == (len(units), len(text))
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert tree.place(k) == (len(before.encode()), len(before))


def test_stretches_that_part_a_run_of_letters(monkeypatch):
    monkeypatch.setattr(fim, "STRETCH", 16)
    text = "abc" * 30 + "é" + "d" * 40 + "1"
    assert fim.BlockTree(text.encode(), 8).units == 4


# Repeats


def without_repeats(docs, window):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    seen = collections.Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=str)


def found(df, window):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(df, window).collect()), key=str)


@pytest.mark.parametrize("window", [1, 2, 5, 6, 35])
def test_repeats_as_by_a_counter(spark, window):
    rand = random.Random(window)
    passages = [" ".join(rand.choice("ab") for _ in range(rand.randrange(60))) for _ in range(30)]
    free = lambda: " ".join(f"w{rand.randrange(1000)}" for _ in range(rand.randrange(30)))
    docs = [(k, rand.choice(" \n").join(rand.choice(passages) if rand.random() < 0.5 else free() for _ in range(rand.randrange(4)))) for k in range(200)]
    assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), window) == without_repeats(docs, window)


def test_repeats_in_odd_rows(odd):
    want = without_repeats(TEXTS, 35)
    assert found(odd, 35) == want
    assert {r[2] for r in want if r[0] == 10} == {40}
    assert found(odd.limit(0), 35) == []


def test_repeats_in_one_text_and_their_spans(spark):
    passage = [f"p{k}" for k in range(50)]
    text = " ".join(["a", *passage, "b", "c", *passage, "d"])
    row = repeats.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(s) for s in row.spans] == [(1, 51), (53, 103)] and row.kept == "a b c d"


def test_a_passage_of_all_documents_is_one_number_a_file(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own"), F.col("id").cast("string"), F.lit(f" {passage}")).alias("text"), F.lit(7).alias("file"))
    numbers = repeats.probes(docs.withColumn("text", F.col("text").cast("binary")).coalesce(1), 18, 4)
    assert numbers.selectExpr("sum(length(numbers)) / 4 AS n").first().n == 2000 + 43  # windows with the own word, and those of the passage
    rows = repeats.remove_repeats(docs.repartition(4)).collect()
    assert {(r.n_words, r.n_removed) for r in rows} == {(61, 60)} and {r.kept for r in rows} == {f"own{k}" for k in range(2000)}


def test_words_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 8)
    long = [("x" * k + f"{k}").encode() for k in range(1, 60)]
    words = repeats.Words([b" ".join(long), b"", b" ".join(long[5:])])
    h = words.hashed(repeats.FIRST)
    assert len(set(h[:59].tolist())) == 59 and (h[5:59] == h[59:]).all() and words.sizes.tolist() == [59, 0, 54]


# Codes


def coded(rows, parts=16, entries=64):
    """vec_id -> code, error by comparing all, with Python's integers."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = len(kept[0][1]) if kept else 0
    at = [size * k // parts for k in range(parts + 1)]
    first = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]]
    books = [[v[a:b] for v in first] for a, b in zip(at, at[1:], strict=False)]
    near = lambda p, book: min(range(len(book)), key=lambda e: (sum((x - y) ** 2 for x, y in zip(p, book[e], strict=True)), e))
    for _ in range(2):
        for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            groups = collections.defaultdict(list)
            for _, v in kept:
                groups[near(v[a:b], books[k])].append(v[a:b])
            for e, members in groups.items():
                books[k][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = []
    for i, v in kept:
        chosen = [near(v[a:b], books[k]) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
        error = sum((x - y) ** 2 for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) for x, y in zip(v[a:b], books[k][chosen[k]], strict=True))
        out.append((i, "".join(f"{c:02x}" for c in chosen), error))
    return sorted(out, key=str), hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("n", "size", "spread"), [(400, 64, 1.0), (300, 32, 0.01), (40, 48, 0.5), (120, 20, 1.0)])
def test_codes_as_by_comparing_all(spark, n, size, spread):
    rand = np.random.default_rng(n)
    rows = [(k, [float(np.float32(x)) for x in rand.normal(0, spread, size)], None if k % 5 == 0 else k % 3) for k in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [None] * size, 1), (n + 3, [float("nan")] * size, 1), (n + 4, [float("inf")] * size, 1), (None, rows[3][1], None), (7, rows[8][1], 1)]
    got = codes.compress(with_clashes(spark.createDataFrame(rows, VECTORS).repartition(3))).collect()
    want, digest = coded(rows)
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=str) == want and {r.codebooks_sha256 for r in got} == {digest}
    sums = collections.Counter()
    for r in got:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in got)


def test_codes_of_odd_tables(spark):
    df = lambda rows: spark.createDataFrame(rows, VECTORS)
    assert codes.compress(df([])).count() == 0
    assert codes.compress(df([(1, None, 1), (2, [None], 1)])).count() == 0
    assert [(r.vec_id, r.code, r.error) for r in codes.compress(df([(1, [], 1), (2, [1.0], 1)])).collect()] == [(1, "00" * 16, 0)]
    same = codes.compress(df([(k, [0.5] * 64, None) for k in range(500)])).collect()
    assert {(r.code, r.error, r.label_error) for r in same} == {("00" * 16, 0, 0)}
    far = codes.compress(df([(k, [3e38 * (-1) ** k] * 16, k) for k in range(4)])).collect()
    assert {r.vec_id: (r.code, r.error) for r in far} == {k: (f"{k % 2:02x}" * 16, 0) for k in range(4)}


def test_balls_owned_as_a_whole_are_not_looked_through():
    rand = np.random.default_rng(2)
    points = np.concatenate([rand.integers(-3, 4, (800, 4)) + 200 * rand.integers(-4, 5, 4) for _ in range(5)])
    tree = codes.BallTree(points)
    entries = points[::63]
    code, n, sums = tree.assigned(entries)
    want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (code == want).all() and (n == np.bincount(want, minlength=len(entries))).all()
    few = points[[0, 800, 1600, 2400, 3200]]
    tree.points = tree.points * 0  # a point that is looked at now goes astray
    assert (tree.assigned(few)[0] == ((points[:, None] - few[None]) ** 2).sum(2).argmin(1)).all()
