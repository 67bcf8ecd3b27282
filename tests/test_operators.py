"""Operators on small literal inputs, and properties."""

import gzip
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runloom.functions import barcodes as B
from runloom.functions import names as N
from runloom.operators import barcodes as C
from runloom.operators import grouping as G
from runloom.operators import lengths as L
from runloom.operators import pairing as P
from runloom.operators import registry as R
from runloom.operators import stats as S
from runloom.sources import fastq, pieces, qc, tables
from runloom.streaming import incremental


def apart(a, b):
    return len(a) != len(b) or sum(x != y or x == "N" or y == "N" for x, y in zip(a, b, strict=True))


def greedy(counts, mismatches):
    left, out = sorted(counts, key=lambda x: (-x[1], x[0])), {}
    while left:
        ref = left.pop(0)[0]
        taken = [x for x in left if apart(x[0], ref) is not True and apart(x[0], ref) <= mismatches]
        out[ref] = {ref, *(x[0] for x in taken)}
        left = [x for x in left if x not in taken]
    return out


@pytest.mark.parametrize("mismatches", [0, 1, 2])
def test_both_ways_of_grouping_are_greedy(spark, mismatches):
    import random

    r = random.Random(mismatches)
    found = {"".join(r.choice("ACGTN" if r.random() < 0.1 else "ACG") for _ in range(6)): r.randint(1, 30) for _ in range(150)}
    df = spark.createDataFrame([(1, b, n) for b, n in found.items()], "lane int, barcode string, n long")
    ranked = G.in_rank_order(df)
    want = greedy(list(found.items()), mismatches)
    for way in (G.group_in_lanes, G.group_by_matches, lambda r, m: G.group_by_matches(r, m, rows=3)):
        got = {}
        for x in way(ranked, mismatches).collect():
            got.setdefault(x.reference, set()).add(x.barcode)
        assert got == want


def test_groups_below_the_cutoff_go_after_taking_members(spark):
    df = spark.createDataFrame([(1, "AAAA", 60), (1, "AAAC", 20), (1, "GGGG", 15), (1, "GGGC", 5)], "lane int, barcode string, n long")
    assert [tuple(x) for x in G.grouped(df, 1, cutoff=0.25).collect()] == [(1, "AAAA", 2, 80)]


def test_hamming(spark):
    df = spark.createDataFrame([("ACGT", "ACGA"), ("ACGN", "ACGN"), ("AC", "ACG")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = df.select(B.hamming(a, b), B.hamming_truncated(a, b), B.hamming_with_n(a, b)).collect()
    assert [tuple(x) for x in rows] == [(1, 1, 1), (0, 0, 1), (None, 0, None)]


def test_matching_is_by_index(spark):
    df = spark.createDataFrame([("AAAA+CCCC", "AAAT+CCCG", 1), ("AATT+CCCC", "AAAA+CCCC", 1), ("AAAA", "AAAA+CCCC", 2)], "a string, b string, m int")
    assert [x[0] for x in df.select(B.matches(F.col("a"), F.col("b"), F.col("m"))).collect()] == [True, False, False]


def test_names(spark):
    cases = {
        "PB1_S4_L002_R2_001.fastq.gz": ("PB1", 4, None, 2, 2, 1, False), "LIV_a_ACAGTG_L003_R1_001.fastq": ("LIV_a", None, "ACAGTG", 3, 1, 1, False),
        "sample_x_I1.fastq": ("sample_x", None, None, None, 1, None, True), "R1": ("R1", None, None, None, None, None, False),
    }
    df = spark.createDataFrame([(k,) for k in cases], "f string")
    a = N.illumina_attrs(F.col("f"))
    for row in df.select("f", *[c.alias(k) for k, c in a.items()], N.basename(F.col("f")).alias("base"), N.changed(F.col("f")).alias("again")).collect():
        assert tuple(row)[1:8] == cases[row.f]
        assert row.base == row.again


def test_length_stats_of_an_all_masked_file(spark):
    df = spark.createDataFrame([("f", "NNN", "!!!"), ("f", "NN", "!!"), ("g", "NAC", "!!!"), ("g", "AC", "II")], "file string, sequence string, quality string")
    rows = {x.file: x for x in L.length_stats(df).collect()}
    assert (rows["f"].n_masked, rows["f"].n_padded, rows["f"].median_length) == (2, 0, 2)
    assert (rows["g"].n_masked, rows["g"].n_padded, rows["g"].frac_padded) == (0, 1, 50.0)
    assert L.length_stats(df.limit(0)).collect() == []


def test_fastq_files(spark, tmp_path):
    one = "@M:1:FC:2:1:1:1 1:N:0:AC-GT\n@CGT\n+\n@III\n@M:1:FC:2:1:1:2 1:N:0:AC\nAC\n+x\nII\n"
    with gzip.open(tmp_path / "a_R1.fastq.gz", "wt") as f:
        f.write(one)
    (tmp_path / "b_R1.fastq.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "c_R1.fastq").write_text("@x\nAC\n+\nI\n")
    rows = fastq.read_fastq(spark, str(tmp_path), "a_*").collect()
    assert [(r.read_idx, r.sequence, r.quality, r.lane, r.barcode) for r in rows] == [(0, "@CGT", "@III", 2, "AC+GT"), (1, "AC", "II", 2, "AC")]
    assert len(fastq.read_fastq(spark, str(tmp_path), "a_*", limit=1).collect()) == 1
    ok = {r.file.rsplit("/", 1)[1]: r.ok for r in fastq.check_fastq(spark, str(tmp_path)).collect()}
    assert ok == {"a_R1.fastq.gz": True, "b_R1.fastq.gz": True, "c_R1.fastq": False}


def test_counts_files_of_both_shapes(spark):
    lines = spark.createDataFrame([("#Lane\tRank\tSequence\tCount",), ("1\t1\tAC-GT\t5",), ("x\t1\tAA\t3",), ("1\tCC\t2",), ("bad",)], "value string")
    rows = sorted(((r.lane, r.barcode, r.n, r.error) for r in tables.parse_counts(lines).collect()), key=str)
    assert (1, "AC+GT", 5, None) in rows and (None, "AA", 3, None) in rows and (None, "CC", 2, None) in rows
    assert sum(r[3] is not None for r in rows) == 1


def test_sheet_file(spark, tmp_path):
    (tmp_path / "s.csv").write_text("[Header]\nx,y\n[Data]\nLane,Sample_ID,Sample_Name,Sample_Project,index,index2\n1,A,A,P,ACG,TTT\n2,B,B,P,,\n")
    rows = sorted((r.lane, r.sample, r.project, r.index_seq) for r in tables.read_sheet(spark, str(tmp_path / "s.csv")).collect())
    assert rows == [(1, "A", "P", "ACG+TTT"), (2, "B", "P", "")]


def test_pairs_by_header(spark):
    reads = spark.createDataFrame([("x", 0, "k", 1), ("x", 1, "z", 1), ("y", 0, "k", 2), ("w", 0, "q", 1)], "file string, read_idx long, name_key string, read_number int")
    assert sorted(map(tuple, P.pairs_by_header(reads).collect()), key=str) == [("w", None), ("x", "y")]


def random_counts(seed, lanes=2, n=150, dual=False):
    import random

    r = random.Random(seed)
    one = lambda: "".join(r.choice("ACGTN" if r.random() < 0.1 else "ACG") for _ in range(5))
    return [(lane, one() + ("+" + one() if dual else ""), r.randint(1, 9)) for lane in range(1, lanes + 1) for _ in range(n)]


def counted(spark, rows):
    df = spark.createDataFrame(rows, "lane int, barcode string, n long")
    return df.groupBy("lane", "barcode").agg(F.sum("n").alias("n"))


def test_places_are_those_of_a_plain_sort(spark):
    df = counted(spark, [*random_counts(3), *[(None, b, n) for _, b, n in random_counts(4, 1, 20)]])
    lanes, want = {}, {}
    for lane, barcode, n in sorted(map(tuple, df.collect()), key=lambda x: (-x[2], x[1])):
        lanes.setdefault(lane, []).append(n)
        want[lane, barcode] = (n, len(lanes[lane]), sum(lanes[lane]))
    got = {(r.lane, r.barcode): (r.n, r["rank"], r.cumulative) for r in C.placed(df).collect()}
    assert got == want
    assert {r.lane: r.lane_total for r in C.placed(df).collect()} == {k: sum(v) for k, v in lanes.items()}
    order = [(r.lane, r["rank"]) for r in C.in_order(df).collect()]
    assert order == sorted(order, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def greedy_in_order(rows, mismatches):
    """(barcode, n) in the order in which they become references."""
    near = lambda a, b: a.count("+") == b.count("+") and all(apart(x, y) is not True and apart(x, y) <= mismatches for x, y in zip(a.split("+"), b.split("+"), strict=True))
    left, out = list(rows), []
    while left:
        ref = left.pop(0)
        taken = [x for x in left if near(x[0], ref[0])]
        out.append((ref[0], 1 + len(taken), ref[1] + sum(x[1] for x in taken)))
        left = [x for x in left if x not in taken]
    return out


@pytest.mark.parametrize("dual", [False, True])
def test_seeded_groups_are_those_of_a_plain_loop(spark, dual):
    """Seeds come first, in the order given, whatever their counts; without an order by
    barcode."""
    df = counted(spark, random_counts(5, 2, 100, dual))
    found = [tuple(x) for x in df.collect()]
    for ordered in (False, True):
        seeds = [(lane, b, i) for lane in (1, 2) for i, b in enumerate(sorted((b for x, b, _ in found if x == lane), key=lambda b: b[::-1])[:15])]
        sheet = spark.createDataFrame(seeds, "lane int, index_seq string, seed_order int")
        place = {(lane, b): (i if ordered else b) for lane, b, i in seeds}
        for rounds in (False, True):
            got = sorted(tuple(x) for x in G.grouped(df, 1, seeds=sheet if ordered else sheet.drop("seed_order"), by_matches=rounds).collect())
            want = []
            for lane in (1, 2):
                mine = [(b, n) for x, b, n in found if x == lane]
                first = sorted((x for x in mine if (lane, x[0]) in place), key=lambda x: place[lane, x[0]])
                rest = sorted((x for x in mine if (lane, x[0]) not in place), key=lambda x: (-x[1], x[0]))
                want += [(lane, *g) for g in greedy_in_order(first + rest, 1)]
            assert got == sorted(want)


def test_analysis_names_groups_and_counts_coverage(spark):
    df = spark.createDataFrame([(1, "AAAA", 50), (1, "AAAC", 5), (1, "GGGG", 30), (1, "GGGC", 1), (1, "CTCT", 14)], "lane int, barcode string, n long")
    sheet = spark.createDataFrame([(1, "AAAC", "rare"), (1, "GGGA", "near")], "lane int, index_seq string, sample string")
    groups = G.grouped(df, 1, cutoff=0.1, seeds=sheet).withColumnRenamed("reference", "barcode")
    rows, summary = C.analyse(df, groups, sheet, 1)
    # The sheet's rare barcode takes in its frequent neighbour, not the other way round.
    assert sorted((r.barcode, r.n, r.sample, r["rank"], r.percent) for r in rows.collect()) == [("AAAC", 55, "rare", 1, 55.0), ("CTCT", 14, None, 3, 14.0), ("GGGG", 31, "near", 2, 31.0)]
    assert [tuple(x) for x in summary.collect()] == [(1, 100, 3, 100, 100.0)]


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_pieces_find_the_references_that_trying_all_finds(spark, distance):
    import random

    r = random.Random(distance)
    make = lambda n: spark.createDataFrame([("".join(r.choice("ACG") for _ in range(r.randint(3, 6))),) for _ in range(n)], "x string").distinct()
    barcodes, refs = make(60).toDF("barcode"), make(25).toDF("index_seq")
    both = [set(map(tuple, C.near_references(barcodes, refs, distance, most).collect())) for most in (10**9, 0)]
    assert both[0] == both[1] and both[0]


def test_collisions_are_between_rows(spark):
    rows = [(1, "S1", "ACGT+AAAA", 1), (1, "S1", "ACGT+AAAC", 2), (1, "S2", "TTTT+AAAA", 3), (2, "S3", "ACGT+AAAA", 4), (1, "S4", "", 5)]
    sheet = spark.createDataFrame(rows, "lane int, sample string, index_seq string, line_no int")
    pairs = lambda *a: sorted((r.sample_a, r.sample_b, r.distance) for r in C.collisions(sheet, *a).collect())
    assert pairs(1) == [("S1", "S1", 1)] and pairs(1, "1") == [("S1", "S1", 0)]
    assert pairs(0, "2") == [("S1", "S2", 0)]
    limits = lambda x: {r.lane: r.mismatches for r in C.mismatch_limit(sheet, x).collect()}
    assert limits(None) == {1: 0, 2: 1}
    assert limits(spark.createDataFrame([(3, "ACG+TTA", 5), (4, "AC", 1)], "lane int, barcode string, n long")) == {1: 0, 2: 1, 3: 1, 4: 0}


def test_globs(spark):
    df = spark.createDataFrame([(x,) for x in ("a1", "a2", "b1", "a]", "a.b", "a^", "a!")], "x string")
    fits = lambda p: {r.x for r in df.filter(N.glob_like(F.col("x"), p)).collect()}
    assert fits("a[!1]") == {"a2", "a]", "a^", "a!"} and fits("[ab]1") == {"a1", "b1"} and fits("a?b") == {"a.b"} and fits("a[]]") == {"a]"}
    assert fits("a[^1]") == {"a1", "a^"} and fits("a[") == set() and fits("*") == {"a1", "a2", "b1", "a]", "a.b", "a^", "a!"}


def test_counts_once_after_a_lost_checkpoint(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("f", 1)] * 3 + [("g", 2)] * 2, "file string, lane int")
    rows.repartition(2).write.parquet(source)
    want = {("f", 1, 3), ("g", 2, 2)}
    for checkpoint in ("one", "two"):  # the second knows nothing of the first
        incremental.follow(spark, source, rows.schema, target, str(tmp_path / checkpoint)).awaitTermination()
        assert {tuple(x) for x in incremental.counted(spark, target).collect()} == want
    rows.write.mode("append").parquet(source)
    incremental.follow(spark, source, rows.schema, target, str(tmp_path / "two")).awaitTermination()
    assert {tuple(x) for x in incremental.counted(spark, target).collect()} == {("f", 1, 6), ("g", 2, 4)}


def test_reading_takes_no_more_memory_for_a_larger_file(tmp_path):
    """A file is streamed: the memory of its records' iterator has a small bound."""
    import tracemalloc

    record = b"@M:1:FC:2:1:1:1 1:N:0:AC\n" + b"ACGT" * 25 + b"\n+\n" + b"I" * 100 + b"\n"
    path = tmp_path / "large.fastq.gz"
    with gzip.open(path, "wb", compresslevel=1) as f:
        for _ in range(300):
            f.write(record * 1000)  # 70 MB
    tracemalloc.start()
    with open(path, "rb") as raw:
        assert sum(b.num_rows for b in pieces.records(pieces.chunks(raw, pieces.GZIP, 0, None), 0, None)) == 300_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def blocked(text, size):
    """Blocked gzip: members that say their size, and an empty one at the end."""
    import struct
    import zlib

    out = b""
    for k in [*range(0, len(text), size), len(text)]:
        part = text[k : k + size] if k < len(text) else b""
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = packer.compress(part) + packer.flush()
        head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(data) + 25)
        out += head + data + struct.pack("<II", zlib.crc32(part), len(part))
    return out


RECORDS = [(f"@M:1:FC:{k % 3}:{k}", "ACGT"[k % 4] * (k % 5), "@+I#!"[k % 5] * (k % 5)) for k in range(12)]
TEXT = "".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in RECORDS).encode()


@pytest.mark.parametrize("text", [TEXT, TEXT[:-1], TEXT.replace(b"\n", b"\r\n")])
@pytest.mark.parametrize("kind", [0, 1])
def test_records_are_the_same_wherever_a_file_is_cut(monkeypatch, text, kind):
    """Two and three pieces with borders at each byte, as Spark's tasks read them."""
    monkeypatch.setattr(pieces, "CHUNK", 16)
    data = blocked(text, 37) if kind else text
    assert pieces.kind_of(data[:18]) == kind
    for a in range(1, len(data)):
        borders = [0, a, *([a + 23] if a + 23 < len(data) else []), len(data)]
        line, got, total = 0, [], 0
        for no, (start, stop) in enumerate(zip(borders, borders[1:], strict=False)):
            p = {"file": "x", "kind": kind, "no": no, "start": start, "stop": stop, "content": data, "line": line}
            p["n_lines"] = sum(t.count(b"\n") for t, own in pieces.chunks(pieces.source("x", data), kind, start, stop) if own)
            for number, b in pieces.read_piece(p):
                got += [(number + i, *r.values()) for i, r in enumerate(b.to_pylist())]
            line += p["n_lines"]
        total = line
        assert got == [(k, *r) for k, r in enumerate(RECORDS)], a
        assert total == len(RECORDS) * 4 - (not text.endswith(b"\n"))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    for name, data in {"a_R1.fastq": TEXT * 50, "b_R1.fastq.gz": blocked(TEXT * 50, 300), "c_R1.fastq.gz": gzip.compress(TEXT * 50), "d_R1.fastq": TEXT[:-1]}.items():
        (tmp_path / name).write_bytes(data)
    short = lambda c="file": F.regexp_extract(c, "([a-z])_R1", 1).alias("f")
    for piece in (150, 1 << 20):
        rows = fastq.read_fastq(spark, str(tmp_path), piece=piece).groupBy(short()).agg(F.count("*").alias("n"), F.countDistinct("read_idx").alias("d"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("read_idx", "header", "quality"))), lambda x: F.concat(x["header"], x["quality"])), ",")).alias("h")).collect()
        assert {r.f: (r.n, r.d) for r in rows} == {"a": (600, 600), "b": (600, 600), "c": (600, 600), "d": (12, 12)} and len({r.h for r in rows if r.f != "d"}) == 1
        counted = {r.f: (r.n_reads, r.whole) for r in fastq.count_reads(spark, str(tmp_path), piece=piece).select(short(), "n_reads", "whole").collect()}
        assert counted == {"a": (600, True), "b": (600, True), "c": (600, True), "d": (12, True)}
        assert all(r.ok for r in fastq.check_fastq(spark, str(tmp_path), piece=piece).collect())
    assert pieces.dealt(pieces.files_of(spark, str(tmp_path), "a_*"), 150).rdd.getNumPartitions() > 4


def test_files_that_are_cut_off_or_spoilt(spark, tmp_path):
    spoilt = bytearray(blocked(TEXT * 5, 300))
    spoilt[400] ^= 255
    bad = {"a": TEXT[:-9], "b": bytes(spoilt), "c": gzip.compress(TEXT * 50)[:-20], "d": TEXT.replace(b"+\n", b"-\n", 1), "e": TEXT + b"@x\n"}
    for name, data in {**bad, "f": TEXT, "g": gzip.compress(b"")}.items():
        (tmp_path / f"{name}_R1.fastq").write_bytes(data)
    for piece in (90, 1 << 20):
        found = {r.file.rsplit("/", 1)[1][0]: r.ok for r in fastq.check_fastq(spark, str(tmp_path), piece=piece).collect()}
        assert found == {**dict.fromkeys("abcde", False), "f": True, "g": True}


def test_heads_read_no_more_than_they_need(spark, tmp_path):
    """The bytes that are read don't grow with the file."""
    seen = []

    class Counted:
        def __init__(self, data):
            import io

            self.raw = io.BytesIO(data)

        def read(self, n):
            data = self.raw.read(n)
            seen.append(len(data))
            return data

        def seek(self, *a):
            return self.raw.seek(*a)

    for data in (TEXT * 100_000, blocked(TEXT * 1000, 60_000) * 20):
        seen.clear()
        raw = Counted(data)
        kind = pieces.kind_of(raw.read(18))
        raw.seek(0)
        assert sum(b.num_rows for b in pieces.records(pieces.chunks(raw, kind, 0, None, pieces.HEAD_CHUNK), 0, 1)) == 1
        assert sum(seen) <= pieces.HEAD_CHUNK + 36 and sum(seen) < len(data) / 2
    (tmp_path / "a_R1.fastq").write_bytes(TEXT.replace(b"@M:1:FC:0:0", b"@M:1:FC:0:0 1:N:0:AC"))
    (tmp_path / "a_R2.fastq").write_bytes(TEXT.replace(b"@M:1:FC:0:0", b"@M:1:FC:0:0 2:N:0:AC"))
    first = fastq.heads(spark, str(tmp_path))
    assert {r.read_number for r in fastq.first_read_numbers(first).collect()} == {1, 2}
    assert [tuple(x.rsplit("/", 1)[1] for x in r) for r in P.pairs_by_header(first).collect()] == [("a_R1.fastq", "a_R2.fastq")]


def test_checksums_and_index_files(spark, tmp_path):
    import hashlib

    text = b"@M:1:FC:2:1:1:1 1:N:0:AC\nAC\n+\nII\n"
    for name in ("S1_S1_L001_R1_001.fastq", "S1_S1_L001_I1_001.fastq"):
        (tmp_path / name).write_bytes(text)
    assert {r.md5 for r in fastq.checksums(spark, str(tmp_path)).collect()} == {hashlib.md5(text).hexdigest()}
    names = lambda **k: {r.file.rsplit("_", 2)[1] for r in fastq.check_fastq(spark, str(tmp_path), **k).collect()}
    assert names() == {"R1"} and names(index_reads=True) == {"R1", "I1"}


def test_readers_of_quality_tools(spark, tmp_path):
    texts = {
        "fastqc": "##FastQC\n>>Basic Statistics\tpass\n#Measure\tValue\nTotal\t5\n>>END_MODULE\n", "summary": "PASS\tBasic Statistics\tx.fastq\nWARN\tOther\tx.fastq\n",
        "screen": "#v\nLibrary\t%Unmapped\nHuman\t12.5\n\n%Hit_no_libraries: 7.5\n", "strand": "#strand version: 0.1\n#Genome\t1st\t2nd\nHuman\t1.0\t50.0\n",
        "insert": "## METRICS CLASS\nMEAN_INSERT_SIZE\n153.7\n\n## HISTOGRAM\ninsert_size\tn\n25\t3\n", "rnaseq": ">>>>>>> Reads genomic origin\n\n    exonic = 63,784 (76.93%)\n",
        "infer": 'This is PairEnd Data\nFraction of reads failed to determine: 0.01\nFraction of reads explained by "1++,1--,2+-,2-+": 0.09\nFraction of reads explained by "1+-,1-+,2++,2--": 0.9\n',
        "cells": 'Cells,Mean\n"2,272",107.5\n', "library": 'Library or Sample,Library Type,Grouped By,Group Name,Metric Name,Metric Value\nLibrary,Gene Expression,,,Cells,"5,175"\n',
        "coverage": "#x\ty\n0.0\t1.5\n0.7\t2.5\n",
    }
    parsers = {
        "fastqc": (qc.fastqc_modules, 2), "summary": (qc.fastqc_summary, 2), "screen": (qc.screen, 2), "strand": (qc.strand, 1), "insert": (qc.insert_sizes, 2), "rnaseq": (qc.rnaseq, 1),
        "infer": (qc.strand_inference, 1), "cells": (qc.cell_summary, 2), "library": (qc.library_summary, 1), "coverage": (qc.coverage_profile, 1),
    }
    for name, text in texts.items():
        for copy in "ab":
            (tmp_path / copy).mkdir(exist_ok=True)
            (tmp_path / copy / f"{name}.txt").write_text(text)
    rows = {}
    for name, (parser, n) in parsers.items():
        rows[name] = qc.read(spark, str(tmp_path), parser, f"{name}.txt").collect()
        assert len(rows[name]) == 2 * n, name
    assert {(r.library, r.metric, r.value) for r in rows["screen"]} == {("Human", "Unmapped", 12.5), (None, "Hit_no_libraries", 7.5)}
    assert {(r.kind, r.name, r.value) for r in rows["insert"]} == {("metric", "MEAN_INSERT_SIZE", 153.7), ("histogram", "25", 3.0)}
    assert {(r.forward, r.reverse, r.undetermined, r.paired) for r in rows["infer"]} == {(0.09, 0.9, 0.01, True)}
    assert {(r.metric, r.value) for r in rows["cells"]} == {("Cells", 2272.0), ("Mean", 107.5)} and {r.y for r in rows["coverage"]} == {2.5}
    assert {r.label for r in rows["strand"]} == {"reverse"} and {r["count"] for r in rows["rnaseq"]} == {63784.0}


def test_files_are_written_by_all_tasks(spark, tmp_path):
    """A small table in one partition, whose files cost by their number (F1 to F10)."""
    from runloom.plans import queries
    from runloom.sources import text_sink

    rows = spark.range(0, 60, 1, 1).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("f"), F.col("id").cast("string").alias("t"))
    folder = Path(re.sub("^file:/+", "/", queries._written(rows, F.col("f"), F.col("t"), "spread")))
    written = sorted(str(p.relative_to(folder)) for p in folder.rglob("*.txt"))
    assert len(written) == 60 and len({w.split("/")[0] for w in written}) > 4
    assert not list(folder.glob("_temporary*")) and (folder / "_SUCCESS").exists()
    found = qc.read_texts(spark, str(folder), "*.txt").select(queries._of(), "text").collect()
    assert sorted(map(tuple, found)) == sorted((f"f{i}", f"{i}\n") for i in range(60))

    odd = [("a/b", "1"), ("a/b", "2"), ("ü +%2F=", "3"), ("_x.1.txt", None), (".hidden", "5\n6")]
    text_sink.write_texts(spark.createDataFrame(odd, "file string, text string"), f"{tmp_path}/odd")
    found = qc.read_texts(spark, f"{tmp_path}/odd", "*.txt").select(text_sink.name_of(F.col("file")), "text").collect()
    assert sorted(map(tuple, found)) == sorted((name, f"{text or ''}\n") for name, text in odd)


def test_small_files_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    """Tasks don't grow with the files while all cores have enough to do (F2 to F9)."""
    for i in range(200):
        (tmp_path / f"f{i}.txt").write_text(f"{i}\n")
    monkeypatch.setattr(qc, "TASKS_A_CORE", 1, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = qc.read_texts(spark, str(tmp_path), "*.txt")
        assert spark.read.text(str(tmp_path), wholetext=True).rdd.getNumPartitions() == 200
        assert found.rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, 7)
        assert sorted(map(tuple, found.select(F.regexp_extract("file", "f([0-9]+)[.]txt$", 1), "text").collect())) == sorted((str(i), f"{i}\n") for i in range(200))
        monkeypatch.setattr(qc, "TASKS_A_CORE", 100)
        assert qc.read_texts(spark, str(tmp_path), "*.txt").rdd.getNumPartitions() == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_plain_and_compressed_texts(spark, tmp_path):
    """Plain files are read without the text reader, whose work for each file is under a
    lock, with the same rows; compressed ones are still inflated (F2 to F9)."""
    import gzip

    texts = {"a": b"x\ty\r\n", "b c%2F+": "ü\n".encode(), "empty": b"", "bom": b"\xef\xbb\xbfz", "odd": b"\xff\xfe\x00q", "last": b"1\n2"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_bytes(text)
    found, other = (qc.read_texts(spark, str(tmp_path), p) for p in ("*.txt", "*.tx?"))
    assert ["FileScan text" in df._jdf.queryExecution().executedPlan().toString() for df in (found, other)] == [False, True]
    rows = lambda df: sorted((r.file, bytes(r.text)) for r in df.select("file", F.col("text").cast("binary")).collect())
    assert rows(found) == rows(other) and len(rows(found)) == len(texts) - 1  # neither reader has rows of empty files
    (tmp_path / "z.txt.gz").write_bytes(gzip.compress(b"whole\n"))
    assert [(f.rsplit("/", 1)[1], t) for f, t in rows(qc.read_texts(spark, str(tmp_path))) if f.endswith(".gz")] == [("z.txt.gz", b"whole\n")]


def test_small_files_are_opened_by_tasks(spark, tmp_path, monkeypatch):
    """Plain files of a mounted folder are listed and opened by tasks, with the rows and
    paths of Spark's own reader, which sets up a reader for each file (F4 to F8)."""
    from runloom.sources import small_files

    signs = [f"s{c}x" for c in map(chr, range(1, 127)) if c not in "/:\n\r"]
    names = [*signs, "\u00fc\u00a0\u3000\u200b\U0001f600", "a+b%20c", "p=1", "_k=v", "_metadata", "_common_metadata1"]
    out = ["_x", ".y", "z._COPYING_"]
    for folder in ("", "p=1/in ner%", "_k=v", "deep/er/still", "_hid/den", ".no", "deep/_not", "_metadata.d", "c._COPYING_"):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for name in names if folder == "" else ["a", "_k=v", *out]:
            (tmp_path / folder / f"{name}.txt").write_text(f"{folder}\n{name}")
        (tmp_path / folder / "other.text").write_text("x")
        (tmp_path / folder / "empty.txt").write_text("")
    rows = lambda df: sorted((r.file, r.text) for r in df.collect())
    for pattern in ("*.txt", "s?x.txt", "a.txt", "none*.txt"):
        found = qc.read_texts(spark, str(tmp_path), pattern)
        assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
        with monkeypatch.context() as m:
            m.setattr(small_files, "folder_of", lambda *a: None)
            assert rows(found) == rows(qc.read_texts(spark, str(tmp_path), pattern)) and (rows(found) or pattern == "none*.txt")
    kept = qc.read_texts(spark, str(tmp_path), "a.txt")
    (tmp_path / "a.txt").write_text("later")
    monkeypatch.setattr(small_files, "BATCH_BYTES", 3)
    assert (kept.count(), qc.read_texts(spark, f"file://{tmp_path}", "a.txt").count()) == (4, 5)  # listed once
    # Wildcards and single files are Spark's, as is a folder that is not there.
    assert qc.read_texts(spark, f"{tmp_path}/d*p", "*.txt").count() == qc.read_texts(spark, f"{tmp_path}/deep", "*.txt").count() == 3
    assert qc.read_texts(spark, f"{tmp_path}/deep/er/still/a.txt", "*.txt").count() == qc.read_texts(spark, str(tmp_path / "deep"), "{a,b}.txt").count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        qc.read_texts(spark, f"{tmp_path}/nowhere", "*.txt")


def test_pairs_meet_once(spark, sf_dir):
    """Reads 1 and 2 are joined once, and reads are not shuffled by their barcodes (F12)."""
    from runloom.plans.queries import QUERIES

    plan = QUERIES["j05_assign_pairs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    first = spark.createDataFrame([("a", "ACGT", 1), ("b", "ACGA", 2), ("c", "TTTT", 3), ("d", None, 4)], "name_key string, barcode string, n int")
    second = spark.createDataFrame([("a", "ACGT"), ("b", "ACGT"), ("d", None), ("e", "ACGT"), ("c", "TTTT")], "name_key string, barcode string")
    refs = spark.createDataFrame([("ACGG",)], "index_seq string")
    found = C.assigned_pairs(first, second, refs, 1, keep=("n",)).select("name_key", "n", "assigned", "error").collect()
    assert sorted(map(tuple, found)) == [("a", 1, "ACGG", None), ("b", 2, None, "barcodes differ"), ("c", 3, "undetermined", None), ("d", 4, None, "no partner"), ("e", None, None, "no partner")]
    good, errors = C.assign_pairs(first, second, refs, 1)
    assert {(r.name_key, r.assigned) for r in good.collect()} == {("a", "ACGG"), ("c", "undetermined")}
    assert {(r.name_key, r.error) for r in errors.collect()} == {("b", "barcodes differ"), ("d", "no partner"), ("e", "no partner")}


def test_small_pieces_are_no_tasks_of_their_own(spark, tmp_path):
    """A file in a thousand pieces is counted by as many tasks as there are cores (F13)."""
    (tmp_path / "x.fastq").write_bytes(b"@M:1:FC:2:1:1:1 1:N:0:AC\nACGT\n+\nIIII\n" * 10_000)
    dealt = pieces.dealt(pieces.files_of(spark, str(tmp_path), "*.fastq"), 400)
    assert dealt.count() > 900 and dealt.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert [(r.n_reads, r.whole) for r in fastq.count_reads(spark, str(tmp_path), piece=400).collect()] == [(10_000, True)]


def test_sums_over_files_of_a_name(spark, tmp_path):
    """Texts of a name's files, packed or not, one after the other by their numbers (F11)."""
    import hashlib

    text = lambda i: f"@M:1:FC:2:1:1:{i} 1:N:0:AC\nAC\n+\nII\n".encode()
    for i in (1, 2, 999, 1000):
        (tmp_path / f"a_{i:03d}.fastq.gz").write_bytes(gzip.compress(text(i)) + gzip.compress(text(-i)))
    (tmp_path / "b_001.fastq").write_bytes(text(5))
    name = F.regexp_extract("file", "([^/]+)_[0-9]+[.]fastq", 1)
    found = {r.name: r.md5 for r in fastq.joined_checksums(spark, str(tmp_path), "*.fastq*", name).collect()}
    whole = b"".join(text(i) + text(-i) for i in (1, 2, 999, 1000))
    assert found == {"a": hashlib.md5(whole).hexdigest(), "b": hashlib.md5(text(5)).hexdigest()}


def test_strand_protocols(spark):
    df = spark.createDataFrame([(10.0, 1.0, 10.0), (1.0, 10.0, 0.0), (1.0, 1.0, 2.0), (1.0, 1.0, 0.0), (None, 1.0, 1.0)], "f double, r double, u double")
    assert [x[0] for x in df.select(N.strand_protocol(F.col("f"), F.col("r"), F.col("u"))).collect()] == ["forward", "reverse", "none", "none", None]


def test_a_run_without_samples_is_paired(spark):
    files = spark.createDataFrame([], "project string, sample string, read_number int, is_index boolean")
    assert [tuple(x) for x in R.paired_end(files).collect()] == [(None, True)]


def test_upsert_has_the_columns_of_both(spark):
    old = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "k string, L1 int, L2 int")
    new = spark.createDataFrame([("b", 7, 8)], "k string, L2 int, L3 int")
    out = S.upsert(old, new, ["k"])
    assert out.columns == ["k", "L1", "L2", "L3"] and sorted(map(tuple, out.collect())) == [("a", 1, 5, None), ("b", None, 7, 8)]


def test_an_extractor_of_names_can_be_given(spark):
    files = spark.createDataFrame([("x-1.fq",), ("x-2.fq",), ("y-1.fq",)], "fastq string")
    own = lambda p: {"sample_name": F.regexp_extract(p, "^([a-z])", 1), "read_number": F.regexp_extract(p, "-([12])", 1).cast("int")}
    assert sorted(map(tuple, P.pairs_by_name(files, own).collect()), key=str) == [("x-1.fq", "x-2.fq"), ("y-1.fq", None)]
    assert [r.fastq for r in P.select_files(files, ["r2"], own).collect()] == ["x-2.fq"]


def test_lanes_and_series_are_no_windows_over_rows(spark, sf_dir):
    from runloom.plans.queries import QUERIES

    plan = lambda name: QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert all("Window" not in plan(n) for n in ("p03_cutoff", "p04_weeding", "a34_rebin", "a35_rescale"))


def with_and_without_lanes(seed):
    return [*random_counts(seed, 2, 80), *[(None, b, n) for _, b, n in random_counts(seed + 1, 1, 80)]]


@pytest.mark.parametrize("cutoff", [None, 0.02])
def test_both_ways_of_grouping_keep_missing_lanes_and_all_lanes(spark, cutoff):
    df = counted(spark, with_and_without_lanes(11))
    found = [tuple(x) for x in df.collect()]
    want = []
    for scope, lane in [("lane", 1), ("lane", 2), ("lane", None), ("all", None)]:
        total = {}
        for x, b, n in found:
            if scope == "all" or x == lane:
                total[b] = total.get(b, 0) + n
        groups = greedy_in_order(sorted(total.items(), key=lambda x: (-x[1], x[0])), 1)
        want += [(scope, lane, *g) for g in groups if g[2] >= int(sum(total.values()) * (cutoff or 0))]
    for rounds in (False, True):
        rows = G.grouped(df, 1, cutoff=cutoff, by_matches=rounds, all_lanes=True).collect()
        assert sorted(((r.scope, r.lane, r.reference, r.n_sequences, r.n) for r in rows), key=str) == sorted(want, key=str)


def test_reports_of_reads_without_a_lane(spark):
    df = spark.createDataFrame([(None, "AAAA", 9), (None, "CCCC", 5), (None, "GGGG", 3), (1, "AAAA", 4)], "lane int, barcode string, n long")
    sheet = spark.createDataFrame([(None, "AAAA", "a"), (None, "GGGG", "g"), (1, "TTTT", "t")], "lane int, index_seq string, sample string")
    reported = C.report(df, sheet, 0.01, all_lanes=True)
    got = {(r.scope, r.lane, r.barcode): (r.n, r["rank"], r.sample) for r in reported.collect()}
    assert got == {
        ("lane", None, "AAAA"): (9, 1, "a"), ("lane", None, "CCCC"): (5, 2, None), ("lane", None, "GGGG"): (3, 3, "g"), ("lane", 1, "AAAA"): (4, 1, "a"),
        ("all", None, "AAAA"): (13, 1, "a"), ("all", None, "CCCC"): (5, 2, None), ("all", None, "GGGG"): (3, 3, "g"),
    }
    under = {(r.scope, r.lane, r.sample, r.n) for r in C.underrepresented(reported, sheet).collect()}
    assert under == {("lane", 1, "t", None), ("lane", 1, "g", None), ("all", None, "t", None)}
    assert {(r.scope, r.lane, r.barcode) for r in C.overrepresented(reported).collect()} == {("lane", None, "CCCC"), ("all", None, "CCCC")}
    found = C.scoped(df)
    rows = {(r.scope, r.lane): (r.total_reads, r.n_barcodes, r.coverage, r.n_under, r.n_over, r.has_problems) for r in C.summary(found, reported, sheet).collect()}
    assert rows == {("lane", None): (17, 3, 17, 0, 1, True), ("lane", 1): (4, 1, 4, 2, 0, True), ("all", None): (21, 3, 21, 1, 1, True)}


def test_analysis_of_missing_lanes_and_of_all(spark):
    df = spark.createDataFrame([(None, "AAAA", 50), (None, "AAAC", 5), (1, "AAAA", 7), (1, "CTCT", 3)], "lane int, barcode string, n long")
    sheet = spark.createDataFrame([(None, "AAAT", "near")], "lane int, index_seq string, sample string")
    found = C.scoped(df)
    groups = G.grouped(df, 1, all_lanes=True).withColumnRenamed("reference", "barcode")
    rows, summary = C.analyse(found, groups, sheet, 1)
    assert {(r.scope, r.lane, r.barcode, r.n, r.sample, r["rank"]) for r in rows.collect()} == {
        ("lane", None, "AAAA", 55, "near", 1), ("lane", 1, "AAAA", 7, "near", 1), ("lane", 1, "CTCT", 3, None, 2),
        ("all", None, "AAAA", 62, "near", 1), ("all", None, "CTCT", 3, None, 2),
    }
    assert {(r.scope, r.lane, r.total_reads, r.n_groups, r.coverage) for r in summary.collect()} == {("lane", None, 55, 1, 55), ("lane", 1, 10, 2, 10), ("all", None, 65, 2, 65)}


def test_limits_of_a_sheet_without_lanes(spark):
    sheet = lambda *i: spark.createDataFrame([(None, f"S{k}", x, k) for k, x in enumerate(i)], "lane int, sample string, index_seq string, line_no int")
    found = spark.createDataFrame([(1, "ACG", 5), (None, "AC", 1)], "lane int, barcode string, n long")
    limits = lambda s: {r.lane: r.mismatches for r in C.mismatch_limit(s, found).collect()}
    assert limits(sheet("AAAAAA", "AAAAAC")) == {None: 0, 1: 0}
    assert limits(sheet("AAAAAA", "CCCCCC")) == {None: 1, 1: 1}


def test_many_rare_barcodes_with_one_beginning_are_no_task_of_their_own(spark):
    """A million barcodes with one read each: places of a plain sort, dealt out by ranges;
    the reads are counted once."""
    rare = spark.range(1_000_000).select(F.lit(1).alias("lane"), F.concat(F.lit("ACGTACGT"), F.lpad(F.conv(F.col("id"), 10, 4), 10, "0")).alias("barcode"), F.lit(1).cast("long").alias("n"))
    rows = C.placed(rare.repartition(8))
    assert rows.agg(F.sum((F.col("rank") != F.col("cumulative")).cast("int")), F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (0, 1, 1_000_000, 1_000_000)
    first = rows.orderBy("barcode").limit(3).collect()
    assert [r["rank"] for r in first] == [1, 2, 3]


def test_names_with_fields_left_out(spark):
    cases = {
        "A_ACGT+TTGA_L001_R1_001": ("A", None, "ACGT+TTGA", 1, 1, 1, False), "X_ACAGTG_L001": ("X", None, "ACAGTG", 1, None, None, False), "ACGT": ("ACGT", None, None, None, None, None, False),
        "A_S3_ACGT": ("A_S3", None, "ACGT", None, None, None, False), "A_R1_L001": ("A_R1", None, None, 1, None, None, False), "A_ACGT-TT+GA_R2": ("A_ACGT-TT+GA", None, None, None, 2, None, False),
        "A_S_R1": ("A_S", None, None, None, 1, None, False), "L001_S1": ("L001", 1, None, None, None, None, False),
    }
    df = spark.createDataFrame([(k,) for k in cases], "f string")
    for row in df.select("f", *[c.alias(k) for k, c in N.illumina_attrs(F.concat("f", F.lit(".fastq"))).items()]).collect():
        assert tuple(row)[1:] == cases[row.f], row.f


def test_extras_are_what_follows_the_last_field_that_tells_something(spark):
    cases = {
        "X_ACAGTG_L001_trimmed": ("X_ACAGTG_L001", "_trimmed"), "X_S1_R2_001_a_b": ("X_S1_R2_001", "_a_b"), "X_a_b": ("X_a_b", None), "X": ("X", None),
        "X.ACGT.r1_trimmed": ("X.ACGT.r1", "_trimmed"), "X_L001": ("X_L001", None), "R1_x": ("R1_x", None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "f string")
    name, extras = N.canonical_and_extras(F.col("f"))
    assert {r.f: (r.n, r.e) for r in df.select("f", name.alias("n"), extras.alias("e")).collect()} == cases


def test_custom_names_both_ways(spark):
    df = spark.createDataFrame([("d/PJB_a_b_1.fastq.gz",), ("PJB_a_b.bam",), ("PJB_a_4.fastq",), ("odd.fastq",)], "f string")
    names = N.CustomNames("{SAMPLE}_*_{READ}")
    a = names(F.col("f"))
    rows = df.select(a["sample_name"].alias("s"), a["read_number"].alias("r"), names.renamed(F.col("f"), F.lit(2)).alias("two"), names.bam_name(F.col("f")).alias("bam")).collect()
    assert [tuple(r) for r in rows] == [("PJB_a", 1, "PJB_a_b_2", "PJB_a_b"), ("PJB_a", None, "PJB_a_b_2", "PJB_a_b"), (None, None, "PJB_a_4", "PJB_a_4"), (None, None, "odd", "odd")]
    with pytest.raises(ValueError):
        N.CustomNames("{SAMPLE}_{LANE}")
    own = N.CustomNames("x+{SAMPLE}.R{READ}")
    row = spark.createDataFrame([("x+a.R2.fq",)], "f string").select(own(F.col("f"))["sample_name"].alias("s"), own.renamed(F.col("f")).alias("n"), own.bam_name(F.col("f")).alias("b")).first()
    assert tuple(row) == ("a", "x+a.R2", "x+a.R")
    files = spark.createDataFrame([("P_a_b_1.fq",), ("P_a_b_2.fq",), ("P_a_c_1.fq",)], "fastq string")
    assert sorted(map(tuple, P.pairs_by_name(files, names).collect()), key=str) == [("P_a_b_1.fq", "P_a_b_2.fq"), ("P_a_c_1.fq", None)]
    assert [r.fastq for r in P.select_files(files, ["r2"], names).collect()] == ["P_a_b_2.fq"]


def test_places_are_those_of_the_order(spark):
    from runloom.sources import shared

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).orderBy(F.desc("x"))
    assert all(r.place == 1000 - r.x for r in shared.with_places(df, "place").collect())


def test_verdict_ignores_modules_that_expect_nothing(spark):
    files = spark.createDataFrame([("S_R1_001.fastq",), ("S_R2_001.fastq",), ("S_I1_001.fastq",)], "fastq string")
    expected = P.expected_outputs(files, [("a", ".x", None), ("b", ".y", (2,)), ("c", ".z", (3,))])
    modules = spark.createDataFrame([("a",), ("b",), ("c",)], "module string")
    present = spark.createDataFrame([("S_R1_001.fastq", ".x"), ("S_R2_001.fastq", ".x")], "fastq string, suffix string")
    status = lambda p: {r.module: (r.n_expected, r.n_missing, r.ok) for r in P.verdict(modules, expected, p).collect()}
    assert status(present) == {"a": (2, 0, True), "b": (1, 1, False), "c": (0, 0, None), None: (3, 1, False)}
    assert status(present.union(spark.createDataFrame([("S_R2_001.fastq", ".y")], present.schema)))[None] == (3, 0, True)
    assert {r.fastq: r.ok for r in P.completeness(files, expected, present).collect()} == {"S_R1_001.fastq": True, "S_R2_001.fastq": False, "S_I1_001.fastq": None}


def test_files_without_reads_in_a_lane(spark):
    expected = spark.createDataFrame([("p", "s", "f", 1), ("p", "s", "f", 2), ("p", "s", "g", None), ("p", "s", "h", None)], "project string, sample string, file string, lane int")
    counts = spark.createDataFrame([("p", "s", "f", 1, 5), ("p", "s", "g", 3, 2)], "project string, sample string, file string, lane int, n_reads long")
    assert {r.file: (r.empty_lanes, r.warning) for r in S.file_warnings(expected, counts).collect()} == {"f": ([2], True), "g": ([], False), "h": ([], True)}


def test_snapshots_and_crashes_change_no_counts(spark, tmp_path, monkeypatch):
    """Batches, a compaction at every second one, a lost checkpoint, and crashes after each
    step of a compaction."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "file string, lane int, barcode string"
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    run = lambda state="one": incremental.follow(spark, source, spark.createDataFrame([], schema).schema, target, str(tmp_path / state), compact_every=2).awaitTermination()
    counts = lambda: ({tuple(r) for r in incremental.counted(spark, target).collect()}, {tuple(r) for r in incremental.counted_barcodes(spark, target).collect()})
    want = ({("f", 1, 2), ("g", None, 1)}, {(1, "AC", 2), (None, None, 1)})
    land([("f", 1, "AC"), ("f", 1, "AC"), ("g", None, None)])
    run()
    assert incremental.current(spark, target) is None and counts() == want
    land([("f", 1, "AC"), ("f", 2, "GG")])
    want = ({("f", 1, 3), ("f", 2, 1), ("g", None, 1)}, {(1, "AC", 3), (2, "GG", 1), (None, None, 1)})
    with monkeypatch.context() as m:
        m.setattr(incremental, "_point", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run()  # the second batch: a snapshot is written, and nothing points to it
    assert counts() == want and incremental.current(spark, target) is None
    run()  # the batch again
    first = incremental.current(spark, target)
    assert counts() == want and first
    run("lost")  # everything again, by a stream that knows nothing of the first
    assert counts() == want
    land([("h", 3, "TT")])
    run()
    want = (want[0] | {("h", 3, 1)}, want[1] | {(3, "TT", 1)})
    with monkeypatch.context() as m:
        m.setattr(incremental, "_drop", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.compact(spark, target)  # the new snapshot is the current one, and nothing was deleted
    assert counts() == want and incremental.current(spark, target) != first
    incremental.compact(spark, target)
    assert counts() == want
    assert not list((tmp_path / "out" / "new").glob("*.parquet")) and len(list((tmp_path / "out").glob("snapshot-*"))) == 2


def test_reads_come_out_as_fastq_files(spark, tmp_path):
    """A name with most of the reads is written by several tasks; its files, joined end to
    end, are its reads in order; a task that fails at first leaves nothing behind."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, "rare").otherwise("undetermined").alias("assigned"), F.lit(1).alias("read_number"), F.col("id").alias("read_idx"),
        F.concat(F.lit("@r"), F.col("id").cast("string")).alias("header"), F.lit("AC").alias("sequence"), F.lit("II").alias("quality"),
    )
    out = tmp_path / "out"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task's
    try:
        fastq.write_demultiplexed_fastq(rows, str(out))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (out / "_SUCCESS").exists() and not list(out.glob("_temporary*"))
    text = {n: b"".join(gzip.decompress(f.read_bytes()) for f in sorted(out.glob(f"{n}_R1_*.fastq.gz"))).decode() for n in ("rare", "undetermined")}
    assert len(list(out.glob("undetermined_R1_*"))) > 1
    for n, k in (("rare", range(0, 3000, 10)), ("undetermined", [i for i in range(3000) if i % 10])):
        assert text[n] == "".join(f"@r{i}\nAC\n+\nII\n" for i in k)
    back = {r.f: r.n for r in fastq.read_fastq(spark, str(out), "*.gz").groupBy(F.regexp_extract("file", "([a-z]+)_R1", 1).alias("f")).agg(F.count("*").alias("n")).collect()}
    assert back == {"rare": 300, "undetermined": 2700}
    fastq.write_fastq(rows.limit(0), str(tmp_path / "none"), F.col("assigned"), packed=False)
    assert [f.name for f in (tmp_path / "none").iterdir()] == ["_SUCCESS"]


def test_pieces_find_the_names_that_trying_all_finds(spark):
    import random

    r = random.Random(4)
    base = ["".join(r.choice("abcd_") for _ in range(r.randint(1, 14))) for _ in range(40)]
    names = {x for b in base for x in (b, b[1:], b + "x", b[: len(b) // 2] + "z" + b[len(b) // 2 :], b[::-1]) if x}
    df = spark.createDataFrame([(x,) for x in sorted(names)] + [(None,), ("",)], "project string")
    for least in (0.6, 0.8, 1.0):
        both = [sorted(tuple(x) for x in R.close_names(df, least, most=m).collect()) for m in (10**9, 0)]
        assert both[0] == both[1] and (both[0] or least == 1.0)
    tried = R.candidate_pairs(df.filter("project <> ''").withColumnRenamed("project", "name"), 0.8).count()
    assert tried < len(names) ** 2 / 20


def test_pieces_find_the_indexes_that_trying_all_finds(spark):
    import random

    r = random.Random(6)
    df = spark.createDataFrame([("".join(r.choice("ACG") for _ in range(r.randint(4, 7))),) for _ in range(80)], "index_seq string")
    for d in (0, 1, 2):
        both = [sorted(tuple(x) for x in C.ambiguous(df, d, m).collect()) for m in (10**9, 0)]
        assert both[0] == both[1] and both[0]


def test_components_of_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of two thousand, and small groups: the number of jobs grows with the
    logarithm of the chain."""
    from runloom.operators import graphs

    rounds = []
    monkeypatch.setattr(graphs, "cut", lambda df: rounds.append(1) or __import__("runloom.sources.shared", fromlist=["cut"]).cut(df))
    chain = spark.range(1999).select(F.lit("x").alias("key"), (F.col("id") * 7919 % 2000).alias("a"), ((F.col("id") + 1) * 7919 % 2000).alias("b"))
    small = spark.createDataFrame([("y", 5, 6), ("y", 9, 8), ("y", 8, 7), ("x", 5000, 5001)], "key string, a long, b long")
    got = {(r.key, r.node): r.root for r in graphs.components(chain.unionByName(small), ["key"]).collect()}
    assert got == {**{("x", k): 0 for k in range(2000)}, ("y", 5): 5, ("y", 6): 5, ("y", 7): 7, ("y", 8): 7, ("y", 9): 7, ("x", 5000): 5000, ("x", 5001): 5000}
    assert len(rounds) < 30


def test_outputs_of_quality_tools_are_parsed_without_a_shuffle(spark):
    """Odd texts: null, empty, without a header row, with a section twice, line ends of
    either kind."""

    def parsed(parser, *texts):
        found = parser(spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file string, text string"))
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        return [tuple(r) for r in found.collect()]

    odd = (None, "", "\n\n")
    assert parsed(qc.fastqc_modules, *odd, "1\t2\n>>A\tpass\r\n#h\tx\r\n1\t2\r\n>>END_MODULE\r\n>>B\n>>C\twarn\n\n##c\n3") == [
        ("f3", "A", "pass", 2, ["#h", "x"]), ("f3", "A", "pass", 3, ["1", "2"]), ("f3", "C", "warn", 9, ["3"]),
    ]
    assert parsed(qc.screen, *odd, "Human\t1\t2", "Human\t0\nGenome\t%U\t%V\nHuman\t1\t2\nMouse\t3\n%Hit_no_libraries: 5.5") == [
        ("f4", "Human", "U", 0.0), ("f4", "Human", "U", 1.0), ("f4", "Human", "V", 2.0), ("f4", "Mouse", "U", 3.0), ("f4", None, "Hit_no_libraries", 5.5),
    ]
    sizes = "## HISTOGRAM\tint\nsize\tn\n5\t1,000\n\n6\tx\n## METRICS CLASS\nA\tB\n1\n## HISTOGRAM\tint\nsize\tn\n7\t1"
    assert parsed(qc.insert_sizes, *odd, "## METRICS CLASS\nA\tB\n", sizes) == [
        ("f4", "histogram", "5", 1000.0), ("f4", "histogram", "6", None), ("f4", "metric", "A", 1.0), ("f4", "metric", "B", None),
    ]
    assert parsed(qc.rnaseq, *odd, " a = 1,234 (5.6%)\n>>>>>>> S\nb = text\n>>>>>>>\nc = 2") == [
        ("f3", None, "a", "1,234", 1234.0, 5.6), ("f3", "S", "b", "text", None, None), ("f3", "S", "c", "2", 2.0, None),
    ]
    assert [x[:5] for x in parsed(qc.strand, *odd, "#Genome\t1\t2\nA\t60.0\t10.0\nshort", "#x version: 0.2\nB\t1\t0")] == [("f3", None, "A", 60.0, 10.0), ("f4", "0.2", "B", 1.0, 0.0)]
    assert parsed(qc.strand_inference, *odd, "This is PairEnd Data\nFraction of reads failed to determine: 0.25") == [
        ("f1", False, None, None, None), ("f2", False, None, None, None), ("f3", True, None, None, 0.25),
    ]
    assert parsed(qc.cell_summary, *odd, 'Cells,"Reads, mean"\n"1,200",7%\n\n') == [("f3", "Cells", "1,200", 1200.0), ("f3", "Reads, mean", "7%", 7.0)]
