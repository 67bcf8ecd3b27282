"""The training-data operators: SQL, brute force, round trips, held-out accuracy,
and the cases that docstrings define."""

import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from compare import same
from pyspark.sql import functions as F

import corpus_pipeline
from runloom.llm import chat, fingerprint, mixing, packing, pii, quality, queries, simhash, token_count, tokens, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, other
    columns with names that operators might use."""
    rows = [
        (1, None, "en", None, None), (2, "", None, "a", 0), (3, " \n\t", "en", "a", 3), (4, "One two. 𝔘 three", "en", "b", 16), (5, "one two. 𝔘 three", "en", "b", 16),
        (5, "one two. 𝔘 three", "en", "b", 16), (6, "word " * 60_000, "en", "b", 300_000), (7, "x@y.example.com +1 (212) 555-0100 1.2.3.4", "en", "c", 42),
    ]
    df = spark.createDataFrame(rows, DOCS)
    clash = {c: F.lit(1) for c in ("size", "f", "words", "bin", "length", "kept", "spans", "_text2", "digest", "copies", "target")}
    return df.withColumns(clash)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_as_in_sql(spark, sf_dir, name):
    same(spark, sf_dir, queries.QUERIES[name], queries.ORACLES[name])


def test_no_operator_fails_on_odd_or_empty_tables(spark, odd):
    empty = odd.limit(0)
    labels = spark.createDataFrame([(4, 1, None), (5, 0, 1)], "doc_id long, quality int, toxic int")
    calls = {
        "mix": mixing.mix, "fingerprints": fingerprint.compare_with_edits, "groups": fingerprint.duplicate_groups, "tokens": token_count.count_tokens,
        "pii": lambda d: pii.digests(pii.find_spans(d)), "redact": pii.redact, "simhash": simhash.cluster, "near": lambda d: simhash.cluster(d, 5, 16, verified=0.8),
        "toxicity": lambda d: toxicity.score(d, labels), "quality": quality.judge,
    }
    for name, call in calls.items():
        assert call(odd).count() == 8, name
        assert call(empty).count() == 0, name
    assert packing.pack_documents(odd).agg(F.count_distinct("doc_id")).first()[0] == 7
    assert packing.pack_documents(empty).count() == 0
    assert quality.keep_good(empty).columns == empty.columns


def test_mix_meets_its_targets(documents, texts):
    rows = mixing.mix(documents, fan_in=8).collect()
    assert len(rows) == len(texts)
    by = collections.defaultdict(list)
    for r in rows:
        assert r.size == len(WORDS.findall(texts[r.doc_id])) and r.taken == r.copies * r.size <= 2 * r.size
        by[r.source].append(r)
    total = sum(r.size for r in rows)
    assert sum(x[0].target for x in by.values()) == pytest.approx(1.5 * total)
    for x in by.values():
        assert sum(r.size for r in x) == x[0].source_size and x[0].target <= 2 * x[0].source_size + 1e-6
        assert abs(sum(r.taken for r in x) - x[0].target) <= max(r.size for r in x)
    assert sorted(map(tuple, mixing.mix(documents, fan_in=8).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_mix_does_not_depend_on_partitions(spark, documents):
    again = documents.unionByName(documents.filter("doc_id < 60")).unionByName(documents.filter("doc_id < 20"))  # repeated rows, too
    runs = [sorted(map(tuple, mixing.mix(again.repartition(n), fan_in=8).collect()), key=str) for n in (1, 7, 40)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == again.count()


def test_targets_fill_to_a_common_level(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    # weights 3, 1, 2, 3: a and c stop at twice their size; the rest is shared 1 : 3, and null stops at 1000
    assert got["a"] == 20 and got["c"] == 0 and got[None] == 1000 and got["b"] == pytest.approx(2265 - 1020)


def test_fingerprints_and_edits(documents, texts):
    order = sorted(texts.items(), reverse=True)
    want = {}
    for i, (k, t) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(t) // 2
        want[k] = hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()
    rows = fingerprint.compare_with_edits(documents).collect()
    assert {r.doc_id: r.edited_sha256 for r in rows} == want
    groups = collections.defaultdict(set)
    for r in rows:
        groups[r.fingerprint].add(" ".join(texts[r.doc_id].casefold().split()))
    assert all(len(x) == 1 for x in groups.values())


def test_canonical_texts_and_equal_digests(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Caf\u00e9  X\n"), (2, "cafe\u0301 x"), (3, "caff\u00e8"), (4, "STRASSE"), (5, "stra\u00dfe")], "doc_id long, text string")
    f = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(df).collect()}
    assert f[1] == f[2] != f[3] and f[4] == f[5]
    monkeypatch.setattr(fingerprint, "digest", lambda c: F.lit("0" * 32))
    assert len({r.fingerprint for r in fingerprint.fingerprints(df).collect()}) == 3


def test_windows_over_ranges_see_the_next_row(spark, documents, texts):
    order = [t for _, t in sorted(texts.items(), reverse=True)]
    got = {r.doc_id: r.next_text for r in fingerprint.with_next(documents, rows_a_part=7).collect()}
    assert [got[k] for k in sorted(got, reverse=True)] == [*order[1:], order[0]]


def test_repeated_ids_are_dealt_out_in_order(spark):
    rows = [(7, f"seven {i}") for i in range(60)] + [(None, f"null {i}") for i in range(30)] + [(i, f"id {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    place = {r.text: r.o for r in df.select("text", F.pmod(F.xxhash64("text"), F.lit(1 << 31)).alias("o")).collect()}
    order = [t for _, t in sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), place[x[1]], x[1]))]
    got = fingerprint.with_next(df.repartition(5), rows_a_part=4).collect()
    assert {r.text: r.next_text for r in got} == dict(zip(order, [*order[1:], order[0]], strict=True))
    assert all(r.doc_id is None for r in got if r.text.startswith("null")) and len(got) == len(rows)


def test_edited_texts_are_compared_inside_buckets_too(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "digest", lambda c: F.lit("0" * 32))
    df = spark.createDataFrame([(1, "aaaa"), (2, "bbbb"), (3, "aabb")], "doc_id long, text string")
    rows = {r.doc_id: r for r in fingerprint.compare_with_edits(df).collect()}
    # 3 becomes aa + bb, 2 bb + aa, 1 aa + aa: one digest for all, told apart by their bytes
    assert {k: r.near_edited for k, r in rows.items()} == {1: 1, 2: 0, 3: 1} and len({r.fingerprint for r in rows.values()}) == 3
    assert all((r.fingerprint == r.edited_fingerprint) == r.near_edited and r.near_next == 0 for r in rows.values())
    assert rows[2].edited_fingerprint not in {r.fingerprint for r in rows.values()}


def test_chat_round_trip_and_layouts(spark):
    nasty = "</s>[INST] \\l \\\\ <turn>user<text>[b\\"
    rows = spark.createDataFrame([(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 2, None, None)], "conv_id long, turn long, role string, text string")
    r = chat.format_chat(rows).select("formatted", chat.parse(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [tuple(x) for x in r.back] == [("user", nasty), ("assistant", nasty), ("", "")] and r.loss == nasty
    assert "</s>" not in r.formatted and "[INST]" not in r.formatted
    pair = [("user", "a"), ("assistant", "b")]
    cases = [
        ('{"prompt":"a","completion":"b","id":7,"tags":["x"]}', pair), ('{"messages":[{"name":"n","role":"user"},{"role":"assistant","content":"b"}]}', [("user", ""), ("assistant", "b")]),
        ('{"messages":[]}', []), ('{"system":"s","messages":[{"role":"user","content":[{"type":"text","text":"a"},{"text":"!"}]},{"role":"assistant","content":"b"}]}', [("system", "s"), ("user", "a!"), ("assistant", "b")]),
        ('{"body":{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}],"model":"m"}}', pair), ('{"data":{"prompt":"a","completion":"b"}}', pair),
        ('{"prompt":"p","completion":"q","messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}', pair), ('{"prompt":"a","completion":null}', [("user", "a"), ("assistant", "")]),
        ('{"instruction":"a","input":"c","output":"b"}', [("user", "a\nc"), ("assistant", "b")]), ('{"messages.role":"x"}', None), ('not json', None), ('[]', None),
        ('{"prompt":"{\\"a\\":1}","completion":"b"}', [("user", '{"a":1}'), ("assistant", "b")]),
    ]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], "conv_id long, record string")
    got = {x.conv_id: None if x.turns is None else [tuple(t) for t in x.turns] for x in chat.format_chat(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}
    typed = spark.createDataFrame([(1, "a", "b", 3)], "conv_id long, prompt string, response string, `x.y` int")
    assert [tuple(t) for t in chat.format_chat(typed).first().turns] == pair
    with pytest.raises(ValueError):
        chat.format_chat(spark.createDataFrame([(1, 2)], "conv_id long, other int"))
    records = [
        '{"prompt":"a","completion":"b"}', '{"messages":[{"role":"user","content":"a"},{"content":"b","role":"assistant"}]}', '{"output":"b","instruction":"a","input":""}',
        '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', '{"other":1}', None,
    ]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    got = {x.conv_id: x.turns and [tuple(t) for t in x.turns] for x in chat.format_chat(df).collect()}
    assert all(got[i] == [("user", "a"), ("assistant", "b")] for i in range(4)) and got[4] is None and got[5] is None


def test_token_counts_across_blocks(documents, texts):
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(documents, block=1000).collect()}
    assert got == {k: len(tokens.encode(t, plain=True)) for k, t in texts.items()}


def test_scan_of_blocks(spark, tmp_path):
    flat = np.array([1, 2, 9, 9, 3, 4, 5, 6, 9, 7], "<u2")
    want = [(0, 2, True), (3, 0, True), (4, 4, True), (9, 1, False)]
    flat.tofile(tmp_path / "a.bin")
    np.array([], "<u2").tofile(tmp_path / "empty.bin")
    for size, run in ((1, 3), (2, 1024), (3, 2), (4, 1), (20, 1024)):
        blocks = [(0, i // size, flat[i : i + size].tobytes()) for i in range(0, len(flat), size)]
        made = spark.createDataFrame(blocks, "file_id long, no long, ids binary")
        for given in (made, token_count.flat_blocks(spark, token_count.listed(spark, str(tmp_path)), size)):
            rows = token_count.scan(given, end=9, run=run).orderBy("doc_no").collect()
            assert [(r.start, r.n_tokens, r.closed) for r in rows] == want


def test_ids_are_the_tokenizers(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokens.paths()[0])
    common = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x250), 0x2013, 0x2014, *range(0x2018, 0x2020), 0x2026]))
    r = np.random.default_rng(1)
    made = ["".join(r.choice(list(common), 200)) for _ in range(100)] + ["<|endoftext|> a", "b <|endoftext|>", "<|", "a\u0085b\u2003c \u200d 漢字 ١٢"]
    for plain in (False, True):  # the plain call first
        model.encode_special_tokens = plain
        for t in [*made, *texts.values()]:
            assert tokens.encode(t, plain=plain).tolist() == model.encode(t, add_special_tokens=False).ids
    assert tokens.encode("<|endoftext|> a").tolist() == [50256, 257]


def test_best_fit_is_that_of_a_plain_loop():
    r = np.random.default_rng(8)
    for top in (2047, 1200, 300):
        sizes = r.integers(1, top, 700)
        bins, want = [], []
        for size in sizes.tolist():
            fits = [k for k, used in enumerate(bins) if used + size <= 2048]
            if fits:
                best = max(bins[k] for k in fits)
                fits = [k for k in fits if bins[k] == best]
            else:
                bins.append(0)
                fits = [len(bins) - 1]
            want.append(bins[fits[0]] + size)
            bins[fits[0]] += size
        got, used, fills = packing.best_fit(sizes, 2048), collections.Counter(), []
        for size, k in zip(sizes.tolist(), got.tolist(), strict=True):
            used[k] += size
            fills.append(used[k])
        assert fills == want and sorted(used.values()) == sorted(bins)  # equally full bins may change places


def test_urls(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "http://WWW.Example.com/en/x?q"), (2, "https://a.example.com/en/"), (3, "x://example.com"), (4, None), (5, "no"), (6, "h://b.net/es/1"), (7, "h://a.spam-farm.example.org/z"), (8, "h://notexample.com/en/")],
        "page_id long, url string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, most=0).collect()} == got  # by joins
    listed = spark.createDataFrame([("no.such/",), ("a.spam-farm.example.org/z",), (None,)], "entry string")
    assert {r.page_id for r in urls.judge(df, blocked=listed).collect() if r.listed} == {7}
    assert all(r.listed is None for r in urls.judge(df, blocked=listed.limit(0)).collect())
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow") and got[2][2:] == ("example.com/en/", "block")
    assert got[3] == ("example.com", "", None, "allow") and got[4] == got[5] == ("", "", None, "allow")
    assert got[6][2:] == ("net/es/", "block") and got[7][2:] == (None, "block") and got[8][2:] == ("com/", "allow")
    rows = df.select("page_id", *[c.alias(n) for n, c in zip(("host", "path"), urls.host_and_path(F.col("url")), strict=True)])
    entries = spark.createDataFrame([(x,) for x in urls.RULES], "entry string")
    assert {r.page_id: r.rule for r in urls.match_by_join(rows, entries, "rule").collect()} == {k: v[2] for k, v in got.items()}


def test_equal_keys_are_told_apart_by_their_strings(tmp_path):
    for part, array in urls.arrays_of([5, 5, 5], [b"a/", b"b/", b"c/"]).items():
        np.save(tmp_path / f"x-{part}.npy", array)
    index = urls.Index([(5, "x")], lambda name: str(tmp_path / name))
    assert index.holds([b"b/", b"d/", b"c/", b"e/"], np.array([5, 5, 5, 6])).tolist() == [True, False, True, False]


def test_lengths_of_entries_are_code_points(spark):
    """Entries of other letters, and such without a path, by arrays and by joins."""
    listed = spark.createDataFrame([("example.org/été/",), ("nopath.org",), ("b.org/x",), ("",), (None,)], "entry string")
    rows = [(1, "http://example.org/été/x"), (2, "http://www.nopath.org"), (3, "http://nopath.org/x?y"), (4, "http://b.org/é"), (5, "http://a.b.org/xé"), (6, "http://notnopath.org/"), (7, "")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    for most in (urls.MOST_BYTES, 0):
        got = {r.page_id: (r.listed, r.verdict) for r in urls.judge(df, rules={}, blocked=listed, most=most).collect()}
        block = {1: "example.org/été/", 2: "nopath.org", 3: "nopath.org", 5: "b.org/x"}
        assert got == {k: (block.get(k), "block" if k in block else "allow") for k, _ in rows}


def test_hosts_that_live_on_copies(spark):
    page = lambda text: f"<html><article>{text}</article><footer>x</footer>"
    rows = [(f"h://farm{k}.org/{j}", page(f"copied {j}")) for k in range(3) for j in range(4)]
    rows += [("h://own.org/1", page("copied 1")), *[(f"h://own.org/{j}", page(f"own {j}")) for j in range(2, 5)], ("h://small.org/1", page("copied 2")), ("h://none.org/1", None), (None, page("copied 1"))]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id long, url string, html string")
    assert {r.entry for r in urls.copying_hosts(df).collect()} == {"farm0.org/", "farm1.org/", "farm2.org/"}
    assert {r.host for r in urls.judge(df, rules={}).filter("verdict = 'block'").collect()} == {"farm0.org", "farm1.org", "farm2.org"}


def test_a_list_of_millions_is_built_by_ranges(spark, monkeypatch):
    """Two million entries in ranges of 4 MB: the driver gets a row for each range."""
    monkeypatch.setattr(urls, "RANGE_BYTES", 1 << 22)
    listed = spark.range(2_000_000).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".org/")).alias("entry"))
    folder, ranges = urls.build(listed, 2_000_000 * 28)
    assert len(ranges) == 14 and [f for f, _ in ranges] == sorted(f for f, _ in ranges)
    index = urls.Index(ranges, lambda name: f"{folder}/{name}".removeprefix("file:"))
    probes = [b"h0.org/", b"h1999999.org/", b"h2000000.org/", b"h777.org/"]
    assert index.holds(probes).tolist() == [True, True, False, True] and sum(len(r[0]) for r in index.ranges) == 2_000_000


def test_repeated_words_are_those_of_a_plain_count(spark, monkeypatch):
    r = np.random.default_rng(6)
    texts = [" ".join(r.choice(list("abc"), int(n))) for n in (0, 1, 2, 3, 4, 5, 9, 40, 300)] + ["x " * 5000, " ".join(f"w{i}" for i in range(3000)), "a b c a b c d", "漢 字 x 漢 字 x"]

    def plain(w):
        n = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(3)})

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: plain(t.split()) for i, t in enumerate(texts)}
    assert {x.doc_id: x.n_repeat_words for x in quality.judge(df).collect()} == want
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(5).cast("long"))  # all bits equal: the windows themselves decide
    assert {x.doc_id: x.n_repeat_words for x in quality.judge(df).collect()} == want


FORMS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def base_spans(t):
    def luhn(x):
        return sum(k if i % 2 == 0 else 2 * k - 9 * (k > 4) for i, k in enumerate(map(int, reversed(x)))) % 10 == 0

    for kind, form in FORMS:
        for m in re.finditer(form, t):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                yield f"{kind}:{m.start()}:{m.end()}"


def test_base_spans_are_those_of_the_forms(spark, documents, texts):
    hard = [
        "a@b.cd_x@y.zz", "é𝔘 1.2.3.4.5.6.7.8 999.1.1.1 00255.0.0.1", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (212) 555-0100 +12 3 +123456789012345678",
        "1" * 40_000, "a" * 40_000 + "@", "a@b a@b. a@b.c. @c.d", "1.2.3.4" * 50, "+1" + " " * 500 + "2",
    ]
    extra = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    known = texts | {-1 - i: t for i, t in enumerate(hard)}
    for r in pii.digests(pii.find_spans(documents.select("doc_id", "text").unionByName(extra))).collect():
        want = list(base_spans(known[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), known[r.doc_id][:80]
        assert set(want) <= set(r.spans.split(",")) | {""}


WORDS_OF_THE_CODE = re.compile("[a-z]{2,}")


def test_trees_tell_planted_spans_from_look_alikes(spark):
    """Spans in spellings that no base form takes, and look-alikes in the same spellings,
    in sentences without a word of the code's cues and leads: recall and precision by
    kind. A kept scorer finds the same."""
    r = np.random.default_rng(17)
    n = lambda k: "".join(map(str, r.integers(0, 10, k)))
    word = lambda k: "".join(r.choice(list("abcdefghijklmnoprstuvw"), k))
    hexes = lambda k: "".join(r.choice(list("0123456789abcdef"), k))
    mixed = lambda k: "".join(r.choice(list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"), k))

    def card(good):
        d = "5" + n(14)
        last = next(str(x) for x in range(10) if (sum(k if i % 2 == 0 else 2 * k - 9 * (k > 4) for i, k in enumerate(map(int, reversed(d + str(x))))) % 10 == 0) == good)
        return ".".join((d + last)[i : i + 4] for i in range(0, 16, 4))

    octets = lambda sign: sign.join(str(x) for x in r.integers(0, 256, 4))
    leads = ("please question ", "thanks go towards ", "billed upon ", "they noted ", "our gadget ", "deployed using ")
    known = {w for x in (*pii.LEADS, *pii.COUNTER_LEADS, *pii.SECRET_LEADS, *pii.DIGEST_LEADS, *pii.CUED, *pii.COUNTERED, *pii.SECRET_CUED, pii.CUES, pii.COUNTER_CUES, pii.SECRET_CUES) for w in WORDS_OF_THE_CODE.findall(x.lower())}
    assert not known & set(" ".join(leads).split())
    planted, clean, rows = {}, {}, []
    for i in range(60):
        good = [
            ("email", f"{word(5)} (at) {word(6)}.org"), ("email", f"{word(4)}[at]{word(5)}[dot]com"), ("phone", f"({n(3)}) {n(3)}-{n(4)}"),
            ("card", card(True)), ("ip", octets("[.]")), ("secret", mixed(32)), ("secret", "pk_" + mixed(28)),
        ]
        bad = [
            ("email", f"{word(4)}[at]{word(4)}.size[1]"), ("phone", f"{n(3)}-{n(3)}-{n(4)}"), ("card", card(False)), ("ip", f"3{n(2)}[.]{n(3)}[.]9{n(2)}[.]1"),
            ("secret", hexes(64)), ("secret", f"{word(6)}/{word(8)}/{word(7)}{n(2)}"), ("secret", f"{word(7)}_{word(9)}_{word(6)}{n(1)}"), ("secret", f"{word(6)}-{word(5)}-{word(8)}-{n(4)}"),
        ]
        for k, (kind, value) in enumerate(good + bad):
            before = " ".join(word(int(x)) for x in r.integers(2, 8, 6)) + " " + leads[int(r.integers(len(leads)))]
            rows.append((100 * i + k, before + value + " " + word(5)))
            (planted if k < len(good) else clean)[100 * i + k] = (kind, len(before), len(before) + len(value))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scorer = pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    got = {x.doc_id: x.spans for x in pii.find_spans(docs, scorer=scorer).collect()}
    tally = collections.defaultdict(lambda: [0, 0, 0, 0])
    for i, (kind, a, b) in planted.items():
        tally[kind][0] += 1
        tally[kind][1] += any(s.kind == kind and s.start < b and a < s.end for s in got[i])
    for i, (kind, _, _) in clean.items():
        tally[kind][2] += 1
        tally[kind][3] += bool(got[i])
    print({k: f"{found} of {there} found, {wrong} of {like} look-alikes taken" for k, (there, found, like, wrong) in tally.items()})
    found, wrong = sum(x[1] for x in tally.values()), sum(x[3] for x in tally.values())
    assert found / len(planted) > 0.85 and found / (found + wrong) > 0.93
    assert all(x[1] > 0.6 * x[0] and x[3] < 0.3 * x[2] for x in tally.values())
    assert pii.Scorer.from_json(scorer.to_json()).thresholds == scorer.thresholds
    again = {x.doc_id: x.spans for x in pii.find_spans(docs.limit(40), scorer=pii.Scorer.from_json(scorer.to_json())).collect()}
    assert all(got[k] == v for k, v in again.items())
    counts = {(x.kind, x.base): (x.n_candidates, x.n_accepted) for x in pii.tallied(docs, scorer).collect()}
    assert counts["secret", False][1] < counts["secret", False][0] and counts["card", False][1] < counts["card", False][0]


def test_redaction_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "𝔘 mail a@b.cd and 10.0.0.1!"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redact(df).collect()} == {1: "𝔘 mail <EMAIL> and <IP>!", 2: None}


def plain_components(f, doc_ids, radius):
    u, inv = np.unique(f, return_inverse=True)
    root = list(range(len(u)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[:i] ^ u[i]) <= radius).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for k, x in enumerate(inv):
        least[find(x)] = min(doc_ids[k], least.get(find(x), doc_ids[k]))
    return [least[find(x)] for x in inv]


@pytest.mark.parametrize(("radius", "tile"), [(4, 8192), (4, 2), (20, 30)])
def test_components_are_those_of_all_pairs(documents, texts, radius, tile):
    rows = simhash.cluster(documents, 4, radius, tile).collect()
    f = np.array([r.f for r in rows], np.int64).view(np.uint64)
    assert [r.component_id for r in rows] == plain_components(f, [r.doc_id for r in rows], radius)
    for r in rows[:20]:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id]))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        assert r.f % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_copies_go_and_others_stay(spark):
    r = np.random.default_rng(3)
    words = ["".join(r.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    docs = [" ".join(r.choice(words, 300)) for _ in range(30)]
    near = docs[0].split()
    near[50] = near[200] = "changed"
    rows = [*enumerate(docs), (100, docs[1]), (101, " ".join(near))]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.doc_id for x in kept.collect()} == set(range(30))


def test_verified_links_are_not_hidden_by_others():
    f = np.array([0b000, 0b001, 0b111], np.uint64)
    holds = lambda i, j: (i + j) == 2  # noqa: E731  the first and the last only
    assert simhash.forest(f, None, 3, holds) == [(2, 0)]
    assert len(simhash.forest(f, None, 3)) == 2


@pytest.mark.parametrize(("radius", "tile"), [(16, 8192), (16, 16), (6, 16)])
def test_verified_components_are_those_of_all_pairs(spark, radius, tile):
    r = np.random.default_rng(5)
    words, texts = [f"w{i}" for i in range(400)], []
    for size in (*[60] * 8, *[300] * 8, 1, 0):
        base = list(r.choice(words, size))
        for edits in (0, 1, 2, 3, 5):
            text = list(base)
            for at in r.choice(max(1, size), min(edits, size), replace=False).tolist():
                text[at] = "edited"
            texts.append(" ".join(text))
    rows = simhash.cluster(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, radius, tile, verified=0.8).collect()
    f = {x.doc_id: x.f % (1 << 64) for x in rows}
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] == sets[b] or ((f[a] ^ f[b]).bit_count() <= radius and alike(a, b)):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {x.doc_id: x.component_id for x in rows} == {k: find(k) for k in range(len(texts))}


@pytest.mark.parametrize("tile", [8192, 8])
def test_bands_find_what_is_alike(spark, tile):
    r = np.random.default_rng(11)
    words, texts = [f"w{i}" for i in range(500)], []
    for size in (50, 80, 120, 300, 900):
        base = list(r.choice(words, size))
        for edits in (0, 0, 1, 2, 4, 8, 20, 60):
            text = list(base)
            for at in r.choice(size, min(edits * size // 300 + (edits > 0), size), replace=False).tolist():
                text[at] = f"edited{at}"
            texts.append(" ".join(text))
    rows = simhash.cluster(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 24, tile, verified=0.8, bands=True).collect()
    got = {x.doc_id: x.component_id for x in rows}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    near = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b])]
    assert len(near) > 20 and all(got[a] == got[b] for a, b in near)
    for a in range(len(sets)):  # nothing joins but by a chain of links near 0.8 or over
        alone = max(len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in range(len(sets)) if b != a) < 0.7
        assert not alone or sum(x == got[a] for x in got.values()) == 1


def test_near_duplicates_are_those_of_exact_similarity(spark):
    r = np.random.default_rng(21)
    rows, near = [], set()
    for n in (60, 100, 500):  # shingles; pairs just below and above 0.8, each of words of its own
        for k in range(40):
            words = [f"w{n}x{k}x{i}" for i in range(n + 4)]
            m = int(n / 9) + int(r.integers(-1, 3)) * max(1, n // 100)  # (n - m) / (n + m) is 0.8 at n / 9
            i = 2 * len(rows)
            rows += [(i, " ".join(words)), (i + 1, " ".join([*words[:-m], *[f"o{x}" for x in words[-m:]]]))]
            if (n - m) / (n + m) >= 0.8:
                near.add(i + 1)
    head = "spam " * 500  # one shingle so frequent that it alone makes the fingerprint
    rows += [(-2, head + " ".join(f"a{i}" for i in range(60))), (-1, head + " ".join(f"b{i}" for i in range(60)))]
    assert 30 < len(near) < 90
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.doc_id for x in kept.collect()) == sorted({i for i, _ in rows} - near)


@pytest.mark.parametrize("tile", [8192, 40])
def test_exact_links_in_large_buckets_are_those_of_all_pairs(spark, tile):
    r = np.random.default_rng(22)
    base, texts = [f"w{i}" for i in range(200)], []
    for _ in range(300):  # one bucket of texts that are 0.7 to 0.9 alike
        text = list(base)
        for at in r.choice(200, int(r.integers(1, 5)), replace=False).tolist():
            text[at] = f"e{r.integers(1000)}"
        texts.append(" ".join(text[: int(r.integers(170, 201))]))
    rows = simhash.cluster(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 64, tile, verified=0.8).collect()
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    least = list(range(len(texts)))
    for _ in range(8):  # by now each has heard of the least it is chained to
        for a in range(len(sets)):
            for b in range(a):
                if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                    least[a] = least[b] = min(least[a], least[b])
    assert {x.doc_id: x.component_id for x in rows} == dict(enumerate(least))


def exact_components(rows, least=0.8):
    """(doc_id, text) -> the doc_id of each row's component, by exact Jaccard
    similarity of five-word shingles, through an index of shingles; and the pairs."""
    sets = [set(simhash.shingle_hashes(t or "", 5).tolist()) for _, t in rows]
    holders, root = collections.defaultdict(list), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    pairs = []
    for b, mine in enumerate(sets):
        common = collections.Counter(a for x in mine for a in holders[x])
        empty = [a for a in range(b) if not sets[a]] if not mine else []
        for a in empty + [a for a, n in common.items() if n >= least * (len(mine) + len(sets[a]) - n)]:
            pairs.append((a, b))
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        for x in mine:
            holders[x].append(b)
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    return [min(ids[find(k)]) for k in range(len(rows))], [(rows[a][0], rows[b][0]) for a, b in pairs if sets[a] != sets[b]]


def test_near_duplicates_found_of_all_on_a_larger_table(spark):
    """At sf0.01, over all documents: recall of inexact pairs and false joins."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want, pairs = exact_components(rows)
    got = {r.doc_id: r.component_id for r in simhash.cluster(docs, 5, 24, verified=0.8, bands=True).collect()}
    assert len(pairs) > 10 and sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)
    joined = {i: w for (i, _), w in zip(rows, want, strict=True)}
    assert all(joined[i] == joined[c] for i, c in got.items()), "a join that no chain of links at 0.8 explains"


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    words = lambda x: " ".join(f"{x}{i}" for i in range(60))
    rows = [(1, words("a"), 1), (1, words("b"), 2), (1, words("b"), 2), (2, words("b"), 3), (None, words("c"), 4), (None, words("d"), 5), (None, words("a"), 6), (3, words("e"), 7), (4, None, 8), (5, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((x[2], x[0]) for x in kept.collect()) == [(1, 1), (2, 1), (4, None), (5, None), (7, 3), (8, 4)]
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_chains_are_one_component(spark):
    n = lambda k: {"d": k, "f": k}
    edges = spark.createDataFrame([(n(i), n(i + 1)) for i in range(60)] + [(n(100), n(101))], f"a {simhash.NODE}, b {simhash.NODE}")
    assert {r.node.d: r.root.d for r in simhash.components(edges).collect()} == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels.filter("toxic IS NOT NULL"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) > 0.93 * len(rows)
    told, toxic = [r.toxic for r in rows if r.predicted], [r.predicted for r in rows if r.toxic]
    assert sum(told) > 0.75 * len(told) and sum(toxic) > 0.5 * len(toxic)  # 2,400 labelled rows


def brute_ratio(text, taught):
    """Interpolated Kneser-Ney by dictionaries; `taught`: texts of class 0 and 1."""
    import math

    grams = lambda t: [x[i : i + 4] for x in [f" {re.sub(r'\W+', ' ', t.lower())} ".replace("  ", " ")] for i in range(len(x) - 3)]
    n = [collections.Counter(g for t in taught[c] for g in grams(t)) for c in (0, 1)]
    types = set(n[0]) | set(n[1])
    three = collections.Counter(g[1:] for g in types)
    two = collections.Counter(g[1:] for g in three)
    one = collections.Counter(g[1:] for g in two)

    def cut(counts):
        a, b = (sum(v == k for v in counts.values()) for k in (1, 2))
        return a / (a + 2 * b) if a + b else 0.5

    def share(counts, g, back):
        same = [v for k, v in counts.items() if k[:-1] == g[:-1]]
        return back if not same else (max(counts[g] - cut(counts), 0) + cut(counts) * len(same) * back) / sum(same)

    def shared(g):
        return share(three, g, share(two, g[1:], share(one, g[2:], 1 / 65536)))

    found = grams(text)
    score = lambda g: math.log(share(n[1], g, shared(g[1:])) / share(n[0], g, shared(g[1:])))
    return sum(map(score, found)) / len(found) if found else 0.0


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_toxicity_ratios_are_those_of_a_brute_force_model(spark, texts, most):
    some = [texts[k][:150] for k in sorted(texts)[:20]]
    taught = [some[:9], some[9:14]]
    rows = spark.createDataFrame([(t, c) for c in (0, 1) for t in taught[c]], "text string, toxic int")
    made = toxicity.model(toxicity.count(rows))
    asked = [*some, "", "zqx 漢字", some[0]]
    got = toxicity.rated(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), made, {"doc_id": "long"}, most).collect()
    assert len(got) == len(asked)
    for r in got:
        assert r.ratio == pytest.approx(brute_ratio(asked[r.doc_id], taught), abs=1e-9)


def test_toxicity_of_long_texts_is_piecewise(monkeypatch):
    text = "".join(np.random.default_rng(1).choice(list("abc d"), 5000))
    whole = np.concatenate(list(toxicity.windows(text)))
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    assert np.array_equal(np.concatenate(list(toxicity.windows(text))), whole)


@pytest.mark.parametrize("leaf", [40, 50_000])
def test_packing_is_whole_and_tight(documents, texts, leaf):
    rows = packing.pack_documents(documents, leaf=leaf).collect()
    by_doc, by_bin = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append(r)
    import zlib

    for k, parts in by_doc.items():
        ids = np.append(tokens.encode(texts[k]), 0).astype("<u4")
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert r.length == 2048 or r.piece == 0
    for parts in by_bin.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_doc) == len(texts) and len(by_bin) <= 1.03 * sum(r.length for r in rows) / 2048 + 1


@pytest.mark.parametrize("fan_in", [4_096, 5])
def test_no_packing_task_sees_all_pieces(spark, monkeypatch, fan_in):
    plain, r = packing.best_fit, np.random.default_rng(4)
    lengths = [*r.integers(1025, 2032, 1500).tolist(), *r.integers(600, 1025, 30).tolist(), 3]  # few fit together

    def guarded(sizes, room):
        assert len(sizes) <= 150, f"a task packs {len(sizes)} items"
        return plain(sizes, room)

    monkeypatch.setattr(packing, "best_fit", guarded)
    rows = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECES)
    got = packing.pack(rows, leaf=50, fan_in=fan_in).collect()
    assert sorted((x.doc_id, x.length) for x in got) == list(enumerate(lengths))
    by_bin = collections.defaultdict(list)
    for x in got:
        by_bin[x.sequence_id].append((x.offset, x.length))
    for parts in by_bin.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert len(by_bin) <= plain(np.array(sorted(lengths, reverse=True)), 2048).max() + 1 + 0.005 * len(lengths)
    assert sum(2 * sum(n for _, n in parts) <= 2048 for parts in by_bin.values()) <= 1


def test_stages_keep_columns_and_take_effect(spark, sf_dir, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == documents.columns, name
        if name == "quality rules":
            kept = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
            assert {r.doc_id for r in out.collect()} == kept
        elif name == "near-duplicates":
            rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
            assert {r.doc_id for r in out.collect()} == set(exact_components(rows)[0])
        elif name == "personal data":
            assert out.count() == docs.count() and not any(list(base_spans(r.text)) for r in out.collect())
        docs = out
    assert docs.count() > 0 and corpus_pipeline.run(spark, sf_dir).count() > 0


def test_large_buckets_of_bands_are_dealt_out_finely(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FINE", 16)
    classes = spark.range(400).select(F.col("id").alias("c"), F.col("id").alias("d"), F.xxhash64("id").alias("f"), F.lit(10).alias("w"), F.array(F.lit(1).cast("long"), F.col("id")).alias("k"))
    units = simhash.into_units(classes, 64).groupBy("block", "key", "t", "u").agg(F.count("*").alias("n"), F.count_distinct("c").alias("m")).collect()
    assert max(x.n for x in units) <= 150 and all(x.n == x.m for x in units)
    met = {x.t: 1 for x in units if x.t == x.u}
    assert len(met) == 8 and len(units) == 8 * 9 // 2  # every tile with every tile, one with itself


def test_bands_lose_no_near_copy_that_all_comparisons_find(spark, sf_dir):
    """The stage with and without its keys, on the next larger tables."""
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    kept = [{r.doc_id for r in simhash.drop_near_duplicates(docs, bands=b).select("doc_id").collect()} for b in (True, False)]
    assert kept[0] == kept[1] and len(kept[0]) < docs.count()
