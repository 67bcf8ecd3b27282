"""URL filters on a sorted digest array.

A list of entries (a host, then a path's beginning, like `example.com/en/`) is
hashed by 64-bit xxhash. Spark sorts it by ranges of hashes, and each range's task
writes sorted keys to one flat file of the shared folder, the entries' borders and
bytes to others; the driver sees no entry. Executors get the files from Spark, map
them into memory and probe with numpy's binary search; a hit counts only if the
stored string equals the probe, so collisions do no harm. An entry fits its host and
all subdomains, and paths that start with its path, in code points; one without `/`
fits whatever path. The longest entry wins.

Lists are tables. Their bytes are added up first; beyond `MOST_BYTES` they are not
sent around: probes are joined to them by their digest and compared there, in
shuffles (`match_by_join`), with the same result.

Defined results: null and empty URLs and such without `://` have empty host and path
and fit nothing; very long URLs are judged whole; repeated rows, equal and null ids
are judged alike, each by its URL; of entries that fit, the longest wins, of two as
long the one with more of the host; null and repeated entries do nothing; other
columns are left out; an empty table or list gives an empty result or no hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, shared_folder
from .token_count import opened

MOST_BYTES = 512 << 20

#: The rules of the contract, longest to be chosen.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
#: Labels of junk sites' hosts.
JUNK = ("spam-farm", "cheap-pills", "casino-win", "ads-track", "free-bets")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased;
    path: then to `?`, `#` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


PARTS = ("keys", "ends", "bytes")
#: Bytes of entries in a range, the seed of Spark's hash.
RANGE_BYTES, SEED = 1 << 25, 42


def hashes(found: list[bytes]) -> np.ndarray:
    """As Spark's `xxhash64` has them."""
    return np.array([xxhash.xxh64_intdigest(x, SEED) for x in found], np.uint64).view(np.int64)


def arrays_of(keys, entries: list[bytes]) -> dict[str, np.ndarray]:
    """Of entries sorted by key: keys, where each one ends, bytes."""
    found = (np.asarray(keys, np.int64), np.cumsum([len(x) for x in entries], dtype=np.int64), np.frombuffer(b"".join(entries), np.uint8))
    return dict(zip(PARTS, found, strict=True))


def build(entries: DataFrame, size: int) -> tuple[str, tuple[tuple[int, str], ...]]:
    """Writes the arrays of each range of hashes to a new folder. Returns the folder, and
    of each range, in order, its first key and its files' common name, which no other
    range of any list has."""
    folder = shared_folder(entries, "digests")
    unique = folder.rpartition("/")[2]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, found = [], []
        for b in batches:
            keys += b["key"].tolist()
            found += b["entry"].tolist()
        if not keys:
            return
        task = TaskContext.get()
        name = f"{unique}-{task.partitionId()}-{task.taskAttemptId()}"
        fs, place = opened(folder)
        fs.create_dir(place, recursive=True)
        for part, array in arrays_of(keys, found).items():
            with fs.open_output_stream(f"{place}/{name}-{part}.npy") as out:
                np.save(out, array)
        yield pd.DataFrame({"first": keys[:1], "name": [name]})

    keyed = entries.select(F.xxhash64("entry").alias("key"), F.col("entry").cast("binary").alias("entry"))
    dealt = keyed.repartitionByRange(max(1, -(-size // RANGE_BYTES)), "key").sortWithinPartitions("key", "entry")
    # A row for each range.
    rows = dealt.mapInPandas(write, "first long, name string").collect()
    return folder, tuple(sorted((r.first, r.name) for r in rows))


class Index:
    """Built files of ranges, mapped into memory. `place` gives a file's path by its name."""

    def __init__(self, ranges, place):
        self.firsts = np.array([first for first, _ in ranges], np.int64)
        self.ranges = [[np.load(place(f"{name}-{part}.npy"), mmap_mode="r") for part in PARTS] for _, name in ranges]

    def holds(self, probes: list[bytes], keys: np.ndarray | None = None) -> np.ndarray:
        """Which of the probes are entries. `keys`: their hashes, if known."""
        out = np.zeros(len(probes), bool)
        keys = hashes(probes) if keys is None else keys
        of = np.searchsorted(self.firsts, keys, "right") - 1
        for k, (own, ends, data) in enumerate(self.ranges):
            mine = np.flatnonzero(of == k)
            at = np.searchsorted(own, keys[mine])
            hit = own[np.minimum(at, len(own) - 1)] == keys[mine]
            for i, at_ in zip(mine[hit].tolist(), at[hit].tolist(), strict=True):
                while at_ < len(own) and own[at_] == keys[i]:  # collisions lie side by side
                    if data[int(ends[at_ - 1]) if at_ else 0 : int(ends[at_])].tobytes() == probes[i]:
                        out[i] = True
                        break
                    at_ += 1
        return out


def probes_of(host: str, path: str, lengths: list[int]) -> list[str]:
    """What entries could fit: each end of the host at a dot, with each start of
    the path that is as long as some entry's. The longest first, of two as long
    the one with more of the host."""
    parts = host.split(".")
    hosts = [".".join(parts[i:]) for i in range(len(parts))]
    out = [(h, path[:n]) for h in hosts if h for n in lengths if n <= len(path)]
    return [h + p for h, p in sorted(out, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


@cache
def _mapped(ranges: tuple) -> Index:
    return Index(ranges, SparkFiles.get)


def entries_of(spark: SparkSession, entries) -> DataFrame:
    """A table with a column `entry`, from one, or from names in the code."""
    if isinstance(entries, DataFrame):
        return entries.select("entry").filter("entry IS NOT NULL").distinct()
    return spark.createDataFrame([(x,) for x in sorted(entries)], "entry string")


def path_lengths(entries: DataFrame) -> list[int]:
    """In code points; 0 for entries without a path. They are few: no more than the
    longest path has code points."""
    at = F.instr("entry", "/")
    length = F.when(at > 0, F.length("entry") - at + 1).otherwise(0)
    return sorted(r[0] for r in entries.select(length.alias("n")).distinct().collect())


def longest_matches(df: DataFrame, lists: dict[str, DataFrame], most: int = MOST_BYTES) -> DataFrame:
    """Adds a column for each of the lists: its longest entry that fits `host` and
    `path`, or null. Probes are made and hashed once for all lists. Lists of up to
    `most` bytes together are sent to the executors as digest arrays; larger ones
    are joined, with the same result."""
    lists = {k: cut(v) for k, v in lists.items()}
    sizes = {k: v.agg(F.coalesce(F.sum(F.octet_length("entry") + 16), F.lit(0))).first()[0] for k, v in lists.items()}
    if sum(sizes.values()) > most:
        for name, entries in lists.items():
            df = match_by_join(df, entries, name)
        return df
    built, lengths = {}, set()
    for column, entries in lists.items():
        folder, ranges = build(entries, sizes[column])
        lengths |= set(path_lengths(entries))
        for _, name in ranges:
            for part in PARTS:
                df.sparkSession.sparkContext.addFile(f"{folder}/{name}-{part}.npy")
        built[column] = ranges
    lengths = sorted(lengths)

    @F.pandas_udf(", ".join(f"{k} string" for k in built))
    def match(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        probes = [probes_of(h, p, lengths) for h, p in zip(hosts, paths, strict=True)]
        flat = [p.encode("utf-8", "surrogatepass") for x in probes for p in x]
        keys, ends = hashes(flat), np.cumsum([0, *map(len, probes)])
        out = {}
        for column, ranges in built.items():
            # The first hit of each row is its longest entry.
            hits = np.flatnonzero(_mapped(ranges).holds(flat, keys)) if ranges else np.zeros(0, np.int64)
            first = hits[np.minimum(np.searchsorted(hits, ends[:-1]), len(hits) - 1)] if len(hits) else np.zeros(0, np.int64)
            out[column] = [flat[h].decode("utf-8", "surrogatepass") if a <= h < b else None for h, a, b in zip(first, ends, ends[1:])] if len(first) else [None] * len(probes)  # noqa: B905
        return pd.DataFrame(out, dtype=object)

    return df.withColumn("_m", match("host", "path")).select("*", "_m.*").drop("_m")


def match_by_join(df: DataFrame, entries: DataFrame, out: str) -> DataFrame:
    """One list of any size, by shuffles: distinct hosts and paths are probed, probes
    meet entries by digest, then by the full string."""
    lengths = path_lengths(entries)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(h, q, p, k) for h, q in zip(b["host"], b["path"], strict=True) for k, p in enumerate(probes_of(h, q, lengths))]
            yield pd.DataFrame(rows, columns=["host", "path", "entry", "k"])

    # A host with a third of all rows has few paths, or paths of their own: distinct pairs spread.
    probes = df.select("host", "path").distinct().mapInPandas(probe, "host string, path string, entry string, k int")
    keyed = lambda x: x.withColumn("digest", F.xxhash64("entry"))
    hits = keyed(probes).join(keyed(entries.select("entry").distinct()), ["digest", "entry"])
    best = hits.groupBy("host", "path").agg(F.min_by("entry", "k").alias(out))
    return df.join(best, ["host", "path"], "left")


def junk_hosts(pages: DataFrame) -> DataFrame:
    """entry: the hosts of `pages` that have a label that junk sites use. It has a row for
    each such host, and grows with the table."""
    host, _ = host_and_path(F.col("url"))
    hosts = pages.select(host.alias("host")).distinct()
    named = F.exists(F.split("host", r"\."), lambda x: x.isin(*JUNK))
    return hosts.filter(named).select(F.concat("host", F.lit("/")).alias("entry"))


def article_of(html: Column) -> Column:
    """What follows the last `<article>`, up to `</article>`."""
    return F.substring_index(F.substring_index(html, "<article>", -1), "</article>", 1)


def copying_hosts(pages: DataFrame, hosts: int = 3, least: int = 3) -> DataFrame:
    """entry: the hosts of `pages` that live on copies: of their pages, `least` or more,
    half or more have an article that stands on so many hosts, the same to the byte.
    Articles are counted once for each host, so one that all hosts have is no more than
    a row for each of them."""
    host, _ = host_and_path(F.col("url"))
    seen = pages.select(host.alias("host"), F.unhex(F.md5(article_of(F.col("html")))).alias("article")).groupBy("article", "host").agg(F.count("*").alias("n"))
    seen = cut(seen.filter("host <> ''"))
    wide = seen.filter("article IS NOT NULL").groupBy("article").agg(F.count("*").alias("_hosts")).filter(F.col("_hosts") >= hosts)
    rows = seen.join(checked_broadcast(cut(wide)), "article", "left")
    sums = rows.groupBy("host").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("_hosts").isNotNull(), F.col("n")).otherwise(0)).alias("copied"))
    return sums.filter((F.col("n") >= least) & (2 * F.col("copied") >= F.col("n"))).select(F.concat("host", F.lit("/")).alias("entry"))


def judge(pages: DataFrame, rules: dict[str, str] | None = None, blocked: DataFrame | None = None, most: int = MOST_BYTES) -> DataFrame:
    """page_id, url, host, path, rule, listed, verdict. The longest rule decides;
    without one, a URL on the list `blocked` (column `entry`: a host, then a path's
    beginning) is blocked. Without a list, it is what the pages themselves tell: `junk_hosts` and
    `copying_hosts`."""
    rules = RULES if rules is None else rules
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    if blocked is None:
        blocked = junk_hosts(pages)
        blocked = blocked.unionByName(copying_hosts(pages)) if "html" in pages.columns else blocked
    lists = {"rule": entries_of(spark, rules), "listed": entries_of(spark, blocked)}
    rows = longest_matches(rows, lists, most)
    said = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]).cast("map<string,string>")
    own = F.when(F.col("listed").isNotNull(), "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNotNull(), said[F.col("rule")]).otherwise(own)
    return rows.select("page_id", "url", "host", "path", "rule", "listed", verdict.alias("verdict"))
