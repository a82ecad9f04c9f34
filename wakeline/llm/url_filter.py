"""URL filters: host and path rules, and a blocklist held as a Bloom filter cascade.

The key universe is every host of the corpus with all its parent domains. Level 0 of the cascade holds
the listed keys; each next level holds the keys of the other side that the level before lets through
by mistake, until none is left. The first level that lacks a key decides it, exactly, for every key of
the universe: odd levels lack listed keys only, even levels others only. Levels shrink geometrically
and are sent to every task, so urls are judged without a join. A list too long for that is cut into parts
by the keys' hashes; each part has a cascade of its own, and the urls pass one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches, written

#: (verdict, host, path) in the contract's order; the longest rule that fits wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Domains that are always on the query's blocklist, each with all its subdomains.
BLOCKLIST = tuple(
    f"{name}.example.{top}" for name in ("adult-x", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")
)
BITS_PER_KEY, HASHES = 10, 7
#: About the most bytes of a cascade that is sent to every task at once; longer lists are judged in parts.
PART_BYTES = 64 << 20
#: Bits are set by the task of their segment, of so many bytes.
SEGMENT = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(said)).otherwise(verdict)
    return text, verdict


def domains(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def hash_pair(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a key, from which every level takes its bits."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


@dataclass
class Level:
    bits: np.ndarray  # of uint8, packed
    size: int


def places(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """HASHES bit positions of each key at one level; both hashes are mixed with the level."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        a = (h1.view(np.uint64) ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
        b = (h2.view(np.uint64) + salt) * np.uint64(0x94D049BB133111EB)
        a ^= a >> np.uint64(31)
        b = (b ^ (b >> np.uint64(29))) | np.uint64(1)
        at = a[:, None] + b[:, None] * np.arange(HASHES, dtype=np.uint64)
    return ((at >> np.uint64(16)) % np.uint64(size)).astype(np.int64)


def passes(level: Level, n: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    at = places(h1, h2, n, level.size)
    return ((level.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def is_listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact membership of keys of the universe: the parity of the first level that lacks the key."""
    depth = np.full(len(h1), len(levels))
    open_ = np.arange(len(h1))
    for n, level in enumerate(levels):
        ok = passes(level, n, h1[open_], h2[open_])
        depth[open_[~ok]] = n
        open_ = open_[ok]
    return depth % 2 == 1


def _fill(keys: DataFrame, n: int, size: int) -> np.ndarray:
    """The bits of one level: tasks find the places of their keys, the task of a segment sets its bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = places(pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64), n, size).ravel()
            yield pd.DataFrame({"segment": at // (8 * SEGMENT), "bit": at % (8 * SEGMENT)})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros(8 * SEGMENT, np.uint8)
        flat[pdf["bit"].to_numpy()] = 1
        return pd.DataFrame({"segment": pdf["segment"].iloc[:1], "bits": [np.packbits(flat, bitorder="little").tobytes()]})

    placed = keys.mapInPandas(run, "segment long, bit long").distinct()
    out = np.zeros(-(-size // (8 * SEGMENT)) * SEGMENT, np.uint8)
    for r in placed.groupBy("segment").applyInPandas(join, "segment long, bits binary").toLocalIterator():  # a row a segment
        out[r.segment * SEGMENT : (r.segment + 1) * SEGMENT] = np.frombuffer(r.bits, np.uint8)
    return out[: (size + 7) // 8]


def build_cascade(inside: DataFrame, outside: DataFrame) -> list[Level]:
    """Levels for the keys ``inside`` against ``outside``, disjoint tables of (h1, h2)."""
    levels: list[Level] = []
    while (count := inside.count()) > 0:
        size, n = max(64, BITS_PER_KEY * count), len(levels)
        level = Level(_fill(inside.select("h1", "h2"), n, size), size)
        levels.append(level)

        def through(batches: Iterator[pd.DataFrame], level: Level = level, n: int = n) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf[passes(level, n, pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64))]

        wrong = written(outside.mapInPandas(through, outside.schema), "cascade-level")
        inside, outside = wrong, inside
    return levels


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.where(F.col("key").isNotNull()).distinct().select("key", *(h.alias(f"h{i + 1}") for i, h in enumerate(hash_pair(F.col("key")))))


def query_blocklist(pages: DataFrame) -> DataFrame:
    """The query's list (key): BLOCKLIST, and every sixteenth host of the pages, those whose MD5 begins with 7."""
    host, _ = host_and_path(F.col("url"))
    hosts = pages.select(host.alias("key")).distinct().where((F.col("key") != "") & F.md5(F.col("key").cast("binary")).startswith("7"))
    return hosts.unionByName(pages.sparkSession.createDataFrame([(d,) for d in BLOCKLIST], "key string"))


def filter_urls(pages: DataFrame, blocklist: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and listed of every page.

    A url with a fitting rule gets its verdict; any other is blocked if its host or a parent domain is
    in ``blocklist`` (key; nulls are left out, repeated keys count once). Null urls and urls without
    ``://`` have an empty host, which fits no rule and is never listed. Urls of any length are taken as
    a whole; repeated rows get equal verdicts. An empty list blocks nothing by itself.
    """
    spark = pages.sparkSession
    small_batches(spark)
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    universe = parsed.select("host").distinct().select(F.explode(domains(F.col("host"))).alias("key"))
    inside = written(_hashed(blocklist.select("key").where("key != ''")), "cascade-listed")
    outside = written(_hashed(universe).join(inside.select("key"), "key", "left_anti"), "cascade-others")
    parts = max(1, -(-inside.count() * BITS_PER_KEY // (8 * PART_BYTES)))
    keys = domains(F.col("host"))
    h1, h2 = F.transform(keys, lambda k: hash_pair(k)[0]), F.transform(keys, lambda k: hash_pair(k)[1])
    kind = pages.schema["page_id"].dataType.simpleString()
    judged = parsed.select("page_id", "host", "path", h1.alias("h1"), h2.alias("h2"), F.lit(False).alias("listed"))
    for part in range(parts):
        own = lambda df, part=part: df.where(F.pmod(F.col("h1"), F.lit(parts)) == part).select("h1", "h2")
        levels = spark.sparkContext.broadcast(build_cascade(own(inside), own(outside)))

        def judge(batches: Iterator[pd.DataFrame], levels=levels, part: int = part) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    flat = [np.concatenate([np.asarray(x, np.int64) for x in pdf[c]]) for c in ("h1", "h2")]
                    hit = is_listed(levels.value, *flat) & (flat[0] % parts == part)
                    starts = np.cumsum([0, *map(len, pdf["h1"])])[:-1]
                    pdf["listed"] = pdf["listed"].to_numpy(bool) | np.logical_or.reduceat(hit, starts)
                yield pdf

        judged = judged.mapInPandas(judge, f"page_id {kind}, host string, path string, h1 array<long>, h2 array<long>, listed boolean")
        if part < parts - 1:
            judged = written(judged, "cascade-judged")
    rule, said = fitting_rule(F.col("host"), F.col("path"))
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"), "listed")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: a verdict for every page."""
    pages = read_table(spark, sf_dir, "pages")
    return filter_urls(pages, query_blocklist(pages))


_FIXED = ", ".join(f"'{d}'" for d in BLOCKLIST)
_CASES = "\n".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{said} {h}{p}'"
    for said, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
)
SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), listed_keys AS (
  SELECT DISTINCT host AS k FROM parsed WHERE host <> '' AND starts_with(md5(host), '7') UNION SELECT unnest([{_FIXED}])
), parents AS (
  SELECT host, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS k
  FROM (SELECT DISTINCT host FROM parsed)
), hit AS (
  SELECT DISTINCT host FROM parents JOIN listed_keys USING (k)
), ruled AS (
  SELECT *, CASE {_CASES} END AS r, host IN (SELECT host FROM hit) AS listed FROM parsed
)
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule,
       CASE WHEN r IS NOT NULL THEN split_part(r, ' ', 1) WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM ruled
"""
