"""MinHash near-dedup with fast similarity sketches.

A document's set holds its different word shingles, as 64-bit hashes. Its sketch has a fixed number of
coordinates, filled in rounds: in round i every shingle is hashed to a bin with the value i + fraction,
bins keep the least value, and from round T on round i throws everything into bin i - T, so that all
bins fill. Each coordinate of two sketches agrees with the sets' Jaccard similarity as probability, and
the number that agree is concentrated as for independent ones, at a cost of |set| + T log T.

Bands of coordinates send equal-looking sets to the same bucket. Within buckets, links are verified on
whole sets. Copies with equal sets are one class from the start. Every class is first compared with its
leader, the class of its buckets that meets the most others; in a large group of copies that is the
text they come from, and most of the group is one component after this. A bucket that still holds
several components gets one representative, the leader most of its classes have; the others are compared
with it too. What is left meets by an index on shingles, in an order that puts those the representative
lacks first, and the rarest of them before others: sets that are linked share one of the first. Two
bitmaps a class, of the representative's shingles it lacks and of those it adds, bound what two classes
can have in common, so that copies of a hot text that were changed in different places never become a
pair. Links inside a component can't change the result, so none is lost to this, and no group is
expanded into all its pairs.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, read_table, small_batches, text_of, written
from .components import connected_components, few_components

SHINGLE_WORDS = 5
#: Link at 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair at the threshold shares no bucket with probability (1 - 0.75**7)**90 < 3e-6.
BAND_ROWS, BANDS = 7, 90
COORDINATES = BAND_ROWS * BANDS
CACHE_WORDS = 400_000
#: Candidates up to this many are looked up by a broadcast of their keys (16 bytes each); beyond, by a shuffle.
BROADCAST_IDS = 2_000_000

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash, emptied at CACHE_WORDS."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted different hashes of the text's word shingles; with fewer words, of the whole sequence."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    at = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(at) - n + 1, np.uint64(n))
    for j in range(n):
        out = _mix(out * _C[j % 5] + at[j : len(at) - n + 1 + j])
    return np.unique(out)


def sketch(items: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """T coordinates: the round (upper bits) and fraction that won each bin."""
    out = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    need = int(t * (np.log(t) + 2))
    at, limit = 0, 2 * t
    while at < limit:
        some = max(1, min(limit - at, need // len(items) + 1))
        rounds = np.arange(at, at + some, dtype=np.uint64)
        h = _mix(items[None, :] + _mix(rounds + np.uint64(1))[:, None])
        value = (rounds[:, None] << np.uint64(40)) | (h >> np.uint64(24))
        own = np.maximum(rounds, np.uint64(t)) - np.uint64(t)
        bins = np.where(rounds[:, None] < t, ((h & np.uint64(0xFFFFFF)) * np.uint64(t)) >> np.uint64(24), own[:, None])
        bins, value = bins.ravel().astype(np.int64), value.ravel()
        np.minimum.at(out, bins, value)
        at += some
        if out.max() != np.iinfo(np.uint64).max:
            break
    return out


_BAND_SALT = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def bands(items: np.ndarray) -> np.ndarray:
    """One bucket key a band, as signed 64-bit numbers; the key holds the band's number too."""
    rows = sketch(items).reshape(BANDS, BAND_ROWS)
    key = _BAND_SALT.copy()
    for j in range(BAND_ROWS):
        key = _mix(key * _C[0] + rows[:, j])
    return key.view(np.int64)


def class_id(items: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """The link test, on whole sets."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for pdf in batches:
        sets = [shingles(t, hashes) for t in pdf["text"]]
        yield pd.DataFrame(
            {
                "doc_id": pdf["doc_id"],
                "th": pdf["th"],
                "cid": pd.array([class_id(s) if len(s) else None for s in sets], dtype="Int64"),
                "n_shingles": [len(s) for s in sets],
                "keys": [bands(s) if len(s) else None for s in sets],
            }
        )


def _with_class(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for pdf in batches:
        cids = [class_id(shingles(t, hashes)) for t in pdf["text"]]
        yield pd.DataFrame({"cid": cids, "text": pdf["text"]})


def first_shingles(x: np.ndarray, leader: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int, int, np.ndarray]:
    """Shingles of x that the leader lacks, some that it has, the number of the former, how many count, and what x lacks.

    Sets that are linked share percent of the larger one. In any order common to both, the first shared
    shingle lies among the first n - percent * n + 1 of each. The order puts those not in the leader
    first, so that only as many of the others are needed as are missing.
    """
    inside = np.isin(x, leader, assume_unique=True)
    need = len(x) - -(-percent * len(x) // 100) + 1
    out, both = x[~inside], x[inside]
    lost = np.setdiff1d(leader, both, assume_unique=True)
    return np.concatenate([out, both[: max(0, need - len(out))]]), len(out), need, lost


#: 64-bit words of a bitmap of shingles.
MAP_WORDS = 4


def bitmap(items: np.ndarray) -> list[int]:
    """Which of 64 * MAP_WORDS numbers the shingles' hashes have as remainder, as signed 64-bit words."""
    flat = np.zeros(64 * MAP_WORDS, np.uint8)
    flat[(items % np.uint64(64 * MAP_WORDS)).astype(np.int64)] = 1
    return np.packbits(flat, bitorder="little").view(np.int64).tolist()


TESTED = "a long, b long, ok boolean, n_a int, n_b int, firsts array<long>, outside int, need int, lost array<long>, new array<long>"


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, sets = WordHashes(), {}
    for pdf in batches:
        out = []
        for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"], strict=True):
            if a not in sets:
                if len(sets) >= 64:
                    sets.clear()
                sets[a] = shingles(x, hashes)
            own, whole = shingles(y, hashes), sets[a]
            found, outside, need, lost = first_shingles(own, whole)
            out.append((a, b, similar(whole, own), len(whole), len(own), found.view(np.int64), outside, need, bitmap(lost), bitmap(found[:outside])))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in TESTED.split(", ")])


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """TESTED of pairs (a, b), from whole texts (cid, text): b as seen from a."""
    of = lambda x: texts.select(F.col("cid").alias(x), F.col("text").alias(f"text_{x}"))
    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "text_a", "text_b")
    return joined.mapInPandas(_verified, TESTED)


#: Links up to this many are joined by one task where the caller allows it; more by distributed union-find.
FEW_LINKS = 2_000_000


def components_of(links: DataFrame, n_links: int, native: bool) -> DataFrame:
    """Components of links whose number is known; native ones always by DataFrame operations."""
    few = not native and n_links <= FEW_LINKS
    return few_components(links) if few else connected_components(links)


def _most(x: str, y: str) -> Column:
    """The most shingles that two classes of one representative can share.

    Of the representative's they share what neither lacks; bits of both maps together count at least as
    many as are lacking. Of the rest, bits that only one map has count shingles the other has not.
    """
    bits = lambda column, other, f: reduce(operator.add, (F.bit_count(f(F.col(column)[k], F.col(other)[k])) for k in range(MAP_WORDS)))
    gone = bits(f"lost_{x}", f"lost_{y}", lambda p, q: p.bitwiseOR(q))
    alone = lambda s, t: F.col(f"outside_{s}") - bits(f"new_{s}", f"new_{t}", lambda p, q: p.bitwiseAND(F.bitwise_not(q)))
    inside = F.least(F.col(f"n_a_{x}") - gone, F.col(f"inside_{x}"), F.col(f"inside_{y}"))
    return inside + F.when(F.col(f"own_{x}"), F.lit(0)).otherwise(F.least(alone(x, y), alone(y, x)))


def _shared(firsts: DataFrame, key: list[str]) -> DataFrame:
    """Shingles that several classes of a group have, one of them unsettled, with their number; all others meet nothing."""
    group = Window.partitionBy(*key)
    return firsts.withColumn("rarity", F.count("*").over(group)).withColumn("open", F.max("far").over(group)).where("rarity > 1 and open")


def _meet_mapped(listed: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: classes of a group that share one of their first shingles, and may share enough by their bitmaps."""
    c = F.col
    met = _shared(firsts.select("a", "b", "g", "far", "need", "outside", "own"), ["a", "g"])
    # Of the many that the representative lacks, the rarest count, those that meet nothing among them.
    w = Window.partitionBy("a", "b")
    place = F.row_number().over(w.orderBy("own", "rarity", "g")) + c("outside") - F.count_if(~c("own")).over(w)
    met = written(met.withColumn("place", place).where(c("own") | (c("place") <= c("need"))).select("a", "b", "g", "own"), "met")
    facts = ("b", "comp", "n_b", "inside", "outside", "n_a", "lost", "new")
    known = listed.select("a", "far", *facts)
    side = lambda far, s: met.join(known.where("far") if far else known, ["a", "b"]).select("a", "g", *(c(x).alias(f"{x}_{s}") for x in (*facts, "own")))
    fit = (100 + percent) * _most("x", "y") >= percent * (c("n_b_x") + c("n_b_y"))
    other = (c("comp_x") != c("comp_y")) & (100 * F.least("n_b_x", "n_b_y") >= percent * F.greatest("n_b_x", "n_b_y"))
    on = (c("l.a") == c("r.a")) & (c("l.g") == c("r.g")) & other & fit
    pairs = side(True, "x").alias("l").join(side(False, "y").alias("r"), on)
    return written(pairs.select(F.least("b_x", "b_y").alias("a"), F.greatest("b_x", "b_y").alias("b")).distinct(), "pairs")


def links_of(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], percent: int = PERCENT, meet: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """All verified links (a, b) that matter for the components of the classes in ``buckets``, and their number.

    buckets: key, cid, others (other rows in the bucket). verify turns pairs (a, b) into TESTED. meet, where
    given, turns members (a, b, comp, far) of unresolved groups a into the pairs to verify; verify then need
    not give more than (a, b, ok), and all that is done here are DataFrame operations.
    """
    c = F.col
    key = Window.partitionBy("key")
    degree = F.sum("others").over(Window.partitionBy("cid"))
    head = F.max(F.struct("degree", "cid")).over(key)
    ranked = buckets.withColumn("degree", degree).withColumn("head", head)
    leaders = ranked.groupBy("cid").agg(F.max("head").alias("h"))
    tested = written(verify(leaders.select(c("h.cid").alias("a"), c("cid").alias("b"))), "tested")
    near = tested.where((c("a") != c("b")) & c("ok")).select("a", "b")
    n_near = near.count()
    parts = written(components_of(near, n_near, meet is not None).select(c("node").alias("cid"), "component"), "parts")
    led = tested.select(c("b").alias("cid"), c("a").alias("leader")).join(parts, "cid", "left")
    led = led.select("cid", "leader", F.coalesce("component", "cid").alias("comp"))
    rows = buckets.select("key", "cid").join(led, "cid").withColumn("lo", F.min("comp").over(key)).withColumn("hi", F.max("comp").over(key))
    rows = written(rows.where("lo != hi").select("key", "cid", "comp", "leader"), "unresolved")
    # One representative a bucket: the leader that most of its classes have.
    main = rows.groupBy("key", "leader").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "leader"))["leader"].alias("a"))
    members = written(rows.select("key", c("cid").alias("b"), "comp").join(main, "key").select("a", "b", "comp").distinct(), "members")
    fresh = members.select("a", "b").join(tested.select("a", "b"), ["a", "b"], "left_anti")
    again = written(verify(fresh), "tested")
    both = tested.unionByName(again)
    # A class is settled in a group if it is linked to the representative, or in its component anyway.
    of_main = parts.select(c("cid").alias("a"), c("component").alias("comp_a"))
    listed = members.join(both, ["a", "b"]).join(of_main, "a", "left").withColumn("far", ~c("ok") & (c("comp") != F.coalesce("comp_a", "a")))
    if meet is None:
        listed = written(listed.withColumn("inside", c("n_b") - c("outside")).drop("ok", "comp_a"), "listed")
        firsts = listed.select("a", "b", "far", "need", "outside", "inside", "n_b", F.posexplode("firsts").alias("at", "g")).withColumn("own", c("at") >= c("outside"))
        # Two classes that share none of what the representative lacks need enough of the rest for a link.
        firsts = firsts.where(~c("own") | (100 * c("inside") >= percent * c("n_b")))
        pairs = _meet_mapped(listed, firsts, percent)
    else:
        listed = written(listed.select("a", "b", "comp", "far"), "listed")
        pairs = written(meet(listed), "pairs")
    seen = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = written(verify(pairs.join(seen, ["a", "b"], "left_anti")).where("ok").select("a", "b"), "more")
    found = written(near.unionByName(again.where("ok").select("a", "b")).unionByName(more), "found")
    discard(tested, parts, rows, members, again, listed, pairs, more)
    return found, found.count()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Null and empty texts have no shingles and are linked with nothing: they form a component of their
    own. Texts shorter than a shingle are one shingle. Rows with equal sets are one class; a repeated
    doc_id is kept in every row if it is its component's least. Null doc_ids come last: a component of
    nothing else has a null component_id. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", text_of().alias("text")).withColumn("th", F.xxhash64("text"))
    rows = written(docs.mapInPandas(_sketched, "doc_id long, th long, cid long, n_shingles long, keys array<long>"), "sketches")
    classes = rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.first("keys").alias("keys"))
    exploded = classes.select("cid", F.explode("keys").alias("key"))
    by_key = Window.partitionBy("key")
    shared = exploded.withColumn("others", F.count("*").over(by_key) - 1).where("others > 0")
    buckets = written(shared.select("key", "cid", "others"), "buckets")
    # A class's text is looked up by the hash of a text of its least row, which rows without a doc_id have too.
    row = F.coalesce("doc_id", F.lit(2**63 - 1))
    heads = rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("doc_id").alias("head"), F.min(row).alias("row"), F.min_by("th", row).alias("th"))
    heads = written(heads, "heads")
    wanted = written(buckets.select("cid").distinct().join(heads, "cid").select("cid", "row", "th"), "candidates")
    heads = heads.select("cid", "head")
    few = wanted.count() <= BROADCAST_IDS
    hint = F.broadcast if few else (lambda df: df)
    texts = docs.withColumn("row", row).join(hint(wanted.select("row", "th").distinct()), ["row", "th"], "left_semi")
    texts = texts.select("text").mapInPandas(_with_class, "cid long, text string").join(hint(wanted.select("cid")), "cid", "left_semi")
    texts = written(texts.groupBy("cid").agg(F.first("text").alias("text")), "texts")
    links, n_links = links_of(buckets, lambda pairs: _verify(pairs, texts))
    discard(buckets, wanted, texts)
    if n_links:
        parts = components_of(links, n_links, False)
        least = heads.join(parts, F.col("cid") == F.col("node")).select("cid", "component", "head")
        tops = least.groupBy("component").agg(F.min("head").alias("top"))
        heads = heads.join(least.join(tops, "component").select("cid", "top"), "cid", "left")
        heads = heads.select("cid", F.coalesce("top", "head").alias("head"))
    out = rows.select("doc_id", "cid", "n_shingles").join(heads, "cid", "left")
    top = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    return out.select("doc_id", "n_shingles", top.alias("component_id"), top.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that are not their component's least doc_id; same columns.

    The ids that go are sent to every executor while they are few, and joined by a shuffle beyond.
    Rows without a doc_id stay.
    """
    gone = written(near_duplicates(docs).where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "copies")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: a row per document with its component."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


#: The same by brute force: all pairs that share a shingle, and everything reachable over links.
SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach(doc_id, r) AS (SELECT x, y FROM e UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.r = e.x),
least_of AS (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""
