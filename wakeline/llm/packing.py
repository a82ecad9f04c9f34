"""Conflict-constrained best-fit packing of documents into training sequences.

A document of n words takes n + 1 tokens. Whole multiples of the capacity fill bins of their own; the
rest is packed by best-fit decreasing: bins are ordered by residual, and the successor search goes up
from the first residual that is large enough until it meets a bin that holds neither the item's source
nor its duplicate cluster, which its bitmaps tell.

Only ids, sizes and hashes are shuffled, never texts. Items are dealt to shards of bounded size by a
hash of the row, its place in the table included, so that a hot source, a hot cluster and rows that repeat
are spread over all shards. Each shard packs on its own: the tightest bin is the tightest of the shard.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, let, read_table, small_batches, text_of, written

CAPACITY = 2048
#: Items a shard holds on average. At least one bin a shard stays part empty.
SHARD_ITEMS = 8192

OUT = "doc_id long, piece long, n_tokens long, bin_id long, slot long"


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int = CAPACITY) -> list[int]:
    """The bin of every item, items being taken in the order given."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    often = [c for c, n in Counter(clusters).items() if n > 1 and c is not None]
    cluster_bit = {c: 1 << i for i, c in enumerate(often)}
    # Bins by residual, there by the sources they hold; and how many of them hold each source.
    at_residual: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
    holding: list[Counter] = [Counter() for _ in range(capacity + 1)]
    number = [0] * (capacity + 1)
    occupied = 0  # bit r: some bin has residual r
    held_sources: list[int] = []
    held_clusters: list[int] = []
    inside: list[list[int]] = []  # source bits of a bin, one by one
    out = []

    def take(residual: int, s: int, c: int) -> int:
        """Remove and return a bin without conflict, -1 if there is none."""
        if holding[residual][s] == number[residual]:
            return -1
        for sources, bins in at_residual[residual].items():
            if sources & s:
                continue
            for k, b in enumerate(bins):
                if not held_clusters[b] & c:
                    del bins[k]
                    if not bins:
                        del at_residual[residual][sources]
                    number[residual] -= 1
                    holding[residual].subtract(inside[b])
                    return b
        return -1

    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = source_bit[source], cluster_bit.get(cluster, 0)
        found, residual, ahead = -1, capacity, occupied >> size
        at = size
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            at += step
            found = take(at, s, c)
            if found >= 0:
                residual = at
                if not number[at]:
                    occupied ^= 1 << at
                break
            ahead >>= step + 1
            at += 1
        if found < 0:
            found = len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
            inside.append([])
        held_sources[found] |= s
        held_clusters[found] |= c
        inside[found].append(s)
        left = residual - size
        if left:
            at_residual[left].setdefault(held_sources[found], []).append(found)
            holding[left].update(inside[found])
            number[left] += 1
            occupied |= 1 << left
        out.append(found)
    return out


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, tokens and duplicate cluster (a hash of the words; null for texts without words)."""
    words = F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.xxhash64(F.array_join(w, " ")).alias("h")))
    found = docs.select("doc_id", F.col("source").cast("string").alias("source"), both.alias("b"))
    cluster = F.when(F.col("b.n") > 0, F.col("b.h"))
    return found.select("doc_id", "source", (F.col("b.n") + 1).alias("tokens"), cluster.alias("cluster"))


def pack(docs: DataFrame, capacity: int = CAPACITY, clusters: DataFrame | None = None) -> DataFrame:
    """A row for every piece of every document: bin_id and its slot there.

    clusters (doc_id, cluster: long; one row a doc_id) replaces the clusters of copies with equal words. No bin holds two pieces of one
    source or cluster, or more than ``capacity`` tokens. Null and empty texts take one token, their
    end; a null source is a source of its own. Ties are taken by doc_id. Every row of the input is
    packed, repeated ones too. An empty table gives no bins.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = sized(docs)
    if clusters is not None:
        items = items.drop("cluster").join(clusters.select("doc_id", "cluster"), "doc_id", "left")
    items = written(items, "items")  # a row's place is the same whenever this table is read
    shards = max(1, -(-items.count() // SHARD_ITEMS))
    items = items.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        whole, rest = pdf["tokens"].to_numpy() // capacity, pdf["tokens"].to_numpy() % capacity
        ids = pdf["doc_id"]
        order = np.lexsort((ids.fillna(-(2**62)).to_numpy(np.int64), -rest))
        order = order[rest[order] > 0]
        source = [None if pd.isna(x) else x for x in pdf["source"].iloc[order]]
        cluster = [None if pd.isna(x) else int(x) for x in pdf["cluster"].iloc[order]]
        bins = np.asarray(best_fit(rest[order].tolist(), source, cluster, capacity), np.int64)
        slots: Counter = Counter()
        slot = []
        for b in bins.tolist():
            slot.append(slots[b])
            slots[b] += 1
        first = int(bins.max()) + 1 if len(bins) else 0
        again = np.repeat(np.arange(len(pdf)), whole)
        starts = np.concatenate([[0], np.cumsum(whole)[:-1]]).astype(np.int64) if len(pdf) else np.zeros(0, np.int64)
        piece = np.arange(len(again)) - starts[again]
        out = pd.DataFrame(
            {
                "doc_id": pd.concat([ids.iloc[order], ids.iloc[again]], ignore_index=True),
                "piece": np.concatenate([whole[order], piece]).astype(np.int64),
                "n_tokens": np.concatenate([rest[order], np.full(len(again), capacity)]).astype(np.int64),
                "bin_id": (np.concatenate([bins, first + np.arange(len(again))]) + (shard << 32)).astype(np.int64),
                "slot": np.concatenate([np.asarray(slot, np.int64), np.zeros(len(again), np.int64)]),
            }
        )
        return out

    schema = "shard long, doc_id long, source string, tokens long, cluster long"
    columns = [c.split()[0] for c in schema.split(", ")]
    return items.select(*columns).groupBy("shard").applyInPandas(run, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: bins over all documents."""
    return pack(read_table(spark, sf_dir, "documents"))
