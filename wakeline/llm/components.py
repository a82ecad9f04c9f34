"""Connected components by distributed union-find, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


#: Rows of a file of links, and what is taken for their number before the first round.
ROWS_PER_FILE, FIRST_ROWS = 200_000, 4_000_000


def _min_neighbour(edges: DataFrame) -> DataFrame:
    """Each node u of (u, v) with the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of all links of one task: least labels spread along links, and labels of labels are followed."""
    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    links = pd.concat(parts)
    nodes, at = np.unique(np.concatenate([links["a"].to_numpy(), links["b"].to_numpy()]), return_inverse=True)
    a, b = at[: len(links)], at[len(links) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            break
        least = np.minimum(x, y)[open_]
        np.minimum.at(label, x[open_], least)
        np.minimum.at(label, y[open_], least)
        while not np.array_equal(label, label[label]):
            label = label[label]
    yield pd.DataFrame({"node": nodes, "component": nodes[label]})


def few_components(edges: DataFrame) -> DataFrame:
    """``connected_components`` of edges whose number is proven small: one task joins them, in Python."""
    return edges.where(F.col("a") != F.col("b")).select("a", "b").coalesce(1).mapInPandas(_local, "node long, component long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long), component being its least node.

    Alternates the two union steps known as large star and small star: every node is hooked to the least
    neighbour it knows, then every node's known smaller neighbours are. Each step aggregates before it
    joins, so a hub costs one row in the aggregate and a splittable join side. The number of rounds grows
    with the logarithm of the longest chain. Each round is a table in the shared folder. Null ends and
    loops are left out; repeated edges do no harm; without edges the result is empty.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    links = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    before, last = None, []
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_min_neighbour(both), "u").where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = _min_neighbour(down)
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        # Small tables get few files, so that the next round's scan doesn't take a task for each shuffle partition.
        files = 1 + (before[0] if before else FIRST_ROWS) // ROWS_PER_FILE
        links = written(small.coalesce(files), "links")
        discard(*last)
        last = [links]
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
