"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by log-count ratios.

Indicators say which byte n-grams (one to three) a text holds, and which runs of repeated words, each
hashed to one of FEATURES numbers. Counts of documents of either class that hold a feature are summed
over all labelled training rows, in Spark; their smoothed log ratio scales the indicator. The weights
come from dual coordinate descent on a sample of labelled rows, bounded by SAMPLE rows a class. Scores
are the logistic of the margin, its two numbers fitted on the same sample with the classes at their
true shares.

Plan: labels meet texts in a join (broadcast while labels are proven small), then one Arrow map over
all texts with a model of 512 KB.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read_table, small_batches, text_of, written

FEATURES = 1 << 16
#: At most about this many labelled rows of each class fit the weights (documented bound).
SAMPLE = 4000
EPOCHS, COST, SMOOTH = 12, 1.0, 1.0
BIAS = 1.0
THRESHOLD = 0.7
#: n-grams of the stream that says of each word whether it equals the next.
REPEATS = (b"\1", b"\1\1", b"\1" * 4, b"\1" * 8, b"\1\0\1", b"\1\0\1\0\1")
#: Labels up to this many rows are sent to every executor (16 bytes each), more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
HELD_OUT_OF = 4


def features(text: str | None) -> np.ndarray:
    """Sorted different features of a whole text; none for null and empty texts."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return np.zeros(0, np.int64)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    has = np.zeros(FEATURES, bool)
    code = b + np.uint32(1)
    for n in range(3):
        if n:
            code = code[:-1] * np.uint32(257) + b[n:] + np.uint32(1)
        has[(code * np.uint32(2654435761)) >> np.uint32(16)] = True
    words = data.split()
    same = bytes(map(eq, words, words[1:]))
    for n, run in enumerate(REPEATS):
        if run in same:
            has[((1 << 28) + n) * 2654435761 % (1 << 32) >> 16] = True
    return np.flatnonzero(has)


def packed(found: np.ndarray) -> bytes:
    """Features as one bit each, deflated: 8 KB at most, however long the text is."""
    has = np.zeros(FEATURES, np.uint8)
    has[found] = 1
    return zlib.compress(np.packbits(has).tobytes(), 1)


def unpacked(rows: pd.Series, ratio: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, values) of packed rows, of unit length: parts of two large arrays, whose memory goes back as a whole."""
    bits = lambda x: np.frombuffer(zlib.decompress(x), np.uint8)
    ends = np.cumsum([0, *(int(np.bitwise_count(bits(x)).sum()) for x in rows)]).tolist()
    features, values = np.empty(ends[-1], np.uint16), np.empty(ends[-1])
    out = []
    for x, i, j in zip(rows, ends, ends[1:]):  # noqa: B905
        f, v = features[i:j], values[i:j]
        f[:] = np.flatnonzero(np.unpackbits(bits(x)))
        v[:] = ratio[f]
        v /= np.sqrt(v @ v) or 1.0
        out.append((f, v))
    return out


@dataclass
class Model:
    ratio: np.ndarray  # log-count ratios
    weight: np.ndarray  # of scaled indicators
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        r = self.ratio[found]
        norm = float(np.sqrt(r @ r)) or 1.0
        return float(self.weight[found] @ r) / norm + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.margin(found) + self.shift))))


def log_count_ratio(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    p, q = pos + SMOOTH, neg + SMOOTH
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1 hinge-loss machine; rows are (features, values) of unit length."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    square = np.array([v @ v for _, v in rows]) + BIAS * BIAS
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            slack = y[i] * (w[f] @ v + bias * BIAS) - 1
            new = min(max(alpha[i] - slack / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[f] += step * v
                bias += step * BIAS
                alpha[i] = new
    return w, bias * BIAS


def calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic that fits smoothed targets, by Newton steps."""
    n_pos, n_neg = weight[y > 0].sum(), weight[y < 0].sum()
    target = np.where(y > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * theta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled rows that are not held out. Null labels are left out, of several the least counts.

    Texts of any length count as a whole, null and empty ones without a feature; rows that repeat a
    doc_id are rows of their own.
    Without rows of both classes every score is the share of label 1 (1 without labels).
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(HELD_OUT_OF))
    known = written(known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")), "labels")
    sizes = {r.quality > 0: r.n for r in known.groupBy((F.col("quality") > 0).cast("int").alias("quality")).agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_neg:
        share = 1.0 if n_pos or not n_neg else 0.0
        zero = np.zeros(FEATURES)
        return Model(zero, zero, 0.0, 1.0, 30.0 if share else -30.0)
    side = F.broadcast(known) if n_pos + n_neg <= BROADCAST_LABELS else known
    # The share of a class that its sample takes, as a bound on a hash of the id.
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = draw < F.when(F.col("quality") > 0, F.lit(SAMPLE / n_pos)).otherwise(F.lit(SAMPLE / n_neg))
    rows = docs.select("doc_id", text_of().alias("text")).join(side, "doc_id").withColumn("drawn", drawn)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, FEATURES), np.int64)
        for pdf in batches:
            kept = []
            for i, text, q, d in zip(pdf["doc_id"], pdf["text"], pdf["quality"], pdf["drawn"], strict=True):
                found = features(text)
                counts[int(q > 0), found] += 1
                if d:
                    kept.append((i, int(q > 0), packed(found)))
            yield pd.DataFrame(kept, columns=["doc_id", "label", "found"])
        # The counts of a task, in one row.
        yield pd.DataFrame({"doc_id": [None], "label": [-1], "found": [counts.astype("<i8").tobytes()]})

    seen = written(rows.mapInPandas(run, "doc_id long, label int, found binary"), "features")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, FEATURES), np.int64)
        for pdf in batches:
            for x in pdf["found"]:
                total += np.frombuffer(x, "<i8").reshape(2, FEATURES)
        held = np.flatnonzero(total.any(axis=0))
        yield pd.DataFrame({"feature": held, "neg": total[0, held], "pos": total[1, held]})

    sums = seen.where("label < 0").mapInPandas(unpack, "feature long, neg long, pos long")
    pos, neg = np.zeros(FEATURES), np.zeros(FEATURES)
    totals = sums.groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toArrow()  # at most FEATURES rows
    at = totals["feature"].to_numpy()
    neg[at], pos[at] = totals["neg"].to_numpy(), totals["pos"].to_numpy()
    ratio = log_count_ratio(pos, neg)
    sample = seen.where("label >= 0").toArrow().to_pandas().sort_values("doc_id")  # about 2 * SAMPLE rows of 8 KB at most
    y = np.where(sample["label"].to_numpy() > 0, 1.0, -1.0)
    data = unpacked(sample["found"], ratio)
    k_pos, k_neg = max(1, (y > 0).sum()), max(1, (y < 0).sum())
    cost = COST * np.where(y > 0, 1.0, max(1.0, k_pos / k_neg))
    weight, bias = dual_coordinate_descent(data, y, cost, FEATURES)
    margin = np.array([weight[f] @ v + bias for f, v in data])
    truth = np.where(y > 0, n_pos / k_pos, n_neg / k_neg)
    truth *= len(y) / truth.sum()
    slope, shift = calibrate(margin, y, truth)
    return Model(ratio.astype(np.float32), weight.astype(np.float32), float(bias), slope, shift)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; nothing but the text enters the score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            scores = [m.score(features(t)) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": scores, "predicted": [int(s >= THRESHOLD) for s in scores]})

    rows = docs.select("doc_id", held_out(HELD_OUT_OF).alias("held_out"), text_of().alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents predicted good, with the columns they came with."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(features(t)) >= THRESHOLD for t in texts])

    return docs.where(good(text_of()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: a score for every document."""
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, read_table(spark, sf_dir, "labels")))
