"""Media columns: texts stored as lossless WebP images, read back and described.

A payload (UTF-8, filled up with bytes 255 to a multiple of 576) becomes rows of 12 RGBA pixels, so a
unit of 576 bytes is a square of 12 by 12. Images hold at most 16,384 rows, the format's limit; longer
payloads take several files one after the other. Everything reported of the payload is computed from
the pixel arrays that the decoder gives.

The plan is one scan and one Arrow map, without a shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from . import webp
from .common import read_table, small_batches, text_of

UNIT, WIDTH, MAX_ROWS = 576, 12, 16384
ROW = 4 * WIDTH


def payload_of(text: str | None) -> tuple[bytes, int]:
    """The payload of a text and its unpadded size."""
    data = (text or "").encode("utf-8", "surrogatepass")
    units = max(1, -(-len(data) // UNIT))
    return data.ljust(units * UNIT, b"\xff"), len(data)


def store(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH, 4)
    return b"".join(webp.encode(rows[i : i + MAX_ROWS]) for i in range(0, len(rows), MAX_ROWS))


def pixels(media: bytes) -> np.ndarray:
    """The samples (rows, WIDTH, 4) of all files of a stored form."""
    parts, at = [], 0
    while at < len(media):
        samples, end = webp.decode(media[at:])
        parts.append(samples)
        at += end
    return np.concatenate(parts)


def feature_of(samples: np.ndarray) -> str:
    """Means of the four channels, and 64 bits that say which of 8 x 8 areas are brighter than the whole."""
    rows, columns, _ = samples.shape
    light = samples.sum(2, dtype=np.int64)
    y, x = (np.minimum(np.arange(8) * n // 8, n - 1) for n in (rows, columns))
    area = np.add.reduceat(np.add.reduceat(light, y, 0), x, 1)
    count = np.diff(np.append(y, rows)).clip(1)[:, None] * np.diff(np.append(x, columns)).clip(1)[None, :]
    bright = (area * light.size > count * light.sum()).ravel()
    means = samples.reshape(-1, 4).sum(0, dtype=np.int64) * 1000 // (rows * columns)
    return ":".join(map(str, means.tolist())) + ":" + np.packbits(bright).tobytes().hex()


OUT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id and media (binary) of every row. Null texts are empty: one unit of padding."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": [payload_of(t)[1] for t in pdf["text"]], "media": [store(payload_of(t)[0]) for t in pdf["text"]]})

    return docs.select("doc_id", text_of().alias("text")).mapInPandas(run, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """The digests and the feature of every stored form (doc_id, n_bytes, media), from its pixels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, n, m in zip(pdf["doc_id"], pdf["n_bytes"], pdf["media"], strict=True):
                samples = pixels(m)
                data = samples.tobytes()
                out.append((i, n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature_of(samples)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return media.mapInPandas(run, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every document stored, read back and described. Equal texts give equal rows but for doc_id."""
    return describe(media_column(read_table(spark, sf_dir, "documents")))
