"""Secret scans over an incremental blob ledger.

Every version of every document is addressed by the SHA-256 of its text (the blob). The ledger holds
one row per (blob, rules version) with the spans found there. A scan reads only the blobs that the
ledger lacks for the present rules, appends them, and joins the findings back to all paths. Rescanning
an unchanged corpus therefore reads no text twice, and a new rules version rescans each blob once.

Plan: one shuffle of texts by blob, in which equal texts meet once per map task already; the join back
moves keys and spans only. A hot blob is one row of the ledger; its many paths are the long side of a
sort-merge join that adaptive execution may split.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shared_dir, small_batches, text_of

#: Kinds of the base rules in their order, then those the ledger's rules add.
BASE_KINDS = ("assign", "access", "hex")
EXTRA_KINDS = ("pem", "jwt", "bearer", "url_login")
KINDS = BASE_KINDS + EXTRA_KINDS

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
BEARER = re.compile(r"(?ai)\bbearer\x20+[A-Za-z0-9._~+/=-]{20,}")
URL_LOGIN = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s/@:]++:[^\s/@]{3,}+@")
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: Follows from the rules, so that findings of other rules never count as those of the present ones.
RULES_VERSION = hashlib.sha256(repr((KINDS, [(r.pattern, r.flags) for r in (ASSIGN, ACCESS, HEX, PEM, JWT, BEARER, URL_LOGIN)], LEAST_VALUE, LEAST_ACCESS)).encode()).hexdigest()[:16]


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of every span, sorted; code points, end exclusive.

    Each rule runs only where a literal that all its matches contain occurs at all.
    """
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        found += [(m.start(), 3, m.end()) for m in PEM.finditer(text)]
    if "eyJ" in text:
        found += [(m.start(), 4, m.end()) for m in JWT.finditer(text)]
    if "bearer" in text.lower():
        found += [(m.start(), 5, m.end()) for m in BEARER.finditer(text)]
    if "://" in text and "@" in text:
        found += [(m.start(), 6, m.end()) for m in URL_LOGIN.finditer(text)]
    return sorted(found)


LEDGER = "blob binary, rules string, kinds array<int>, starts array<int>, ends array<int>"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        spans = [find_secrets(t) for t in pdf["_text"]]
        yield pd.DataFrame(
            {
                "blob": pdf["blob"],
                "rules": RULES_VERSION,
                "kinds": [[k for _, k, _ in s] for s in spans],
                "starts": [[a for a, _, _ in s] for s in spans],
                "ends": [[b for _, _, b in s] for s in spans],
            }
        )


def blob_of() -> Column:
    """The content address of the text (null counts as empty)."""
    return F.unhex(F.sha2(text_of().cast("binary"), 256))


def with_blob(docs: DataFrame) -> DataFrame:
    """Documents with their content address as ``blob``."""
    return docs.withColumn("blob", blob_of())


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows, or none where it has not been written yet."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(LEDGER).parquet(ledger)
    return spark.createDataFrame([], LEDGER)


def findings(spark: SparkSession, ledger: str) -> DataFrame:
    """(blob, kinds, starts, ends) of the blobs with findings under the present rules, one row each.

    Two writers may both have scanned a blob; they found the same in it.
    """
    own = read_ledger(spark, ledger).where((F.col("rules") == RULES_VERSION) & (F.size("kinds") > 0))
    return own.groupBy("blob").agg(*(F.first(c).alias(c) for c in ("kinds", "starts", "ends")))


def update_ledger(docs: DataFrame, ledger: str) -> None:
    """Scan the blobs of ``docs`` that ``ledger`` lacks under the present rules, append them."""
    spark = docs.sparkSession
    small_batches(spark)
    blobs = with_blob(docs.select(text_of().alias("text"))).groupBy("blob").agg(F.first("text").alias("_text"))
    seen = read_ledger(spark, ledger).where(F.col("rules") == RULES_VERSION).select("blob")
    unseen = blobs.join(seen, "blob", "left_anti")
    unseen.mapInPandas(_scan, LEDGER).write.mode("append").option("compression", "zstd").parquet(ledger)


def new_ledger(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/wakeline/ledger-{uuid.uuid4().hex}"


def scan_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` rows' doc_id with kinds, starts and ends of all spans of their texts.

    Null texts are empty and have no spans. Repeated rows are scanned once and all reported. Without a
    ledger a new one is started in the shared folder. A ledger of the same rules makes known blobs free.
    """
    spark = docs.sparkSession
    ledger = ledger or new_ledger(spark)
    update_ledger(docs, ledger)
    found = findings(spark, ledger)
    return with_blob(docs.select("doc_id", "text")).select("doc_id", "blob").join(found, "blob", "left")


#: Findings up to this size are sent to every executor when texts are redacted; beyond, they are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def redact_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Documents with every secret replaced by ``[kind]``, and n_chars renewed; same columns, all rows."""
    spark = docs.sparkSession
    ledger = ledger or new_ledger(spark)
    update_ledger(docs, ledger)
    found = findings(spark, ledger)
    size = found.agg(F.count("*") * 96 + F.coalesce(F.sum(F.size("kinds")), F.lit(0)) * 12).first()[0]
    found = found.select(*[F.col(c).alias(f"_wl_{c}") for c in ("blob", "kinds", "starts", "ends")])  # names that can't clash
    joined = docs.withColumn("_wl_blob", blob_of()).join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "_wl_blob", "left")
    kept, names = F.col("text"), F.array(*[F.lit(f"[{k}]") for k in KINDS])
    # Overlapping spans: one that starts inside an earlier one is cut to what that one left.
    spans = F.sort_array(F.arrays_zip("_wl_starts", "_wl_ends", "_wl_kinds"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    built = F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["_wl_ends"]).alias("at"),
            F.when(s["_wl_starts"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.substring(kept, acc["at"] + 1, s["_wl_starts"] - acc["at"]), F.get(names, s["_wl_kinds"])))
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(kept, acc["at"] + 1, F.length(kept))),
    )
    text = F.when(F.col("_wl_kinds").isNull(), kept).otherwise(built)
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, kinds, starts, ends in zip(pdf["doc_id"], pdf["kinds"], pdf["starts"], pdf["ends"], strict=True):
            spans = list(zip(kinds, starts, ends, strict=True)) if kinds is not None else []
            show = [(k, f"{KINDS[k]}:{a}:{b}") for k, a, b in spans]
            base = ",".join(s for k, s in show if k < len(BASE_KINDS))
            counts = [sum(k == n for k, _ in show) for n in range(len(BASE_KINDS))]
            rows.append((i, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(s for _, s in show)))
        yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: a row per document with counts, digest and spans, through a fresh ledger."""
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "kinds", "starts", "ends").mapInPandas(
        _digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
