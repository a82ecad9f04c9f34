"""Shared plumbing of the training-data operators: tables, shared storage, batch sizes.

Everything an operator has to keep between two jobs goes to the folder named by
``spark.checkpoint.dir``: it is the one place that the driver and all executors see.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

#: Rows and bytes an Arrow batch holds at most, whichever comes first; a row of more bytes is a batch of its own.
ARROW_ROWS, ARROW_BYTES = 1024, 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the Python operators, alike for all of them, so that long texts fit in memory.

    Also sends this package to the executors, once an application: they need not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="wakeline-")) / f"{top.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all nodes share: the session's ``spark.checkpoint.dir``, or its context's checkpoint folder.

    Where neither is set, a new folder serves a session of one machine; a cluster has to name one.
    """
    set_in_context = spark.sparkContext._jsc.sc().getCheckpointDir()
    where = spark.conf.get("spark.checkpoint.dir", None) or (set_in_context.get() if set_in_context.isDefined() else None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="wakeline-")
    if not set_in_context.isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: its lineage ends there.

    Lost executors cost no recomputation beyond this table, and a later reader sees the same rows
    even where the plan above is not deterministic. Shuffle files of the plan above are let go.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/wakeline/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._wl_path = path
    spark.sparkContext._jvm.System.gc()  # Spark drops shuffle files once the driver's garbage is collected
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave, after the last job that reads them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._wl_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it in inner lambdas at no cost.

    An outer expression named inside a lambda is evaluated once an element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def held_out(remainder_of: int) -> Column:
    """crc32 of doc_id as text, modulo ``remainder_of``, equals 2. A null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % remainder_of == 2
