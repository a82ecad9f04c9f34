"""Event-time as-of join of two streams: each ping with the last static record at or before its time.

State a vessel: its known static records, and the pings that wait until the watermark has passed them.
When it has, a ping leaves with the newest record not younger than it, or with none (left join), and
records that no later ping can need are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wakeline.operators.live import PING, SHIP, live_columns

DELAY = "5 seconds"
#: JSON keeps milliseconds unless told otherwise.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
OUT = "mmsi bigint, recorded_time timestamp, ping string, ship string"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastVersion(StatefulProcessor):
    """Rows in: side (0 static, 1 ping), at (microseconds), body (JSON)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", "at bigint, body string")
        self.waiting = handle.getListState("waiting", "at bigint, body string")
        self.due = handle.getValueState("due", "at bigint")  # the one timer that is set, in ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for side, state in ((0, self.versions), (1, self.waiting)):
                part = pdf[pdf["side"] == side]
                if len(part):
                    state.appendList([(int(a), b) for a, b in zip(part["at"], part["body"], strict=True)])
            pings = pdf.loc[pdf["side"] == 1, "at"]
            if len(pings):
                self._wake(int(pings.min()), timerValues)
        return iter(())

    def _wake(self, at: int, timerValues) -> None:
        """One timer a vessel: for its earliest waiting ping."""
        when = max(at // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1)
        due = self.due.get()[0] if self.due.exists() else None
        if due is None or when < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(when)
            self.due.update((when,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        waiting = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[0]) if self.waiting.exists() else []
        ready, rest = [r for r in waiting if r[0] <= limit], [r for r in waiting if r[0] > limit]
        if not ready:
            if rest:
                self._wake(rest[0][0], timerValues)
            return
        known = sorted((tuple(r) for r in self.versions.get()), key=lambda r: r[0]) if self.versions.exists() else []
        out, k = [], -1
        for at, body in ready:
            while k + 1 < len(known) and known[k + 1][0] <= at:
                k += 1
            out.append((key[0], pd.Timestamp(at, unit="us"), body, known[k][1] if k >= 0 else None))
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0], timerValues)
        else:
            self.waiting.clear()
        older = [i for i, r in enumerate(known) if r[0] <= limit]
        if older and older[-1] > 0:
            self.versions.put(known[older[-1] :])
        yield pd.DataFrame(out, columns=["mmsi", "recorded_time", "ping", "ship"])

    def close(self) -> None:
        pass


def as_of(pings: DataFrame, static: DataFrame, delay: str = DELAY) -> DataFrame:
    """The live view of two streams. The watermark is the lesser of both: a silent static stream holds it back."""
    spark = pings.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    side = lambda df, n, names: df.withWatermark("recorded_time", delay).select(
        "mmsi", "recorded_time", F.lit(n).alias("side"), F.unix_micros("recorded_time").alias("at"), F.to_json(F.struct(*names), TIMES).alias("body")
    )
    both = side(static, 0, SHIP).unionByName(side(pings, 1, PING)).where(F.col("mmsi").isNotNull())
    joined = both.groupBy("mmsi").transformWithStateInPandas(LastVersion(), OUT, "Append", "EventTime")
    ping_type = pings.select(F.struct(*PING)).schema[0].dataType
    ship_type = static.select(F.struct(*SHIP)).schema[0].dataType
    parsed = joined.select(F.from_json("ping", ping_type, TIMES).alias("p"), F.from_json("ship", ship_type, TIMES).alias("s"))
    return parsed.select("p.*", "s.*").select(*PING, *live_columns())
