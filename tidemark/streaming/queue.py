"""Queue life as a stream: keyed state, and event-time timers that free what ran out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.queue import ROWS, Entry

STATE = "status string, token long, attempts int, visible long, retry long"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class QueueLife(StatefulProcessor):
    """Calls of a batch are taken by ``at, seq``; a claim's end is a timer, dropped when the claim is extended or over."""

    def __init__(self, key: str, budget: int):
        self.key, self.budget = key, budget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.entry = handle, handle.getValueState("entry", STATE)

    def load(self) -> Entry:
        if not self.entry.exists():
            return Entry()
        s = self.entry.get()
        return Entry(s[0], int(s[1]), int(s[2]), None if s[3] is None or pd.isna(s[3]) else int(s[3]), None if s[4] is None or pd.isna(s[4]) else int(s[4]))

    def save(self, entry: Entry) -> None:
        """Keep the state and exactly the one timer it needs."""
        due = None if entry.visible is None else entry.visible * 1000
        for t in list(self.handle.listTimers()):
            if t != due:
                self.handle.deleteTimer(t)
        if due is not None:
            self.handle.registerTimer(due)
        self.entry.update(entry.values())

    def frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        names = [f.split()[0] for f in ROWS.split(", ")]
        out = pd.DataFrame(rows, columns=names)
        out.insert(0, self.key, key[0])
        return out.astype({"seq": "Int64"})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        entry, out = self.load(), []
        calls = pd.concat(list(rows)).sort_values(["at", "seq"])  # one micro-batch's calls of one entry
        for call in calls.astype(object).where(calls.notna(), None).to_dict("records"):
            out += entry.take(call, self.budget)
        self.save(entry)
        yield self.frame(key, out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        entry = self.load()
        out = entry.run_out(expiredTimerInfo.getExpiryTimeInMs() // 1000)
        if out:
            self.entry.update(entry.values())
            yield self.frame(key, out)

    def close(self) -> None:
        pass


def queue_life(calls: DataFrame, key: str, time: str, late: str = "0 seconds", budget: int = 3) -> DataFrame:
    """The rows of ``operators.queue.replay``, as the calls arrive; the session's state store must be ``STORE``."""
    kind = calls.schema[key].dataType.simpleString()
    timed = calls.withWatermark(time, late).groupBy(key)
    return timed.transformWithStateInPandas(QueueLife(key, budget), outputStructType=f"{key} {kind}, {ROWS}", outputMode="Append", timeMode="EventTime")
