"""Alert holds as streaming state: a series fires when every window of the trailing hold was in breach.

`transformWithState` keeps, per series, the ends of the last hold's windows and the closed windows the watermark has not passed yet.
An event-time timer wakes a series when the watermark passes its next window; windows are then judged in the order of
their ends, so the order in which they arrive does not matter. A series costs one read and one write of its state per
micro-batch, and its state is bounded by the hold and the watermark's delay.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from foresight.session import ROCKSDB
from foresight.streaming.windows import interval_us

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Hold:
    """The windows of one series: ends (microseconds) of breaches inside the hold, and windows still to be judged."""

    def __init__(self, hold_us: int, slide_us: int, state: str | None = None):
        self.hold_us, self.needed = hold_us, hold_us // slide_us + 1
        kept = json.loads(state) if state else {"breaches": [], "judged": None, "waiting": []}
        self.breaches, self.judged, self.waiting = kept["breaches"], kept["judged"], kept["waiting"]

    def add(self, end: int, breach: bool, row: str) -> None:
        """A closed window; one that ends no later than a window already judged came after the watermark and is dropped."""
        if self.judged is None or end > self.judged:
            self.waiting.append([end, bool(breach), row])

    def judge(self, until: int) -> Iterator[tuple[int, bool, str]]:
        """(end, firing, row) of the waiting windows that end by `until`, oldest first. Rows that repeat an end count once."""
        due = sorted(w for w in self.waiting if w[0] <= until)
        self.waiting = [w for w in self.waiting if w[0] > until]
        for end, breach, row in due:
            if breach and (not self.breaches or self.breaches[-1] != end):
                self.breaches.append(end)
            while self.breaches and self.breaches[0] < end - self.hold_us:
                self.breaches.pop(0)
            self.judged = end
            yield end, breach and len(self.breaches) == self.needed, row

    def next_end(self) -> int | None:
        return min((w[0] for w in self.waiting), default=None)

    def state(self) -> str:
        return json.dumps({"breaches": self.breaches, "judged": self.judged, "waiting": self.waiting})


class _HoldProcessor(StatefulProcessor):
    def __init__(self, hold_us: int, slide_us: int):
        self.hold_us, self.slide_us = hold_us, slide_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("hold", "state string")

    def _load(self) -> Hold:
        return Hold(self.hold_us, self.slide_us, self.value.get()[0] if self.value.exists() else None)

    def _save(self, hold: Hold) -> None:
        self.value.update((hold.state(),))
        end = hold.next_end()
        if end is not None:
            self.handle.registerTimer(-(-end // 1000))

    def handleInputRows(self, key, rows, timerValues):
        hold = self._load()
        for r in rows:
            hold.add(r["_end"], r["_breach"], r["_row"])
        self._save(hold)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        hold = self._load()
        for _, firing, row in hold.judge(timerValues.getCurrentWatermarkInMs() * 1000):
            yield Row(_row=row, firing=firing)
        self._save(hold)

    def close(self) -> None:
        pass


def keep_state_in_rocksdb(df: DataFrame) -> None:
    """Timers need the RocksDB state store; the setting holds for queries of this session that start later."""
    if df.sparkSession.conf.get(PROVIDER, "") != ROCKSDB:
        df.sparkSession.conf.set(PROVIDER, ROCKSDB)


def held_stream(windows: DataFrame, hold: str, slide: str, ts: str = "window_end", breach: str = "breach", by: Sequence[str] = ()) -> DataFrame:
    """The stream form of `held_breaches`: every closed window with `firing`, once the watermark has passed its end.

    `windows` is a stream with a watermark, such as the sliding statistics of `windows.py`; `by` names its series (null is a series).
    A breach that is null is none. A window without an end, or later than the watermark, is dropped. Columns stay as they are;
    a column named `firing` is replaced. Without `by` there is one series, whose windows, not rows, pass one task."""
    keep_state_in_rocksdb(windows)
    keep = windows.drop("firing")
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
    series = F.to_json(F.struct(*by), options) if by else F.lit("")
    packed = windows.where(F.col(ts).isNotNull()).select(
        series.alias("_series"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_end"), F.coalesce(F.col(breach).cast("boolean"), F.lit(False)).alias("_breach"),
        F.to_json(F.struct(*[F.col(c) for c in keep.columns]), options).alias("_row"))
    judged = packed.groupBy("_series").transformWithState(
        _HoldProcessor(interval_us(hold), interval_us(slide)), "_row string, firing boolean", "Append", "EventTime")
    return judged.select(F.from_json("_row", keep.schema, options).alias("w"), "firing").select("w.*", "firing")
