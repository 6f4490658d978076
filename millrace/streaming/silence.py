"""Alerts for keys that fall silent: per-key state with an event-time timer."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Silence(StatefulProcessor):
    """Remembers when a key was last seen, and has one timer that rings a gap later."""

    def __init__(self, key: str, gap_ms: int):
        self.key, self.gap_ms = key, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("last_seen", "at_us BIGINT, timer_ms BIGINT")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """Gaps between the batch's rows of a key, and before the first of them.

        A key's rows of one batch come as an iterator; only their times are held, as numbers.
        """
        at = sorted(r.at_us for r in rows if r.at_us is not None)
        if not at:
            return
        known, timer = self.seen.get() if self.seen.exists() else (at[0], None)
        last = known
        for now in at:
            if now - last > self.gap_ms * 1000:
                yield Row(**{self.key: key[0], "at_us": last})
            last = max(last, now)
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = last // 1000 + self.gap_ms + 1
        self.handle.registerTimer(timer)
        self.seen.update((last, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The watermark has passed the gap: nothing can come any more that would end it in time."""
        if self.seen.exists():
            yield Row(**{self.key: key[0], "at_us": self.seen.get()[0]})
            self.seen.clear()

    def close(self) -> None:
        pass


def silence_alerts(stream: DataFrame, key: str, time: str, gap_seconds: int) -> DataFrame:
    """A row whenever a key was not seen for longer than the gap: the key, ``last_seen``, ``silent_at``.

    The stream must be watermarked on ``time`` (see ``event_time.watermarked``). An open silence is
    told once the watermark is past it and the key is forgotten, so state holds the keys that are
    still active; a key seen again starts anew. Rows without a time start or end no silence.
    """
    kind = stream.schema[key].dataType.simpleString()
    times = stream.select(F.col(key), F.col(time), F.unix_micros(time).alias("at_us"))
    found = times.groupBy(key).transformWithState(
        Silence(key, gap_seconds * 1000), f"`{key}` {kind}, at_us BIGINT", "append", "eventTime"
    )
    return found.select(
        key,
        F.timestamp_micros("at_us").alias("last_seen"),
        F.timestamp_micros(F.col("at_us") + gap_seconds * 1_000_000).alias("silent_at"),
    )
