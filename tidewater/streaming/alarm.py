"""T5. Live alarm: T4's closed periods -> per-key state with event-time timers -> W1's rule.

Three steps, each with one owner:

* :func:`tidewater.streaming.jobs.stream_metrics` aggregates raw rows per key
  and period and emits a period once the watermark has closed it (rows later
  than that are dropped there and counted, see :func:`late_rows`);
* a stateful processor keeps the last ``periods`` flags of a key, fills
  silent periods between two rows, and wakes by an event-time timer to
  close the periods of a key that went silent;
* the breach flag and the state are the same column expressions that the
  batch :func:`tidewater.operators.timeseries.alarm` uses.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewater.operators import timeseries as TS
from tidewater.session import ship_by_value
from tidewater.streaming.jobs import stream_metrics

ship_by_value(__name__)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK_ROWS = 10_000  # rows of one output frame: a long silence is emitted in pieces


class AlarmPeriods(StatefulProcessor):
    """Every closed period of a key in order, silent ones included, with counts over its last ``periods`` flags.

    State: the next period to close, the last one with a row, and a letter per
    recent period ('1' breaches, '0' doesn't, '-' silent). Spark's own state
    TTL counts processing time only, so retention is a timer in event time.
    """

    def __init__(self, by: Sequence[str], periods: int, period_s: int, missing: str, ttl_s: int | None):
        self.by, self.periods, self.period_s, self.missing = list(by), periods, period_s, missing
        self.keep = None if ttl_s is None else -(-ttl_s // period_s)  # silent periods after which a key is forgotten

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alarm", "next long, seen long, flags string")

    def close(self) -> None:
        pass

    def _row(self, flags: str, period: int, value) -> tuple:
        silent = flags.count("-")
        return (period, value, flags[-1] == "1" or (flags[-1] == "-" and self.missing == "breach"),
                flags.count("1") + silent * (self.missing == "breach"), len(flags) - silent * (self.missing == "missing"), len(flags))

    def _emit(self, key: tuple, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        names = [*self.by, "period", "value", "breaching", "breaches", "present", "seen"]
        for row in rows:
            held.append((*key, *row))
            if len(held) == CHUNK_ROWS:
                yield pd.DataFrame(held, columns=names)
                held = []
        if held:
            yield pd.DataFrame(held, columns=names)

    def _wake(self, period: int) -> None:
        """One timer a key: when ``period`` has ended."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer((period + 1) * self.period_s * 1000)

    def _silence(self, stop: int) -> Iterator[tuple]:
        """Close the periods before ``stop``, which have no row."""
        nxt, seen, flags = self.state.get()
        for p in range(nxt, stop):
            flags = (flags + "-")[-self.periods:]
            yield self._row(flags, p, None)
        self.state.update((max(nxt, stop), seen, flags))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = pd.concat(list(rows)).sort_values("period")  # at most one row a period

        def run() -> Iterator[tuple]:
            for p, v, b in zip(closed["period"].tolist(), closed["value"].tolist(), closed["breaching"].tolist()):
                if not self.state.exists():
                    self.state.update((p, p, ""))
                yield from self._silence(p)
                _, _, flags = self.state.get()
                known = v is not None and v == v
                flags = (flags + (("1" if b else "0") if known else "-"))[-self.periods:]
                self.state.update((p + 1, p, flags))
                yield self._row(flags, p, v if known else None)
            self._wake(self.state.get()[0])

        yield from self._emit(key, run())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        _, seen, _ = self.state.get()
        stop = timerValues.getCurrentWatermarkInMs() // (1000 * self.period_s)  # the first period that is still open
        if self.keep is not None and stop > seen + self.keep:
            yield from self._emit(key, self._silence(seen + self.keep))
            self.state.clear()  # forgotten until it reports again
            return
        yield from self._emit(key, self._silence(stop))
        self._wake(self.state.get()[0])


def stream_alarm(df: DataFrame, ts: str, value: str, by: Sequence[str], stat: str, op: str,
                 threshold: float, periods: int, period_s: int = 300, delay: str = "10 minutes",
                 missing: str = "missing", ttl_s: int | None = 86_400) -> DataFrame:
    """Live W1 over raw metric rows; (by..., period_start, value, breaching, state), one row per closed period per key.

    Append mode, one or more key columns. A key silent for ``ttl_s`` seconds of
    event time (T10 retention; ``None`` keeps it) is forgotten until it reports
    again. Uses the RocksDB state store, which arbitrary state needs.
    """
    by, spark = list(by), df.sparkSession
    if not by:
        raise ValueError("a live alarm needs at least one key column")
    spark.conf.set(PROVIDER, ROCKSDB)
    stats = stream_metrics(df, ts, value, by, period_s, delay, closed_at="_closed")
    v = F.col(TS.STATISTICS.get(stat, stat)).cast("double")
    rows = stats.select(*by, "_closed", TS.period_index("period_start", "timestamp", period_s).alias("period"), v.alias("value"),
                        TS.breaches(v, op, threshold, missing).alias("breaching"))
    keys = ", ".join(f"`{c}` {t}" for c, t in df.select(*by).dtypes)
    out = rows.groupBy(*by).transformWithStateInPandas(
        AlarmPeriods(by, periods, period_s, missing, ttl_s),
        f"{keys}, period long, value double, breaching boolean, breaches int, present int, seen int", "Append", "EventTime")
    return out.select(*by, TS.period_time("period", "timestamp", period_s).alias("period_start"), "value", "breaching",
                      TS.alarm_state(F.col("breaches"), F.col("present"), F.col("seen"), periods).alias("state"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their period was closed, as far back as the query's progress goes."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
