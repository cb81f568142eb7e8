"""Runs of failures and deferred sweeps as stateful streams."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Stateful processors keep their state in this store: (setting, value).
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class InOrder(StatefulProcessor):
    """Holds a key's rows (millis, tie, flag) until the watermark has passed them and folds them in order, however they came in.

    A micro-batch's rows of a key are one value of the state, as each value goes to the store and back by itself.
    """

    #: The folded state, as DDL, and its first value; the names of what fold() hands on.
    state, first, names = "", (), ()

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.folded = handle.getValueState("folded", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.millis, r.tie, r.flag) for r in rows]
        if key[0] is not None:
            self.held.appendValue((pickle.dumps(new),))
            self.handle.registerTimer(max(r[0] for r in new))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs()
        held = sorted(r for (rows,) in self.held.get() for r in pickle.loads(rows))
        past = [r for r in held if r[0] <= until]
        if len(past) < len(held):
            self.held.put([(pickle.dumps(held[len(past) :]),)])
        else:
            self.held.clear()
        before = self.folded.get() if self.folded.exists() else self.first
        after, found = self.fold(tuple(before), past, until)
        self.folded.update(after)
        for values in found:
            yield Row(**{self.key: key[0]}, **dict(zip(self.names, values)))

    def fold(self, state: tuple, rows: list[tuple], until: int) -> tuple[tuple, list[tuple]]:
        """The state after the rows, all up to `until`, and what is to be handed on."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class Runs(InOrder):
    """Runs of rows whose flag is set: an island's number counts the other rows before it."""

    state, first, names = "island long, length long", (0, 0), ("island", "run_length", "open")

    def fold(self, state, rows, until):
        island, length = state
        found = []
        for _, _, fails in rows:
            if fails:
                length += 1
                continue
            if length:
                found.append((island, length, False))
            island, length = island + 1, 0
        if length and rows:
            found.append((island, length, True))
        return (island, length), found


class Sweeps(InOrder):
    """One later look at what came stale: due `wait` after the first stale row, unless one that isn't stale comes by then."""

    state, first, names = "due long", (None,), ("due_millis",)

    def __init__(self, key: str, wait: int):
        super().__init__(key)
        self.wait = wait

    def fold(self, state, rows, until):
        (due,), found = state, []
        for millis, _, stale in rows:
            if due is not None and millis > due:
                found.append((due,))
                due = None
            if not stale:
                due = None
            elif due is None:
                due = millis + self.wait
                self.handle.registerTimer(due)
        if due is not None and due <= until:
            found.append((due,))
            due = None
        return (due,), found


def _stateful(stream: DataFrame, key: str, time: str, tie: str, flag: Column, late: str, processor: InOrder, more: str) -> DataFrame:
    rows = stream.withWatermark(time, late).select(key, time, F.unix_millis(time).alias("millis"), F.col(tie).cast("long").alias("tie"), F.coalesce(flag, F.lit(False)).alias("flag"))
    kind = stream.schema[key].dataType.simpleString()
    return rows.groupBy(key).transformWithState(processor, f"`{key}` {kind}, {more}", "Update", "EventTime")


def failure_runs(stream: DataFrame, key: str, time: str, tie: str, fails: Column, late: str = "0 seconds") -> DataFrame:
    """Runs of consecutive failures of each key, as relational.run_lengths gives them: key, island, run_length, open.

    Rows count in the order of (time to the millisecond, tie), whichever micro-batch brings them, as long as they are
    no later than `late` behind the newest. A run is handed on when it ends and, as open, when it has grown: of an
    island the longest counts, and a breaker trips on the first row of its length or more. Only what the watermark has passed
    is told; rows with a null key just move it on. The session needs STORE.
    """
    return _stateful(stream, key, time, tie, fails, late, Runs(key), "island long, run_length long, open boolean")


def deferred_sweeps(stream: DataFrame, key: str, time: str, tie: str, stale: Column, wait_seconds: int = 3600, late: str = "0 seconds") -> DataFrame:
    """When each key is to be looked at again, once for each time that it came stale: key, due.

    due is wait_seconds after the first stale row, unless a row that isn't stale comes up to then. Order, lateness and
    nulls as for failure_runs.
    """
    found = _stateful(stream, key, time, tie, stale, late, Sweeps(key, wait_seconds * 1000), "due_millis long")
    return found.select(key, F.timestamp_millis("due_millis").alias("due"))
