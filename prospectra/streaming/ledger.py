"""The ledger over a stream: keyed state with event-time timers.

Each account's cache, counts and open reservations are maps in the state store, so a request reads the entries that it
needs and no more. Reservations outlive their batch: a mailbox reserved in one is in flight in the next, and a timer at
the end of its hold takes it away. Results and counts are entered under the day on which they lapse; a timer at that day's
end drops those that were not renewed. An account that never comes again leaves no state behind.

Timers only tidy up: decisions compare times themselves, so they do not depend on when a watermark passes, and the
stream decides as `operators.ledger.decisions` does on the same rows, if they arrive in order of seq. Rows later than
the watermark are dropped. The rows of an account in one micro-batch are sorted by seq in memory, so a trigger's size
(`maxFilesPerTrigger`, `maxOffsetsPerTrigger`) bounds what a task holds.

Needs the RocksDB state store: see `with_state_store`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ledger import DAY, DECISION, Decider, Rules, decided, requests

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> None:
    """Keyed state with several maps and timers needs this store; set before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class Stored(dict):
    """The entries of a state map that one call has read or set; `flush` writes those set."""

    def __init__(self, state):
        super().__init__()
        self.state, self.changed = state, set()

    def get(self, key, default=None):
        if key not in self:
            found = self.state.getValue((key,)) if self.state.containsKey((key,)) else None
            super().__setitem__(key, tuple(found) if found is not None else None)
        value = self[key]
        return default if value is None else value[0] if len(value) == 1 else value

    def __setitem__(self, key, value):
        super().__setitem__(key, value if isinstance(value, tuple) else (value,))
        self.changed.add(key)

    def flush(self) -> None:
        for key in self.changed:
            self.state.updateValue((key,), self[key])


class LedgerProcessor(StatefulProcessor):
    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cache = handle.getMapState("cache", "email string", "status string, at double")
        self.runs = handle.getMapState("runs", "run string", "n int, at double")
        self.day = handle.getMapState("day", "day string", "n int")
        self.inflight = handle.getMapState("inflight", "email string", "at double, run string")
        self.venues = handle.getMapState("venues", "venue string", "n int, at double")
        self.due = handle.getMapState("due", "day int", "names array<string>")

    def _held(self) -> dict[str, tuple[float, str]]:
        """Open reservations: at most `per_day`, as a cap counts them."""
        return {k[0]: tuple(v) for k, v in self.inflight.iterator()} if self.inflight.exists() else {}

    def _keep(self, before: dict, now: dict) -> None:
        for email in before.keys() - now.keys():
            self.inflight.removeKey((email,))
        for email in now:
            if now[email] != before.get(email):
                self.inflight.updateValue((email,), now[email])
                self.handle.registerTimer(int((now[email][0] + self.rules.hold) * 1000) + 1)

    def _lapse(self, name: str) -> float | None:
        """When the entry of a name (kind, colon, key) lapses, if it is there."""
        kind, key = name[0], (name[2:],)
        if kind == "d":
            return (int(key[0]) + 1) * DAY if self.day.containsKey(key) else None
        state = {"c": self.cache, "r": self.runs, "v": self.venues}[kind]
        if not state.containsKey(key):
            return None
        value = state.getValue(key)
        if kind in "rv":
            return value[1] + DAY * self.rules.run_days
        return value[1] + DAY * (self.rules.unknown_days if value[0] == "unknown" else self.rules.days)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["seq", "ts", "email"], kind="stable")
        before = self._held()
        maps = [Stored(s) for s in (self.cache, self.runs, self.day, self.venues)]
        decider = Decider(self.rules, *maps[:3], dict(before), maps[3])
        out = decided(lambda _: decider, batch)
        for m in maps:
            m.flush()
        self._keep(before, decider.inflight)
        names = [f"{kind}:{k}" for kind, m in zip("crdv", maps, strict=True) for k in m.changed]
        by_day: dict[int, list[str]] = {}
        for name in names:
            by_day.setdefault(int(self._lapse(name) // DAY), []).append(name)
        for day, found in by_day.items():
            old = list(self.due.getValue((day,))[0]) if self.due.containsKey((day,)) else []
            self.due.updateValue((day,), (list(dict.fromkeys(old + found)),))
            self.handle.registerTimer(int((day + 1) * DAY * 1000))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() / 1000
        for email, (at, _) in self._held().items():
            if now - at > self.rules.hold:
                self.inflight.removeKey((email,))
        day = int(now // DAY) - 1
        if now % DAY == 0 and self.due.containsKey((day,)):
            for name in self.due.getValue((day,))[0]:
                lapse = self._lapse(name)
                if lapse is not None and lapse < now:
                    {"c": self.cache, "r": self.runs, "d": self.day, "v": self.venues}[name[0]].removeKey((name[2:],))
                elif lapse == now:  # still good at this instant: looked at a day later
                    again = list(self.due.getValue((day + 1,))[0]) if self.due.containsKey((day + 1,)) else []
                    self.due.updateValue((day + 1,), ([*again, name],))
                    self.handle.registerTimer(int((day + 2) * DAY * 1000))
            self.due.removeKey((day,))
        return iter([])

    def close(self) -> None:
        pass


def ledger_stream(rows: DataFrame, rules: Rules, late: str = "10 minutes") -> DataFrame:
    """Decisions (rows of `ledger.DECISION`) on a stream of requests, each as its request comes in."""
    asked = requests(rows.withWatermark("ts", late))
    return asked.groupBy("account").transformWithStateInPandas(statefulProcessor=LedgerProcessor(rules), outputStructType=DECISION, outputMode="Append", timeMode="EventTime")
