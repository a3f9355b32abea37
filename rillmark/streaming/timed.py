"""Incidents, sustained breaches and notifications in Spark's own state store, with timers.

A key's events wait in its state until the watermark has passed them, so they
are taken in the order of their time whatever order they came in; what comes
later than the watermark is left out, as everywhere in Structured Streaming.
Streams are started inside `state_store`, whatever store the session names. A
timer per key stands at the next moment at which something is due: an event
whose time has come, the end of a silence, a notification that waits. So holds,
waits and expiries end without a further event, and a micro-batch pays for the
keys that it has events for or that are due, not for those that are idle.

For keys of ordinary size: all events of a key that wait are in one task. Keys
that may fill a third of a batch belong in `streaming.batched`, which spreads
them over time chunks; results are the same where events are less than the
allowed lateness late.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import AbstractContextManager
from dataclasses import dataclass
from itertools import groupby
from typing import Any, ClassVar

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rillmark import fixed_values as fv
from rillmark.session import STATE_STORE, holding
from rillmark.streaming.batched import FIRING_OUTPUT, INCIDENT_OUTPUT, NOTIFY_OUTPUT

State = tuple | None
Step = tuple[State, list[tuple]]


def _ceil(ms: int, width: int) -> int:
    return -(-ms // width) * width


@dataclass(frozen=True)
class Incidents:
    """Triggers open and add to an incident, a resolve closes it, a silence of `ttl_ms` expires it."""

    ttl_ms: int
    key: ClassVar[str] = "dedup_key"
    event: ClassVar[str] = "ts_ms long, seq long, event_action string"
    state: ClassVar[str] = "opened_ms long, last_ms long, triggers long"
    output: ClassVar[str] = INCIDENT_OUTPUT

    def time(self, event: tuple) -> int:
        return event[0]

    def at(self, state: State, time: int, events: list[tuple]) -> Step:
        out = []
        for _, _, action in events:
            if action == "trigger":
                state = (time, time, 1) if state is None else (state[0], time, state[2] + 1)
            elif action == "resolve" and state is not None:
                out.append((state[0], time, state[2], "resolved"))
                state = None
        return state, out

    def due(self, state: tuple) -> int | None:
        return state[1] + self.ttl_ms

    def fire(self, state: tuple, time: int) -> Step:
        return None, [(state[0], None, state[2], "expired")]


@dataclass(frozen=True)
class Breaches:
    """A breach that has held for `hold_ms` is reported once; a silence over `max_gap_ms` ends it."""

    hold_ms: int
    max_gap_ms: int
    key: ClassVar[str] = "series"
    event: ClassVar[str] = "ts_ms long, seq long, breach boolean"
    state: ClassVar[str] = "since_ms long, last_ms long, fired boolean"
    output: ClassVar[str] = FIRING_OUTPUT

    def time(self, event: tuple) -> int:
        return event[0]

    def at(self, state: State, time: int, events: list[tuple]) -> Step:
        # Of several samples in one millisecond the largest counts.
        if not any(e[2] for e in events):
            return None, []
        since, _, fired = state or (time, time, False)
        if not fired and time - since >= self.hold_ms:
            return (since, time, True), [(since, since + self.hold_ms)]
        return (since, time, fired), []

    def due(self, state: tuple) -> int | None:
        return state[1] + self.max_gap_ms + 1

    def fire(self, state: tuple, time: int) -> Step:
        return None, []


@dataclass(frozen=True)
class Notices:
    """Notifications of a group at ticks.

    A new group is sent `wait_ms` after its first event, so that events that
    come together go out together; a change is sent at the first tick
    `interval_ms` after the last notification; an unchanged group again after
    `repeat_ms`. A group silent for the repeat time is forgotten.
    """

    repeat_ms: int = fv.REPEAT_INTERVAL_MS
    tick_ms: int = fv.RULE_STEP_MS
    interval_ms: int = fv.GROUP_INTERVAL_MS
    wait_ms: int = fv.GROUP_WAIT_MS
    key: ClassVar[str] = "group_key"
    event: ClassVar[str] = "ts_ms long, seq long, changed boolean"
    #: `sent_ms` is null while the first notification waits for `waits_ms`.
    state: ClassVar[str] = "sent_ms long, pending boolean, waits_ms long"
    output: ClassVar[str] = NOTIFY_OUTPUT

    def time(self, event: tuple) -> int:
        return _ceil(event[0], self.tick_ms)

    def at(self, state: State, time: int, events: list[tuple]) -> Step:
        changed = any(e[2] for e in events)
        if state is None:
            first = _ceil(min(e[0] for e in events) + self.wait_ms, self.tick_ms)
            return ((time, False, None), [(time,)]) if first <= time else ((None, False, first), [])
        sent, pending, _ = state
        if sent is None:
            # Everything until the first notification is part of it.
            return state, []
        pending = pending or changed
        if time - sent >= self.repeat_ms or (pending and time - sent >= self.interval_ms):
            return (time, False, None), [(time,)]
        return (sent, pending, None), []

    def due(self, state: tuple) -> int | None:
        sent, pending, waits = state
        if sent is None:
            return waits
        return _ceil(sent + self.interval_ms, self.tick_ms) if pending else sent + self.repeat_ms

    def fire(self, state: tuple, time: int) -> Step:
        sent, pending, _ = state
        if sent is None or pending:
            return (time, False, None), [(time,)]
        return None, []


Machine = Incidents | Breaches | Notices


def advance(machine: Machine, state: State, events: Iterable[tuple], until: int) -> Step:
    """The state and what goes out after all that is due up to a time; `events` are not after it.

    At one moment events come first: a resolve at the last moment still closes
    what would expire then, and a group's events join what goes out then.
    """
    out: list[tuple] = []

    def up_to(time: int) -> None:
        nonlocal state
        while state is not None and (at := machine.due(state)) is not None and at < time:
            state, more = machine.fire(state, at)
            out.extend(more)

    for time, same in groupby(sorted(events, key=lambda e: (machine.time(e), *e[:2])), key=machine.time):
        up_to(time)
        state, more = machine.at(state, time, list(same))
        out.extend(more)
    up_to(until + 1)
    return state, out


class KeyedTimers(StatefulProcessor):
    """Keeps a key's waiting events, its machine's state and one timer."""

    def __init__(self, machine: Machine):
        self.machine = machine

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.machine.event)
        self.kept = handle.getValueState("kept", self.machine.state)
        self.timer = handle.getValueState("timer", "at_ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        names = [f.split()[0] for f in self.machine.event.split(", ")]
        new = [tuple(r) for df in rows for r in df[names].astype(object).itertuples(index=False)]
        self.waiting.appendList(new)
        first = min(self.machine.time(e) for e in new)
        if not self.timer.exists() or first < self.timer.get()[0]:
            self._set(first)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = timerValues.getCurrentWatermarkInMs()
        events = [tuple(e) for e in self.waiting.get()]
        due = [e for e in events if self.machine.time(e) <= until]
        left = [e for e in events if self.machine.time(e) > until]
        before = tuple(self.kept.get()) if self.kept.exists() else None
        after, out = advance(self.machine, before, due, until)
        if due:
            if left:
                self.waiting.put(left)
            else:
                self.waiting.clear()
        if after is None:
            self.kept.clear()
        elif after != before:
            self.kept.update(after)
        moments = [self.machine.time(e) for e in left]
        if after is not None and (at := self.machine.due(after)) is not None:
            moments.append(at)
        self._set(min(moments, default=None))
        names = [f.split()[0] for f in self.machine.output.split(", ")]
        if out:
            yield pd.DataFrame([(key[0], *row) for row in out], columns=names).astype(
                {n: "Int64" for n in names if n.endswith("_ms")}
            )

    def _set(self, at: int | None) -> None:
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def close(self) -> None:
        """Nothing to close."""


def state_store(spark: SparkSession) -> AbstractContextManager[None]:
    """A block in which streams start with a state store that has several states and timers for a key.

    Spark's default store has one state for a key, and the stream fails at its
    first batch. A stream keeps the store that it was started with.
    """
    return holding(spark, "spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _run(events: DataFrame, machine: Machine, late: str) -> DataFrame:
    names = [f.split()[0] for f in machine.event.split(", ")]
    types = dict(f.split() for f in machine.event.split(", "))
    columns = [(F.col(n) if n in events.columns else F.lit(None)).cast(types[n]).alias(n) for n in names]
    # Events in no order of their own keep none.
    rows = events.select(machine.key, *columns, F.timestamp_millis("ts_ms").alias("_at")).fillna({"seq": 0})
    return (
        rows.withWatermark("_at", late)
        .groupBy(machine.key)
        .transformWithStateInPandas(KeyedTimers(machine), machine.output, "Append", "EventTime")
    )


def incidents(events: DataFrame, ttl_ms: int = 7 * 86_400_000, late: str = "1 hour") -> DataFrame:
    """A stream of (dedup_key, event_action, ts_ms, seq) as a stream of closed incidents."""
    return _run(events.where(F.col("event_action").isin("trigger", "resolve")), Incidents(ttl_ms), late)


def sustained(samples: DataFrame, hold_ms: int, max_gap_ms: int, late: str = "1 hour") -> DataFrame:
    """A stream of (series, ts_ms, breach) as a stream of breaches that held."""
    return _run(samples, Breaches(hold_ms, max_gap_ms), late)


def notifications(
    events: DataFrame, repeat_ms: int = fv.REPEAT_INTERVAL_MS, tick_ms: int = fv.RULE_STEP_MS,
    interval_ms: int = fv.GROUP_INTERVAL_MS, wait_ms: int = fv.GROUP_WAIT_MS, late: str = "1 hour",
) -> DataFrame:
    """A stream of (group_key, ts_ms, perhaps changed) as a stream of notifications."""
    return _run(events, Notices(repeat_ms, tick_ms, interval_ms, wait_ms), late)
