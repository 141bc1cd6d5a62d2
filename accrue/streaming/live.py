"""The second query of the stream: versions, waiting facts and growing totals per key, in Spark's state store.

A key's state holds its versions, the facts that the watermark has not passed, and the totals of its open periods. The
key's timer is the time of its oldest waiting fact, of its next version or of the first period to end: when the watermark reaches
it, the fact is joined to the version valid at its time, once and for all, and the lines it touches come out with their new
totals. Versions that no fact to come can find, and periods that have ended, leave the state. Keys are dealt to a fixed number
of groups, which the state store holds; a group's event-time timer is the first of its keys'. So the work of a micro-batch
is its own rows, the keys whose timer has come, and reading the groups of both, however long the history is.

A version counts for a fact only if it was admitted before the fact was released, whichever micro-batches the state
happened to see them in: that is decided from the numbers and watermarks of their admission.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from accrue.functions.periods import Period, period_end, period_start
from accrue.operators.intervals import DELETE
from accrue.plans.consolidate import DELAY_SECONDS
from accrue.plans.model import Model
from accrue.streaming.admission import NEVER

MONEY = T.DecimalType(18, 2)
_TOO_LARGE = 10**MONEY.precision
MARK = "_watermark"
GROUPS = 4096  # of keys; each costs a few calls into the state store per micro-batch that touches it
LAST_MS = 4_500_000_000_000  # the year 2112
_FACT, _CHANGE, _MARK, _BARE = range(4)  # kinds of rows; a bare fact has no key and finds no version


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _micros(at: Column) -> Column:
    """A UTC wall clock as whole microseconds."""
    seconds = (at - F.expr(_EPOCH)).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint")


def _clock(micros: Column) -> Column:
    return F.expr(_EPOCH) + F.make_dt_interval(secs=(micros * F.expr("0.000001BD")).cast("decimal(18,6)"))


def _timer(times: list[int]) -> int | None:
    """Where the first of these times, in microseconds, is on the axis of the watermark."""
    return min(2 * -(-min(times) // 1000), 2 * LAST_MS) if times else None


def _plain(held: tuple) -> tuple:
    """A key's part of the state as the state takes it back."""
    return held if type(held) is tuple else (*held[:3], *([tuple(x) for x in part] for part in held[3:]))


class GroupState(StatefulProcessor):
    """Versions, waiting facts and open lines of a group of keys. Every call into the state store costs far more than a row,
    so a group takes a fixed number of them however many keys it holds: its versions are one value and what is open in it
    another, and a value is written only if it changed. Only keys that have rows or whose time has come are worked on."""

    def __init__(self, attributes: int, measures: int, eager: bool, delay: int):
        self.attributes, self.measures, self.eager, self.delay = attributes, measures, eager, delay

    @property
    def versions_schema(self) -> str:
        texts = "".join(f", a{i}:string" for i in range(self.attributes))
        version = f"struct<at:bigint, seq:bigint, batch:bigint, before:bigint, alive:boolean{texts}>"
        return f"keys array<struct<key:string, shard:bigint, timer:bigint, versions:array<{version}>>>"

    @property
    def open_schema(self) -> str:
        values = "".join(f", m{i}:bigint" for i in range(self.measures))
        held = "".join(f", a{i}:string, t{i}:bigint" for i in range(self.attributes))
        fact = f"struct<at:bigint, batch:bigint, keyed:boolean, line:string, start:bigint, end:bigint{values}>"
        line = f"struct<line:string, start:bigint, end:bigint{values}{held}>"
        return f"keys array<struct<key:string, shard:bigint, timer:bigint, waiting:array<{fact}>, lines:array<{line}>>>"

    @property
    def output(self) -> str:
        values = "".join(f", m{i} bigint" for i in range(self.measures))
        texts = "".join(f", a{i} string" for i in range(self.attributes))
        return f"line string, start bigint, end bigint{values}{texts}"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getValueState("versions", self.versions_schema)
        self.open = handle.getValueState("open", self.open_schema)
        self.columns = [column.split()[0] for column in self.output.split(", ")]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        n = self.measures
        new: dict[tuple, tuple[list, list]] = {}
        for frame in rows:
            cells = [frame.iloc[:, i].tolist() for i in range(1, frame.shape[1])]
            for own, shard, kind, at, batch, seq, before, alive, line, start, end, *rest in zip(*cells):
                if kind == _MARK:
                    continue
                facts, changes = new.setdefault((own, shard), ([], []))
                if kind == _CHANGE:
                    changes.append((at, seq, batch, before, alive, *rest[n : n + self.attributes]))
                else:
                    facts.append((at, batch, kind == _FACT, line, start, end, *rest[:n]))
        if new:
            yield from self._advance(new, timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance({}, timerValues, expired=True)

    def close(self) -> None:
        pass

    def _advance(self, new: dict[tuple, tuple[list, list]], timers: TimerValues, expired: bool = False) -> Iterator[pd.DataFrame]:
        now = timers.getCurrentWatermarkInMs()
        # the axis of the watermark counts half milliseconds, so that a timer at twice a time fires exactly when it is reached
        passed = max(0, (now - 1) // 2) * 1000
        parts = [{(x[0], x[1]): x for x in (state.get() or ((),))[0]} for state in (self.versions, self.open)]
        timer = None if expired else self._soonest(parts)
        due = {own for part in parts for own, x in part.items() if x[2] is not None and x[2] <= now}
        out, changed = [], [False, False]
        for own in due | new.keys():
            before = [_plain(part[own]) if own in part else None for part in parts]
            facts, changes = new.get(own, ((), ()))
            versions = [*before[0][3], *changes] if before[0] else list(changes)
            waiting, totals = ([*before[1][3], *facts], before[1][4]) if before[1] else (list(facts), [])
            lines, after = self._advance_key(own, versions, waiting, totals, passed)
            out += lines
            for i, (was, now_is) in enumerate(zip(before, after)):
                if was != now_is:
                    changed[i] = True
                    if now_is is None:
                        del parts[i][own]
                    else:
                        parts[i][own] = now_is
        if out:
            yield pd.DataFrame(out, columns=self.columns)
        for state, part, differs in zip((self.versions, self.open), parts, changed):
            if differs and part:
                state.update(([_plain(x) for x in part.values()],))
            elif differs:
                state.clear()
        wanted = self._soonest(parts)
        if timer != wanted:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)

    @staticmethod
    def _soonest(parts: list[dict]) -> int | None:
        return min((x[2] for part in parts for x in part.values() if x[2] is not None), default=None)

    def _advance_key(
        self, own: tuple, versions: list[tuple], waiting: list[tuple], totals: list[tuple], passed: int
    ) -> tuple[list[tuple], list[tuple | None]]:
        """Lines touched, and what is held of the key now: its versions and what is open, None where there is nothing."""
        n, k = self.measures, self.attributes
        # facts to come may be behind the watermark, where only changes moved it, but never by more than the delay
        settled = passed - self.delay
        ready = waiting if self.eager else [w for w in waiting if w[0] <= passed]
        lines = {(x[0], x[1]): list(x) for x in totals}
        touched: dict[tuple, list] = {}
        if ready:
            versions.sort(key=lambda v: (v[0], v[1]))
            times = [v[0] for v in versions]
            for w in sorted(ready):
                found = bisect_right(times, w[0]) - 1 if w[2] else -1
                while found >= 0 and not self._counts(versions[found], w):
                    found -= 1
                of = (w[3], w[4])
                line = touched[of] = lines.setdefault(of, [*w[3:6], *[0] * n, *[None, NEVER] * k])
                for i in range(n):
                    line[3 + i] += w[6 + i]
                    if not -_TOO_LARGE < line[3 + i] < _TOO_LARGE:
                        raise OverflowError(f"sum does not fit {MONEY.simpleString()}")
                if found >= 0 and versions[found][4]:
                    for i, text in enumerate(versions[found][5:]):
                        at = 3 + n + 2 * i
                        if text is not None and w[0] >= line[at + 1]:
                            line[at], line[at + 1] = text, w[0]
            waiting = [] if self.eager else [w for w in waiting if w[0] > passed]
        out = [(*line[: 3 + n], *line[3 + n :: 2]) for line in touched.values()]
        versions = self._needed(versions, settled)
        left = [tuple(x) for x in lines.values() if x[2] > settled]
        # a version gives way as soon as the next one has settled
        replaced = [x for x in (max(v[0], v[3]) for v in versions) if x > settled] if len(versions) > 1 else []
        known = (*own, _timer([x + self.delay for x in replaced]), versions) if versions else None
        soonest = _timer([*(w[0] for w in waiting), *(x[2] + self.delay for x in left)])
        return out, [known, (*own, soonest, waiting, left) if waiting or left else None]

    def _counts(self, version: tuple, fact: tuple) -> bool:
        """Whether the version was admitted before the fact was released."""
        return version[2] <= fact[1] or (not self.eager and fact[0] > version[3])

    @staticmethod
    def _needed(versions: list[tuple], settled: int) -> list[tuple]:
        """Without those that a fact of that time or a newer one finds another version after."""
        old = [v for v in versions if v[0] <= settled and v[3] <= settled]
        rest = [v for v in versions if not (v[0] <= settled and v[3] <= settled)]
        if old:
            base = max(old, key=lambda v: (v[0], v[1]))
            if base[4] or rest:
                rest.append(base)
        return rest


def live_lines(
    admitted: DataFrame,
    period: Period,
    zone: str,
    model: Model,
    anchor: str = "epoch",
    eager: bool = False,
    shards: int = 1,
    delay: float = DELAY_SECONDS,
    groups: int = GROUPS,
) -> DataFrame:
    """The streaming plan: admitted batches -> lines touched by each micro-batch, with their totals so far.

    ``shards`` spreads the lines of one key over so many groups, each with the key's versions: for keys that alone would
    keep one task busy. ``groups`` is the number of groups of keys that the state holds.
    """
    m = model
    fact_type, change_type = admitted.schema["fact"].dataType, admitted.schema["change"].dataType
    is_fact, is_change = F.col("fact").isNotNull(), F.col("change").isNotNull()
    at = F.col(f"fact.{m.event_time}")
    start = period_start(at, period, zone, anchor)
    rows = admitted.withColumn("_start", F.when(is_fact, start))
    told = F.struct(*[F.col(f"fact.{c}").alias(c) for c in m.groups])
    of_line = F.pmod(F.xxhash64(F.to_json(told), F.col("_start")), F.lit(shards))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    scaled = [(F.col(f"fact.{c}").cast(MONEY) * F.expr("100BD")) for c in m.measures]
    passed = F.least(F.floor(F.col("mark") / 1000).cast("bigint"), F.lit(LAST_MS).cast("bigint"))
    rows = rows.select(
        F.coalesce(F.col(f"fact.{m.key}").cast("string"), F.col(f"change.{m.key}").cast("string"), F.lit("")).alias("key"),
        F.explode(F.when(is_change, every).otherwise(F.array(F.coalesce(of_line, F.lit(0).cast("bigint"))))).alias("shard"),
        F.when(is_fact & F.col(f"fact.{m.key}").isNull(), _BARE).when(is_fact, _FACT).when(is_change, _CHANGE).otherwise(_MARK).alias("kind"),
        whole(_micros(F.coalesce(at, F.col("change.op_ts")))).alias("at"),
        whole(F.col("batch_id")).alias("batch"),
        whole(F.col("change.seq")).alias("seq"),
        whole(F.col("before")).alias("before"),
        F.coalesce(F.col("change.op") != DELETE, F.lit(False)).alias("alive"),
        F.when(is_fact, F.to_json(told)).alias("line"),
        whole(_micros(F.col("_start"))).alias("start"),
        whole(_micros(F.when(is_fact, period_end(F.col("_start"), period, zone, anchor)))).alias("end"),
        *[whole(c).alias(f"m{i}") for i, c in enumerate(scaled)],
        *[F.col(f"change.{c}").cast("string").alias(f"a{i}") for i, c in enumerate(m.attributes)],
        F.when(F.col("mark") > 0, F.timestamp_millis(2 * passed + 1)).alias(MARK),
    )
    kept = GroupState(len(m.attributes), len(m.measures), eager, round(delay * 1_000_000))
    group = F.pmod(F.xxhash64("key", "shard"), F.lit(groups)).alias("group")
    out = (
        rows.select(group, "*")
        .withWatermark(MARK, "0 seconds")
        .groupBy("group")
        .transformWithStateInPandas(kept, kept.output, "Update", "EventTime")
    )
    line = F.from_json("line", T.StructType([fact_type[c] for c in m.groups]))
    return out.withColumn("line", line).select(
        *[F.col(f"line.{c}").alias(c) for c in m.groups],
        _clock(F.col("start")).alias("window_start"),
        _clock(F.col("end")).alias("window_end"),
        *[F.col(f"a{i}").cast(change_type[c].dataType).alias(name) for i, (c, name) in enumerate(m.attributes.items())],
        *[(F.col(f"m{i}").cast("decimal(20,0)") * F.expr("0.01BD")).cast(MONEY).alias(name) for i, name in enumerate(m.measures.values())],
    ).select(*m.line_columns)
