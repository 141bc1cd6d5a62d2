"""The consolidation as a streaming job of two queries.

The first admits what both inputs deliver (``admission``), the second joins, sums and upserts (``live``); its state is
Spark's own, in RocksDB. Both keep their places in one checkpoint folder. The target gets the absolute totals of the lines
a micro-batch touched, so writing a micro-batch again changes nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accrue.functions.periods import DEFAULT_PERIOD, DEFAULT_ZONE, Period, check_fixed_offset, parse_period
from accrue.operators.reconcile import reconcile
from accrue.plans.consolidate import DELAY_SECONDS
from accrue.plans.model import TAXES, Model
from accrue.sources.ship import send_library
from accrue.streaming.admission import IDLE_SECONDS, Admission, StateMismatch
from accrue.streaming.files import Records
from accrue.streaming.live import live_lines
from accrue.streaming.watermarks import Progress

TRIGGER = "10 seconds"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LINES_BY_DAY = "CAST(window_start AS DATE)"


class Consolidation:
    """``checkpoint`` is a folder on storage all executors share; a fresh one is a cold start.

    ``target`` receives the absolute rate lines of every micro-batch; anything with ``upsert(lines, token)`` will do.
    ``emit='eager'`` skips the hold-back. ``heartbeat`` lets batches go on without records, so that an idle input is
    found out; it is part of the checkpoint, as ``shards`` is (see ``live_lines``).
    """

    def __init__(
        self,
        spark: SparkSession,
        checkpoint: str,
        target,
        period: str | Period = DEFAULT_PERIOD,
        zone: str = DEFAULT_ZONE,
        delay: float = DELAY_SECONDS,
        idle_after: float = IDLE_SECONDS,
        model: Model = TAXES,
        emit: str = "watermark",
        clock: Callable[[], float] = time.time,
        anchor: str = "epoch",
        strict_zone: bool = False,
        heartbeat: bool = False,
        shards: int = 1,
    ):
        if not checkpoint:
            raise ValueError("a checkpoint location is required: without it a restart would lose its place")
        if emit not in ("watermark", "eager"):
            raise ValueError(f"emit must be 'watermark' or 'eager', got {emit!r}")
        self.spark, self.checkpoint, self.target = spark, checkpoint.rstrip("/"), target
        self.period, self.zone = parse_period(period), zone
        self.model, self.emit, self.anchor = model, emit, anchor
        self.heartbeat, self.shards = heartbeat, shards
        if strict_zone:
            check_fixed_offset(zone)
        self.admission = Admission(spark, self.checkpoint, delay, idle_after, model, clock)
        self._run_id = self._identify()

    def _identify(self) -> str:
        run = Records(self.spark, f"{self.checkpoint}/run")
        if run.last() is None:
            run.put(0, {"id": uuid.uuid4().hex})
        return run.get(0)["id"]

    def admit(self, facts: DataFrame, changes: DataFrame, trigger: str | None = TRIGGER) -> StreamingQuery:
        """Start the first query; ``trigger=None`` takes all there is now and stops."""
        rows = self.admission.tagged(facts, changes, self.heartbeat)
        return self.admission.start(rows, f"{self.checkpoint}/inputs", trigger)

    def consolidate(self, trigger: str | None = TRIGGER) -> StreamingQuery:
        """Start the second query, once there is a first one."""
        send_library(self.spark)
        lines = live_lines(self.admission.read(), self.period, self.zone, self.model, self.anchor, self.emit == "eager", self.shards, self.admission.delay)
        how = {"availableNow": True} if trigger is None else {"processingTime": trigger}
        before = self.spark.conf.get(STATE_STORE, None)
        self.spark.conf.set(STATE_STORE, ROCKS_DB)
        try:
            writer = lines.writeStream.outputMode("update").foreachBatch(self._put)
            return writer.option("checkpointLocation", f"{self.checkpoint}/lines").trigger(**how).start()
        finally:
            if before is None:
                self.spark.conf.unset(STATE_STORE)
            else:
                self.spark.conf.set(STATE_STORE, before)

    def _put(self, lines: DataFrame, batch_id: int) -> None:
        # the state moves on with every run over its rows, so there is one, and all of it
        lines = lines.persist()
        try:
            if lines.count():
                self.target.upsert(lines, token=f"{self._run_id}/{batch_id}")
        finally:
            lines.unpersist()

    def catch_up(self, facts: DataFrame, changes: DataFrame, attempts: int | None = None, delay: float = 1.0) -> None:
        """Admit all that is there now and bring the target up to date, starting again after failures."""
        run_with_restarts(lambda: self.admit(facts, changes, None), attempts, delay)
        run_with_restarts(lambda: self.consolidate(None), attempts, delay)

    def finish(self, attempts: int | None = None, delay: float = 1.0) -> None:
        """The end of a bounded input: facts that still wait are released."""
        self.admission.finish()
        run_with_restarts(lambda: self.consolidate(None), attempts, delay)

    def progress(self) -> Progress | None:
        return self.admission.progress()

    def state(self) -> DataFrame:
        """What the second query's state holds now, by Spark's state data source: a row per key and shard."""
        def held(name: str) -> DataFrame:
            groups = self.spark.read.format("statestore").option("stateVarName", name).load(f"{self.checkpoint}/lines")
            return groups.select(F.inline("value.keys"))

        both = held("versions").withColumnRenamed("timer", "_next").join(held("open"), ["key", "shard"], "full")
        lists = [F.coalesce(c, F.array().cast(both.schema[c].dataType)).alias(c) for c in ("versions", "waiting", "lines")]
        return both.select("key", "shard", *lists, F.least("_next", "timer").alias("timer"))


def state_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys and shards that two states (``Consolidation.state``) do not hold alike, with ``status`` only_left / only_right /
    changed. What a state holds in another order is alike."""
    lists = ["versions", "waiting", "lines"]
    left, right = (df.withColumns({c: F.sort_array(c) for c in lists}) for df in (left, right))
    return reconcile(left, right, ["key", "shard"])


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int | None = None, delay: float = 1.0) -> None:
    """Run a query to its end and start it again when it fails, ``delay`` seconds later.

    Without ``attempts`` it never gives up; the checkpoint decides where it goes on.
    """
    failures = 0
    while True:
        try:
            start().awaitTermination()
            return
        except StreamingQueryException as error:
            failures += 1
            if StateMismatch.__name__ in str(error):
                raise  # no restart can mend it
            if attempts is not None and failures >= attempts:
                raise
            time.sleep(delay)
