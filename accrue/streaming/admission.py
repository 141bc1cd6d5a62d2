"""The first query of the stream: what the two inputs deliver, admitted in order.

Lateness and the combined watermark look at all keys at once, so they are decided here, per micro-batch and before any
state: late facts go, the others and the dimension changes are admitted with their batch's number and with the watermark
before it, and one more row says how far the watermark is now. An admitted batch appears as a whole, by one rename, and
only once: its decisions are recorded first, and a replay of a batch that is there already does nothing.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from accrue.functions.timestamps import to_utc
from accrue.operators.intervals import checked_log
from accrue.plans.consolidate import DELAY_SECONDS, on_time_facts
from accrue.plans.model import TAXES, Model
from accrue.streaming.files import Records
from accrue.streaming.watermarks import Progress

IDLE_SECONDS = 2.0
NEVER, FOREVER = -(1 << 62), 1 << 62  # microseconds of a watermark before its begin and behind its end
LAST_BATCH = (1 << 31) - 1  # the number under which the end of a bounded input is admitted


class StateMismatch(RuntimeError):
    """What was admitted and the checkpoint do not belong together."""


def micros(at: datetime | None) -> int:
    """A UTC wall clock in whole microseconds."""
    if at is None:
        return NEVER
    since = at - datetime(1970, 1, 1)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


class Admission:
    """Micro-batch function over both inputs; ``folder`` is on storage all executors share."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        delay: float = DELAY_SECONDS,
        idle_after: float = IDLE_SECONDS,
        model: Model = TAXES,
        clock: Callable[[], float] = time.time,
    ):
        self.spark, self.folder, self.model = spark, folder.rstrip("/"), model
        self.delay, self.idle_after, self.clock = delay, idle_after, clock
        self.admitted = f"{self.folder}/admitted"
        self._records = Records(spark, f"{self.folder}/progress")
        self._schemas = Records(spark, f"{self.folder}/schema")

    def tagged(self, facts: DataFrame, changes: DataFrame, heartbeat: bool = False) -> DataFrame:
        """Both inputs as one: columns ``fact`` and ``change``, one of them NULL.

        ``heartbeat`` adds an input of one empty row a second, so that batches go on when no record comes and an idle
        input is found out.
        """
        m = self.model
        fact_columns = list(dict.fromkeys([*m.arrival, *m.groups, *m.measures, m.event_time]))
        change_columns = [m.key, *m.attributes, "op", "op_ts", "seq"]
        left = to_utc(facts.select(*fact_columns), m.event_time).select(F.struct(*fact_columns).alias("fact"))
        right = checked_log(to_utc(changes.select(*change_columns), "op_ts"), [m.key], "op_ts", "seq")
        both = left.unionByName(right.select(F.struct(*change_columns).alias("change")), allowMissingColumns=True)
        if not heartbeat:
            return both
        beat = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        nothing = [F.lit(None).cast(both.schema[c].dataType).alias(c) for c in both.columns]
        return both.unionByName(beat.select(*nothing))

    def prepare(self, rows: DataFrame) -> None:
        """Make the place where batches of ``tagged`` rows are admitted, so that they can be read from the start."""
        if self._schemas.last() is None:
            self._records.make(self.admitted)
            self._schemas.put(0, {"schema": rows.schema.json()})

    def start(self, rows: DataFrame, checkpoint: str, trigger: str | None) -> StreamingQuery:
        """Start the query over ``tagged`` rows; ``trigger=None`` takes all there is now and stops."""
        self.prepare(rows)
        how = {"availableNow": True} if trigger is None else {"processingTime": trigger}
        writer = rows.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**how).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        # a stream's session starts without adaptive execution; the batch inside is plain DataFrame work
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        self.prepare(batch)
        self._fits(batch_id)
        place = f"{self.admitted}/batch_id={batch_id}"
        if self._records.exists(place):
            return
        batch = batch.persist()
        try:
            progress, before = self._advance(batch, batch_id)
            m = self.model
            facts = batch.where(F.col("fact").isNotNull()).select("fact.*")
            kept = on_time_facts(facts, m, self.delay, seen=before.newest_fact)
            kept = kept.select(F.struct(*facts.columns).alias("fact"))
            changes = batch.where(F.col("change").isNotNull()).select("change")
            rows = kept.unionByName(changes, allowMissingColumns=True)
            # no fact is newer than the newest, and what may still come is at most the delay behind it
            marks = [min(micros(p.watermark), micros(p.newest_fact)) for p in (before, progress)]
            self._admit(rows, batch_id, *marks)
        finally:
            batch.unpersist()

    def finish(self) -> None:
        """The end of a bounded input: the watermark passes every fact. Nothing can be admitted after that."""
        progress = self.progress()
        if progress is None or self._records.exists(f"{self.admitted}/batch_id={LAST_BATCH}"):
            return
        before = min(micros(progress.watermark), micros(progress.newest_fact))
        self._admit(self.spark.createDataFrame([], self.schema), LAST_BATCH, before, FOREVER)

    def _admit(self, rows: DataFrame, number: int, before: int, mark: int) -> None:
        """Write the rows and the one of the watermark, then show them at once."""
        mark_row = self.spark.range(1).select(F.lit(mark).cast("bigint").alias("mark"))
        marked = rows.unionByName(mark_row, allowMissingColumns=True).withColumn("before", F.lit(before).cast("bigint"))
        draft = f"{self.folder}/draft/batch_id={number}"
        marked.write.mode("overwrite").parquet(draft)
        self._records.move(draft, f"{self.admitted}/batch_id={number}")

    @property
    def schema(self) -> T.StructType:
        """Of the tagged rows."""
        return T.StructType.fromJson(json.loads(self._schemas.get(0)["schema"]))

    def read(self) -> DataFrame:
        """The admitted batches as a stream: ``fact``, ``change``, ``mark`` (one of them not NULL), ``before`` and
        ``batch_id``. Files are deleted when they have been taken."""
        added = [T.StructField("mark", T.LongType()), T.StructField("before", T.LongType()), T.StructField("batch_id", T.IntegerType())]
        schema = T.StructType([*self.schema.fields, *added])
        return self.spark.readStream.schema(schema).option("cleanSource", "delete").parquet(self.admitted)

    def _fits(self, batch_id: int) -> None:
        """Raise when the folder belongs to another checkpoint: facts would count twice or not at all."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        last = self._records.last()
        owner = None if last is None else self._records.get(last).get("query")
        if query and owner and query != owner:
            raise StateMismatch(f"{self.folder} belongs to another checkpoint (query {owner}, not {query})")
        if batch_id not in ((0,) if last is None else (last, last + 1)):
            raise StateMismatch(f"{self.folder} holds batches up to {last}, the checkpoint goes on with {batch_id}")
        if self._records.exists(f"{self.admitted}/batch_id={LAST_BATCH}"):
            raise StateMismatch(f"{self.folder} has been finished")

    def _advance(self, batch: DataFrame, batch_id: int) -> tuple[Progress, Progress]:
        """(progress of this batch, of the batch before)."""
        earlier = self._records.get(batch_id - 1)
        before = Progress() if earlier is None else Progress.from_json(earlier["progress"])
        record = self._records.get(batch_id)  # there already in a replay: the clock must not decide anew
        if record is None:
            newest = batch.agg(F.max(f"fact.{self.model.event_time}"), F.max("change.op_ts")).first()
            progress = before.advance(self.clock(), newest[0], newest[1], self.delay, self.idle_after)
            query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            record = {"progress": progress.to_json(), "query": query}
            self._records.put(batch_id, record)
        return Progress.from_json(record["progress"]), before

    def progress(self) -> Progress | None:
        last = self._records.last()
        return None if last is None else Progress.from_json(self._records.get(last)["progress"])
