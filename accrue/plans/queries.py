"""The library's operators over the sample tables, one query each.

Every query reads whole tables. Those that could only return "nothing wrong"
return counts, so there is something to compare.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.functions.periods import DEFAULT_ZONE, period_start, with_period
from accrue.functions.timestamps import from_epoch, to_utc, utc_literal
from accrue.operators import quality
from accrue.operators.asof import VERSION, asof_join
from accrue.operators.filters import in_family, pending, released
from accrue.operators.intervals import to_intervals
from accrue.operators.keyed import apply_changes, latest_per_key, upsert
from accrue.operators.lateness import drop_late, watermark
from accrue.operators.reconcile import reconcile
from accrue.plans import views
from accrue.plans.consolidate import consolidate, on_time_facts
from accrue.sources import sample
from accrue.sources.changelog import decode_changes, encode_changes, merge_snapshot_and_log, stamp_snapshot
from accrue.sources.incremental import ChunkedSnapshot
from accrue.sources.landed import read_landed
from accrue.sources.landing import fan_out, land_in_waves
from accrue.sources.schemas import FACTS, MERCHANT
from accrue.sources.shared import shared_folder, written
from accrue.streaming.keyed_table import KeyedTable
from accrue.streaming.run import LINES_BY_DAY, Consolidation, run_with_restarts, state_differences

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 16)  # "now" of the closed and open views
DELAY, MODEL, KEY = sample.DELAY_SECONDS, sample.MODEL, ["cuit"]
TEXTS = ["name", "establishment"]
LINE_KEYS = MODEL.line_keys
ITEM_KEYS = ["l_orderkey", "l_linenumber"]
ITEM_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _lines(spark: SparkSession, sf: str, period: str = "daily", **options) -> DataFrame:
    options = {"delay": DELAY, "model": MODEL, **options}
    return consolidate(sample.facts(spark, sf), sample.changelog(spark, sf), period, **options)


def _counts(**frames: DataFrame) -> DataFrame:
    """One row, a count per frame, in one plan."""
    tagged = [df.select(F.lit(name).alias("name")) for name, df in frames.items()]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other)
    return rows.agg(*[F.count_if(F.col("name") == name).alias(name) for name in frames])


# -- filters and periods -------------------------------------------------------


def family_filter(spark, sf):
    facts = sample.facts(spark, sf)
    return facts.where(in_family(F.col("tax_id"))).select("id", "cuit", "tax_id", "base_tax")


def prefix_count(spark, sf):
    facts = sample.facts(spark, sf).where(F.col("tax_id").startswith("PER"))
    return facts.groupBy("tax_id").agg(F.count(F.lit(1)).alias("n"))


def _period(spec: str, anchor: str = "epoch") -> Query:
    def query(spark, sf):
        facts = sample.facts(spark, sf).select("id", "created_at")
        return with_period(facts, "created_at", spec, DEFAULT_ZONE, anchor).drop("created_at")

    return query


def period_daily_dst(spark, sf):
    """A zone whose offset changes, on dates of seven years."""
    orders = to_utc(_table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    return with_period(orders, "o_orderdate", "daily", "America/New_York").drop("o_orderdate")


# -- lateness ------------------------------------------------------------------


def _split(spark, sf):
    return drop_late(sample.facts(spark, sf), "created_at", list(MODEL.arrival), DELAY)


def late_drop(spark, sf):
    return _split(spark, sf)[0].select("id", "tax_id", "created_at", "arr")


def late_rows(spark, sf):
    return _split(spark, sf)[1].select("id", "tax_id", "created_at", "arr")


def _at_watermark(choose) -> Query:
    def query(spark, sf):
        facts = sample.facts(spark, sf)
        kept = on_time_facts(facts, MODEL, DELAY)
        return choose(kept, "created_at", watermark(facts, "created_at", DELAY)).select("id", "cuit", "created_at")

    return query


# -- change log ----------------------------------------------------------------


def changelog_intervals(spark, sf):
    return to_intervals(sample.changelog(spark, sf, everyone=True), KEY, TEXTS)


def change_records(spark, sf):
    """Change records written as JSON and decoded again."""
    log = sample.changelog(spark, sf, everyone=True)
    return decode_changes(encode_changes(log, MERCHANT, KEY), MERCHANT, KEY)


def fact_records(spark, sf):
    """Facts as the change records of an append-only table, decoded."""
    facts = sample.facts(spark, sf).drop("arr")
    records = facts.select("*", F.lit("c").alias("op"), F.col("created_at").alias("op_ts"), F.col("id").alias("seq"))
    return decode_changes(encode_changes(records, facts.schema, ["id"]), facts.schema, ["id"]).select(*facts.columns)


def snapshot_log_merge(spark, sf):
    """A snapshot and a log that overlap by two days."""
    facts = sample.facts(spark, sf).select("id", "cuit", "tax_id", "base_tax", "created_at")
    snapshot = facts.where(F.col("created_at") < utc_literal(datetime(2024, 1, 16)))
    log = facts.where(F.col("created_at") >= utc_literal(datetime(2024, 1, 14)))
    return merge_snapshot_and_log(snapshot, log, ["id"])


#: Minutes from 2024-01-10 12:00 at which a chunk's reading begins, the table is read, and it ends: updates, then deletes fall inside.
_READINGS = [(0, 50, 110), (120, 130, 300), (310, 500, 500), (13620, 13650, 13800), (13630, 13760, 13790)]


def _read_in_chunks(spark, sf) -> DataFrame:
    """Master data read in five chunks while it changes, stopped after two and taken up again."""
    began = datetime(2024, 1, 10, 12)
    log = sample.changelog(spark, sf, everyone=True)
    log = written(log.withColumn("seq", F.unix_timestamp("op_ts") * 10_000_000 + F.col("seq")), "log")
    width = log.agg(F.max(F.col("cuit").cast("long"))).first()[0] // len(_READINGS) + 1
    chunk = F.floor(F.col("cuit").cast("long") / width)

    def at(minutes: int) -> tuple[int, datetime]:
        now = began + timedelta(minutes=minutes)
        return int((now - datetime(1970, 1, 1)).total_seconds()) * 10_000_000 + 9_999_999, now

    folder = shared_folder(spark, "chunks")
    for stop in (2, len(_READINGS)):
        snapshot = ChunkedSnapshot(spark, folder, MERCHANT, KEY)
        for number in snapshot.missing(range(len(_READINGS)))[: stop]:
            low, middle, high = _READINGS[number]
            seen = log.where((chunk == number) & (F.col("seq") <= at(middle)[0]))
            rows = latest_per_key(seen, KEY, ["seq"]).where(F.col("op") != "d")
            times = iter([at(low), at(high)])
            snapshot.take(number, rows, lambda times=times: next(times))
    return ChunkedSnapshot(spark, folder, MERCHANT, KEY).changes(log, chunk)


def incremental_snapshot(spark, sf):
    """The change log that chunks and log give together."""
    return _read_in_chunks(spark, sf)


def incremental_snapshot_state(spark, sf):
    """The table at the log's end, from chunks read at different times."""
    changes = _read_in_chunks(spark, sf)
    snapshot = changes.where(F.col("op") == "r").select("cuit", *TEXTS)
    return apply_changes(snapshot, changes.where(F.col("op") != "r"), KEY, ["seq"])


def asof_snapshot(spark, sf):
    """Versions that begin when the snapshot was read: older facts find none."""
    customers = _table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("cuit"), F.col("c_name").alias("name")
    )
    versions = stamp_snapshot(customers, datetime(2024, 1, 15))
    return asof_join(sample.facts(spark, sf), versions, KEY, ["name"]).select("id", "cuit", "name")


# -- as-of join ----------------------------------------------------------------


def _asof(strategy: str) -> Query:
    def query(spark, sf):
        facts, log = sample.facts(spark, sf), sample.changelog(spark, sf)
        joined = asof_join(facts, log, KEY, TEXTS, strategy=strategy, shuffle=True)
        return joined.select("id", "cuit", "created_at", *TEXTS, VERSION)

    return query


def asof_null_keys(spark, sf):
    """Both strategies on facts of which some have no key."""
    facts, log = sample.facts(spark, sf), sample.changelog(spark, sf)
    facts = facts.withColumn("cuit", F.when(F.col("id") % 7 != 3, F.col("cuit")))
    found = [
        asof_join(facts, log, KEY, ["name"], strategy=s, shuffle=True).select(F.lit(s).alias("strategy"), "id", "cuit", "name", VERSION)
        for s in ("interval", "union")
    ]
    return found[0].unionByName(found[1])


def asof_delete(spark, sf):
    """Facts at or after the delete of their key."""
    log = sample.changelog(spark, sf)
    deleted = log.where(F.col("op") == "d").select("cuit", F.col("op_ts").alias("deleted_at"))
    joined = _asof("auto")(spark, sf).join(deleted, "cuit")
    return joined.where(F.col("created_at") >= F.col("deleted_at")).drop("deleted_at", VERSION)


def asof_before_first(spark, sf):
    """Facts older than the first version of their key."""
    first = sample.changelog(spark, sf).groupBy("cuit").agg(F.min("op_ts").alias("first_at"))
    joined = _asof("auto")(spark, sf).join(first, "cuit")
    return joined.where(F.col("created_at") < F.col("first_at")).drop("first_at", VERSION)


# -- rate lines and views ------------------------------------------------------


def _rate_lines(period: str) -> Query:
    return lambda spark, sf: _lines(spark, sf, period)


def rate_lines_open_end(spark, sf):
    """Without the facts that still wait for the watermark."""
    return _lines(spark, sf, flush=False)


def rate_lines_report(spark, sf):
    return views.report(_lines(spark, sf, "monthly"), by="period")


def _numbered(*order: str) -> Query:
    def query(spark, sf):
        lines = _lines(spark, sf).select(*LINE_KEYS, "total_base_tax")
        return views.numbered(lines, list(order), KEY)

    return query


def rate_lines_7s_midnight(spark, sf):
    """Periods counted from each local midnight, in a zone whose offset is fixed."""
    return _lines(spark, sf, "7s", anchor="midnight", strict_zone=True)


def certificates(spark, sf):
    found = views.certificates(_lines(spark, sf, "monthly"), MODEL)
    parts = ["tax_rate", *MODEL.measures.values(), *MODEL.attributes.values()]

    def told(x):
        return F.concat_ws("|", *[F.coalesce(x[c].cast("string"), F.lit("")) for c in parts])

    rates = F.array_join(F.transform("rate_lines", told), ",")
    return found.withColumn("rates", rates).drop("rate_lines")


def closed_certificates(spark, sf):
    return views.closed(_lines(spark, sf), AS_OF)


def open_certificates(spark, sf):
    return views.still_open(_lines(spark, sf), AS_OF)


def final_certificates(spark, sf):
    return views.final(_lines(spark, sf), watermark(sample.facts(spark, sf), "created_at", DELAY))


def key_lookup(spark, sf):
    lines = _lines(spark, sf, "monthly")
    return views.line(lines, cuit="11", tax_id="RET_IVA", tax_rate=Decimal("3.50"), window_start=datetime(2024, 1, 1, 3))


def key_lookup_written(spark, sf):
    """The same on a written target: one day's folder and the pages that can hold the key are read."""
    target = _target(spark, shared_folder(spark, "lookup"))
    target.upsert(_lines(spark, sf, "monthly"), token="a")
    start = datetime(2024, 1, 1, 3)
    lines = target.read(parts=["2024-01-01"])
    return views.line(lines, cuit="11", tax_id="RET_IVA", tax_rate=Decimal("3.50"), window_start=start)


def enriched_keys(spark, sf):
    return views.enriched_keys(_lines(spark, sf))


# -- upserts -------------------------------------------------------------------


def _items(spark, sf):
    items = _table(spark, sf, "lineitem")
    cut = F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    return items.where(F.col("l_shipdate") < cut), items.where(F.col("l_shipdate") >= cut)


def upsert_latest(spark, sf):
    """Later items upserted onto the latest of the earlier ones."""
    early, late = _items(spark, sf)
    return upsert(latest_per_key(early, ITEM_KEYS, ITEM_ORDER), late, ITEM_KEYS, ITEM_ORDER)


def keyed_table_upsert(spark, sf):
    """The same through the keyed Parquet target."""
    early, late = _items(spark, sf)
    table = KeyedTable(spark, shared_folder(spark, "items"), ITEM_KEYS)
    # one row a key already: looking for a second one would do the whole aggregation twice
    table.upsert(latest_per_key(early, ITEM_KEYS, ITEM_ORDER), "early", unique=True)
    table.upsert(latest_per_key(late, ITEM_KEYS, ITEM_ORDER), "late", unique=True)
    return table.read()


def apply_change_log(spark, sf):
    """Master data now: the snapshot with its updates and deletes."""
    log = sample.changelog(spark, sf, everyone=True)
    snapshot = log.where(F.col("op") == "r").select("cuit", *TEXTS)
    return apply_changes(snapshot, log.where(F.col("op") != "r"), KEY, ["op_ts", "seq"])


def crossjoin_fanout(spark, sf):
    """One fact per part and tax of a fixed list."""
    taxes = [("RET_IVA", "3.50"), ("RET_IVA", "5.00"), ("RET_GANANCIAS", "3.00")]
    lines = [{"tax_id": tax_id, "tax_rate": rate} for tax_id, rate in taxes]
    schema = T.StructType([FACTS["tax_id"], FACTS["tax_rate"]])
    return fan_out(_table(spark, sf, "part").select("p_partkey"), lines, schema)


# -- checks --------------------------------------------------------------------


def qa_duplicates(spark, sf):
    found = quality.duplicates(_table(spark, sf, "lineitem"), ITEM_KEYS)
    return found.withColumnRenamed("count", "n")


def qa_orphans(spark, sf):
    lines, log = _lines(spark, sf), sample.changelog(spark, sf)
    enriched = lines.where(F.col("merchant_name").isNotNull())
    return _counts(orphan_lines=quality.orphans(lines, log, KEY), enriched_orphans=quality.orphans(enriched, log, KEY))


def qa_family_leak(spark, sf):
    lines, facts = _lines(spark, sf), sample.facts(spark, sf)
    return _counts(leaked_lines=quality.family_leak(lines), family_facts=quality.family_leak(facts))


def _statuses(found: DataFrame) -> DataFrame:
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def qa_diff(spark, sf):
    """Two runs with different delays, compared line by line."""
    left, right = _lines(spark, sf), _lines(spark, sf, delay=300)
    return _statuses(quality.differences(left, right, LINE_KEYS, same=True))


def qa_reconcile(spark, sf):
    """The same by bucket sums: only what differs is joined."""
    left, right = written(_lines(spark, sf), "left"), written(_lines(spark, sf, delay=300), "right")
    found = reconcile(left, right, LINE_KEYS).select("status", F.lit(1).alias("n"))
    unequal = found.where(F.col("status") != "only_right").select(F.lit("equal").alias("status"), F.lit(-1).alias("n"))
    counted = found.unionByName(unequal).unionByName(left.select(F.lit("equal").alias("status"), F.lit(1).alias("n")))
    return counted.groupBy("status").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def qa_reconcile_planted(spark, sf):
    """All orders against a copy with some changed, some missing."""
    orders = _table(spark, sf, "orders")
    copy = orders.where(F.col("o_orderkey") % 1009 != 5)
    copy = copy.withColumn("o_custkey", F.when(F.col("o_orderkey") % 997 != 3, F.col("o_custkey")))
    return reconcile(orders, copy, ["o_orderkey"])


def qa_amounts(spark, sf):
    facts = sample.facts(spark, sf)
    return _counts(facts=facts, wrong=quality.wrong_amounts(facts))


def qa_closed_stable(spark, sf):
    """Lines final at the watermark of an earlier snapshot never change; others do."""
    facts, log = sample.facts(spark, sf), sample.changelog(spark, sf)
    so_far = facts.where(F.col("arr") < F.unix_timestamp(utc_literal(AS_OF)))
    earlier, later = (consolidate(f, log, "daily", delay=DELAY, model=MODEL) for f in (so_far, facts))
    final = views.final(earlier, watermark(so_far, "created_at", DELAY))
    return _counts(
        final_lines=final,
        changed_final_lines=quality.changed_lines(final, later, LINE_KEYS),
        changed_lines=quality.changed_lines(earlier, later, LINE_KEYS),
    )


def qa_span(spark, sf):
    lines = _lines(spark, sf)
    return _counts(
        not_daily=quality.wrong_spans(lines, "daily", DEFAULT_ZONE),
        not_monthly=quality.wrong_spans(lines, "monthly", DEFAULT_ZONE),
        lines=lines,
    )


def qa_resum(spark, sf):
    """Totals against plain sums of all facts of the family, late ones included."""
    facts = sample.facts(spark, sf).where(in_family(F.col("tax_id")))
    facts = facts.withColumn("window_start", period_start(F.col("created_at"), "daily", DEFAULT_ZONE))
    return _statuses(quality.wrong_totals(_lines(spark, sf), facts, LINE_KEYS, MODEL.measures))


# -- streaming -----------------------------------------------------------------


class _FailsOnce:
    """A target that fails once, after its write."""

    def __init__(self, table: KeyedTable, at: int):
        self.table, self.left = table, at

    def upsert(self, lines: DataFrame, token: str) -> DataFrame:
        written = self.table.upsert(lines, token)
        self.left -= 1
        if self.left == 0:
            raise RuntimeError("target lost its connection")
        return written


def _landed(like: DataFrame, folder: str) -> DataFrame:
    return like.sparkSession.readStream.schema(like.schema).parquet(folder)


def _stream(spark, sf, waves: int, folder: str, run: str, target, period: str = "daily", **options) -> Consolidation:
    """Land the facts wave by wave; after each, start the query from its checkpoint until it is done."""
    facts, log = sample.facts(spark, sf), sample.changelog(spark, sf)
    ticks = itertools.count(0, 10)
    job = Consolidation(
        spark, f"{folder}/checkpoint-{run}", target, period, delay=DELAY, model=MODEL, clock=lambda: float(next(ticks)), **options
    )
    inbox, changes = f"{folder}/facts-{run}", f"{folder}/changes-{run}"
    log.write.parquet(changes)
    for _ in land_in_waves(facts, inbox, waves, "arr"):
        job.catch_up(_landed(facts, inbox), _landed(log, changes), attempts=3, delay=0)
    return job


def _finished(job: Consolidation, target: KeyedTable) -> DataFrame:
    job.finish(attempts=3, delay=0)
    return target.read()


def _target(spark, folder: str) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/lines", LINE_KEYS, LINES_BY_DAY)


def stream_equals_batch(spark, sf):
    folder = shared_folder(spark, "stream")
    target = _target(spark, folder)
    return _finished(_stream(spark, sf, 4, folder, "a", target), target)


def stream_live_target(spark, sf):
    """What the target holds while the newest facts still wait."""
    folder = shared_folder(spark, "live")
    target = _target(spark, folder)
    _stream(spark, sf, 3, folder, "a", target)
    return target.read()


def restart_from_scratch(spark, sf):
    """A second cold run, with other micro-batches, onto the same target."""
    folder = shared_folder(spark, "scratch")
    target = _target(spark, folder)
    _stream(spark, sf, 2, folder, "a", target)
    _stream(spark, sf, 3, folder, "b", target)
    return target.read()


def replay_idempotent(spark, sf):
    """The target fails after a write; the micro-batch is replayed from the checkpoint."""
    folder = shared_folder(spark, "replay")
    target = _target(spark, folder)
    return _finished(_stream(spark, sf, 3, folder, "a", _FailsOnce(target, at=2)), target)


def stream_new_checkpoint(spark, sf):
    """A second cold run beside the first, with its own checkpoint and the same target."""
    folder = shared_folder(spark, "anew")
    target = _target(spark, folder)
    _stream(spark, sf, 1, folder, "a", target)
    return _finished(_stream(spark, sf, 2, folder, "b", target), target)


def stream_midnight(spark, sf):
    """Periods counted from each local midnight."""
    folder = shared_folder(spark, "midnight")
    target = _target(spark, folder)
    return _finished(_stream(spark, sf, 2, folder, "a", target, "7s", anchor="midnight", strict_zone=True, shards=3), target)


def stream_late_changes(spark, sf):
    """The change log lands between the waves of facts, much of it behind facts that are out by then: those it leaves alone."""
    folder = shared_folder(spark, "late")
    target, facts, log = _target(spark, folder), sample.facts(spark, sf), sample.changelog(spark, sf)
    ticks = itertools.count(0, 10)
    job = Consolidation(spark, f"{folder}/checkpoint", target, "daily", delay=DELAY, model=MODEL, clock=lambda: float(next(ticks)))
    for inbox, rows in ((f"{folder}/facts", facts), (f"{folder}/changes", log)):
        rows.limit(0).write.parquet(inbox)
    streams = _landed(facts, f"{folder}/facts"), _landed(log, f"{folder}/changes")
    waves = land_in_waves(facts, f"{folder}/facts", 3, "arr")
    for ops in (["r"], ["u"], ["d"]):
        log.where(F.col("op").isin(ops)).write.mode("append").parquet(f"{folder}/changes")
        job.catch_up(*streams, attempts=1)
        next(waves)
        job.catch_up(*streams, attempts=1)
    return _finished(job, target)


def stream_idle_inputs(spark, sf):
    """No record comes after the facts: heartbeats find the change log idle before the facts are, which releases them."""
    folder = shared_folder(spark, "idle")
    target, facts, log = _target(spark, folder), sample.facts(spark, sf), sample.changelog(spark, sf)
    ticks = itertools.count(0, 1)
    job = Consolidation(
        spark, f"{folder}/checkpoint", target, "daily", delay=DELAY, model=MODEL, clock=lambda: float(next(ticks)), heartbeat=True
    )
    facts.limit(0).write.parquet(f"{folder}/facts")
    early = log.where(F.col("op_ts") < utc_literal(datetime(2024, 1, 3)))
    early.write.parquet(f"{folder}/changes")
    streams = _landed(facts, f"{folder}/facts"), _landed(log, f"{folder}/changes")
    job.catch_up(*streams, attempts=1)
    facts.write.mode("append").parquet(f"{folder}/facts")
    # both active; then heartbeats alone: the change log is idle one batch before the facts, after which nothing moves
    for _ in range(4):
        job.catch_up(*streams, attempts=1)
    return target.read()


def _gaps(spark, sf) -> DataFrame:
    """The change log with attributes missing here and there, each by itself."""
    log = sample.changelog(spark, sf)
    number = F.col("seq") % 10
    key = F.floor(F.col("seq") / 10)
    return log.withColumns({
        "name": F.when((key + number) % 4 != 1, F.col("name")),
        "establishment": F.when((key + number) % 4 != 2, F.col("establishment")),
    })


def last_value_nulls(spark, sf):
    """Attributes missing in some versions: each column of a line keeps its own last value."""
    return consolidate(sample.facts(spark, sf), _gaps(spark, sf), "monthly", delay=DELAY, model=MODEL)


def stream_last_value_nulls(spark, sf):
    """The same, live."""
    folder = shared_folder(spark, "gaps")
    target, facts, log = _target(spark, folder), sample.facts(spark, sf), _gaps(spark, sf)
    ticks = itertools.count(0, 10)
    job = Consolidation(spark, f"{folder}/checkpoint", target, "monthly", delay=DELAY, model=MODEL, clock=lambda: float(next(ticks)))
    log.write.parquet(f"{folder}/changes")
    for _ in land_in_waves(facts, f"{folder}/facts", 2, "arr"):
        job.catch_up(_landed(facts, f"{folder}/facts"), _landed(log, f"{folder}/changes"), attempts=1)
    return _finished(job, target)


def stream_landed_source(spark, sf):
    """Both inputs by the source with offsets, a third of the rows a batch: stopped after one batch, taken up from the checkpoint."""
    folder = shared_folder(spark, "source")
    target, facts, log = _target(spark, folder), sample.facts(spark, sf), sample.changelog(spark, sf)
    log = log.withColumn("lsn", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', op_ts)"))

    def land(rows: DataFrame, name: str, position: str) -> None:
        rows.repartitionByRange(9, position).sortWithinPartitions(position).write.parquet(f"{folder}/{name}")

    land(facts, "facts", "arr")
    land(log.where("op = 'r'"), "snapshot", "seq")
    land(log.where("op != 'r'"), "changes", "lsn")
    third = [-(-rows.count() // 3) for rows in (facts, log)]
    ticks = itertools.count(0, 10)
    job = Consolidation(spark, f"{folder}/checkpoint", target, "daily", delay=DELAY, model=MODEL, clock=lambda: float(next(ticks)))

    def inputs() -> tuple[DataFrame, DataFrame]:
        return (
            read_landed(spark, f"{folder}/facts", facts.schema, "arr", limit=third[0]),
            read_landed(spark, f"{folder}/changes", log.schema, "lsn", f"{folder}/snapshot", third[1]),
        )

    job.admit(*inputs(), trigger=None).awaitTermination()
    rest = job.admit(*inputs(), trigger="0 seconds")
    rest.processAllAvailable()
    rest.stop()
    run_with_restarts(lambda: job.consolidate(None), 3, 0)
    return _finished(job, target)


def stream_state(spark, sf):
    """What is left in the state when the input has paused: waiting facts, and totals of periods that a fact may still reach."""
    folder = shared_folder(spark, "state")
    job = _stream(spark, sf, 3, folder, "a", _target(spark, folder))
    waiting = job.state().select("key", F.explode("waiting").alias("x")).select("key", F.lit("waiting").alias("kind"), "x.line", "x.start", F.col("x.m0").alias("base"))
    lines = job.state().select("key", F.explode("lines").alias("x")).select("key", F.lit("line").alias("kind"), "x.line", "x.start", F.col("x.m0").alias("base"))
    told = F.from_json("line", "tax_id string, tax_rate decimal(5,2)")
    held = waiting.unionByName(lines).select("key", "kind", told.alias("line"), "start", "base")
    return held.select(
        F.col("key").alias("cuit"), "kind", "line.tax_id", "line.tax_rate",
        from_epoch(F.floor(F.col("start") / 1_000_000)).alias("window_start"),
        (F.col("base").cast("decimal(20,0)") * F.expr("0.01BD")).cast("decimal(18,2)").alias("base_tax"),
    )


def stream_state_restored(spark, sf):
    """State of a job that failed in a micro-batch and was restored against that of one that was not, and against one with
    planted differences: of open keys, every seventh gone and every seventh with another timer."""
    states = []
    for run, fails in (("a", 0), ("b", 2)):
        folder = shared_folder(spark, "restored")
        job = _stream(spark, sf, 2, folder, run, _FailsOnce(_target(spark, folder), at=fails))
        states.append(written(job.state(), "state"))
    steady, restored = states
    is_open = F.expr("try_cast(key AS BIGINT) IS NOT NULL AND (size(waiting) > 0 OR size(lines) > 0)")
    turn = F.expr("try_cast(key AS BIGINT) % 7")
    other = F.when(is_open & (turn == 1), F.coalesce(F.col("timer"), F.lit(0)) + 1).otherwise(F.col("timer"))
    planted = restored.where(~F.coalesce(is_open & (turn == 0), F.lit(False))).withColumn("timer", other)
    found = [
        state_differences(steady, state).select(F.lit(name).alias("against"), F.col("key").alias("cuit"), "status")
        for name, state in (("restored", restored), ("planted", planted))
    ]
    return found[0].unionByName(found[1])


QUERIES: dict[str, Query] = {
    "family_filter": family_filter,
    "prefix_count": prefix_count,
    "period_60s": _period("60s"),
    "period_7s": _period("7s"),
    "period_7s_midnight": _period("7s", "midnight"),
    "period_120s": _period("120s"),
    "period_daily": _period("daily"),
    "period_monthly": _period("monthly"),
    "period_daily_dst": period_daily_dst,
    "late_drop": late_drop,
    "late_rows": late_rows,
    "released_at_watermark": _at_watermark(released),
    "pending_at_watermark": _at_watermark(pending),
    "changelog_intervals": changelog_intervals,
    "change_records": change_records,
    "fact_records": fact_records,
    "snapshot_log_merge": snapshot_log_merge,
    "incremental_snapshot": incremental_snapshot,
    "incremental_snapshot_state": incremental_snapshot_state,
    "asof_interval": _asof("interval"),
    "asof_union": _asof("union"),
    "asof_null_keys": asof_null_keys,
    "asof_delete": asof_delete,
    "asof_before_first": asof_before_first,
    "asof_snapshot": asof_snapshot,
    "rate_lines_60s": _rate_lines("60s"),
    "rate_lines_daily": _rate_lines("daily"),
    "rate_lines_monthly": _rate_lines("monthly"),
    "rate_lines_7s_midnight": rate_lines_7s_midnight,
    "report_by_tax": _numbered("tax_id", "tax_rate", "window_start"),
    "dump_order": _numbered("tax_id", "window_start", "tax_rate"),
    "rate_lines_open_end": rate_lines_open_end,
    "rate_lines_report": rate_lines_report,
    "certificates": certificates,
    "closed_certificates": closed_certificates,
    "open_certificates": open_certificates,
    "final_certificates": final_certificates,
    "key_lookup": key_lookup,
    "key_lookup_written": key_lookup_written,
    "enriched_keys": enriched_keys,
    "upsert_latest": upsert_latest,
    "keyed_table_upsert": keyed_table_upsert,
    "apply_changes": apply_change_log,
    "crossjoin_fanout": crossjoin_fanout,
    "qa_duplicates": qa_duplicates,
    "qa_orphans": qa_orphans,
    "qa_family_leak": qa_family_leak,
    "qa_diff": qa_diff,
    "qa_reconcile": qa_reconcile,
    "qa_reconcile_planted": qa_reconcile_planted,
    "qa_amounts": qa_amounts,
    "qa_closed_stable": qa_closed_stable,
    "qa_span": qa_span,
    "qa_resum": qa_resum,
    "stream_equals_batch": stream_equals_batch,
    "stream_live_target": stream_live_target,
    "restart_from_scratch": restart_from_scratch,
    "replay_idempotent": replay_idempotent,
    "stream_new_checkpoint": stream_new_checkpoint,
    "stream_midnight": stream_midnight,
    "stream_late_changes": stream_late_changes,
    "stream_idle_inputs": stream_idle_inputs,
    "last_value_nulls": last_value_nulls,
    "stream_last_value_nulls": stream_last_value_nulls,
    "stream_landed_source": stream_landed_source,
    "stream_state": stream_state,
    "stream_state_restored": stream_state_restored,
}
