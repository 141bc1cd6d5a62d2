"""The consolidation query: facts and a dimension change log -> rate lines.

Order of the steps: watermark over all rows, late rows out, family filter, as-of
join, group by key and period, exact sums. Through the shuffle a fact carries
the start time of its version instead of the version's texts; versions of one
key follow each other in time, so the last non-null value of an attribute is that
of the version that began last among those that have one (a fixed-width maximum,
which keeps the hash aggregation), and texts are fetched once per rate line. Where
every version has all attributes, one maximum serves them all.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrue.functions.aggregates import exact_sum
from accrue.functions.periods import DEFAULT_PERIOD, DEFAULT_ZONE, Period, check_fixed_offset, parse_period, period_end, period_start
from accrue.functions.timestamps import to_utc
from accrue.operators.asof import VERSION, LogSize, asof_join, measure
from accrue.operators.filters import in_family, released
from accrue.operators.intervals import to_intervals
from accrue.operators.lateness import LATE, mark_late, watermark
from accrue.plans.model import TAXES, Model

DELAY_SECONDS = 5


def on_time_facts(facts: DataFrame, model: Model = TAXES, delay: float = DELAY_SECONDS, **options) -> DataFrame:
    """Facts of the family that arrived on time. Rows of other families advance the watermark."""
    marked = mark_late(to_utc(facts, model.event_time), model.event_time, list(model.arrival), delay, **options)
    return marked.where(~F.col(LATE) & in_family(F.col(model.family_column), model.family)).drop(LATE)


def line_totals(
    enriched: DataFrame, period: Period, zone: str, model: Model = TAXES, anchor: str = "epoch"
) -> DataFrame:
    """Sums per (key, group, rate, period) of facts that carry ``version_from``.

    ``version_from`` is the newest one; where the facts tell which attributes their version has (``has_...``), also the
    newest one per attribute, as ``from_...``.
    """
    start = period_start(F.col(model.event_time), period, zone, anchor)
    own = [F.max(F.when(F.col(_has(c)), F.col(VERSION))).alias(_since(c)) for c in model.attributes if _has(c) in enriched.columns]
    return (
        enriched.withColumn("window_start", start)
        .groupBy(*model.groups, "window_start")
        .agg(*[exact_sum(F.col(c)).alias(total) for c, total in model.measures.items()], F.max(VERSION).alias(VERSION), *own)
    )


def _has(attribute: str) -> str:
    return f"_has_{attribute}"


def _since(attribute: str) -> str:
    return f"_from_{attribute}"


def with_attributes(totals: DataFrame, log: DataFrame, size: LogSize, model: Model = TAXES) -> DataFrame:
    """Fetch each line's attributes by (key, start of version), each by its own start where there are several."""
    versions = to_intervals(log, [model.key], list(model.attributes), largest=size.largest)
    lines = totals
    together = {VERSION: list(model.attributes)} if not size.gaps else {_since(c): [c] for c in model.attributes}
    for since, names in together.items():
        found = versions.select(model.key, F.col("valid_from").alias(since), *[F.col(c).alias(model.attributes[c]) for c in names])
        lines = lines.join(F.broadcast(found) if size.fits_broadcast() else found, [model.key, since], "left")
    return lines


def consolidate(
    facts: DataFrame,
    log: DataFrame,
    period: str | Period = DEFAULT_PERIOD,
    zone: str = DEFAULT_ZONE,
    delay: float = DELAY_SECONDS,
    model: Model = TAXES,
    strategy: str = "auto",
    flush: bool = True,
    anchor: str = "epoch",
    wm: datetime | None = None,
    strict_zone: bool = False,
    **lateness_options,
) -> DataFrame:
    """Rate lines of a bounded input, ``model.line_columns``.

    ``flush=False`` leaves out facts that still wait for the watermark: those
    newer than ``wm``, by default the newest event time minus ``delay``.
    ``strict_zone`` raises for a zone whose offset will change.
    """
    period = parse_period(period)
    if strict_zone:
        check_fixed_offset(zone)
    facts = to_utc(facts, model.event_time)
    accepted = on_time_facts(facts, model, delay, **lateness_options)
    if not flush:
        accepted = released(accepted, model.event_time, wm or watermark(facts, model.event_time, delay))
    needed = [*model.groups, *model.measures, model.event_time]
    size = measure(log, [model.key], list(model.attributes))
    has = [_has(c) for c in model.attributes] if size.gaps else []
    told = log.withColumns({_has(c): F.col(c).isNotNull() for c in model.attributes}) if has else log
    enriched = asof_join(
        accepted.select(*needed), told, [model.key], has, model.event_time, strategy=strategy, size=size, gauge=facts
    )
    lines = with_attributes(line_totals(enriched, period, zone, model, anchor), log, size, model)
    end = period_end(F.col("window_start"), period, zone, anchor)
    return lines.withColumn("window_end", end).select(*model.line_columns)
