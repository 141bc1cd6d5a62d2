"""Watermarks of two inputs, kept per micro-batch.

Structured Streaming's own watermark drops per window end and one batch late, and
knows no idle input, so the pipeline keeps its own (see ``accrue.streaming.run``).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace
from datetime import datetime, timedelta


@dataclass(frozen=True)
class Progress:
    """What a micro-batch knew when it ran; written before its effects, reused by a replay."""

    newest_fact: datetime | None = None
    newest_change: datetime | None = None
    fact_heard: float | None = None  # processing time of the last row, or of the start
    change_heard: float | None = None
    watermark: datetime | None = None  # of both inputs together

    def advance(
        self,
        now: float,
        facts: datetime | None,
        changes: datetime | None,
        delay: float,
        idle_after: float,
    ) -> Progress:
        """Progress after a batch with these newest event times (None: no rows)."""

        def later(a, b):
            return max((x for x in (a, b) if x is not None), default=None)

        after = replace(
            self,
            newest_fact=later(self.newest_fact, facts),
            newest_change=later(self.newest_change, changes),
            fact_heard=now if facts is not None or self.fact_heard is None else self.fact_heard,
            change_heard=now if changes is not None or self.change_heard is None else self.change_heard,
        )
        inputs = ((after.newest_fact, after.fact_heard), (after.newest_change, after.change_heard))
        active = [newest for newest, heard in inputs if now - heard <= idle_after]
        # an active input without rows holds everything back; with all idle nothing moves
        if active and all(newest is not None for newest in active):
            reached = min(active) - timedelta(seconds=delay)
            after = replace(after, watermark=later(self.watermark, reached))
        return after

    def to_json(self) -> dict:
        return {k: v.isoformat() if isinstance(v, datetime) else v for k, v in asdict(self).items()}

    @staticmethod
    def from_json(record: dict) -> Progress:
        times = ("newest_fact", "newest_change", "watermark")
        return Progress(
            **{k: datetime.fromisoformat(v) if k in times and v is not None else v for k, v in record.items()}
        )
