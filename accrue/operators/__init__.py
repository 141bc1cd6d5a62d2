from accrue.operators.asof import asof_join, measure
from accrue.operators.filters import in_family, pending, released
from accrue.operators.intervals import to_intervals
from accrue.operators.keyed import apply_changes, latest_per_key, upsert
from accrue.operators.lateness import drop_late, mark_late, watermark
from accrue.operators.reconcile import reconcile

__all__ = [
    "apply_changes",
    "asof_join",
    "drop_late",
    "in_family",
    "latest_per_key",
    "mark_late",
    "measure",
    "pending",
    "reconcile",
    "released",
    "to_intervals",
    "upsert",
    "watermark",
]
