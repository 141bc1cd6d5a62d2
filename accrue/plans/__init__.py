from accrue.plans.consolidate import consolidate, line_totals, on_time_facts, with_attributes
from accrue.plans.model import TAXES, Model
from accrue.plans.views import certificates, closed, enriched_keys, final, line, report, still_open

__all__ = [
    "TAXES",
    "Model",
    "certificates",
    "closed",
    "consolidate",
    "enriched_keys",
    "final",
    "line",
    "line_totals",
    "on_time_facts",
    "report",
    "still_open",
    "with_attributes",
]
