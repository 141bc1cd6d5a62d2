from accrue.streaming.keyed_table import KeyedTable, merge_into
from accrue.streaming.admission import Admission, StateMismatch
from accrue.streaming.live import live_lines
from accrue.streaming.run import TRIGGER, Consolidation, run_with_restarts
from accrue.streaming.watermarks import Progress

__all__ = [
    "TRIGGER",
    "Admission",
    "Consolidation",
    "KeyedTable",
    "Progress",
    "StateMismatch",
    "live_lines",
    "merge_into",
    "run_with_restarts",
]
