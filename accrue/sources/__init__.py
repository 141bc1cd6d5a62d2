from accrue.sources.changelog import decode_changes, encode_changes, merge_snapshot_and_log, stamp_snapshot
from accrue.sources.files import read_change_records, read_changelog, read_facts
from accrue.sources.incremental import ChunkedSnapshot, merge_chunks
from accrue.sources.jdbc import jdbc_options
from accrue.sources.landed import read_landed

__all__ = [
    "ChunkedSnapshot",
    "decode_changes",
    "encode_changes",
    "jdbc_options",
    "merge_chunks",
    "merge_snapshot_and_log",
    "read_change_records",
    "read_changelog",
    "read_facts",
    "read_landed",
    "stamp_snapshot",
]
