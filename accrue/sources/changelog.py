"""Change records of a database table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.functions.timestamps import from_epoch, utc_literal
from accrue.operators.intervals import DELETE
from accrue.operators.keyed import upsert


_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def envelope(row: T.StructType) -> T.StructType:
    """Schema of a change record ``{op, before, after, source: {ts_ms, lsn}}``."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("source", T.StructType([
            T.StructField("ts_ms", T.LongType()),
            T.StructField("lsn", T.LongType()),
        ])),
    ])


def decode_changes(records: DataFrame, row: T.StructType, key: list[str], value: str = "value") -> DataFrame:
    """JSON change records -> row columns, ``op``, ``op_ts`` (commit time, UTC) and ``seq`` (log position).

    A delete keeps the key of its before image and has NULL for the rest. Broken
    JSON, an unknown op, a record without commit time or log position or without the
    image its op needs raises, whatever columns are read: a lost change would
    silently change every later join.
    """
    schema = envelope(row)
    parsed = records.select(F.from_json(value, schema, {"mode": "FAILFAST", **_TIMES}).alias("r"))
    op = F.col("r.op")
    known = op.isin("r", "c", "u", DELETE)
    image = F.when(op == DELETE, F.col("r.before")).otherwise(F.col("r.after"))
    # REPLICA IDENTITY FULL: an update carries both images
    complete = known & image.isNotNull() & ((op != "u") | F.col("r.before").isNotNull())
    complete = complete & F.col("r.source.ts_ms").isNotNull() & F.col("r.source.lsn").isNotNull()
    for name in key:
        complete = complete & image[name].isNotNull()
    complaint = F.concat(F.lit("incomplete change record, op "), F.coalesce(op, F.lit("NULL")))
    record = F.when(F.coalesce(complete, F.lit(False)), F.col("r")).otherwise(F.raise_error(complaint).cast(schema))
    parsed = parsed.select(record.alias("r"))

    def field(name: str) -> Column:
        return image[name] if name in key else F.when(op != DELETE, image[name])

    millis = F.col("r.source.ts_ms")
    op_ts = from_epoch(F.floor(millis / 1000)) + F.expr("INTERVAL '0.001' SECOND") * F.pmod(millis, F.lit(1000))
    return parsed.select(
        *[field(f.name).alias(f.name) for f in row.fields],
        op.alias("op"),
        op_ts.alias("op_ts"),
        F.col("r.source.lsn").alias("seq"),
    )


def encode_changes(changes: DataFrame, row: T.StructType, key: list[str]) -> DataFrame:
    """The inverse of :func:`decode_changes`: one JSON change record per row, column ``value``.

    Only the key is known of a before image.
    """
    image = F.struct(*[F.col(f.name) for f in row.fields])
    before = F.struct(*[F.col(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name) for f in row.fields])
    op = F.col("op")
    millis = F.unix_timestamp("op_ts") * 1000 + F.floor(F.date_format("op_ts", "SSS").cast("int"))
    return changes.select(
        F.to_json(
            F.struct(
                op,
                F.when(op.isin("u", DELETE), before).alias("before"),
                F.when(op != DELETE, image).alias("after"),
                F.struct(millis.alias("ts_ms"), F.col("seq").alias("lsn")).alias("source"),
            ),
            _TIMES,
        ).alias("value")
    )


def stamp_snapshot(rows: DataFrame, read_at: datetime | Column, seq: Column | None = None) -> DataFrame:
    """Snapshot rows as versions that begin when the snapshot was read.

    Facts older than the snapshot find no version; log rows keep their commit time.
    """
    at = read_at if isinstance(read_at, Column) else utc_literal(read_at)
    return rows.withColumns({
        "op": F.lit("r"),
        "op_ts": at,
        "seq": F.lit(0).cast("bigint") if seq is None else seq,
    })


def merge_snapshot_and_log(
    snapshot: DataFrame, log: DataFrame, key: list[str], order: list[str] | None = None
) -> DataFrame:
    """Snapshot and log of one table without the rows both hold.

    ``key`` identifies a record, for facts their id, for changes the row key and
    the log position. The log's copy wins, the last by ``order`` or, where copies
    are alike, any.
    """
    return upsert(snapshot, log.dropDuplicates(key) if order is None else log, key, order)
