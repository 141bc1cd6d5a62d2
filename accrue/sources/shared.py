"""A folder that the driver and all executors share, for tables a job writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Where that is unset, a session whose executors run inside the driver (master
    ``local`` or ``local[n]``) uses its warehouse folder; any other session raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a shared folder and read from there: nothing before has to run again.

    So the shuffle files of what came before are of no more use and go as soon as the rows are written.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, label)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(folder)
    _FOLDERS[id(out)] = (out, folder)
    return out


#: Tables of `written` by identity; each entry holds its DataFrame, so that no other gets its identity.
_FOLDERS: dict[int, tuple[DataFrame, str]] = {}


def discard(*tables: DataFrame) -> None:
    """Empty the folders of tables of `written` that nothing will read any more."""
    for table in tables:
        _, folder = _FOLDERS.pop(id(table))
        table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)
