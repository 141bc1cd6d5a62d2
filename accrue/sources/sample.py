"""The sample tables as facts and a dimension change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrue.functions.timestamps import to_utc
from accrue.plans.model import Model

DELAY_SECONDS = 600
MODEL = Model(arrival=("arr", "id"))

# Event type -> tax id
TAX_IDS = {
    "purchase": "RET_IVA",
    "click": "RET_GANANCIAS",
    "view": "RET_IIBB_CABA",
    "signup": "PER_IVA",
    "error": "PER_IIBB_CABA",
}


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as tax facts; ``arr`` is a made-up arrival second, out of event order. Every 97th amount is a cent off."""
    events = to_utc(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")
    tax_id = " ".join(f"WHEN '{event}' THEN '{tax}'" for event, tax in TAX_IDS.items())
    return events.selectExpr(
        "event_id AS id",
        "CAST(user_id AS STRING) AS cuit",
        f"CASE event_type {tax_id} END AS tax_id",
        "CAST(2 + event_id % 3 * 1.5BD AS DECIMAL(5,2)) AS tax_rate",
        "CAST(value AS DECIMAL(18,2)) AS base_tax",
        "ts AS created_at",
    ).selectExpr(
        "*",
        "CAST(base_tax * tax_rate * 0.01BD AS DECIMAL(18,2)) + IF(id % 97 = 13, 0.01BD, 0.00BD) AS amount",
        "unix_timestamp(created_at) + id * 7919 % 1200 AS arr",
    ).selectExpr("* EXCEPT (amount)", "CAST(amount AS DECIMAL(18,2)) AS tax_amount")


def changelog(spark: SparkSession, sf_dir: str, everyone: bool = False) -> DataFrame:
    """``customer`` as a change log.

    Some customers are no merchants, so their facts find no version, unless
    ``everyone`` is one. The others have a snapshot row, some two updates at one
    time, some a delete.
    """

    def change(op: str, at: str, suffix: str | None, offset: int) -> str:
        name = "CAST(NULL AS STRING)" if suffix is None else f"concat(c_name, '{suffix}')"
        number = "CAST(NULL AS STRING)" if suffix is None else f"CAST(c_custkey + {offset} AS STRING)"
        return f"named_struct('op', '{op}', 'op_ts', {at}, 'name', {name}, 'establishment', {number})"

    updated_at = "TIMESTAMP_NTZ '2024-01-10 12:00:00' + INTERVAL '1' MINUTE * (c_custkey % 600)"
    changes = f"""posexplode(array(
        {change("r", "TIMESTAMP_NTZ '2024-01-02 00:00:00'", "", 10000)},
        IF(c_custkey % 3 = 0, {change("u", updated_at, " II", 20000)}, NULL),
        IF(c_custkey % 6 = 0, {change("u", updated_at, " III", 30000)}, NULL),
        IF(c_custkey % 7 = 0, {change("d", "TIMESTAMP_NTZ '2024-01-20 00:00:00'", None, 0)}, NULL))) AS (k, c)"""
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .where(F.lit(everyone) | (F.col("c_custkey") % 11 != 5))
        .selectExpr("c_custkey", changes)
        .where("c IS NOT NULL")
        .selectExpr(
            "CAST(c_custkey AS STRING) AS cuit", "c.name", "c.establishment", "c.op", "c.op_ts", "c_custkey * 10 + k AS seq"
        )
    )
