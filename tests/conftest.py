import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from accrue.sources.schemas import CHANGES, FACTS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        # no result may depend on the session zone
        .config("spark.sql.session.timeZone", "Asia/Tokyo")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text)


def fact(id, cuit, tax_id, rate, base, amount, at):
    """One fact row; amounts as text."""
    at = utc(at) if isinstance(at, str) else at
    return (id, f"tx-{id}", cuit, tax_id, Decimal(rate), Decimal(base), Decimal(amount), "CL", Decimal("0.00"), at)


@pytest.fixture(scope="session")
def facts_of(spark):
    return lambda *rows: spark.createDataFrame(list(rows), FACTS)


@pytest.fixture(scope="session")
def log_of(spark):
    """Change log from (cuit, name, establishment, op, op_ts, seq) rows."""

    def build(*rows):
        typed = [(*r[:4], utc(r[4]) if isinstance(r[4], str) else r[4], r[5]) for r in rows]
        return spark.createDataFrame(typed, CHANGES)

    return build


def line_set(df):
    """Rate lines as a set of plain tuples without the window end."""
    return {
        (r.cuit, r.tax_id, str(r.tax_rate), r.window_start, r.merchant_name, str(r.total_base_tax), str(r.total_tax_amount))
        for r in df.collect()
    }
