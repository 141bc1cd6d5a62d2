"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_RATE = T.DecimalType(5, 2)
_MONEY = T.DecimalType(18, 2)

FACTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("cuit", T.StringType(), False),
    T.StructField("tax_id", T.StringType(), False),
    T.StructField("tax_rate", _RATE, False),
    T.StructField("base_tax", _MONEY, False),
    T.StructField("tax_amount", _MONEY, False),
    T.StructField("tax_status", T.StringType()),
    T.StructField("exclusion_rate", _RATE),
    T.StructField("created_at", T.TimestampNTZType(), False),
])

MERCHANT = T.StructType([
    T.StructField("cuit", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("establishment", T.StringType()),
])

CHANGES = T.StructType([
    *MERCHANT.fields,
    T.StructField("op", T.StringType()),
    T.StructField("op_ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

RATE_LINES = T.StructType([
    T.StructField("cuit", T.StringType()),
    T.StructField("tax_id", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("tax_rate", _RATE),
    T.StructField("establishment", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("total_base_tax", _MONEY),
    T.StructField("total_tax_amount", _MONEY),
])
