"""Column layouts of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_COLUMNS = ("open", "high", "low", "close")
CORE_COLUMNS = PRICE_COLUMNS + ("volume",)

BARS = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("oi", T.LongType()),
    ]
)

# The text form of bar timestamps: the offset is a literal, the value is naive local time.
BAR_TS_FORMAT = "yyyy-MM-dd HH:mm:ss'+05:30'"

# Accepted spellings of the core columns.
COLUMN_ALIASES = {
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
}


def field_type(schema: T.StructType, name: str) -> T.DataType:
    return schema[name].dataType


def fields_of(schema: T.StructType, names) -> list[T.StructField]:
    return [T.StructField(n, schema[n].dataType) for n in names]


TRADE_FIELDS = [
    T.StructField("entry_signal_ts", T.TimestampNTZType()),
    T.StructField("entry_ts", T.TimestampNTZType()),
    T.StructField("entry_price", T.DoubleType()),
    T.StructField("exit_signal_ts", T.TimestampNTZType()),
    T.StructField("exit_ts", T.TimestampNTZType()),
    T.StructField("exit_price", T.DoubleType()),
    T.StructField("exit_reason", T.StringType()),
]
