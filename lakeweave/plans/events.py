"""Event landings for the incremental path: raw event files partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)


def with_day(events: DataFrame) -> DataFrame:
    return events.select(*[f.name for f in RAW_EVENT_SCHEMA.fields if f.name != "event_date"], F.to_date("ts").alias("event_date"))


def land(events: DataFrame, raw_path: str) -> None:
    """Append one landing: files under ``event_date=YYYY-MM-DD`` folders."""
    with_day(events).write.mode("append").partitionBy("event_date").parquet(raw_path)


def cleanse(raw: DataFrame) -> DataFrame:
    """Typed, trimmed events; the partition column goes last."""
    return raw.select(
        "event_id", "ts", "user_id", F.trim("event_type").alias("event_type"), "value", "props", "event_date"
    )
