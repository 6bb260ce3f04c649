from datetime import datetime

from pyspark.sql import functions as F

from lakeweave.functions.text import byte_substring
from lakeweave.functions.time import observed_at, parse_yyyymmdd
from lakeweave.functions.units import normalized_value


def test_byte_substring_counts_bytes_not_characters(spark):
    # 'é' is two bytes: the name field starts one *character* earlier than byte 7
    df = spark.createDataFrame([("AB Zé XY",)], "line string")
    row = df.select(byte_substring("line", 4, 3).alias("name"), byte_substring("line", 8, 2).alias("tail"), F.substring("line", 8, 2).alias("chars")).first()
    assert row.name == "Zé"
    assert row.tail == "XY"
    assert row.chars == "Y"  # the character-based slice is shifted


def test_byte_substring_short_line_is_empty(spark):
    df = spark.createDataFrame([("ABC",)], "line string")
    assert df.select(byte_substring("line", 10, 4).alias("x")).first().x == ""


def test_observed_at_edge_cases(spark):
    rows = [(20240105, None), (20240105, ""), (20240105, "0"), (20240105, "700"), (20240105, "2400"), (20240105, "1234")]
    df = spark.createDataFrame(rows, "d int, t string")
    day = parse_yyyymmdd(F.col("d"))
    got = [r.ts for r in df.select(observed_at(day, F.col("t")).alias("ts")).collect()]
    assert got == [
        None,
        None,
        datetime(2024, 1, 5, 0, 0),
        datetime(2024, 1, 5, 7, 0),
        datetime(2024, 1, 6, 0, 0),  # 2400 rolls to the next day
        datetime(2024, 1, 5, 12, 34),
    ]


def test_lpad_truncates(spark):
    assert spark.range(1).select(F.lpad(F.lit("12345"), 4, "0").alias("x")).first().x == "1234"


def test_normalized_value(spark):
    df = spark.createDataFrame([("TMAX", 215), ("PRCP", 7), ("SNOW", 30), ("TAVG", -5)], "m string, v int")
    got = [r.x for r in df.select(normalized_value(F.col("m"), F.col("v")).alias("x")).collect()]
    assert got == [21.5, 0.7, 30.0, -0.5]
    assert dict(df.select(normalized_value(F.col("m"), F.col("v")).alias("x")).dtypes)["x"] == "double"


def test_station_number_beyond_the_layout_raises(spark):
    import pytest

    from lakeweave.plans.bindings import station_id_sql

    rows = spark.createDataFrame([(7, 999_999_999)], "n int, c long")
    assert rows.selectExpr(station_id_sql("n", "c")).first()[0] == "07999999999"
    with pytest.raises(Exception, match="nine digits"):
        rows.selectExpr("n", "c + 1 AS c").selectExpr(station_id_sql("n", "c")).collect()
