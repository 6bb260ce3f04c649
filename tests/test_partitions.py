from datetime import date, datetime

import pytest

from lakeweave.operators import partitions as P
from lakeweave.specs import FileFormat, SourceSpec, StaticPartition, TimePartition


def test_time_keys_include_open_period(spark):
    b = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2026, 3, 5))], "start timestamp_ntz, as_of timestamp_ntz")
    assert [r[0] for r in P.time_keys(b, "start", "as_of", "year", "%Y").collect()] == ["2024", "2025", "2026"]
    months = [r[0] for r in P.time_keys(b, "start", "as_of", "month", "%Y-%m").collect()]
    assert months[0] == "2024-01" and months[-1] == "2026-03" and len(months) == 27


def test_multi_keys_cross_product_in_dimension_order(spark):
    b = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2025, 1, 1))], "start timestamp_ntz, as_of timestamp_ntz")
    keys = P.multi_keys(P.time_keys(b, "start", "as_of", name="YEAR"), [StaticPartition("R", ("a", "b"))])
    assert keys.columns == ["YEAR", "R"]
    assert sorted(tuple(r) for r in keys.collect()) == [("2024", "a"), ("2024", "b"), ("2025", "a"), ("2025", "b")]


def test_run_keys_name_every_partition_column_and_no_other():
    year, region = TimePartition("YEAR", datetime(2024, 1, 1)), StaticPartition("R", ("a", "b"))
    one = SourceSpec("t", FileFormat.PARQUET, partitions=(year,))
    two = SourceSpec("t", FileFormat.PARQUET, partitions=(year, region))
    none = SourceSpec("u", FileFormat.PARQUET, full_refresh=True)
    assert P.run_keys(one, "2024") == P.run_keys(one, {"YEAR": "2024"}) == {"YEAR": "2024"}
    assert list(P.run_keys(two, {"R": "a", "YEAR": "2024"}).items()) == [("YEAR", "2024"), ("R", "a")]
    assert P.run_keys(none) == {}
    for spec, key in ((one, None), (two, "2024"), (two, {"YEAR": "2024"}), (one, {"YEAR": "1", "R": "a"}), (none, "2024")):
        with pytest.raises(ValueError, match="needs a value for each"):
            P.run_keys(spec, key)


def test_week_day_and_hour_keys_ignore_the_time_zone(spark):
    # in this zone 2024-03-31 has no hour 02 and 2024-10-27 has two
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        def keys(start, end, *how, **more):
            b = spark.createDataFrame([(start, end)], "start timestamp_ntz, as_of timestamp_ntz")
            return [r[0] for r in P.time_keys(b, "start", "as_of", *how, **more).collect()]

        for day in ("2024-03-31", "2024-10-27"):
            at = datetime.fromisoformat(day)
            hours = keys(at, at.replace(hour=23, minute=59), "hour", "%Y-%m-%dT%H:%M")
            assert hours == [f"{day}T{h:02}:00" for h in range(24)]
        assert keys(datetime(2024, 3, 30, 5), datetime(2024, 4, 1, 1), "day", "%d%%%m") == ["30%03", "31%03", "01%04"]
        # 2024-01-03 is a Wednesday
        weeks = keys(datetime(2024, 1, 3), datetime(2024, 1, 15), "week", "%Y-%m-%d")
        assert weeks == ["2023-12-31", "2024-01-07", "2024-01-14"]
        weeks = keys(datetime(2024, 1, 3), datetime(2024, 1, 15), "week", "%Y-%m-%d", weekday=3)
        assert weeks == ["2024-01-03", "2024-01-10"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_key_formats_without_a_rule_raise(spark):
    from pyspark.sql import functions as F

    for fmt in ("%Y-%j", "%y", "%Y%"):
        with pytest.raises(ValueError, match="no rule"):
            P.key_text(F.lit(None), fmt)


@pytest.mark.parametrize(
    "cron,period,weekday",
    [("0 0 1 1 *", "year", 0), ("0 0 1 * *", "month", 0), ("0 0 * * 1", "week", 1), ("0 0 * * 7", "week", 0),
     ("0 0 * * *", "day", 0), ("0 * * * *", "hour", 0)],
)
def test_cron_periods(cron, period, weekday):
    spec = SourceSpec.from_dict(
        {"name": "t", "file_format": "ORC", "partitions": [{"name": "P", "start": "2024-01-01", "cron": cron}]}
    )
    assert (spec.partitions[0].period, spec.partitions[0].weekday) == (period, weekday)


@pytest.mark.parametrize("cron", ["0 */6 * * *", "*/15 * * * *", "0 0 1 */3 *", "0 5 * * *", "0 0 1 * 1", "0 0 * *"])
def test_crons_without_a_period_raise(cron):
    with pytest.raises(ValueError, match="does not start"):
        SourceSpec.from_dict(
            {"name": "t", "file_format": "ORC", "partitions": [{"name": "P", "start": "2024-01-01", "cron": cron}]}
        )


def test_key_window():
    y = TimePartition("YEAR", datetime(2024, 1, 1))
    assert P.key_window("2024", y) == (date(2024, 1, 1), date(2024, 12, 31))
    m = TimePartition("M", datetime(2024, 1, 1), "month", "%Y-%m")
    assert P.key_window("2024-12", m) == (date(2024, 12, 1), date(2024, 12, 31))
    w = TimePartition("W", datetime(2024, 1, 1), "week", "%Y-%m-%d")
    assert P.key_window("2024-12-29", w) == (date(2024, 12, 29), date(2025, 1, 4))
    assert P.year_bounds(P.key_window("2024", y)) == (2024, 2024)


def test_common_partitioning():
    y = (TimePartition("YEAR", datetime(2024, 1, 1)),)
    assert P.common_partitioning({"a": y, "b": None}) == y
    with pytest.raises(ValueError, match="different partitionings"):
        P.common_partitioning({"a": y, "b": (StaticPartition("K", ("x",)),)})


def test_missing_keys(spark):
    exp = spark.createDataFrame([("2024",), ("2025",), ("2026",)], "partition_key string")
    present = spark.createDataFrame([("2024",), ("2024",)], "partition_key string")
    assert sorted(r[0] for r in P.missing_keys(exp, present).collect()) == ["2025", "2026"]
