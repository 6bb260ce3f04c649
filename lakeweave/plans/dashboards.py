"""Dashboard queries: one grouped aggregate over a mart each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_country(mart: DataFrame, agg, alias: str, limit: int, desc: bool) -> DataFrame:
    out = mart.groupBy("country_name").agg(agg.alias(alias))
    order = F.col(alias).desc_nulls_last() if desc else F.col(alias)
    # country_name breaks ties so the cut at ``limit`` is deterministic
    return out.orderBy(order, F.col("country_name").asc_nulls_last()).limit(limit)


def country_tmax(country_year: DataFrame) -> DataFrame:
    """Map: mean of country-year mean max temperature, by country (average of averages)."""
    out = country_year.groupBy("country_name").agg(F.avg("avg_tmax_celsius").alias("avg_tmax_celsius"))
    return out.orderBy(F.col("country_name").asc_nulls_last()).limit(10000)


def top_precip(country_year: DataFrame) -> DataFrame:
    return _by_country(country_year, F.avg("avg_yearly_precip_mm"), "avg_yearly_precip_mm", 1000, True)


def snowiest(snow_cold: DataFrame) -> DataFrame:
    return _by_country(snow_cold, F.avg("avg_yearly_snowfall_mm"), "avg_yearly_snowfall_mm", 1000, True)


def coverage(station_coverage: DataFrame) -> DataFrame:
    return _by_country(station_coverage, F.sum("station_count"), "station_count", 1000, True)


def trend(global_year: DataFrame) -> DataFrame:
    return (
        global_year.groupBy("observation_year")
        .agg(F.avg("avg_tmax_celsius").alias("avg_tmax_celsius"), F.avg("avg_tmin_celsius").alias("avg_tmin_celsius"))
        .orderBy("observation_year")
        .limit(10000)
    )


def kpis(station_coverage: DataFrame, global_year: DataFrame) -> DataFrame:
    """Four big numbers in one row: countries, stations, observations, global mean max.

    The two marts are stacked (union) and reduced by one global aggregate, each KPI
    reading only its own mart's rows.
    """
    null_long, null_double = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    cov = station_coverage.select(
        F.lit(1).alias("is_country"), F.col("station_count").cast("bigint").alias("stations"),
        null_long.alias("obs"), null_double.alias("tmax"),
    )
    glob = global_year.select(
        F.lit(0).alias("is_country"), null_long.alias("stations"),
        F.col("observation_count").cast("bigint").alias("obs"), F.col("avg_tmax_celsius").alias("tmax"),
    )
    return cov.unionByName(glob).agg(
        F.sum("is_country").cast("bigint").alias("countries_covered"),
        F.sum("stations").cast("bigint").alias("weather_stations"),
        F.sum("obs").cast("bigint").alias("observations"),
        F.avg("tmax").alias("global_avg_max_temp"),
    )
