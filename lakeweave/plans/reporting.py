"""Reporting marts: second stage over the station-year fact (never collapsed into one
pass: averages are unweighted across stations)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.operators.aggregates import any_not_null

COUNTRY_YEAR_KEYS = ["observation_year", "country_id", "country_name"]


def _has_reading():
    return any_not_null(F.col("avg_tmax_celsius"), F.col("avg_tmin_celsius"), F.col("total_precip_mm"))


def country_year(station_year: DataFrame) -> DataFrame:
    """Country-year averages; country-years without any temperature/precip station dropped."""
    return (
        station_year.groupBy(*COUNTRY_YEAR_KEYS)
        .agg(
            F.count_if(_has_reading()).alias("station_count"),
            F.avg("avg_tmax_celsius").alias("avg_tmax_celsius"),
            F.avg("avg_tmin_celsius").alias("avg_tmin_celsius"),
            F.avg("total_precip_mm").alias("avg_yearly_precip_mm"),
        )
        .filter(F.col("station_count") > 0)
    )


def global_year(station_year: DataFrame) -> DataFrame:
    """One row per year. ``country_count`` ignores the NULL country (exact distinct)."""
    return (
        station_year.groupBy("observation_year")
        .agg(
            F.count_if(_has_reading()).alias("station_count"),
            F.count_distinct("country_id").alias("country_count"),
            F.sum("observation_count").cast("bigint").alias("observation_count"),
            F.avg("avg_tmax_celsius").alias("avg_tmax_celsius"),
            F.avg("avg_tmin_celsius").alias("avg_tmin_celsius"),
            F.avg("total_precip_mm").alias("avg_precip_mm"),
        )
        .orderBy("observation_year")
    )


def snow_cold(station_year: DataFrame) -> DataFrame:
    """Mean of per-station snow totals and the coldest station reading per country-year."""
    return (
        station_year.groupBy(*COUNTRY_YEAR_KEYS)
        .agg(
            F.avg("total_snowfall_mm").alias("avg_yearly_snowfall_mm"),
            F.min("min_tmin_celsius").alias("min_tmin_celsius"),
        )
        .filter(F.col("avg_yearly_snowfall_mm").isNotNull() | F.col("min_tmin_celsius").isNotNull())
    )


def station_coverage(curated_stations: DataFrame) -> DataFrame:
    """Stations and mean geography per country; the elevation sentinel (<= -900) is left
    out of the elevation mean only. Decimal columns are averaged as DOUBLE."""
    elev = F.col("elevation").cast("double")
    return (
        curated_stations.groupBy("country_id", "country_name")
        .agg(
            F.count("id").alias("station_count"),
            F.avg(F.when(elev > -900, elev)).alias("avg_elevation_m"),
            F.avg(F.col("latitude").cast("double")).alias("avg_latitude"),
            F.avg(F.col("longitude").cast("double")).alias("avg_longitude"),
        )
        .orderBy(F.col("station_count").desc(), F.col("country_id"))
    )
