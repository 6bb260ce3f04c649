"""Layer, mart and dashboard keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.plans import bindings, cleansed, dashboards
from lakeweave.plans.chain import LayerChain
from lakeweave.registry import register


@register("cleansed_countries")
def cleansed_countries(spark, d):
    return LayerChain(spark, d).countries


@register("cleansed_states")
def cleansed_states(spark, d):
    return LayerChain(spark, d).states


@register("cleansed_stations")
def cleansed_stations(spark, d):
    return LayerChain(spark, d).stations


@register("cleansed_inventory")
def cleansed_inventory(spark, d):
    return LayerChain(spark, d).inventory


@register("cleansed_observations")
def cleansed_observations(spark, d):
    return LayerChain(spark, d).observations


@register("cleansed_flags")
def cleansed_flags(spark, d):
    seeds = bindings.seed_frames(spark, d)
    views = [cleansed.flags_view(df).select(F.lit(name).alias("flag_type"), "*") for name, df in seeds.items()]
    out = views[0]
    for v in views[1:]:
        out = out.unionByName(v)
    return out


@register("curated_stations")
def curated_stations(spark, d):
    return LayerChain(spark, d).curated_stations


@register("curated_observations")
def curated_observations(spark, d):
    return LayerChain(spark, d).curated_observations


@register("curated_station_year")
def curated_station_year(spark, d):
    return LayerChain(spark, d).station_year


@register("report_country_year")
def report_country_year(spark, d):
    return LayerChain(spark, d).country_year


@register("report_global_year")
def report_global_year(spark, d):
    return LayerChain(spark, d).global_year


@register("report_snow_cold")
def report_snow_cold(spark, d):
    return LayerChain(spark, d).snow_cold


@register("report_station_coverage")
def report_station_coverage(spark, d):
    return LayerChain(spark, d).station_coverage


@register("dash_country_tmax")
def dash_country_tmax(spark, d):
    return dashboards.country_tmax(LayerChain(spark, d).country_year)


@register("dash_top_precip")
def dash_top_precip(spark, d):
    return dashboards.top_precip(LayerChain(spark, d).country_year)


@register("dash_snowiest")
def dash_snowiest(spark, d):
    return dashboards.snowiest(LayerChain(spark, d).snow_cold)


@register("dash_coverage")
def dash_coverage(spark, d):
    return dashboards.coverage(LayerChain(spark, d).station_coverage)


@register("dash_trend")
def dash_trend(spark, d):
    return dashboards.trend(LayerChain(spark, d).global_year)


@register("dash_kpis")
def dash_kpis(spark, d):
    p = LayerChain(spark, d)
    return dashboards.kpis(p.station_coverage, p.global_year)
