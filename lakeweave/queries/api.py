"""Landed API page keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.plans import api_pages
from lakeweave.registry import register
from lakeweave.session import fresh_dir
from lakeweave.sinks.files import write_documents


def _land(spark, d) -> str:
    path = fresh_dir(spark, "api-pages")
    api_pages.land_pages(api_pages.api_records(spark, d), path)
    return path


@register("src_api_pages")
def src_api_pages(spark, d):
    return api_pages.read_pages(spark, _land(spark, d))


@register("src_api_completeness")
def src_api_completeness(spark, d):
    return api_pages.completeness(spark, _land(spark, d))


@register("src_landing_manifest")
def src_landing_manifest(spark, d):
    return api_pages.landing_manifest(spark, _land(spark, d))


@register("src_api_unpartitioned")
def src_api_unpartitioned(spark, d):
    """Pages ``{"items": [...]}`` without partition folders or a declared page count."""
    path = fresh_dir(spark, "api-items")
    records = api_pages.api_records(spark, d)
    pages = records.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("id", "value"))).alias("items"))
    write_documents(pages.select("page", F.to_json(F.struct("items")).alias("value")), path, ["page"])
    return api_pages.decode_pages(spark, path, "struct<id:bigint,value:double>", "items", None).drop("pages")
