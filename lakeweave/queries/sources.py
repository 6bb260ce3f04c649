"""Source keys: land a bound input in a format, then read it back through its spec.

Each call writes under a fresh folder of the shared root, so runs never collide.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakeweave.plans import bindings
from lakeweave.plans.ingest import ingest_table
from lakeweave.plans.layouts import CODE_NAME_REGEXP, STATION_LAYOUT
from lakeweave.registry import register
from lakeweave.session import fresh_dir
from lakeweave.sinks.files import write_files
from lakeweave.sinks.tables import Lakehouse
from lakeweave.sources.files import file_counts, read_source
from lakeweave.sources.seeds import read_seed
from lakeweave.specs import ColumnSpec, FileFormat, Source, SourceSpec, TimePartition

# The run's launch time, stamped as ``ingested_at`` on every row of a declared-column
# load; the checked queries pass this fixed value so their output is reproducible.
RUN_TS = datetime(2024, 1, 1, 0, 0, 0)

OBS_COLUMNS = (
    ColumnSpec("ID"),
    ColumnSpec("DATE", "int"),
    ColumnSpec("DATA_VALUE", "int"),
    ColumnSpec("M_FLAG"),
    ColumnSpec("Q_FLAG"),
    ColumnSpec("S_FLAG"),
    ColumnSpec("OBS_TIME"),
    ColumnSpec("ELEMENT"),
    ColumnSpec("YEAR", "int"),
)

COUNTRIES_SPEC = SourceSpec(
    "countries", FileFormat.REGEXP, "countries/", (ColumnSpec("code"), ColumnSpec("name")),
    {"format_regexp": CODE_NAME_REGEXP}, full_refresh=True,
)
STATIONS_SPEC = SourceSpec(
    "stations", FileFormat.LINE_AS_STRING, "stations/",
    tuple(ColumnSpec(n, slice=pos) for n, pos in STATION_LAYOUT.items()), full_refresh=True,
)
OBSERVATIONS_SPEC = SourceSpec(
    "observations", FileFormat.PARQUET, "parquet/by_year/", None,
    {"use_hive_partitioning": "1"},
    partitions=(TimePartition("YEAR", datetime(1995, 1, 1)),),
)


def _obs_spec(fmt: FileFormat) -> SourceSpec:
    return SourceSpec(f"observations_{fmt.name.lower()}", fmt, "obs/", OBS_COLUMNS, full_refresh=True)


def _land_obs(spark, d, fmt: FileFormat, partition_by=()) -> str:
    root = fresh_dir(spark, f"src-{fmt.name.lower()}")
    write_files(bindings.raw_observations(spark, d), fmt, f"{root}/obs", partition_by)
    return root


@register("src_parquet_hive")
def src_parquet_hive(spark, d):
    root = fresh_dir(spark, "src-parquet")
    write_files(bindings.raw_observations(spark, d), FileFormat.PARQUET, f"{root}/parquet/by_year", ["YEAR"])
    return read_source(spark, OBSERVATIONS_SPEC, root)


@register("part_prune")
def part_prune(spark, d):
    """One partition's leaf folder read with basePath: only YEAR=1997 files are listed."""
    root = fresh_dir(spark, "src-parquet")
    write_files(bindings.raw_observations(spark, d), FileFormat.PARQUET, f"{root}/parquet/by_year", ["YEAR"])
    return read_source(spark, OBSERVATIONS_SPEC, root, partition_params={"YEAR": "1997"})


@register("src_fixed_width")
def src_fixed_width(spark, d):
    root = fresh_dir(spark, "src-fixed")
    write_files(bindings.station_lines(spark, d), FileFormat.LINE_AS_STRING, f"{root}/stations")
    return read_source(spark, STATIONS_SPEC, root, ingested_at=RUN_TS)


@register("src_expression")
def src_expression(spark, d):
    """Columns given as SQL over the whole line; a byte slice is one on the line's bytes."""
    root = fresh_dir(spark, "src-expression")
    write_files(bindings.station_lines(spark, d), FileFormat.LINE_AS_STRING, f"{root}/stations")
    columns = (
        ColumnSpec("id", expression="decode(substring(encode(line, 'UTF-8'), 1, 11), 'UTF-8')"),
        ColumnSpec("elevation", "double", expression="cast(trim(substring(line, 32, 6)) AS double)"),
        ColumnSpec("in_network", "boolean", expression="substring(line, 73, 3) = 'GSN'"),
    )
    spec = SourceSpec("stations", FileFormat.LINE_AS_STRING, "stations/", columns, full_refresh=True)
    return read_source(spark, spec, root, ingested_at=RUN_TS)


@register("src_regexp")
def src_regexp(spark, d):
    root = fresh_dir(spark, "src-regexp")
    write_files(bindings.country_lines(spark, d), FileFormat.REGEXP, f"{root}/countries")
    return read_source(spark, COUNTRIES_SPEC, root, ingested_at=RUN_TS)


@register("src_csv")
def src_csv(spark, d):
    return read_source(spark, _obs_spec(FileFormat.CSV), _land_obs(spark, d, FileFormat.CSV), ingested_at=RUN_TS)


@register("src_csv_header")
def src_csv_header(spark, d):
    spec = _obs_spec(FileFormat.CSV_WITH_NAMES)
    return read_source(spark, spec, _land_obs(spark, d, FileFormat.CSV_WITH_NAMES), ingested_at=RUN_TS)


@register("src_tsv")
def src_tsv(spark, d):
    return read_source(spark, _obs_spec(FileFormat.TSV), _land_obs(spark, d, FileFormat.TSV), ingested_at=RUN_TS)


@register("src_json_lines")
def src_json_lines(spark, d):
    spec = _obs_spec(FileFormat.JSON_EACH_ROW)
    return read_source(spark, spec, _land_obs(spark, d, FileFormat.JSON_EACH_ROW), ingested_at=RUN_TS)


@register("src_orc")
def src_orc(spark, d):
    spec = SourceSpec("observations_orc", FileFormat.ORC, "obs/", None, full_refresh=True)
    return read_source(spark, spec, _land_obs(spark, d, FileFormat.ORC))


@register("src_arrow")
def src_arrow(spark, d):
    spec = SourceSpec("observations_arrow", FileFormat.ARROW, "obs/", None, full_refresh=True)
    return read_source(spark, spec, _land_obs(spark, d, FileFormat.ARROW))


@register("src_seed")
def src_seed(spark, d):
    root = fresh_dir(spark, "src-seed")
    out = None
    for name, df in bindings.seed_frames(spark, d).items():
        df.write.mode("overwrite").csv(f"{root}/{name}", header=True)
        part = read_seed(spark, f"{root}/{name}").select(F.lit(name).alias("flag_type"), "id", "description")
        out = part if out is None else out.unionByName(part)
    return out


@register("src_prefix_recursive")
def src_prefix_recursive(spark, d):
    """Files at the prefix (customers) and in a plain folder below it (suppliers)."""
    path = fresh_dir(spark, "nested")
    people = {"": ("customer", "c_custkey", "c_name"), "/more": ("supplier", "s_suppkey", "s_name")}
    for folder, (name, key, label) in people.items():
        bindings.table(spark, d, name).select(key, label).write.mode("append").csv(f"{path}/people{folder}")
    columns = (ColumnSpec("id", "bigint"), ColumnSpec("name"))
    spec = SourceSpec("people", FileFormat.CSV, "people/**", columns, full_refresh=True)
    return read_source(spark, spec, path, ingested_at=RUN_TS).drop("ingested_at")


@register("src_rejects")
def src_rejects(spark, d):
    """Customer lines by segment, those of every seventh key cut short: records and rejected ones a file, as the load
    counted them in all and as the table of rejects keeps them."""
    root, lh = fresh_dir(spark, "src-rejects"), Lakehouse.scratch(spark)
    line = "if(c_custkey % 7 = 0, concat('?', c_name), concat_ws('|', c_custkey, c_name)) AS line"
    lines = bindings.table(spark, d, "customer").selectExpr(line, "c_mktsegment AS segment")
    lines.write.partitionBy("segment").text(f"{root}/shop/people")
    settings = {"format_regexp": "^([0-9]+)[|](.*)$", "format_regexp_skip_unmatched": "1"}
    spec = SourceSpec("people", FileFormat.REGEXP, "", (ColumnSpec("id", "bigint"), ColumnSpec("name")), settings, full_refresh=True)
    ingest_table(lh, Source("shop", "s3", (spec,)), "people", root, RUN_TS)
    counted = lh.counted["raw.shop_people"]
    kept = lh.table("raw", "shop_people_rejects").groupBy(_segment("file")).agg(F.count("*").alias("kept"))
    files = file_counts(spark, spec, f"{root}/shop/people").groupBy(_segment("file"))
    return (
        files.agg(F.sum("records").alias("records"), F.sum("rejected").alias("rejected"))
        .join(kept, "segment", "left")
        .withColumn("all_records", F.lit(counted["records"]).cast("bigint"))
        .withColumn("all_rejected", F.lit(counted["rejected"]).cast("bigint"))
    )


def _segment(file: str):
    return F.url_decode(F.regexp_extract(file, "/segment=([^/]*)/", 1)).alias("segment")
