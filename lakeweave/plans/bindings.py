"""Bind the shared test tables to the weather dataset's raw inputs.

The driver's tables are a star schema, not weather data; each raw input of the
weather pipeline is derived from them by plain column expressions (written so the
same rule can be stated in any SQL engine). Everything here is lazy; the raw frames
feed the layer jobs directly or are landed as files by the source tests.

Binding rules:
  countries    nation: code = 2-digit nation key, name = n_name
  states       region: code = 2-digit region key, name = r_name
  stations     customer x nation, every customer
  observations lineitem x orders x customer, one reading per line item
  inventory    observations grouped by station and element
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Element recorded by line number 1..7.
ELEMENTS_BY_LINE = ("TMAX", "TMIN", "PRCP", "SNOW", "TAVG", "SNWD", "WT01")


# Schemas of the shared tables. Declaring them skips the footer-reading
# schema-inference job that every ``spark.read.parquet`` would otherwise start.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _code2(col: str) -> str:
    return f"lpad(cast({col} as string), 2, '0')"


def station_id_sql(nationkey: str, custkey: str) -> str:
    """11 chars: 2-char country code + 9-digit station number; a number that doesn't fit the layout raises."""
    number = f"lpad(cast({custkey} as string), 9, '0')"
    wide = f"raise_error(concat('station number does not fit nine digits: ', {custkey}))"
    return f"concat({_code2(nationkey)}, if({custkey} between 0 and 999999999, {number}, {wide}))"


def _fixed(value: str, width: int) -> str:
    """Right-align a value's text in ``width`` characters."""
    return f"lpad(cast({value} as string), {width}, ' ')"


def latitude_text_sql(custkey: str) -> str:
    return _fixed(f"cast(cast(({custkey} * 37) % 1800 - 900 as decimal(12,1)) / 10 as decimal(8,4))", 8)


def longitude_text_sql(custkey: str) -> str:
    return _fixed(f"cast(cast(({custkey} * 91) % 3600 - 1800 as decimal(12,1)) / 10 as decimal(9,4))", 9)


def country_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.selectExpr(f"concat({_code2('n_nationkey')}, ' ', n_name) AS line")


def state_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.selectExpr(f"concat({_code2('r_regionkey')}, ' ', r_name) AS line")


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    fields = [
        station_id_sql("c_nationkey", "c_custkey"),
        latitude_text_sql("c_custkey"),
        longitude_text_sql("c_custkey"),
        _fixed("cast(floor(c_acctbal) as decimal(6,1))", 6),
        f"CASE WHEN c_mktsegment = 'BUILDING' THEN {_code2('n_regionkey')} ELSE '  ' END",
        "rpad(c_name, 30, ' ')",
        "CASE WHEN c_custkey % 10 = 0 THEN 'GSN' ELSE '   ' END",
        "CASE WHEN c_custkey % 15 = 0 THEN 'HCN' ELSE '   ' END",
        "lpad(cast(c_custkey % 100000 as string), 5, '0')",
    ]
    return (
        c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
        .selectExpr(f"concat_ws(' ', {', '.join(fields)}) AS line")
    )


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observation rows: ID, DATE, DATA_VALUE, M_FLAG, Q_FLAG, S_FLAG, OBS_TIME,
    ELEMENT, YEAR.

    Join order: orders x customer first (the smaller join), then line items, so the
    largest table is shuffled once, by order key.
    """
    # a customer's station id is built once, before its readings multiply it
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{station_id_sql('c_nationkey', 'c_custkey')} AS ID")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    x = li.join(oc, li["l_orderkey"] == oc["o_orderkey"], "inner")
    elements = ", ".join(f"'{e}'" for e in ELEMENTS_BY_LINE)
    element = f"try_element_at(array({elements}), l_linenumber)"
    qty10 = "cast(floor(l_quantity) * 10 as int)"
    return x.selectExpr(
        "ID",
        "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + dayofmonth(o_orderdate) AS DATE",
        f"CASE WHEN {element} = 'TMIN' THEN {qty10} - 250 ELSE {qty10} END AS DATA_VALUE",
        "CASE WHEN l_quantity = 1 THEN 'T' END AS M_FLAG",
        "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'X' END AS Q_FLAG",
        "l_linestatus AS S_FLAG",
        "CASE l_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN '700' WHEN 3 THEN '2400' END AS OBS_TIME",
        f"{element} AS ELEMENT",
        "year(o_orderdate) AS YEAR",
    )


def inventory_lines(raw_obs: DataFrame) -> DataFrame:
    """Period of record per (station, element), rendered in the inventory layout."""
    per = raw_obs.groupBy("ID", "ELEMENT").agg(
        F.min("YEAR").alias("first_year"), F.max("YEAR").alias("last_year")
    )
    k = "cast(substring(ID, 3, 9) as bigint)"
    fields = [
        "ID",
        latitude_text_sql(k),
        longitude_text_sql(k),
        "rpad(ELEMENT, 4, ' ')",
        "cast(first_year as string)",
        "cast(last_year as string)",
    ]
    return per.selectExpr(f"concat_ws(' ', {', '.join(fields)}) AS line")


def seed_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Flag lookups derived from the tables: distinct languages and event types."""
    docs = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events")
    return {
        "measurement_flags": docs.select(F.col("lang").alias("id")).distinct().select(
            "id", F.concat(F.lit("language "), F.col("id")).alias("description")
        ),
        "quality_flags": events.select(F.col("event_type").alias("id")).distinct().select(
            "id", F.concat(F.lit("event type "), F.col("id")).alias("description")
        ),
        "source_flags": table(spark, sf_dir, "lineitem")
        .select(F.col("l_linestatus").alias("id"))
        .distinct()
        .select("id", F.concat(F.lit("line status "), F.col("id")).alias("description")),
    }
