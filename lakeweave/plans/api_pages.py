"""Paged API responses landed as files, decoded and checked as batch jobs.

A response page is ``[meta, records]``: the records are selected by the JSONPath
``$[1]`` and the declared page count by ``$[0].pages`` unless a table's paging says
otherwise. Pages are landed one file per
(YEAR, page) folder, so a landing can be listed, audited and re-read per partition.

Binding: the records of year Y are that year's orders (id = order key, date = year,
value = total price); page p holds the orders whose key falls in the p-th block of
``PAGE_SIZE`` keys. Every page holds at most ``PAGE_SIZE`` records, so building a page
never gathers more than that into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.plans.bindings import table
from lakeweave.sinks.files import write_documents
from lakeweave.sinks.tables import session_conf

PAGE_SIZE = 1000
LISTING_TASKS = 64
RECORD_SCHEMA = "array<struct<id:bigint,date:string,value:double>>"


def api_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.year("o_orderdate").alias("YEAR"),
        (F.floor(F.col("o_orderkey") / PAGE_SIZE) + 1).cast("int").alias("page"),
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").cast("string").alias("date"),
        F.col("o_totalprice").alias("value"),
    )


def land_pages(records: DataFrame, path: str) -> None:
    """One JSON document per (YEAR, page): ``[{"page":p,"pages":n},[{...},...]]``.

    The yearly totals are broadcast: a DATE has at most 9,999 years, so there are at most
    that many rows of two numbers, and no year's pages meet in one task.
    """
    totals = records.groupBy("YEAR").agg(F.max("page").alias("pages"))
    pages = records.groupBy("YEAR", "page").agg(
        F.sort_array(F.collect_list(F.struct("id", "date", "value"))).alias("records"),
    )
    pages = pages.join(F.broadcast(totals), "YEAR")
    # a page is one block of PAGE_SIZE unique order keys; fail loudly if the key ever
    # stops being unique rather than emitting an oversized page
    too_big = F.size("records") > PAGE_SIZE
    pages = pages.withColumn(
        "records", F.when(too_big, F.raise_error(F.lit("page exceeds PAGE_SIZE records"))).otherwise(F.col("records"))
    )
    doc = F.concat(
        F.lit("["),
        F.to_json(F.struct(F.col("page"), F.col("pages"))),
        F.lit(","),
        F.to_json(F.col("records")),
        F.lit("]"),
    )
    write_documents(pages.select("YEAR", "page", doc.alias("value")), path, ["YEAR", "page"])


def _listed(spark: SparkSession, path: str, fmt: str, **options) -> DataFrame:
    """The files below ``path`` with their folder columns.

    Spark lists a folder's subfolders with a task for each of up to 10,000; a page's folder holds one file, so
    starting the tasks takes most of the time. Here there are a few tasks a core, and each lists many folders.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = min(int(spark.conf.get(key)), max(LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism))
    with session_conf(spark, key, str(tasks)):
        return spark.read.format(fmt).options(basePath=path, **options).load(path)


def _page_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed page file (a response may be pretty-printed over many lines;
    a file is one page, so reading it whole is bounded by the page size)."""
    return _listed(spark, path, "text", wholetext=True)


def jsonpath(selector: str) -> str:
    """A spec selector (``[1]``, ``[0].pages``, ``data.items``) as a JSONPath."""
    if selector.startswith("$"):
        return selector
    return "$" + (selector if selector.startswith("[") else "." + selector)


def _records_json(selector: str) -> tuple[str, str]:
    """SQL of (a page's record array as JSON text, whether the page holds one).

    A page that is no whole JSON document (cut off in transfer) or has nothing at the
    selector (an error envelope) holds none; an explicit ``null`` is an empty page.
    """
    path = jsonpath(selector).replace("\\", "\\\\").replace("'", "\\'")
    picked = f"try_variant_get(try_parse_json(value), '{path}', 'variant')"
    return f"if(is_variant_null({picked}), '[]', get_json_object(value, '{path}'))", f"{picked} IS NOT NULL"


def decode_pages(
    spark: SparkSession,
    path: str,
    record_schema: str,
    data_selector: str = "[1]",
    total_path: str | None = "[0].pages",
) -> DataFrame:
    """One row per record of every landed page under ``path``, plus the partition and
    page columns from the folder names and the declared total (NULL when the response
    has none); see ``page_records``."""
    found = page_records(spark, path, record_schema, data_selector, total_path)
    return found.select("run.*", "record.*")


def page_records(
    spark: SparkSession,
    path: str,
    record_schema: str,
    data_selector: str = "[1]",
    total_path: str | None = "[0].pages",
) -> DataFrame:
    """(run, record) of every record of every landed page: ``run`` holds the folder columns and the declared total as
    ``pages``, ``record`` the record's own fields, whatever their names.

    Each page file is decoded by its own task. A page that is cut off, has no
    records at the selector, or holds a record that does not fit the schema fails the job."""
    raw = _page_files(spark, path)
    keys = [c for c in raw.columns if c != "value"]
    total = F.get_json_object("value", jsonpath(total_path)).cast("int") if total_path else F.lit(None).cast("int")
    text, whole = _records_json(data_selector)
    fault = F.concat(F.lit(f"no records at {data_selector} of the page: "), F.substring("value", 1, 200))
    checked = F.when(F.expr(whole), F.expr(text)).otherwise(F.raise_error(fault))
    decoded = raw.select(
        *keys,
        total.alias("pages"),
        F.from_json(checked, f"array<{record_schema}>", {"mode": "FAILFAST"}).alias("records"),
    )
    return decoded.select(F.struct(*keys, "pages").alias("run"), F.explode("records").alias("record"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Decode every landed page into one row per record, with the page's meta."""
    return decode_pages(spark, path, RECORD_SCHEMA.removeprefix("array<").removesuffix(">")).select(
        "YEAR", "page", "pages", "id", "date", "value"
    )


def completeness(
    spark: SparkSession,
    path: str,
    base_page: int = 1,
    data_selector: str = "[1]",
    total_path: str | None = "[0].pages",
    page_column: str = "page",
) -> DataFrame:
    """Per partition (the other folder columns; one row if there are none): expected pages
    vs distinct pages landed, in one aggregation over page meta (records are counted,
    never gathered). A page without a whole record array has not landed.

    With a declared total (``total_path``) the expected pages are base..total. Without
    one, paging stops at the first empty page: the expected pages are base..the last
    landed page, and the partition is complete only if that last page is empty.
    """
    raw = _page_files(spark, path)
    keys = [c for c in raw.columns if c not in ("value", page_column)]
    text, whole = _records_json(data_selector)
    total = F.get_json_object("value", jsonpath(total_path)).cast("int") if total_path else F.lit(None).cast("int")
    meta = raw.select(
        *keys,
        F.col(page_column).alias("page"),
        total.alias("pages"),
        F.expr(f"CASE WHEN {whole} THEN json_array_length({text}) END").alias("n_records"),
    )
    in_range = F.expr(f"n_records IS NOT NULL AND page >= {int(base_page)} AND (pages IS NULL OR page <= pages)")
    per = meta.groupBy(*keys).agg(
        F.max("pages").alias("declared"),
        F.max("page").alias("last_page"),
        F.max_by("n_records", "page").alias("last_records"),
        F.count_distinct(F.when(in_range, F.col("page"))).alias("landed_pages"),
    )
    expected = f"coalesce(declared, last_page) - {int(base_page)} + 1"
    return per.selectExpr(
        *keys,
        "coalesce(declared, last_page) AS declared_pages",
        "landed_pages",
        f"cast({expected} - landed_pages as bigint) AS missing_pages",
        f"coalesce(({expected} - landed_pages) = 0 AND (declared IS NOT NULL OR last_records = 0), false) AS complete",
    )


def landing_manifest(spark: SparkSession, path: str, page_column: str = "page") -> DataFrame:
    """Files and pages landed per partition (the folder columns but the page's; one row
    if there are none); file bodies are never read."""
    files = _listed(spark, path, "binaryFile")
    keys = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content", page_column)]
    return files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct(page_column).alias("pages"),
    )
