"""Marts that follow newly landed readings without a rebuild.

Each micro-batch of new files becomes one set of partials per station and year (sums, counts, the minimum), stored in
``curated.station_year_partials`` under the batch's number: a batch that is run again after a lost driver replaces its
own partials and counts once. The years of these partitions, read from the catalog, are the touched ones:
for them alone ``curated.station_year`` is merged from all stored partials and joined to
the station list, and every mart below it is computed from the touched years of its parent. Nothing
rereads older readings, and partitions of other years keep their files.

Averages stay two-stage: the partials hold sums and counts of readings, the marts average station-years.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.paths import partition_values
from lakeweave.plans import cleansed, curated, reporting
from lakeweave.sinks.tables import Lakehouse

YEAR = "observation_year"
PARTIALS = ("curated", "station_year_partials")
Step = tuple[tuple[str, str], tuple[str, str], Callable[[DataFrame], DataFrame]]

#: (table, its parent, how its rows follow from the parent's of the same years), parents first
MARTS: tuple[Step, ...] = (
    (("reporting", "country_year"), ("curated", "station_year"), reporting.country_year),
    (("reporting", "global_year"), ("curated", "station_year"), reporting.global_year),
    (("reporting", "snow_cold"), ("curated", "station_year"), reporting.snow_cold),
)


def touched_years(lh: Lakehouse, load: int) -> list[int]:
    """Years that a load's partials hold, from the catalog's partitions."""
    specs = [partition_values(r["spec"]) for r in lh.partitions(*PARTIALS).select("spec").collect()]
    return sorted(int(s[YEAR]) for s in specs if int(s["load"]) == load)


def merge_years(lh: Lakehouse, years: Sequence[int], stations: DataFrame, marts: Sequence[Step] = MARTS) -> None:
    """Bring ``curated.station_year`` and the marts below it up to date for ``years``; others stay as they are."""
    if not years:
        return
    partials = lh.table(*PARTIALS).where(F.col(YEAR).isin(*years))
    lh.insert_overwrite("curated", "station_year", curated.merge_station_year(partials, stations), [YEAR], ["station_id"])
    for table, parent, rows in marts:
        lh.insert_overwrite(*table, rows(lh.table(*parent).where(F.col(YEAR).isin(*years))), [YEAR])


def incremental_marts(
    spark: SparkSession,
    lh: Lakehouse,
    raw_path: str,
    schema: T.StructType | str,
    stations: DataFrame,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    marts: Sequence[Step] = MARTS,
) -> None:
    """Take in everything landed under ``raw_path`` since the last run, then stop.

    A run that finds nothing new starts no batch. Readings are only ever added here, so a mart that has rows for a year
    keeps having some; after a correction of landed files, rebuild.
    """

    def refresh(batch: DataFrame, load: int) -> None:
        target = Lakehouse(batch.sparkSession, lh.root, lh.namespace)
        partials = curated.station_year_partials(cleansed.observations(batch)).withColumn("load", F.lit(load).cast("bigint"))
        target.insert_overwrite(*PARTIALS, partials, [YEAR, "load"])
        merge_years(target, touched_years(target, load), stations, marts)

    reader = spark.readStream.schema(schema).option("basePath", raw_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    q = (
        reader.parquet(raw_path)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    for table in (("curated", "station_year"), *(m[0] for m in marts)):  # written through the stream's own session
        if lh.exists(*table):
            spark.catalog.refreshTable(f"{lh.database(table[0])}.{table[1]}")
