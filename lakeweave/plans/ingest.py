"""Ingestion of one source table into ``raw``: read the landed files through the spec,
then load them (full refresh, or replacement of the run's partition tuple)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeweave.functions.paths import hive_path
from lakeweave.operators.partitions import expected_keys, loaded_keys, missing_keys, run_keys
from lakeweave.sinks.folders import Folders
from lakeweave.sinks.tables import Lakehouse
from lakeweave.sources.files import read_source, rejected_records, skips_malformed
from lakeweave.plans.api_pages import page_records
from lakeweave.specs import ApiTableSpec, Source, SourceSpec


def ingest_table(
    lh: Lakehouse,
    source: Source,
    table: str,
    landing_root: str,
    ingested_at: datetime,
    partition_key: str | dict[str, str] | None = None,
) -> DataFrame:
    """Files for a run sit under ``landing_root/<source>/<table>[/K=v...]``.

    Partitioned tables replace exactly the run's partition tuple (re-running a key is
    idempotent); others are fully refreshed. ``ingested_at`` is the run's launch time,
    one value for every row of the run. Where the table skips malformed records, ``lh.counted`` has
    the run's ``records`` and ``rejected`` from the load's own pass, and the rejected ones go to
    ``raw.<source>_<table>_rejects`` with their files.
    """
    spec = source.table(table)
    if not isinstance(spec, SourceSpec):
        raise TypeError(f"{table} is not a file table")
    params = run_keys(spec, partition_key)
    base = hive_path(landing_root, source.name, spec.name)
    # read the run's leaf folder, keeping the partition columns from the path
    leaf = SourceSpec(
        spec.name, spec.file_format, "", spec.columns,
        {**spec.settings, "use_hive_partitioning": "1"} if params else spec.settings,
        spec.partitions, spec.full_refresh, spec.description,
    )
    seen = Observation() if skips_malformed(spec) else None
    df = read_source(lh.spark, leaf, base, params or None, ingested_at if spec.columns else None, seen)
    name = source.raw_table(spec.name)
    out = lh.replace_partition("raw", name, df, params) if params else lh.full_refresh("raw", name, df)
    if seen is not None:
        lh.counted[f"raw.{name}"] = dict(seen.get)
        _keep_rejects(lh, leaf, base, params, name, seen.get["rejected"])
    return out


def _keep_rejects(lh: Lakehouse, spec: SourceSpec, base: str, params: dict[str, str], name: str, rejected: int) -> None:
    """Replace the run's rows of ``raw.<name>_rejects`` (file, record): a second pass over the files, only if there are any."""
    table = f"{name}_rejects"
    if not rejected and not lh.exists("raw", table):
        return
    rows = rejected_records(lh.spark, spec, base, params or None) if rejected else lh.spark.createDataFrame([], "file string, record string")
    if params:
        rows = rows.select("*", *[F.lit(v).cast("string").alias(k) for k, v in params.items()])
        lh.replace_partition("raw", table, rows, params)
    else:
        lh.full_refresh("raw", table, rows)


@dataclass(frozen=True)
class Backfilled:
    """One partition tuple of a backfill: ``loaded``, ``not landed`` or ``failed``, with the reason."""

    key: dict[str, str]
    state: str
    reason: str = ""


def backfill(lh: Lakehouse, source: Source, table: str, landing_root: str, ingested_at: datetime, as_of: datetime) -> list[Backfilled]:
    """Ingest every partition tuple up to ``as_of`` that has no partition in the raw table yet, oldest first.

    What is present is read from the catalog's partitions, not from the data, so a finished tuple costs no job
    and a run that was broken off goes on where it stopped. A tuple whose files have not
    landed, or whose load fails, doesn't stop the others and is tried again by the next run. An empty landing folder
    loads an empty partition, which is present from then on.
    """
    spec = source.table(table)
    columns = spec.partition_columns
    if not columns:
        raise ValueError(f"table {table!r} has no partitions to backfill")
    present = loaded_keys(lh.partitions("raw", source.raw_table(spec.name)), columns)
    missing = missing_keys(expected_keys(lh.spark, spec.partitions, as_of), present, columns).orderBy(*columns)
    out, folders = [], Folders(lh.spark)
    for key in (r.asDict() for r in missing.collect()):  # one row per missing partition
        leaf = hive_path(landing_root, source.name, spec.name, keys=key)
        if not folders.exists(leaf):
            out.append(Backfilled(key, "not landed"))
            continue
        try:
            ingest_table(lh, source, table, landing_root, ingested_at, key)
        except Exception as e:  # the reason is the caller's; the other tuples go on
            out.append(Backfilled(key, "failed", str(e).split("\n", 1)[0]))
        else:
            out.append(Backfilled(key, "loaded"))
    return out


def ingest_api_table(
    lh: Lakehouse,
    source: Source,
    table: str,
    landing_root: str,
    record_schema: str,
    partition_key: str | dict[str, str] | None = None,
) -> DataFrame:
    """Load the landed pages of one API table run into ``raw.<source>_<table>``.

    Pages sit under ``landing_root/<source>/<table>[/K=v...]/page=<n>``; records are
    selected with the table's ``data_selector``. The write disposition follows the
    table: ``replace`` (full refresh) or ``append``, which stores a re-run twice.
    """
    spec = source.table(table)
    if not isinstance(spec, ApiTableSpec):
        raise TypeError(f"{table} is not an API table")
    params = run_keys(spec, partition_key)
    run_path = hive_path(landing_root, source.name, spec.name, keys=params)
    paging = spec.paging
    pages = page_records(
        lh.spark, run_path, record_schema,
        paging.data_selector if paging and paging.data_selector else "[1]",
        paging.total_path if paging else None,
    )
    records = pages.select("record.*")
    for k, v in params.items():
        records = records.withColumn(k, F.lit(v))
    return lh.load("raw", source.raw_table(spec.name), records, spec.write_disposition, list(params))
