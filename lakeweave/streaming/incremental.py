"""Pick up newly landed raw files exactly once, then rebuild the partitions they touch.

A file-source stream (explicit schema, checkpointed offsets) sees only files it has
not processed; ``trigger(availableNow=True)`` turns a run into "process everything
new, then stop". The stream itself carries the partition column alone, which comes from
folder names. For each micro-batch the touched partitions' folders are re-read *whole* (a
partition can receive files in several landings), nothing else is listed, and they are
written with a dynamic partition overwrite. Re-running with nothing new is a no-op. The
checkpoint lives in the shared folder, so a restarted driver resumes where the last run stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeweave.functions.paths import hive_path
from lakeweave.sinks.tables import Lakehouse


def incremental_partition_refresh(
    spark: SparkSession,
    lh: Lakehouse,
    raw_path: str,
    schema: T.StructType,
    partition_col: str,
    transform: Callable[[DataFrame], DataFrame],
    layer: str,
    table: str,
    checkpoint: str,
    order_by: Sequence[str] = (),
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Run once over everything landed since the last run, then stop.

    ``raw_path`` holds ``partition_col=value`` folders. ``max_files_per_trigger`` bounds each
    micro-batch (a large backlog is processed in several batches, each rebuilding only the
    partitions its files touch).
    """

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        # folder names to list: at most one per file of the batch
        touched = [hive_path(raw_path, keys={partition_col: r[0]}) for r in batch.distinct().toLocalIterator()]
        if not touched:
            return
        whole = session.read.schema(schema).option("basePath", raw_path).parquet(*touched)
        target = Lakehouse(session, lh.root, lh.namespace)
        target.insert_overwrite(layer, table, transform(whole), [partition_col], order_by)

    reader = spark.readStream.schema(schema).option("basePath", raw_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    q = (
        reader.parquet(raw_path)
        .select(partition_col)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    # the batch wrote through a cloned session: refresh this session's file listing
    if lh.exists(layer, table):
        spark.catalog.refreshTable(f"{lh.database(layer)}.{table}")
    return lh.table(layer, table) if lh.exists(layer, table) else spark.createDataFrame([], schema)
