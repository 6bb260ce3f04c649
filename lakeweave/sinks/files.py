"""Land a DataFrame as files in one of the declared formats (used to stage sources)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lakeweave.functions.paths import hive_path
from lakeweave.sinks.folders import Folders
from lakeweave.sources import arrow
from lakeweave.sources.files import NULL_MARKER
from lakeweave.specs import FileFormat


def write_files(df: DataFrame, fmt: FileFormat, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` under ``path``; text formats get one string column ``line``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == FileFormat.PARQUET:
        w.parquet(path)
    elif fmt == FileFormat.ORC:
        w.orc(path)
    elif fmt == FileFormat.CSV:
        w.csv(path, header=False, nullValue=NULL_MARKER)
    elif fmt == FileFormat.CSV_WITH_NAMES:
        w.csv(path, header=True, nullValue=NULL_MARKER)
    elif fmt == FileFormat.TSV:
        w.csv(path, header=False, sep="\t", nullValue=NULL_MARKER)
    elif fmt == FileFormat.JSON_EACH_ROW:
        w.json(path)
    elif fmt in (FileFormat.LINE_AS_STRING, FileFormat.REGEXP):
        w.text(path)
    elif fmt == FileFormat.ARROW:
        if partition_by:
            df = df.sortWithinPartitions(*partition_by)  # a task then has one file a folder
        df.write.format(arrow.register(df.sparkSession)).mode("overwrite").option("partitionBy", ",".join(partition_by)).save(path)
    else:
        raise ValueError(f"cannot write {fmt}")
    return path


def write_documents(docs: DataFrame, path: str, keys: Sequence[str], value: str = "value") -> str:
    """Replace ``path`` by one text file per row: ``value`` and a line end, in the folder ``K1=v1/K2=v2`` of the row's ``keys``.

    No two rows may have the same keys. On a mounted file system the tasks write the files themselves: Spark's writer
    starts two ``chmod`` processes a file there (the file and its checksum), and the driver then moves
    the folders one by one. A file is written under a hidden name and renamed, and its name depends on its
    keys alone, so a task that runs again replaces its files. Elsewhere Spark's writer is used, whose tasks move their
    own files. Either way ``_SUCCESS`` comes last, and a job that fails may leave files without it.
    """
    folders = Folders(docs.sparkSession)
    top = folders.mounted(path)
    if top is None:
        w = docs.select(*keys, value).write.mode("overwrite").partitionBy(*keys)
        w.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
        return path
    folders.delete(path)
    rows = docs.select(F.col(value), *[F.col(k).cast("string") for k in keys])
    rows.foreachPartition(lambda part: write_rows(part, top, keys))
    folders.write_text(f"{path}/_SUCCESS", "")
    return path


def write_rows(rows: Iterable[Row], top: str, keys: Sequence[str]) -> None:
    """Files of one task of ``write_documents``: rows of (value, key folders' values) below the local folder ``top``."""
    for value, *own in rows:
        folder = hive_path(top, keys=dict(zip(keys, own)))
        os.makedirs(folder, exist_ok=True)
        hidden = f"{folder}/.{uuid.uuid4().hex}"
        with open(hidden, "w", encoding="utf-8", newline="") as out:
            out.write(("" if value is None else value) + "\n")
        os.replace(hidden, f"{folder}/part-0.txt")
