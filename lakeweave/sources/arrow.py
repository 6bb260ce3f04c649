"""Arrow IPC files as a Spark data source (Python DataSource API).

Reading: files are listed once, narrowed by the path filter, and planned by size into partitions of about
``TASK_BYTES``: small files are read together, a large one is cut into shares of its
record batches (a stream-format file can't be cut). ``k=v`` folders below the base path become columns.
Every file must have the same columns.

Writing: a task writes files of its own into a hidden folder of the job and names them in its
commit message; Spark commits the attempts that won, and only then are their files moved into place (and, when
overwriting, those of earlier writes deleted). A failed job deletes the hidden folder.
"""

from __future__ import annotations

import fnmatch
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from lakeweave.functions.paths import hive_path, partition_values

FORMAT = "lakeweave_arrow"
TASK_BYTES = 128 << 20


def register(spark: SparkSession) -> str:
    """Make the format known to the session; returns its name."""
    spark.dataSource.register(ArrowFiles)
    return FORMAT


def arrow_filesystem(uri: str):
    """pyarrow filesystem + path for a Hadoop-style URI (``s3a://``/``s3n://`` are
    pyarrow's ``s3://``; local paths and ``file:`` URIs pass through)."""
    import pyarrow.fs as pafs

    for hadoop_scheme in ("s3a://", "s3n://"):
        if uri.startswith(hadoop_scheme):
            uri = "s3://" + uri[len(hadoop_scheme):]
    return pafs.FileSystem.from_uri(uri)


@dataclass
class Share(InputPartition):
    """Parts of files: (path, size, this share, shares) with the shares of a file's record batches counted from 0."""

    files: list[tuple[str, int, int, int]]

    @property
    def value(self):
        return self.files


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: hidden path and final path."""

    files: list[tuple[str, str]]


@contextmanager
def _opened(uri: str, path: str):
    """(schema, number of record batches or None, batches by range) of an IPC file or stream."""
    import pyarrow as pa

    fs, _ = arrow_filesystem(uri)
    with fs.open_input_file(path) as f:
        try:
            reader = pa.ipc.open_file(f)
        except pa.ArrowInvalid:
            f.seek(0)
            try:
                stream = pa.ipc.open_stream(f)
            except (pa.ArrowInvalid, OSError) as e:
                raise ValueError(f"{path} is not an Arrow file or stream") from e
            with stream:
                yield stream.schema, None, lambda a, b: iter(stream)
            return
        with reader:
            yield reader.schema, reader.num_record_batches, lambda a, b: (reader.get_batch(i) for i in range(a, b))


class ArrowFiles(DataSource):
    """Options: ``path``, ``basePath``, ``pathGlobFilter``, ``recursiveFileLookup``; for writing ``partitionBy``, comma-joined."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _files(self) -> list[tuple[str, int]]:
        from pyarrow.fs import FileSelector, FileType

        pattern = self.options.get("pathGlobFilter")
        fs, top = arrow_filesystem(self.options["path"])
        info = fs.get_file_info(top)
        below = fs.get_file_info(FileSelector(top, recursive=True)) if info.type == FileType.Directory else [info]
        found = [
            (i.path, i.size)
            for i in below
            if i.type == FileType.File
            and not any(p[0] in "._" for p in i.path[len(top) :].split("/") if p)
            and (pattern is None or fnmatch.fnmatchcase(i.base_name, pattern))
        ]
        return sorted(found)

    def _folder_values(self, path: str) -> dict[str, str | None]:
        if str(self.options.get("recursiveFileLookup", "")).lower() == "true":
            return {}
        _, base = arrow_filesystem(self.options.get("basePath", self.options["path"]))
        spec = "/".join(p for p in path[len(base) :].split("/")[:-1] if "=" in p)
        return partition_values(spec) if spec else {}

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        files = self._files()
        if not files:
            raise ValueError(f"no Arrow files found in {self.options['path']}")
        with _opened(self.options["path"], files[0][0]) as (schema, _, _):
            out = from_arrow_schema(schema)
        values: dict[str, list] = {}
        for path, _ in files:
            for k, v in self._folder_values(path).items():
                values.setdefault(k, []).append(v)
        for k, own in values.items():
            out = out.add(k, _kind_of(own))
        return out

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArrowReader(self, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowWriter(self.options["path"], schema, overwrite, [c for c in self.options.get("partitionBy", "").split(",") if c])


def _kind_of(values: list[str | None]) -> T.DataType:
    """int, long or string: the narrowest type that holds all folder values."""
    try:
        numbers = [int(v) for v in values if v is not None]
    except ValueError:
        return T.StringType()
    if any(str(n) != v for n, v in zip(numbers, (v for v in values if v is not None))) or not numbers:
        return T.StringType()
    return T.IntegerType() if all(-(2**31) <= n < 2**31 for n in numbers) else T.LongType()


class ArrowReader(DataSourceReader):
    def __init__(self, source: ArrowFiles, schema: T.StructType):
        self.source, self.schema = source, schema

    def partitions(self) -> list[Share]:
        shares: list[Share] = []
        held: list[tuple[str, int, int, int]] = []
        size = 0
        for path, length in self.source._files():
            parts = max(1, ceil(length / TASK_BYTES))
            if parts > 1:
                shares += [Share([(path, length, i, parts)]) for i in range(parts)]
                continue
            if held and size + length > TASK_BYTES:
                shares.append(Share(held))
                held, size = [], 0
            held.append((path, length, 0, 1))
            size += length
        return shares + [Share(held)]

    def read(self, partition: Share) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        for path, _, part, parts in partition.files:
            folder = self.source._folder_values(path)
            inside = [f.name for f in self.schema.fields if f.name not in folder]
            kinds = {f.name: f.dataType for f in self.schema.fields}
            with _opened(self.source.options["path"], path) as (schema, n, batches):
                if sorted(schema.names) != sorted(inside):
                    raise ValueError(f"{path} has columns {schema.names}, not {inside}")
                if n is None and part:
                    continue
                for batch in batches((n or 0) * part // parts, (n or 0) * (part + 1) // parts):
                    columns = []
                    for name in self.schema.names:
                        if name in folder:
                            value = folder[name] if isinstance(kinds[name], T.StringType) or folder[name] is None else int(folder[name])
                            columns.append(pa.array([value] * batch.num_rows, to_arrow_type(kinds[name])))
                        else:
                            columns.append(batch.column(name))
                    yield pa.RecordBatch.from_arrays(columns, self.schema.names)


class ArrowWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, partition_by: list[str]):
        self.path, self.schema, self.overwrite, self.partition_by = path.rstrip("/"), schema, overwrite, partition_by
        self.run = uuid.uuid4().hex[:12]

    def _arrow_schema(self):
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(T.StructType([f for f in self.schema.fields if f.name not in self.partition_by]))

    def _pieces(self, batch):
        """Slices of a batch with one folder each; rows of a folder follow each other."""
        import pyarrow as pa

        if not self.partition_by:
            yield "", batch
            return
        keys = list(zip(*(batch.column(k).to_pylist() for k in self.partition_by)))
        names = [n for n in batch.schema.names if n not in self.partition_by]
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                folder = hive_path("", keys=dict(zip(self.partition_by, keys[start])))
                yield folder, pa.RecordBatch.from_arrays([batch.column(n).slice(start, i - start) for n in names], names)
                start = i

    def write(self, iterator: Iterator) -> Written:
        import pyarrow as pa

        fs, base = arrow_filesystem(self.path)
        files: list[tuple[str, str]] = []
        hidden = f"{base}/_job-{self.run}"
        fs.create_dir(hidden, recursive=True)
        folder = out = writer = None

        def close() -> None:
            if writer is not None:
                writer.close()
                out.close()

        try:
            for batch in iterator:
                for where, rows in self._pieces(batch):
                    if writer is None or where != folder:
                        close()
                        name = f"part-{uuid.uuid4().hex}.arrow"
                        files.append((f"{hidden}/{name}", f"{base}{where}/{name}"))
                        folder, out = where, fs.open_output_stream(files[-1][0])
                        writer = pa.ipc.new_file(out, rows.schema)
                    writer.write_batch(rows)
        finally:
            close()
        return Written(files)

    def commit(self, messages: list) -> None:
        import pyarrow as pa
        from pyarrow.fs import FileSelector, FileType

        fs, base = arrow_filesystem(self.path)
        fs.create_dir(base, recursive=True)
        old = []
        if self.overwrite:
            old = [i.path for i in fs.get_file_info(FileSelector(base, recursive=True)) if i.type == FileType.File]
            old = [p for p in old if p.endswith(".arrow") and "/_job-" not in p[len(base) :]]
        moved = [f for m in messages if m is not None for f in m.files]
        for hidden, final in moved:
            fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
            fs.move(hidden, final)
        for path in old:
            fs.delete_file(path)
        if not moved:  # no rows: a file without any keeps the schema
            with fs.open_output_stream(f"{base}/part-{uuid.uuid4().hex}.arrow") as out:
                pa.ipc.new_file(out, self._arrow_schema()).close()
        self._drop_hidden()

    def abort(self, messages: list) -> None:
        self._drop_hidden()

    def _drop_hidden(self) -> None:
        from pyarrow.fs import FileType

        fs, base = arrow_filesystem(self.path)
        hidden = f"{base}/_job-{self.run}"
        if fs.get_file_info(hidden).type != FileType.NotFound:
            fs.delete_dir(hidden)
