"""File readers for every declared format.

Each format maps to a Spark reader; the declared columns are then applied as one
``select`` (cast by position or name, SQL expression, or byte slice), so Catalyst
prunes and pushes filters into the scan. Text formats always get an explicit schema;
only Parquet, ORC and Arrow carry their own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.paths import hive_path
from lakeweave.functions.text import byte_substring, fixed_width_sql
from lakeweave.sources import arrow
from lakeweave.specs import ColumnSpec, FileFormat, SourceSpec

# Settings understood in a spec. Anything else is rejected rather than ignored.
_KNOWN_SETTINGS = {"format_regexp", "format_regexp_skip_unmatched", "skip_malformed", "use_hive_partitioning", "path_glob"}
_CORRUPT = "_malformed"  # text of a record that doesn't parse, null for good ones

# Fixed value: NULL marker of the CSV and tab-separated formats (an empty field is '').
NULL_MARKER = "\\N"

_NAMED_FORMATS = {
    FileFormat.PARQUET,
    FileFormat.CSV_WITH_NAMES,
    FileFormat.JSON_EACH_ROW,
    FileFormat.ORC,
    FileFormat.ARROW,
    FileFormat.AVRO,
}


def _check_settings(spec: SourceSpec) -> None:
    unknown = sorted(set(spec.settings) - _KNOWN_SETTINGS)
    if unknown:
        raise ValueError(f"Table '{spec.name}': unsupported settings {unknown}")


def _positional_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i + 1}", T.StringType()) for i in range(n)])


def _reader(spark: SparkSession, spec: SourceSpec, root: str):
    r = spark.read
    if spec.settings.get("use_hive_partitioning", "0") == "1":
        # basePath keeps the k=v directories as columns even for a leaf path.
        r = r.option("basePath", root)
    elif not spec.partitions:
        # without partition columns to find, files of plain nested folders are read too
        r = r.option("recursiveFileLookup", True)
    if "path_glob" in spec.settings:
        r = r.option("pathGlobFilter", spec.settings["path_glob"])
    return r


def _raw_frame(spark: SparkSession, spec: SourceSpec, root: str, path: str) -> DataFrame:
    fmt = spec.file_format
    r = _reader(spark, spec, root)
    ncols = len(spec.columns or ())
    if fmt == FileFormat.PARQUET:
        return r.parquet(path)
    if fmt == FileFormat.ORC:
        return r.orc(path)
    if fmt == FileFormat.AVRO:
        try:
            return r.format("avro").load(path)
        except AnalysisException as e:  # the spark-avro package is not on every classpath
            if "data source" not in str(e).lower():
                raise
            raise RuntimeError(
                f"Table '{spec.name}': Avro needs the spark-avro data source on the classpath"
            ) from e
    if fmt == FileFormat.ARROW:
        r = r.format(arrow.register(spark))
        schema = None if spec.partitions else _declared_schema(spec)  # folder columns are found, not declared
        return (r.schema(schema) if schema else r).load(path)
    if fmt in (FileFormat.CSV, FileFormat.TSV):
        sep = "\t" if fmt == FileFormat.TSV else ","
        schema, options = _tolerant(spec, _positional_schema(ncols))
        return r.schema(schema).csv(path, sep=sep, header=False, nullValue=NULL_MARKER, **options)
    if fmt == FileFormat.CSV_WITH_NAMES:
        # names come from the header (all strings) and every file's header is checked
        # against them; declared columns and expressions then select by name
        return r.csv(path, header=True, mode="FAILFAST", enforceSchema=False, nullValue=NULL_MARKER)
    if fmt == FileFormat.JSON_EACH_ROW:
        schema, options = _tolerant(spec, _declared_schema(spec))
        return (r.schema(schema) if schema else r).json(path, **options)
    if fmt == FileFormat.LINE_AS_STRING:
        return r.text(path).withColumnRenamed("value", "line")
    if fmt == FileFormat.REGEXP:
        return _regexp_frame(r.text(path), spec)
    raise ValueError(f"unsupported format {fmt}")


def skips_malformed(spec: SourceSpec) -> bool:
    """Whether records that don't parse are left out (and counted) instead of failing the load."""
    key = "format_regexp_skip_unmatched" if spec.file_format == FileFormat.REGEXP else "skip_malformed"
    asked = spec.settings.get(key, "0") == "1"
    if asked and spec.file_format not in (FileFormat.REGEXP, FileFormat.CSV, FileFormat.TSV, FileFormat.JSON_EACH_ROW):
        raise ValueError(f"Table '{spec.name}': {key} has no meaning for {spec.file_format.value}")
    return asked


def _tolerant(spec: SourceSpec, schema: T.StructType | None) -> tuple[T.StructType | None, dict[str, str]]:
    """Schema and options of a reader that fails on a malformed record or, if the spec skips them, keeps its text."""
    if not skips_malformed(spec):
        return schema, {"mode": "FAILFAST"}
    if schema is None:
        raise ValueError(f"Table '{spec.name}': skip_malformed needs declared columns without expressions")
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _declared_schema(spec: SourceSpec) -> T.StructType | None:
    if not spec.columns or any(c.expression or c.slice for c in spec.columns):
        return None
    return T.StructType([T.StructField(c.name, _parse_type(c.type)) for c in spec.columns])


def _parse_type(type_name: str) -> T.DataType:
    return T._parse_datatype_string(type_name)


def _regexp_frame(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """Capture groups -> c1..cN. A non-matching line fails the job, or is skipped
    when ``format_regexp_skip_unmatched`` is 1."""
    pattern = spec.settings.get("format_regexp")
    if not pattern:
        raise ValueError(f"Table '{spec.name}': Regexp format needs settings.format_regexp")
    n = len(spec.columns or ())
    if n == 0:
        raise ValueError(f"Table '{spec.name}': Regexp format needs declared columns")
    matched = F.col("value").rlike(pattern)
    skipped = []
    if skips_malformed(spec):
        guard = F.col("value")
        skipped = [F.when(~matched, guard).alias(_CORRUPT)]
    else:
        guard = F.when(
            matched, F.col("value")
        ).otherwise(F.raise_error(F.concat(F.lit(f"Table '{spec.name}': line does not match regexp: "), F.col("value"))))
    # columns other than the line itself come from k=v folders and are kept
    path_cols = [c for c in lines.columns if c != "value"]
    groups = [F.regexp_extract(guard, pattern, i + 1).alias(f"c{i + 1}") for i in range(n)]
    return lines.select(*groups, *path_cols, *skipped)


def _column(spec: SourceSpec, c: ColumnSpec, index: int) -> Column:
    if c.expression:
        return F.expr(c.expression).alias(c.name)
    if c.slice:
        return byte_substring("line", *c.slice).cast(c.type).alias(c.name)
    src = c.name if spec.file_format in _NAMED_FORMATS else f"c{index}"
    return F.col(f"`{src}`").cast(c.type).alias(c.name)


def read_source(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    partition_params: dict[str, str] | None = None,
    ingested_at: datetime | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Read the files of ``spec`` under ``root`` (optionally one partition's leaf).

    Where the spec skips malformed records, ``seen`` gets the counts ``records`` and ``rejected`` from the job that
    reads the rows, without a pass of its own.

    With declared columns the result is exactly those columns plus ``ingested_at``
    (one value per run, given by the caller) and any partition columns found in the
    path; without, it is the reader's own columns (``SELECT *``).
    """
    _check_settings(spec)
    root = root.rstrip("/")
    raw = _raw_frame(spark, spec, root, hive_path(root, spec.folder, keys=partition_params))
    if skips_malformed(spec):
        if seen is not None:
            raw = raw.observe(seen, F.count(F.lit(1)).alias("records"), F.count(_CORRUPT).alias("rejected"))
        raw = raw.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    if not spec.columns:
        return raw
    cols = [_column(spec, c, i + 1) for i, c in enumerate(spec.columns)]
    declared = {c.name for c in spec.columns}
    keep = [F.col(p) for p in spec.partition_columns if p in raw.columns and p not in declared]
    if ingested_at is None:
        raise ValueError("declared columns need the run's ingested_at timestamp")
    audit = ntz_literal(ingested_at).alias("ingested_at")
    return raw.select(*cols, *keep, audit)


def rejected_records(spark: SparkSession, spec: SourceSpec, root: str, partition_params: dict[str, str] | None = None) -> DataFrame:
    """(file, record) of every malformed record that a load of ``spec`` leaves out."""
    return _with_files(spark, spec, root, partition_params).where("record IS NOT NULL")


def file_counts(spark: SparkSession, spec: SourceSpec, root: str, partition_params: dict[str, str] | None = None) -> DataFrame:
    """(file, records, rejected) of every landed file with records."""
    rows = _with_files(spark, spec, root, partition_params)
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("records"), F.count("record").alias("rejected"))


def _with_files(spark: SparkSession, spec: SourceSpec, root: str, partition_params: dict[str, str] | None) -> DataFrame:
    _check_settings(spec)
    if not skips_malformed(spec):
        raise ValueError(f"Table '{spec.name}' fails on malformed records, it doesn't skip them")
    root = root.rstrip("/")
    raw = _raw_frame(spark, spec, root, hive_path(root, spec.folder, keys=partition_params))
    # the parser tells a malformed record only if the declared columns are read too: they add nothing to the text
    nothing = F.substring(F.hash(*[F.col(f"`{c}`") for c in raw.columns if c != _CORRUPT]).cast("string"), 1, 0)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.concat(F.col(_CORRUPT), nothing).alias("record"))


def ntz_literal(ts: datetime) -> Column:
    """A TIMESTAMP_NTZ literal from its wall-clock text: independent of both the Python
    process's and the session's time zone (aware datetimes are taken in UTC)."""
    if ts.tzinfo is not None:
        from datetime import timezone

        ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def read_layout_lines(lines: DataFrame, layout: dict[str, tuple[int, int]], line_col: str = "line") -> DataFrame:
    """Fixed-width parse of an existing ``line`` column (untrimmed strings)."""
    return lines.selectExpr(*fixed_width_sql(line_col, layout))
