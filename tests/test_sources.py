from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeweave.functions.paths import hive_path
from lakeweave.sinks.files import write_files
from lakeweave.sources.files import read_layout_lines, read_source
from lakeweave.specs import ColumnSpec, FileFormat, SourceSpec, StaticPartition, TimePartition

RUN = datetime(2024, 1, 1)


def test_spec_validation():
    with pytest.raises(ValueError, match="lowercase.*no partition columns"):
        SourceSpec("Bad-Name", FileFormat.CSV)
    twice = StaticPartition("k", ("a",))
    with pytest.raises(ValueError, match=r"\['k'\] are given twice"):
        SourceSpec("t", FileFormat.CSV, partitions=(twice, twice))
    SourceSpec("t", FileFormat.CSV, partitions=(twice,))


def test_hive_path():
    assert hive_path("s3a://b/landing/", "shop", "", "orders/") == "s3a://b/landing/shop/orders"
    assert hive_path("/r", keys={"day": "2024-01-02", "shop": "a/b%"}) == "/r/day=2024-01-02/shop=a%2Fb%25"
    assert hive_path("/r", keys={"shop": None}) == "/r/shop=__HIVE_DEFAULT_PARTITION__"


def test_hive_path_names_the_folders_that_spark_writes(spark, tmp_root):
    values = ["a b", "c/d", "e%f", "g:h", "i'j", "k=l", None]
    spark.createDataFrame([(1, v) for v in values], "n int, k string").write.partitionBy("k").parquet(f"{tmp_root}/t")
    for v in values:
        assert spark.read.parquet(hive_path(tmp_root, "t", keys={"k": v})).count() == 1


@pytest.mark.parametrize("prefix", ["lines", "lines/", "lines/*", "lines/**"])
def test_files_of_nested_folders_are_read(spark, tmp_root, prefix):
    for sub, rows in {"": ["a,1"], "/sub": ["b,2", "c,3"], "/sub/deep": ["d,4"]}.items():
        spark.createDataFrame([(r,) for r in rows], "line string").coalesce(1).write.mode("append").text(f"{tmp_root}/lines{sub}")
    spec = SourceSpec("t", FileFormat.CSV, prefix, (ColumnSpec("k"), ColumnSpec("n", "int")), full_refresh=True)
    got = read_source(spark, spec, tmp_root, ingested_at=RUN)
    assert sorted((r.k, r.n) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_header_columns_by_name_and_expression(spark, tmp_root):
    write_files(spark.createDataFrame([("7", "x", "é1")], "n string, k string, s string"), FileFormat.CSV_WITH_NAMES, f"{tmp_root}/h")
    cols = (ColumnSpec("k"), ColumnSpec("n", "int"), ColumnSpec("twice", expression="cast(n AS int) * 2"))
    spec = SourceSpec("t", FileFormat.CSV_WITH_NAMES, "h", cols, full_refresh=True)
    assert [tuple(r)[:3] for r in read_source(spark, spec, tmp_root, ingested_at=RUN).collect()] == [("x", 7, 14)]


def test_from_dict():
    spec = SourceSpec.from_dict(
        {
            "name": "observations",
            "file_format": "Parquet",
            "prefix": "parquet/by_year/",
            "partitions": [{"type": "time", "name": "YEAR", "start": "2024-01-01", "format": "%Y"}],
            "settings": {"use_hive_partitioning": "1"},
        }
    )
    assert spec.partition_columns == ["YEAR"]
    assert isinstance(spec.partitions[0], TimePartition)


def test_unknown_setting_rejected(spark, tmp_root):
    spec = SourceSpec("t", FileFormat.CSV, "", (ColumnSpec("a"),), {"input_format_foo": "1"}, full_refresh=True)
    with pytest.raises(ValueError, match="unsupported settings"):
        read_source(spark, spec, tmp_root, ingested_at=RUN)


def test_regexp_non_match_fails_or_skips(spark, tmp_root):
    lines = spark.createDataFrame([("01 ALPHA",), ("bad",), ("02 BETA",)], "line string")
    write_files(lines, FileFormat.REGEXP, f"{tmp_root}/c")
    cols = (ColumnSpec("code"), ColumnSpec("name"))
    strict = SourceSpec("c", FileFormat.REGEXP, "c", cols, {"format_regexp": "^(.{2}) (.+)$"}, full_refresh=True)
    with pytest.raises(Exception, match="does not match"):
        read_source(spark, strict, tmp_root, ingested_at=RUN).collect()
    lenient = SourceSpec(
        "c", FileFormat.REGEXP, "c", cols,
        {"format_regexp": "^(.{2}) (.+)$", "format_regexp_skip_unmatched": "1"}, full_refresh=True,
    )
    got = sorted((r.code, r.name) for r in read_source(spark, lenient, tmp_root, ingested_at=RUN).collect())
    assert got == [("01", "ALPHA"), ("02", "BETA")]


def test_declared_columns_get_one_ingested_at(spark, tmp_root):
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    write_files(df, FileFormat.CSV, f"{tmp_root}/t")
    spec = SourceSpec("t", FileFormat.CSV, "t", (ColumnSpec("a", "int"), ColumnSpec("b")), full_refresh=True)
    out = read_source(spark, spec, tmp_root, ingested_at=RUN)
    assert out.columns == ["a", "b", "ingested_at"]
    assert {r.ingested_at for r in out.collect()} == {RUN}
    # SELECT * (no declared columns) gets no audit column
    star = read_source(spark, SourceSpec("t", FileFormat.CSV_WITH_NAMES, "t", None, full_refresh=True), tmp_root)
    assert "ingested_at" not in star.columns


def test_csv_keeps_null_and_empty_apart(spark, tmp_root):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "x")], "k string, v string")
    write_files(df, FileFormat.TSV, f"{tmp_root}/t")
    spec = SourceSpec("t", FileFormat.TSV, "t", (ColumnSpec("k"), ColumnSpec("v")), full_refresh=True)
    got = {r.k: r.v for r in read_source(spark, spec, tmp_root, ingested_at=RUN).collect()}
    assert got == {"a": None, "b": "", "c": "x"}


def test_hive_partition_column_kept_for_leaf_read(spark, tmp_root):
    df = spark.createDataFrame([(1, 2023), (2, 2024), (3, 2024)], "v int, YEAR int")
    write_files(df, FileFormat.PARQUET, f"{tmp_root}/p", ["YEAR"])
    spec = SourceSpec("p", FileFormat.PARQUET, "p/", None, {"use_hive_partitioning": "1"}, partitions=(TimePartition("YEAR", datetime(2023, 1, 1)),))
    out = read_source(spark, spec, tmp_root, partition_params={"YEAR": "2024"})
    assert sorted((r.v, r.YEAR) for r in out.collect()) == [(2, 2024), (3, 2024)]


def test_arrow_round_trip(spark, tmp_root):
    df = spark.range(0, 1000).selectExpr("id", "cast(id * 2 as double) as x", "cast(id as string) as s")
    write_files(df.repartition(3), FileFormat.ARROW, f"{tmp_root}/a")
    out = read_source(spark, SourceSpec("a", FileFormat.ARROW, "a", None, full_refresh=True), tmp_root)
    assert out.count() == 1000
    assert out.agg({"x": "sum"}).first()[0] == sum(i * 2.0 for i in range(1000))


def test_arrow_rewrite_leaves_no_old_rows_and_keeps_an_empty_schema(spark, tmp_root):
    spec = SourceSpec("a", FileFormat.ARROW, "a", None, full_refresh=True)
    rows = spark.range(100).selectExpr("id", "cast(id AS string) AS s")
    write_files(rows.repartition(4), FileFormat.ARROW, f"{tmp_root}/a")
    write_files(rows.where("id < 10").coalesce(1), FileFormat.ARROW, f"{tmp_root}/a")
    assert sorted(r.id for r in read_source(spark, spec, tmp_root).collect()) == list(range(10))
    write_files(rows.where("id < 0"), FileFormat.ARROW, f"{tmp_root}/a")
    out = read_source(spark, spec, tmp_root)
    assert out.columns == ["id", "s"] and out.count() == 0


def test_arrow_files_are_read_in_runs_and_must_agree(spark, tmp_root):
    import os

    import pyarrow as pa

    os.makedirs(f"{tmp_root}/a")
    kind = pa.schema([("id", pa.int64()), ("s", pa.string())])
    with pa.ipc.new_file(f"{tmp_root}/a/x.arrow", kind) as w:  # 40 record batches: three runs
        for i in range(40):
            w.write_batch(pa.record_batch([pa.array([i]), pa.array([str(i)])], schema=kind))
    with pa.ipc.new_stream(f"{tmp_root}/a/y.arrow", kind) as w:
        w.write_batch(pa.record_batch([pa.array([40]), pa.array([None], pa.string())], schema=kind))
    spec = SourceSpec("a", FileFormat.ARROW, "a", None, full_refresh=True)
    assert sorted(r.id for r in read_source(spark, spec, tmp_root).collect()) == list(range(41))
    other = pa.schema([("id", pa.int64())])
    with pa.ipc.new_file(f"{tmp_root}/a/z.arrow", other) as w:
        w.write_batch(pa.record_batch([pa.array([41])], schema=other))
    with pytest.raises(Exception, match="has columns"):
        read_source(spark, SourceSpec("a", FileFormat.ARROW, "a", (ColumnSpec("id", "bigint"), ColumnSpec("s")), full_refresh=True), tmp_root, ingested_at=RUN).collect()


def test_arrow_folders_and_path_filter(spark, tmp_root):
    rows = [(i, f"s{i}", [None, "a/b", "c"][i % 3], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s string, k string, YEAR int")
    write_files(df.repartition(3), FileFormat.ARROW, f"{tmp_root}/a", ["YEAR", "k"])
    with open(f"{tmp_root}/a/YEAR=0/notes.txt", "w") as f:
        f.write("not Arrow")
    spec = SourceSpec(
        "a", FileFormat.ARROW, "a", None, {"use_hive_partitioning": "1", "path_glob": "*.arrow"}, (TimePartition("YEAR", RUN),)
    )
    out = read_source(spark, spec, tmp_root)
    assert dict(out.dtypes) == {"id": "bigint", "s": "string", "YEAR": "int", "k": "string"}
    assert sorted((r.id, r.s, r.k, r.YEAR) for r in out.collect()) == rows
    leaf = read_source(spark, SourceSpec("a", FileFormat.ARROW, "", None, spec.settings, spec.partitions), f"{tmp_root}/a", {"YEAR": "1"})
    assert sorted((r.id, r.YEAR) for r in leaf.collect()) == [(r[0], 1) for r in rows if r[3] == 1]
    declared = SourceSpec("a", FileFormat.ARROW, "a", (ColumnSpec("id", "string"),), spec.settings, spec.partitions)
    with pytest.raises(Exception, match="notes.txt|not an Arrow|columns"):
        read_source(spark, SourceSpec("a", FileFormat.ARROW, "a", None, {}, spec.partitions), tmp_root).collect()
    assert read_source(spark, declared, tmp_root, ingested_at=RUN).columns == ["id", "YEAR", "ingested_at"]


def test_arrow_large_files_are_cut_by_record_batches(spark, tmp_root, monkeypatch):
    from lakeweave.sources.arrow import ArrowFiles

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        write_files(spark.range(205).coalesce(1), FileFormat.ARROW, f"{tmp_root}/a")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr("lakeweave.sources.arrow.TASK_BYTES", 1000)
    source = ArrowFiles({"path": f"{tmp_root}/a"})
    reader = source.reader(source.schema())
    shares = reader.partitions()
    assert len(shares) > 3
    ids = [[i for b in reader.read(s) for i in b.column("id").to_pylist()] for s in shares]
    assert sum(ids, []) == list(range(205)) and sum(bool(x) for x in ids) > 3


def test_arrow_failed_write_leaves_the_old_files(spark, tmp_root):
    import os

    from pyspark.sql import functions as F

    write_files(spark.range(10), FileFormat.ARROW, f"{tmp_root}/a")
    before = sorted(os.listdir(f"{tmp_root}/a"))
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 777, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        write_files(bad, FileFormat.ARROW, f"{tmp_root}/a")
    assert sorted(os.listdir(f"{tmp_root}/a")) == before
    spec = SourceSpec("a", FileFormat.ARROW, "a", None, full_refresh=True)
    assert sorted(r.id for r in read_source(spark, spec, tmp_root).collect()) == list(range(10))


def test_avro_gives_clear_error(spark, tmp_root):
    spec = SourceSpec("a", FileFormat.AVRO, "a", None, full_refresh=True)
    with pytest.raises(Exception) as caught:
        read_source(spark, spec, tmp_root)
    # with the package on the classpath, the missing path is the error and is not renamed
    assert "spark-avro" in str(caught.value) or "PATH_NOT_FOUND" in str(caught.value)


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", min_size=1, max_size=11),
            st.text(alphabet="abcdefghijklmnopqrstuvwxyzéü ", min_size=0, max_size=30),
        ),
        min_size=1,
        max_size=5,
    )
)
def test_fixed_width_format_parse_round_trip(spark, rows):
    # format each row into the layout (id 1-11, name 13-42, bytes), then parse it back
    def fmt(i, name):
        raw = i.ljust(11).encode() + b" " + name.encode()[:30].ljust(30)
        return raw.decode("utf-8", errors="ignore")

    rows = [(i, n) for i, n in rows if len(n.encode()) <= 30]
    if not rows:
        return
    lines = spark.createDataFrame([(fmt(i, n),) for i, n in rows], "line string")
    parsed = read_layout_lines(lines, {"id": (1, 11), "name": (13, 30)}).collect()
    assert [(r.id.strip(), r.name.rstrip()) for r in parsed] == [(i, n.rstrip()) for i, n in rows]


def test_seed_ids_are_case_sensitive(spark, tmp_root):
    from lakeweave.operators.quality import duplicate_values
    from lakeweave.sources.seeds import read_seed

    spark.createDataFrame([("A", "upper"), ("a", "lower"), ("B", "b")], "id string, description string").write.csv(
        f"{tmp_root}/flags", header=True
    )
    seed = read_seed(spark, f"{tmp_root}/flags")
    assert sorted(r.id for r in seed.collect()) == ["A", "B", "a"]
    assert duplicate_values(seed, ["id"]).count() == 0


def test_arrow_filesystem_maps_hadoop_schemes():
    from lakeweave.sources.arrow import arrow_filesystem

    assert arrow_filesystem("file:/tmp/x")[1] == "/tmp/x"
    assert arrow_filesystem("/tmp/x")[1] == "/tmp/x"
