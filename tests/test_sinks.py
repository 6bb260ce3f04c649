import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lakeweave.sinks.tables import Lakehouse, RejectedLoad


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_partition_exact_idempotent_and_empty_clears(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.createDataFrame([(1, "a", 2023), (2, "b", 2024), (3, "c", 2024)], "id int, v string, YEAR int")
    lh.insert_overwrite("raw", "t", base, ["YEAR"])
    new = spark.createDataFrame([(9, "z", 2024)], "id int, v string, YEAR int")
    once = _rows(lh.replace_partition("raw", "t", new, {"YEAR": 2024}))
    twice = _rows(lh.replace_partition("raw", "t", new, {"YEAR": 2024}))
    assert once == twice == [(1, "a", 2023), (9, "z", 2024)]
    empty = spark.createDataFrame([], "id int, v string, YEAR int")
    assert _rows(lh.replace_partition("raw", "t", empty, {"YEAR": 2024})) == [(1, "a", 2023)]


def test_replace_partition_rejects_rows_outside(spark):
    lh = Lakehouse.scratch(spark)
    df = spark.createDataFrame([(1, 2023)], "id int, YEAR int")
    try:
        lh.replace_partition("raw", "t", df, {"YEAR": 2024})
    except Exception as e:
        assert "outside partition" in str(e)
    else:
        raise AssertionError("expected failure")


def test_insert_overwrite_keeps_untouched_partitions(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.createDataFrame([(1, 2022), (2, 2023), (3, 2024)], "id int, y int")
    lh.insert_overwrite("cleansed", "t", base, ["y"])
    upd = spark.createDataFrame([(20, 2023), (21, 2023)], "id int, y int")
    assert _rows(lh.insert_overwrite("cleansed", "t", upd, ["y"])) == [(1, 2022), (3, 2024), (20, 2023), (21, 2023)]


def test_full_refresh_publishes_new_version(spark):
    lh = Lakehouse.scratch(spark)
    lh.full_refresh("curated", "t", spark.range(3))
    assert lh.table("curated", "t").count() == 3
    lh.full_refresh("curated", "t", spark.range(5))
    assert lh.table("curated", "t").count() == 5


def test_full_refresh_checks_block_publish(spark):
    lh = Lakehouse.scratch(spark)
    lh.full_refresh("curated", "t", spark.range(3))

    def no_big_ids(df):
        if df.filter(F.col("id") > 3).count():
            raise ValueError("bad rows")

    try:
        lh.full_refresh("curated", "t", spark.range(10), checks=[no_big_ids])
    except ValueError:
        pass
    assert lh.table("curated", "t").count() == 3  # the old version is still published


def test_append_duplicates_replace_does_not(spark):
    lh = Lakehouse.scratch(spark)
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    lh.load("raw", "a", df, "append")
    assert lh.load("raw", "a", df, "append").count() == 2
    lh.load("raw", "r", df, "replace")
    assert lh.load("raw", "r", df, "replace").count() == 1


def test_full_refresh_of_empty_result(spark):
    lh = Lakehouse.scratch(spark)
    lh.full_refresh("curated", "t", spark.range(3))
    empty = spark.range(10).filter("id < 0")
    assert lh.full_refresh("curated", "t", empty, checks=[lambda df: df.count()]).count() == 0


def test_view_is_persistent_and_late_binding(spark):
    lh = Lakehouse.scratch(spark)
    lh.full_refresh("raw", "flags", spark.createDataFrame([("A", "x")], "id string, description string"))
    v = lh.view("cleansed", "flags", "raw", "flags")
    assert v.count() == 1
    assert spark.catalog.tableExists(f"{lh.database('cleansed')}.flags")
    lh.full_refresh("raw", "flags", spark.createDataFrame([("A", "x"), ("a", "y")], "id string, description string"))
    assert lh.table("cleansed", "flags").count() == 2


def test_partitioned_full_refresh_replaces_all_partitions(spark):
    lh = Lakehouse.scratch(spark)
    a = spark.createDataFrame([(1, 2022), (2, 2023)], "id int, y int")
    b = spark.createDataFrame([(3, 2023), (4, 2024)], "id int, y int")
    lh.full_refresh("curated", "p", a, partition_by=["y"])
    out = lh.full_refresh("curated", "p", b, partition_by=["y"])
    assert sorted(tuple(r) for r in out.collect()) == [(3, 2023), (4, 2024)]
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {lh.version('curated', 'p')}").collect())
    assert parts == ["y=2023", "y=2024"]


@pytest.mark.parametrize("partition_by", [[], ["k"]])
def test_full_refresh_adopts_the_new_schema_and_keeps_open_readers(spark, partition_by):
    lh = Lakehouse.scratch(spark)
    old = lh.full_refresh("curated", "s", spark.createDataFrame([(1, 2, "x")], "a int, b int, k string"), partition_by)
    new = lh.full_refresh("curated", "s", spark.createDataFrame([(10, "30", "y")], "a int, c string, k string"), partition_by)
    assert new.columns == ["a", "c", "k"] and _rows(new) == [(10, "30", "y")]
    assert _rows(old) == [(1, 2, "x")]  # planned after the swap, still the version it was opened on


def test_loads_into_a_table_reject_other_columns(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.createDataFrame([(1, "x", 2023)], "id int, v string, y int")
    lh.insert_overwrite("raw", "t", base, ["y"])
    extra, short = base.withColumn("w", F.lit(1)), base.drop("v")
    for df, column in ((extra, "w"), (short, "v")):
        for load in (
            lambda: lh.replace_partition("raw", "t", df, {"y": 2023}),
            lambda: lh.insert_overwrite("raw", "t", df, ["y"]),
            lambda: lh.append("raw", "t", df, ["y"]),
        ):
            with pytest.raises(ValueError, match=f"'{column}'"):
                load()
    assert _rows(lh.table("raw", "t")) == [(1, "x", 2023)]


def test_partition_values_with_special_characters(spark):
    lh = Lakehouse.scratch(spark)
    for value in ("a/b", "c\\d", "e'f", "g=h i"):
        lh.replace_partition("raw", "t", spark.createDataFrame([(1, value)], "id int, k string"), {"k": value})
    assert _rows(lh.table("raw", "t")) == [(1, "a/b"), (1, "c\\d"), (1, "e'f"), (1, "g=h i")]


def test_partitioned_write_makes_files_by_size(spark):
    lh = Lakehouse.scratch(spark)
    rows = spark.range(20_000, numPartitions=16).selectExpr("id", "id % 3 AS y")
    out = lh.insert_overwrite("raw", "t", rows, ["y"], ["id"])
    assert out.count() == 20_000 and len(out.inputFiles()) == 3


def test_views_take_no_rows(spark):
    lh = Lakehouse.scratch(spark)
    lh.full_refresh("raw", "t", spark.range(3))
    lh.view("cleansed", "t", "raw", "t")
    with pytest.raises(ValueError, match="view of another table"):
        lh.append("cleansed", "t", spark.range(1))


def test_replace_partition_of_null(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    lh.insert_overwrite("raw", "t", base, ["k"])
    new = spark.createDataFrame([(9, None)], "id int, k string")
    assert _rows(lh.replace_partition("raw", "t", new, {"k": None}).orderBy("id").na.fill("-")) == [(1, "a"), (3, "b"), (9, "-")]
    assert lh.table("raw", "t").where("k IS NULL").count() == 1
    with pytest.raises(Exception, match="outside partition"):
        lh.replace_partition("raw", "t", base, {"k": None})
    empty = base.limit(0)
    assert _rows(lh.replace_partition("raw", "t", empty, {"k": None})) == [(1, "a"), (3, "b")]
    ints = spark.createDataFrame([(1, 5, None), (2, None, 7)], "id int, a int, b int")
    lh.insert_overwrite("raw", "two", ints, ["a", "b"])
    lh.replace_partition("raw", "two", ints.where("a = 5").withColumn("id", F.lit(8)), {"a": "05", "b": None})
    assert sorted((r.id, r.a, r.b) for r in lh.table("raw", "two").collect()) == [(2, None, 7), (8, 5, None)]


def test_overwrite_is_atomic_and_keeps_open_readers(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.range(1000).selectExpr("id", "id % 4 AS y")
    old = lh.insert_overwrite("raw", "t", base, ["y"])
    lh.insert_overwrite("raw", "t", spark.createDataFrame([(7, 1), (8, 2)], "id long, y long"), ["y"])
    assert old.count() == 1000 and old.where("y = 1").count() == 250  # planned anew after the swap
    assert lh.table("raw", "t").count() == 502
    lh.insert_overwrite("raw", "t", base.limit(0), ["y"])
    assert lh.table("raw", "t").count() == 502
    where = {r.spec: r.location for r in lh.partitions("raw", "t").collect()}
    assert len(where) == 4 and where["y=0"].rsplit("/", 1)[0] == where["y=3"].rsplit("/", 1)[0] != where["y=1"].rsplit("/", 1)[0]
    assert [r.id for r in lh.table("raw", "t").where("y = 2").collect()] == [8]


def test_failing_checks_publish_nothing_and_leave_no_folder(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.createDataFrame([(1, "a", 2022), (2, "b", 2023)], "id int, v string, y int")
    lh.insert_overwrite("raw", "t", base, ["y"])
    bad = spark.createDataFrame([(3, None, 2022), (4, "c", 2024)], "id int, v string, y int")
    folders = set(os.listdir(f"{lh.root}/raw/t"))

    def no_2024(df):
        assert not df.where("y = 2024").count()

    loads = [
        lambda: lh.insert_overwrite("raw", "t", bad, ["y"], expect={"v missing": "v IS NULL"}),
        lambda: lh.insert_overwrite("raw", "t", bad, ["y"], checks=[no_2024]),
        lambda: lh.full_refresh("raw", "t", bad, ["y"], expect={"v missing": "v IS NULL"}),
        lambda: lh.replace_partition("raw", "t", bad.where("y = 2022"), {"y": 2022}, expect={"early": "y < 2023"}),
    ]
    for load in loads:
        with pytest.raises((RejectedLoad, AssertionError)):
            load()
    assert _rows(lh.table("raw", "t")) == _rows(base) and set(os.listdir(f"{lh.root}/raw/t")) == folders
    lh.insert_overwrite("raw", "t", bad, ["y"], expect={"v missing": "v IS NULL"}, strict=False)
    assert lh.counted["raw.t"] == {"rows": 2, "v missing": 1}


@pytest.mark.parametrize("rows", [0, 500])
def test_expectations_are_counted_by_the_write(spark, rows):
    lh = Lakehouse.scratch(spark)
    df = spark.range(rows).selectExpr("id", "nullif(id % 7, 0) AS v", "id % 3 AS y")
    tracker = spark.sparkContext.statusTracker()

    def jobs(name, **kwargs):
        spark.sparkContext.setJobGroup(f"count-{rows}-{name}", name)
        lh.full_refresh("raw", name, df, ["y"], **kwargs)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"count-{rows}-{name}"))

    plain = jobs("plain")
    expect = {"id missing": "id IS NULL", "v missing": "v IS NULL", "y high": "y > 1"}
    assert jobs("checked", expect=expect, strict=False) == plain  # no job of their own, no second scan
    want = {"rows": rows, "id missing": 0, "v missing": len(range(0, rows, 7)), "y high": len(range(2, rows, 3))}
    assert lh.counted["raw.checked"] == want


def test_expire_keeps_tables_and_folders_bounded(spark):
    lh = Lakehouse.scratch(spark)
    base = spark.range(30).selectExpr("id", "id % 3 AS y")
    for name in ("t", "__u"):
        lh.insert_overwrite("raw", name, base, ["y"])
    for i in range(20):
        lh.insert_overwrite("raw", "t", base.where("y = 1").selectExpr(f"id + {i} AS id", "y"), ["y"])
    stale = lh.full_refresh("raw", "f", spark.range(2))
    for i in range(3):
        lh.full_refresh("raw", "f", spark.range(i))
    os.makedirs(f"{lh.root}/raw/t/v-failed/y=1")  # of a load whose driver was lost
    before = _rows(lh.table("raw", "t"))
    assert len(lh.expire("raw", "t")) == 0  # younger than a day
    assert len(lh.expire("raw", "t", keep=2, older_than=timedelta(0))) == 19
    assert len(lh.expire("raw", "f", older_than=timedelta(0))) == 3
    assert _rows(lh.table("raw", "t")) == before and lh.table("raw", "f").count() == 2
    names = {t.name for t in spark.catalog.listTables(lh.database("raw"))}
    assert len([n for n in names if n.startswith("t__")]) == 2 and len([n for n in names if n.startswith("f__")]) == 1
    data = [d for d, _, files in os.walk(f"{lh.root}/raw/t") if any(f.endswith(".parquet") for f in files)]
    assert len(data) == 4 and not os.path.exists(f"{lh.root}/raw/t/v-failed")  # y=0, y=2 and two of y=1
    assert lh.ledger("raw", "t").select("version").distinct().count() == 2
    with pytest.raises(Exception):
        stale.collect()
    lh.append("raw", "t", spark.createDataFrame([(1, 9)], "id long, y long"), ["y"])
    lh.expire("raw", "t", older_than=timedelta(0))
    assert _rows(lh.table("raw", "t")) == sorted([*before, (1, 9)])
    lh.insert_overwrite("raw", "t", base.where("y = 0"), ["y"])
    assert _rows(lh.table("raw", "t").where("y <> 0")) == sorted([*(r for r in before if r[1]), (1, 9)])


def test_rows_take_the_tables_types(spark):
    lh = Lakehouse.scratch(spark)
    lh.insert_overwrite("raw", "t", spark.createDataFrame([(1, 2.5, 1)], "id long, v double, y int"), ["y"])
    out = lh.insert_overwrite("raw", "t", spark.createDataFrame([(2, 7, 2)], "y int, v int, id int"), ["y"])
    assert _rows(out) == [(1, 2.5, 1), (2, 7.0, 2)] and dict(out.dtypes) == {"id": "bigint", "v": "double", "y": "int"}
