from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeweave.plans import api_pages
from lakeweave.plans import events as E
from lakeweave.sinks.files import write_documents, write_rows
from lakeweave.sinks.folders import Folders
from lakeweave.sinks.tables import Lakehouse
from lakeweave.streaming.incremental import incremental_partition_refresh


def _write_page(spark, root, year, page, pages, records):
    import json

    doc = json.dumps([{"page": page, "pages": pages}, records])
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{root}/YEAR={year}/page={page}"
    )


def test_pages_decode_and_missing_page(spark, tmp_root):
    _write_page(spark, tmp_root, 2020, 1, 3, [{"id": 1, "date": "2020", "value": 1.5}, {"id": 2, "date": "2020", "value": None}])
    _write_page(spark, tmp_root, 2020, 3, 3, [{"id": 5, "date": "2020", "value": 2.0}])
    _write_page(spark, tmp_root, 2021, 1, 1, [])
    recs = api_pages.read_pages(spark, tmp_root)
    assert sorted((r.YEAR, r.page, r.id) for r in recs.collect()) == [(2020, 1, 1), (2020, 1, 2), (2020, 3, 5)]
    comp = {r.YEAR: r for r in api_pages.completeness(spark, tmp_root).collect()}
    assert (comp[2020].declared_pages, comp[2020].landed_pages, comp[2020].missing_pages, comp[2020].complete) == (3, 2, 1, False)
    assert comp[2021].complete
    man = {r.YEAR: r.files for r in api_pages.landing_manifest(spark, tmp_root).collect()}
    assert man == {2020: 2, 2021: 1}


def test_stream_picks_up_only_new_files_and_rebuilds_whole_partitions(spark, tmp_root):
    rows = [
        (1, datetime(2024, 1, 1, 10), 1, "view", 1.0, "{}"),
        (2, datetime(2024, 1, 2, 9), 1, "click", 2.0, "{}"),
        (3, datetime(2024, 1, 2, 18), 2, " buy ", 3.0, "{}"),
    ]
    ev = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    raw, ckpt = f"{tmp_root}/raw", f"{tmp_root}/ckpt"
    lh = Lakehouse.scratch(spark)
    run = lambda: incremental_partition_refresh(
        spark, lh, raw, E.RAW_EVENT_SCHEMA, "event_date", E.cleanse, "cleansed", "events", ckpt
    )
    E.land(ev.filter(F.col("event_id") <= 2), raw)
    assert run().count() == 2
    E.land(ev.filter(F.col("event_id") == 3), raw)  # second file for 2024-01-02
    out = run()
    assert sorted((r.event_id, r.event_type) for r in out.collect()) == [(1, "view"), (2, "click"), (3, "buy")]
    assert run().count() == 3  # nothing new: no-op


def test_copy_table_with_data_skips_existing(spark):
    lh = Lakehouse.scratch(spark)
    lh.full_refresh("raw", "src", spark.range(4))
    assert lh.copy_table("raw", "src", "curated", "dst").count() == 4
    lh.full_refresh("raw", "src", spark.range(9))
    assert lh.copy_table("raw", "src", "curated", "dst").count() == 4  # target existed: untouched


def test_completeness_without_declared_total_needs_trailing_empty_page(spark, tmp_root):
    import json

    def page(year, p, recs):
        doc = json.dumps([{"page": p}, recs])
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{tmp_root}/YEAR={year}/page={p}"
        )

    rec = [{"id": 1, "date": "2020", "value": 1.0}]
    page(2020, 1, rec), page(2020, 2, rec), page(2020, 3, [])  # stopped at the empty page
    page(2021, 1, rec), page(2021, 2, rec)  # no empty page yet: not complete
    page(2022, 1, rec), page(2022, 3, [])  # page 2 missing
    got = {r.YEAR: (r.declared_pages, r.landed_pages, r.missing_pages, r.complete)
           for r in api_pages.completeness(spark, tmp_root).collect()}
    assert got == {2020: (3, 3, 0, True), 2021: (2, 2, 0, False), 2022: (3, 2, 1, False)}


def test_stream_backlog_in_bounded_batches(spark, tmp_root):
    rows = [(i, datetime(2024, 1, 1 + i % 3, 8), i, "view", float(i), "{}") for i in range(12)]
    ev = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    raw, ckpt = f"{tmp_root}/raw", f"{tmp_root}/ckpt"
    for k in range(3):  # three landings -> several files per day
        E.land(ev.filter(F.col("event_id") % 3 == k), raw)
    lh = Lakehouse.scratch(spark)
    out = incremental_partition_refresh(
        spark, lh, raw, E.RAW_EVENT_SCHEMA, "event_date", E.cleanse, "cleansed", "events", ckpt,
        max_files_per_trigger=1,
    )
    assert sorted(r.event_id for r in out.collect()) == list(range(12))


def test_pretty_printed_page(spark, tmp_root):
    import json

    doc = json.dumps([{"page": 1, "pages": 1}, [{"id": 7, "date": "2020", "value": 2.5}]], indent=2)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(f"{tmp_root}/YEAR=2020/page=1")
    rows = api_pages.read_pages(spark, tmp_root).collect()
    assert [(r.YEAR, r.page, r.pages, r.id, r.value) for r in rows] == [(2020, 1, 1, 7, 2.5)]
    assert api_pages.completeness(spark, tmp_root).first().complete


GOOD = '{"meta": {"last": 2}, "items": [{"id": 1}]}'


@pytest.mark.parametrize(
    "body",
    [GOOD[:-3], '{"error": "too many requests"}', "<html>busy</html>", "", '{"meta": {"last": 2}, "items": [{"id": "x"}]}'],
)
def test_broken_pages_fail_the_load(spark, tmp_root, body):
    for page, doc in {1: GOOD, 2: body}.items():
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(f"{tmp_root}/page={page}", lineSep=" ")
    with pytest.raises(Exception, match="no records at items|MALFORMED_RECORD|CANNOT_PARSE"):
        api_pages.decode_pages(spark, tmp_root, "struct<id:int>", "items", "meta.last").collect()


@pytest.mark.parametrize(
    "body,landed",
    [(GOOD, 2), ('{"meta": {"last": 2}, "items": null}', 2), (GOOD[:-3], 1), ('{"error": "busy"}', 1)],
)
def test_completeness_of_unpartitioned_pages(spark, tmp_root, body, landed):
    for page, doc in {1: GOOD, 2: body}.items():
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(f"{tmp_root}/page={page}")
    rows = api_pages.completeness(spark, tmp_root, data_selector="items", total_path="meta.last").collect()
    assert [tuple(r) for r in rows] == [(2, landed, 2 - landed, landed == 2)]
    assert [tuple(r) for r in api_pages.landing_manifest(spark, tmp_root).collect()] == [(2, 2)]


DOCS = "YEAR int, page int, value string"


def _tree(root):
    """Text of every file below a local folder that readers see, by its path there."""
    from pathlib import Path

    found = [p.relative_to(root) for p in Path(root).rglob("*") if p.is_file() and p.name[0] not in "._"]
    return {str(p): (Path(root) / p).read_bytes().decode() for p in found}


def test_a_page_is_one_file_without_a_checksum_beside_it(spark, tmp_root):
    import os

    docs = spark.createDataFrame([(2020, p, f"[{p}]\n[\u00e9]") for p in range(1, 60)] + [(None, 1, "null"), (2021, 7, None)], DOCS)
    write_documents(docs.repartition(5), tmp_root, ["YEAR", "page"])
    want = {f"YEAR=2020/page={p}/part-0.txt": f"[{p}]\n[\u00e9]\n" for p in range(1, 60)}
    want |= {"YEAR=__HIVE_DEFAULT_PARTITION__/page=1/part-0.txt": "null\n", "YEAR=2021/page=7/part-0.txt": "\n"}
    assert _tree(tmp_root) == want
    assert os.listdir(f"{tmp_root}/YEAR=2020/page=3") == ["part-0.txt"]
    assert os.path.exists(f"{tmp_root}/_SUCCESS")
    write_documents(docs.filter("page = 7"), tmp_root, ["YEAR", "page"])  # replaces the landing
    assert sorted(_tree(tmp_root)) == ["YEAR=2020/page=7/part-0.txt", "YEAR=2021/page=7/part-0.txt"]
    write_documents(docs.filter("false"), tmp_root, ["YEAR", "page"])
    assert _tree(tmp_root) == {} and os.path.exists(f"{tmp_root}/_SUCCESS")


def test_a_landing_task_that_runs_again_leaves_one_file_a_page(tmp_path):
    rows = [("[1]", "2020", "1"), ("[2]", "2020", "2")]
    with pytest.raises(OSError, match="lost"):
        write_rows(_broken_after(rows), str(tmp_path), ["YEAR", "page"])
    write_rows(rows[::-1], str(tmp_path), ["YEAR", "page"])
    assert _tree(tmp_path) == {"YEAR=2020/page=1/part-0.txt": "[1]\n", "YEAR=2020/page=2/part-0.txt": "[2]\n"}


def test_land_pages_writes_the_page_alone(spark, tmp_root):
    import os

    records = spark.range(3).selectExpr("2020 AS YEAR", "cast(id as int) AS page", "id", "'2020' AS date", "1.5D AS value")
    api_pages.land_pages(records, tmp_root)
    assert [len(os.listdir(f"{tmp_root}/YEAR=2020/page={p}")) for p in range(3)] == [1, 1, 1]
    assert _tree(tmp_root)["YEAR=2020/page=1/part-0.txt"] == '[{"page":1,"pages":2},[{"id":1,"date":"2020","value":1.5}]]\n'


def _broken_after(rows):
    yield from rows
    raise OSError("executor lost")


def test_spark_writes_the_same_documents_where_nothing_is_mounted(spark, tmp_root, monkeypatch):
    rows = [(y, p, f"[{y}, {p}]") for y in ("2020", "a b/c=%d:e", None) for p in range(1, 4)]
    docs = spark.createDataFrame(rows, DOCS.replace("YEAR int", "YEAR string"))
    assert Folders(spark).mounted(f"file:{tmp_root}") == Folders(spark).mounted(tmp_root) == tmp_root
    own, by_spark = f"{tmp_root}/own", f"{tmp_root}/spark"
    write_documents(docs, own, ["YEAR", "page"])
    monkeypatch.setattr(Folders, "mounted", lambda self, path: None)
    write_documents(docs, by_spark, ["YEAR", "page"])
    folders = [{p.rsplit("/", 1)[0]: text for p, text in _tree(at).items()} for at in (own, by_spark)]
    assert folders[0] == folders[1] and len(folders[0]) == len(_tree(by_spark)) == 9


@pytest.mark.parametrize("read", [api_pages.completeness, api_pages.landing_manifest])
def test_a_task_lists_many_page_folders(spark, tmp_root, read):
    n = 300
    doc = F.format_string('[{"page":%d,"pages":%d},[]]', F.col("id") + 1, F.lit(n))
    write_documents(spark.range(n).select(F.lit(2020).alias("YEAR"), (F.col("id") + 1).alias("page"), doc.alias("value")), tmp_root, ["YEAR", "page"])
    sc, group = spark.sparkContext, f"listing {tmp_root}"
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    sc.setJobGroup(group, "list")
    try:
        found = read(spark, tmp_root)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds]
    tasks = [sc.statusTracker().getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 100
    assert spark.conf.get(key) == before
    row = found.first()
    assert row.YEAR == 2020 and (row.landed_pages if "landed_pages" in found.columns else row.files) == n
