from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeweave.plans.metrics import CUBES, MetricModel, MetricQuery, MetricService, Star, ValidationError, validate_query

OBS = "noaa_ghcn_observations"
SCHEMA = MetricModel(CUBES)


@pytest.fixture(scope="module")
def svc(spark):
    obs = spark.createDataFrame(
        [("01", "A", "TMAX", None, 10, "2024-01-05"), ("01", "A", "TMIN", "X", 5, "2024-03-01"), ("02", "B", "TMAX", None, 7, "2025-02-01")],
        "country_id string, country_name string, measure string, quality_flag string, observation_value int, observation_date string",
    ).selectExpr("*", "to_date(observation_date) as d").drop("observation_date").withColumnRenamed("d", "observation_date")
    return MetricService({"curated.observations": obs, "curated.station_year": obs.limit(0), "curated.stations": obs.limit(0)})


def test_empty_query_rejected():
    with pytest.raises(ValidationError, match="at least one"):
        validate_query(MetricQuery(), SCHEMA)


def test_unknown_members_listed_sorted_once():
    q = MetricQuery(
        measures=[f"{OBS}.zeta", f"{OBS}.count"],
        dimensions=[f"{OBS}.alpha"],
        time_dimensions=[{"dimension": f"{OBS}.when", "granularity": "year"}],
        filters=[{"or": [{"member": f"{OBS}.beta", "operator": "equals", "values": ["1"]}, {"member": f"{OBS}.alpha"}]}],
    )
    with pytest.raises(ValidationError) as e:
        validate_query(q, SCHEMA)
    assert str(e.value).endswith(f"{OBS}.alpha, {OBS}.beta, {OBS}.when, {OBS}.zeta")


def test_measures_by_dimension_and_filters(svc):
    out = svc.query({"measures": [f"{OBS}.count", f"{OBS}.observation_value"], "dimensions": [f"{OBS}.country_id"]})
    assert sorted(tuple(r) for r in out.collect()) == [("01", 2, 15), ("02", 1, 7)]
    f = svc.query(
        {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.measure"],
         "filters": [{"member": f"{OBS}.quality_flag", "operator": "notSet"}]}
    )
    assert sorted(tuple(r) for r in f.collect()) == [("TMAX", 2)]
    having = svc.query(
        {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.country_id"],
         "filters": [{"member": f"{OBS}.count", "operator": "gt", "values": ["1"]}]}
    )
    assert [tuple(r) for r in having.collect()] == [("01", 2)]


def test_time_dimension_order_limit(svc):
    out = svc.query(
        {"measures": [f"{OBS}.count"], "timeDimensions": [{"dimension": f"{OBS}.observation_date", "granularity": "year"}],
         "order": {f"{OBS}.count": "desc"}, "limit": 1}
    )
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["count"] == 2 and rows[0]["observation_date_year"].year == 2024
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_dimensions_only_is_distinct(svc):
    assert svc.query({"dimensions": [f"{OBS}.country_id"]}).count() == 2


def test_mixed_boolean_filter_and_cross_cube_rejected(svc):
    with pytest.raises(ValidationError, match="mix"):
        svc.query({"measures": [f"{OBS}.count"], "filters": [{"and": [
            {"member": f"{OBS}.count", "operator": "gt", "values": ["1"]},
            {"member": f"{OBS}.measure", "operator": "equals", "values": ["TMAX"]}]}]})
    with pytest.raises(ValidationError, match="one cube"):
        svc.query({"measures": [f"{OBS}.count", "noaa_ghcn_stations.count"]})
    with pytest.raises(ValidationError, match="operator"):
        svc.query({"measures": [f"{OBS}.count"], "filters": [{"member": f"{OBS}.measure", "operator": "regex", "values": ["x"]}]})


def test_describe_and_preview(svc):
    d = svc.describe()
    assert [c["name"] for c in d["cubes"]] == [c.name for c in CUBES]
    text, args = svc.preview(
        {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.measure"], "limit": 3,
         "filters": [{"member": f"{OBS}.country_id", "operator": "equals", "values": ["x'; DROP TABLE t; --"]}]}
    )
    assert text.splitlines() == [
        "SELECT `measure` AS `measure`, count(1) AS `count`", "FROM `curated`.`observations`", "WHERE `country_id` IN (:p0)",
        "GROUP BY `measure`", "ORDER BY `measure` ASC NULLS FIRST", "LIMIT 3",
    ]
    assert args == {"p0": "x'; DROP TABLE t; --"}


def test_load_returns_rows_keyed_by_qualified_member(svc):
    rows = svc.load(
        {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.country_id"],
         "timeDimensions": [{"dimension": f"{OBS}.observation_date", "granularity": "year"}],
         "order": {f"{OBS}.count": "desc"}, "limit": 5}
    )
    assert rows and set(rows[0]) == {f"{OBS}.count", f"{OBS}.country_id", f"{OBS}.observation_date.year"}


def test_load_is_bounded(svc):
    q = {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.measure"]}
    n = svc.query(q).count()
    assert len(svc.load(q, max_rows=n)) == n
    with pytest.raises(ValidationError, match="more than"):
        svc.load(q, max_rows=n - 1)


def test_describe_lists_qualified_members(svc):
    cubes = {c["name"]: c for c in svc.describe()["cubes"]}
    assert {"noaa_ghcn_stations", "noaa_ghcn_station_year", "noaa_ghcn_observations"} <= set(cubes)
    names = {m["name"] for m in cubes["noaa_ghcn_stations"]["measures"]}
    assert names == {"noaa_ghcn_stations.count"}
    q = {"measures": [next(iter(names))]}
    validate_query(MetricQuery.from_dict(q), SCHEMA)  # what describe lists is queryable


def test_cli_describe(capsys):
    import json

    from lakeweave.__main__ import main

    assert main(["describe"]) == 0
    out = json.loads(capsys.readouterr().out)
    assert len(out["cubes"]) == 3


def test_date_range_without_granularity_and_whole_days(svc):
    q = {"measures": [f"{OBS}.count"], "timeDimensions": [{"dimension": f"{OBS}.observation_date", "dateRange": ["2024-01-01", "2024-03-01"]}]}
    assert svc.query(q).first()[0] == 2
    q["timeDimensions"][0]["dateRange"] = "2025-02-01"
    assert svc.query(q).first()[0] == 1


def test_filter_on_a_measure_that_is_not_selected(svc):
    out = svc.query(
        {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.country_id"],
         "filters": [{"member": f"{OBS}.observation_value", "operator": "gt", "values": [10]}]}
    )
    assert out.columns == ["country_id", "count"] and [tuple(r) for r in out.collect()] == [("01", 2)]


def test_order_by_time_dimension_and_within_one_cube(svc):
    period = {"dimension": f"{OBS}.observation_date", "granularity": "year"}
    out = svc.query({"measures": [f"{OBS}.count"], "timeDimensions": [period], "order": {f"{OBS}.observation_date": "desc"}})
    assert [r["count"] for r in out.collect()] == [1, 2]
    with pytest.raises(ValidationError, match="one cube"):
        svc.query({"measures": [f"{OBS}.count"], "order": {"noaa_ghcn_stations.count": "desc"}})
    with pytest.raises(ValidationError, match="does not select"):
        svc.query({"measures": [f"{OBS}.count"], "order": {f"{OBS}.country_id": "desc"}})


@pytest.fixture(scope="module")
def star(spark):
    """Readings and a station list with a repeated station and a missing one, as a star and as one table."""
    facts = [
        (f"S{i % 5}", ["TMAX", "TMIN", None][i % 3], [None, "X"][i % 2], i * 7 % 11 - 3, datetime(2023 + i % 2, 1 + i % 12, 1 + i % 28, i % 24))
        for i in range(60)
    ]
    fact = spark.createDataFrame(
        facts, "station_id string, measure string, quality_flag string, observation_value int, observed_at timestamp_ntz"
    ).selectExpr("*", "cast(null AS string) AS measurement_flag", "'F' AS source_flag", "to_date(observed_at) AS observation_date")
    stations = [("S0", "01", "A", "x"), ("S1", "01", "A", None), ("S2", "02", "B", "x"), ("S2", "02", "C", "y"), ("S3", None, None, "x")]
    stations = spark.createDataFrame(stations, "id string, country_id string, country_name string, state_id string")
    joined = fact.join(stations, fact.station_id == stations.id, "left").drop("id").cache()
    joined.createOrReplaceTempView("joined_observations")
    one = MetricService({"curated.observations": joined})
    two = MetricService(
        {"curated.observations": joined},
        stars={"curated.observations": Star(fact, "station_id", stations, "id", frozenset(["country_id", "country_name", "state_id"]))},
    )
    return one, two


_TEXTS = st.sampled_from(["country_id", "country_name", "state_id", "measure", "quality_flag", "station_id"])
_WORDS = st.lists(st.sampled_from(["01", "02", "A", "x", "X", "TMAX", "S2", "a'b"]), min_size=1, max_size=3)
_DAYS = st.sampled_from(["2023-03-05", "2024-01-01", "2023-11-30 10:00:00", "2024-12-31"])
_ON_TEXT = st.builds(
    lambda m, op, v: {"member": f"{OBS}.{m}", "operator": op, "values": v},
    _TEXTS, st.sampled_from(["equals", "notEquals", "contains", "notContains", "startsWith", "endsWith", "set", "notSet"]), _WORDS,
)
_ON_TIME = st.builds(
    lambda op, v: {"member": f"{OBS}.observed_at", "operator": op, "values": [v]},
    st.sampled_from(["gt", "gte", "lt", "lte", "inDateRange", "beforeDate", "afterDate"]), _DAYS,
)
_ROWS = st.recursive(
    st.one_of(_ON_TEXT, _ON_TIME), lambda f: st.builds(lambda g, x: {g: x}, st.sampled_from(["and", "or"]), st.lists(f, min_size=1, max_size=2)), max_leaves=3
)
_ON_MEASURE = st.builds(
    lambda m, op, v: {"member": f"{OBS}.{m}", "operator": op, "values": [v]},
    st.sampled_from(["count", "observation_value"]), st.sampled_from(["gt", "lte", "equals"]), st.sampled_from([3, 10, "4"]),
)


@st.composite
def structured(draw):
    q = {
        "measures": [f"{OBS}.{m}" for m in draw(st.lists(st.sampled_from(["count", "observation_value"]), unique=True))],
        "dimensions": [f"{OBS}.{d}" for d in draw(st.lists(_TEXTS, unique=True, max_size=2))],
        "filters": draw(st.lists(_ROWS, max_size=2)) + (draw(st.lists(_ON_MEASURE, max_size=1))),
    }
    if draw(st.booleans()):
        q["timeDimensions"] = [{"dimension": f"{OBS}.observed_at", "granularity": draw(st.sampled_from(["month", "year", "week"]))}]
        if draw(st.booleans()):
            q["timeDimensions"][0]["dateRange"] = draw(st.lists(_DAYS, min_size=1, max_size=2))
    if not q["measures"] and not q["dimensions"]:
        q["measures"] = [f"{OBS}.count"]
    if draw(st.booleans()):
        q["order"] = {m: draw(st.sampled_from(["asc", "desc"])) for m in (q["measures"] + q["dimensions"])[:1]}
    if draw(st.booleans()):
        q["limit"] = draw(st.integers(1, 4))
    return q


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(structured())
def test_star_and_sql_text_equal_the_row_level_query(spark, star, q):
    one, two = star
    want = one.query(q)
    text, args = one.preview(q, {"curated.observations": "joined_observations"})
    rows = want.collect()
    for got in (two.query(q), spark.sql(text, args=args)):
        assert got.columns == want.columns and got.dtypes == want.dtypes
        found = got.collect()
        assert found == rows if q.get("order") else sorted(map(str, found)) == sorted(map(str, rows))


def test_star_joins_a_row_for_each_station_and_not_for_each_reading(spark):
    from lakeweave.queries.metrics import service

    from .conftest import SF_SMALL

    query = {"measures": [f"{OBS}.count"], "dimensions": [f"{OBS}.country_name"], "order": {f"{OBS}.count": "desc"}, "limit": 3}
    plan = service(spark, SF_SMALL).query(query)._jdf.queryExecution().optimizedPlan().toString()
    outer = plan.splitlines()
    join = next(i for i, line in enumerate(outer) if "Join LeftOuter" in line)
    assert "Aggregate" in outer[join + 1]  # the left side of the station join is already aggregated
