from datetime import date

from pyspark.sql import functions as F

from lakeweave.plans import curated, reporting
from lakeweave.plans.chain import LayerChain
from tests.conftest import SF_SMALL


def _obs(spark, rows):
    return spark.createDataFrame(
        rows,
        "observation_year int, station_id string, observation_date date, observed_at timestamp_ntz, "
        "observation_value int, measurement_flag string, quality_flag string, source_flag string, measure string",
    )


def _stations(spark):
    return spark.createDataFrame(
        [("S1", "01", "ONE"), ("S2", "01", "ONE"), ("S3", "02", "TWO")], "id string, country_id string, country_name string"
    )


ROWS = [
    # S1: three TMAX readings, one failed-QC TMAX
    (2024, "S1", date(2024, 1, 1), None, 100, None, None, "a", "TMAX"),
    (2024, "S1", date(2024, 1, 2), None, 200, None, None, "a", "TMAX"),
    (2024, "S1", date(2024, 1, 3), None, 300, None, None, "a", "TMAX"),
    (2024, "S1", date(2024, 1, 4), None, 900, None, "X", "a", "TMAX"),
    # S2: one TMAX, one PRCP
    (2024, "S2", date(2024, 1, 1), None, 400, None, None, "a", "TMAX"),
    (2024, "S2", date(2024, 1, 1), None, 5, None, None, "a", "PRCP"),
    # S3: only failed-QC rows -> no station-year row
    (2024, "S3", date(2024, 1, 1), None, 50, None, "X", "a", "TMIN"),
    # S9: orphan station (no station row), SNOW only
    (2024, "S9", date(2024, 1, 1), None, 30, None, None, "a", "SNOW"),
]


def test_station_year_preaggregated_equals_obt_form(spark):
    obs, st = _obs(spark, ROWS), _stations(spark)
    a = curated.station_year(obs, st)
    b = curated.station_year_from_obt(curated.observations(obs, st.select("id", "country_id", "country_name", *[F.lit(None).cast(t).alias(c) for c, t in [("state_id", "string"), ("latitude", "decimal(9,6)"), ("longitude", "decimal(9,6)"), ("elevation", "decimal(8,1)")]])))
    key = lambda r: r.station_id
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert [tuple(r) for r in ra] == [tuple(r) for r in rb]
    by = {r.station_id: r for r in ra}
    assert by["S1"].avg_tmax_celsius == 20.0 and by["S1"].observation_count == 3
    assert by["S1"].total_precip_mm is None  # sum of nothing is NULL, not 0
    assert "S3" not in by
    assert by["S9"].country_id is None and by["S9"].total_snowfall_mm == 30.0


def test_two_stage_average_is_unweighted(spark):
    sy = curated.station_year(_obs(spark, ROWS), _stations(spark))
    cy = {(r.country_id): r for r in reporting.country_year(sy).collect()}
    # S1 mean 20.0 (3 readings), S2 mean 40.0 (1 reading): across stations 30.0,
    # whereas a one-pass mean over the 4 readings would be 25.0
    assert cy["01"].avg_tmax_celsius == 30.0
    assert cy["01"].station_count == 2
    assert None not in cy  # the orphan country-year has no temp/precip station: dropped
    snow = {r.country_id: r for r in reporting.snow_cold(sy).collect()}
    assert snow[None].avg_yearly_snowfall_mm == 30.0  # kept by its own rule
    g = reporting.global_year(sy).first()
    assert g.country_count == 1 and g.station_count == 2  # NULL country not counted as distinct


def test_station_coverage_sentinel(spark):
    st = spark.createDataFrame(
        [("A", "01", "ONE", 10.0, 1.0, 2.0), ("B", "01", "ONE", -999.9, 3.0, 4.0), ("C", "02", "TWO", -999.9, 0.0, 0.0)],
        "id string, country_id string, country_name string, elevation double, latitude double, longitude double",
    ).select("id", "country_id", "country_name", F.col("elevation").cast("decimal(8,1)").alias("elevation"),
             F.col("latitude").cast("decimal(9,6)").alias("latitude"), F.col("longitude").cast("decimal(9,6)").alias("longitude"))
    cov = {r.country_id: r for r in reporting.station_coverage(st).collect()}
    assert cov["01"].station_count == 2 and cov["01"].avg_elevation_m == 10.0 and cov["01"].avg_latitude == 2.0
    assert cov["02"].avg_elevation_m is None  # NULL, never NaN


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_partial_aggregation_and_pushdown(spark):
    p = LayerChain(spark, SF_SMALL)
    plan = _plan(p.station_year)
    assert "partial_" in plan or "HashAggregate" in plan
    # the QC filter reaches the line-item scan (quality_flag IS NULL pushed through the joins)
    assert "l_returnflag" in p.station_year._jdf.queryExecution().optimizedPlan().toString()


def test_plan_partition_filters_on_incremental_read(spark, tmp_root):
    from lakeweave.plans import bindings, cleansed
    from lakeweave.sinks.files import write_files
    from lakeweave.specs import FileFormat

    write_files(bindings.raw_observations(spark, SF_SMALL), FileFormat.PARQUET, f"{tmp_root}/obs", ["YEAR"])
    raw = spark.read.parquet(f"{tmp_root}/obs")
    df = cleansed.observations(raw, (1997, 1997))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in text and "1997" in text


def test_plan_top_k(spark):
    from lakeweave.registry import raw_queries

    df = raw_queries()["sem_order_limit"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in _plan(df)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["S1", "S2", "S3", "S4"]), st.sampled_from(["TMAX", "TMIN", "PRCP", "SNOW"]),
                  st.integers(-400, 400), st.booleans()),
        min_size=1, max_size=40,
    )
)
def test_two_stage_mean_property(spark, readings):
    """Country mean = unweighted mean over stations of each station's mean (QC-passing),
    computed directly in Python."""
    rows = [(2024, s, date(2024, 1, 1), None, v, None, "X" if bad else None, "a", m) for s, m, v, bad in readings]
    sy = curated.station_year(_obs(spark, rows), _stations(spark))
    got = {r.country_id: r.avg_tmax_celsius for r in reporting.country_year(sy).collect()}
    country = {"S1": "01", "S2": "01", "S3": "02", "S4": None}
    per_station: dict = {}
    for s, m, v, bad in readings:
        if not bad and m == "TMAX":
            per_station.setdefault(s, []).append(v / 10.0)
    by_country: dict = {}
    for s, vals in per_station.items():
        by_country.setdefault(country[s], []).append(sum(vals) / len(vals))
    for c, means in by_country.items():
        assert abs(got[c] - sum(means) / len(means)) < 1e-9


def test_plan_small_dimensions_broadcast(spark):
    plan = _plan(LayerChain(spark, SF_SMALL).curated_stations)
    assert plan.count("BroadcastHashJoin") >= 2  # countries and states lookups


def test_plan_partial_then_final_aggregate(spark):
    df = LayerChain(spark, SF_SMALL).station_year
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "HashAggregate" in text


def test_plan_qc_filter_pushed_into_persisted_obt(spark):
    from lakeweave.plans import curated as C
    from lakeweave.sinks.tables import Lakehouse

    lh = Lakehouse.scratch(spark)
    chain = LayerChain(spark, SF_SMALL)
    obt = lh.full_refresh("curated", "observations", chain.curated_observations, partition_by=["observation_year"])
    sy = C.station_year_from_obt(obt)
    text = sy._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(quality_flag)]" in text
    assert sy.count() == chain.station_year.count()


def test_strict_casts_fail_tolerant_casts_count_rejects(spark):
    import pytest

    from lakeweave.plans import cleansed as CL

    raw = spark.createDataFrame(
        [("US000000001", "  12.5000", " -70.0000", "  10.0", "  ", "A", "", "", "00001"),
         ("US000000002", "  abc    ", " -71.0000", "      ", "  ", "B", "", "", "00002")],
        "station_id string, latitude string, longitude string, elevation string, state string, name string, "
        "gsn_flag string, hcn_crn_flag string, wmo_id string",
    )
    with pytest.raises(Exception):
        CL.stations(raw).collect()
    got = {r.id: r.latitude for r in CL.stations(raw, strict=False).collect()}
    assert got["US000000002"] is None and float(got["US000000001"]) == 12.5
    rej = {r.column_name: r.rejects for r in CL.cast_rejects(raw, CL.STATION_CASTS).collect()}
    assert rej == {"latitude": 1, "longitude": 0, "elevation": 0}  # blank elevation is not a reject
