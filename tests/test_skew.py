"""A station holding about a third of all observations: the row-level station join is
split by AQE, and results do not change.

AQE splits a skewed reduce partition along map-output boundaries, so the fact side needs
several map tasks (thousands at scale; here 16, made explicit with ``repartition``)."""

from pyspark.sql import functions as F

from lakeweave.plans import curated
from lakeweave.plans.chain import LayerChain
from lakeweave.sinks.tables import session_conf
from tests.conftest import SF_CHECK


def _final_plan(df) -> str:
    df.collect()  # run this DataFrame's own query, so its adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_station_join_is_split_and_results_hold(spark):
    chain = LayerChain(spark, SF_CHECK)
    hot = chain.stations.agg(F.min("id")).first()[0]
    # readings of lines 1-2 (~2/7 of all rows) plus every fifth order all go to one station
    obs = chain.observations.withColumn(
        "station_id",
        F.when(F.col("measure").isin("TMAX", "TMIN") | (F.hash("observed_at", "station_id") % 5 == 0), F.lit(hot)).otherwise(
            F.col("station_id")
        ),
    )
    obs = obs.repartition(16)
    share = obs.filter(F.col("station_id") == hot).count() / obs.count()
    assert share > 0.3
    with session_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), session_conf(
        spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"
    ), session_conf(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k"), session_conf(
        spark, "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2"
    ), session_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k"), session_conf(
        spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0"
    ):
        joined = curated.observations(obs, chain.curated_stations)
        plan = _final_plan(joined)
        assert "skew=true" in plan
        assert joined.count() == obs.count()
        # pre-aggregated station-year equals the one-big-table form under the same skew
        a = curated.station_year(obs, chain.curated_stations)
        b = curated.station_year_from_obt(joined)
        cols = a.columns
        assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
        assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0
