import pytest

from lakeweave.operators import quality as Q


def test_checks_on_known_violations(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "zz")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    nn = {r.column_name: r.failures for r in Q.not_null_failures(child, ["id", "k"]).collect()}
    assert nn == {"id": 0, "k": 1}
    assert [tuple(r) for r in Q.duplicate_values(parent, ["k"]).collect()] == [("b", 2)]
    assert Q.orphan_count(child, "k", parent, "k").first().failures == 2  # two 'zz' rows; NULL is not an orphan
    assert sorted(r.id for r in Q.orphan_rows(child, "k", parent, "k").collect()) == [4, 5]


def test_suite_and_verdict(spark):
    m = {
        "p": spark.createDataFrame([("a",), ("b",)], "id string"),
        "c": spark.createDataFrame([("a",), ("x",)], "pid string"),
    }
    checks = [
        Q.Check("p", "not_null", ("id",)),
        Q.Check("p", "unique", ("id",)),
        Q.Check("c", "relationships", ("pid",), "p", "id"),
        Q.Check("c", "unique_combination", ("pid",)),
    ]
    res = Q.run_suite(m, checks)
    got = {(r.model, r.test): r.failures for r in res.collect()}
    assert got == {("p", "not_null"): 0, ("p", "unique"): 0, ("c", "relationships"): 1, ("c", "unique_combination"): 0}
    with pytest.raises(AssertionError, match="relationships=1"):
        Q.assert_passing(res)


def test_unknown_test_rejected():
    with pytest.raises(ValueError):
        Q.Check("m", "accepted_values", ("c",))


def test_build_fail_fast_stops_at_first_failing_model(spark):
    from lakeweave.plans.build import build_all
    from lakeweave.plans.checks import DECLARED_CHECKS
    from lakeweave.plans.raw import RawTables
    from lakeweave.sinks.tables import Lakehouse
    from tests.conftest import SF_SMALL

    class ShortList(RawTables):
        """A station list that lacks stations with readings."""

        def stations(self):
            return super().stations().filter("station_id NOT LIKE '%7'")

    lh = Lakehouse.scratch(spark)
    with pytest.raises(AssertionError, match="cleansed.inventory.station_id relationships"):
        build_all(lh, ShortList(spark, SF_SMALL), DECLARED_CHECKS, fail_fast=True)
    assert lh.exists("cleansed", "inventory") and not lh.exists("curated", "stations")
