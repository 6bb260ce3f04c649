"""Metric-layer keys: structured queries over the curated tables."""

from __future__ import annotations

from lakeweave.plans.metrics import MetricService, Star
from lakeweave.plans.chain import LayerChain
from lakeweave.registry import register

STATION_ATTRIBUTES = frozenset(["country_id", "country_name", "state_id"])  # what the model has of the station list
OBS, SY, ST = "noaa_ghcn_observations", "noaa_ghcn_station_year", "noaa_ghcn_stations"


def service(spark, d) -> MetricService:
    p = LayerChain(spark, d)
    return MetricService(
        {
            "curated.observations": p.curated_observations,
            "curated.station_year": p.station_year,
            "curated.stations": p.curated_stations,
        },
        stars={"curated.observations": Star(p.observations, "station_id", p.curated_stations, "id", STATION_ATTRIBUTES)},
    )


@register("sem_measures_by_dimension")
def sem_measures_by_dimension(spark, d):
    return service(spark, d).query(
        {"measures": [f"{OBS}.count", f"{OBS}.observation_value"], "dimensions": [f"{OBS}.country_name", f"{OBS}.measure"]}
    )


@register("sem_filter_equals")
def sem_filter_equals(spark, d):
    return service(spark, d).query(
        {
            "measures": [f"{ST}.count"],
            "dimensions": [f"{ST}.country_name", f"{ST}.state_name"],
            "filters": [{"member": f"{ST}.country_id", "operator": "equals", "values": ["01", "05", "10"]}],
        }
    )


@register("sem_filter_bool")
def sem_filter_bool(spark, d):
    return service(spark, d).query(
        {
            "measures": [f"{OBS}.count"],
            "dimensions": [f"{OBS}.measure"],
            "filters": [
                {
                    "or": [
                        {"member": f"{OBS}.quality_flag", "operator": "equals", "values": ["X"]},
                        {
                            "and": [
                                {"member": f"{OBS}.measurement_flag", "operator": "equals", "values": ["T"]},
                                {"member": f"{OBS}.source_flag", "operator": "equals", "values": ["O"]},
                            ]
                        },
                    ]
                }
            ],
        }
    )


@register("sem_filter_measure")
def sem_filter_measure(spark, d):
    return service(spark, d).query(
        {
            "measures": [f"{SY}.count", f"{SY}.observation_count"],
            "dimensions": [f"{SY}.country_name"],
            "filters": [{"member": f"{SY}.count", "operator": "gt", "values": ["300"]}],
        }
    )


@register("sem_time_dimension")
def sem_time_dimension(spark, d):
    return service(spark, d).query(
        {
            "measures": [f"{OBS}.count"],
            "dimensions": [f"{OBS}.measure"],
            "timeDimensions": [{"dimension": f"{OBS}.observation_date", "granularity": "year"}],
        }
    )


@register("sem_order_limit")
def sem_order_limit(spark, d):
    return service(spark, d).query(
        {
            "measures": [f"{OBS}.count"],
            "dimensions": [f"{OBS}.station_id"],
            "order": {f"{OBS}.count": "desc"},
            "limit": 10,
        }
    )


@register("sem_date_range")
def sem_date_range(spark, d):
    """A date range without a granularity filters and adds no column; the last day is included."""
    return service(spark, d).query(
        {
            "measures": [f"{OBS}.count"],
            "dimensions": [f"{OBS}.measure"],
            "timeDimensions": [{"dimension": f"{OBS}.observation_date", "dateRange": ["1996-03-01", "1997-06-30"]}],
        }
    )


@register("sem_filter_hidden_measure")
def sem_filter_hidden_measure(spark, d):
    """A measure that is filtered on and not selected."""
    return service(spark, d).query(
        {
            "measures": [f"{SY}.count"],
            "dimensions": [f"{SY}.country_name"],
            "filters": [{"member": f"{SY}.observation_count", "operator": "gt", "values": [2000]}],
        }
    )


@register("sem_order_time")
def sem_order_time(spark, d):
    """The last twelve months with observations, latest first."""
    return service(spark, d).query(
        {
            "measures": [f"{OBS}.count"],
            "timeDimensions": [{"dimension": f"{OBS}.observation_date", "granularity": "month"}],
            "order": {f"{OBS}.observation_date": "desc"},
            "limit": 12,
        }
    )


#: Filter operator -> (cube, member, values, dimension to group by).
OPERATOR_CASES = {
    "notEquals": (ST, "country_id", ["01", "05"], "country_name"),
    "contains": (ST, "state_name", ["ri", "SI"], "state_name"),
    "notContains": (ST, "state_name", ["ri", "SI"], "state_name"),
    "startsWith": (ST, "state_name", ["A"], "state_name"),
    "endsWith": (ST, "state_name", ["A", "T"], "state_name"),
    "set": (ST, "state_name", [], "country_name"),
    "notSet": (ST, "state_name", [], "country_name"),
    "gte": (SY, "count", [300], "country_name"),
    "lt": (SY, "count", [300], "country_name"),
    "lte": (SY, "count", [300], "country_name"),
    "inDateRange": (OBS, "observation_date", ["1996-03-01", "1997-06-30"], "measure"),
    "beforeDate": (OBS, "observation_date", ["1996-03-01"], "measure"),
    "afterDate": (OBS, "observation_date", ["1997-06-30"], "measure"),
}


def _operator_key(operator: str, cube: str, member: str, values: list, by: str) -> None:
    condition = {"member": f"{cube}.{member}", "operator": operator, "values": values}
    asked = {"measures": [f"{cube}.count"], "dimensions": [f"{cube}.{by}"], "filters": [condition]}
    register(f"sem_op_{operator.lower()}")(lambda spark, d: service(spark, d).query(asked))


for _operator, _case in OPERATOR_CASES.items():
    _operator_key(_operator, *_case)
