"""Cleansed layer: trim, type, rename. Raw text stays text until here; casts are strict
(ANSI), so a malformed number fails the load instead of turning into NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.time import observed_at_sql, parse_yyyymmdd_sql


def code_names(raw: DataFrame) -> DataFrame:
    """countries / states: (id, name)."""
    return raw.selectExpr("trim(code) AS id", "trim(name) AS name")


countries = code_names
states = code_names


def _cast(text: str, type_name: str, strict: bool) -> str:
    return f"{'cast' if strict else 'try_cast'}({text} as {type_name})"


# typed columns of the station list and the inventory: column -> (text expression, type)
STATION_CASTS = {
    "latitude": ("trim(latitude)", "decimal(9,6)"),
    "longitude": ("trim(longitude)", "decimal(9,6)"),
    "elevation": ("trim(elevation)", "decimal(8,1)"),
}
INVENTORY_CASTS = {
    "latitude": ("trim(latitude)", "decimal(9,6)"),
    "longitude": ("trim(longitude)", "decimal(9,6)"),
    "first_year": ("first_year", "int"),
    "last_year": ("last_year", "int"),
}


def stations(raw: DataFrame, strict: bool = True) -> DataFrame:
    """``strict`` (default): a malformed number fails the load (ANSI cast). Otherwise
    it becomes NULL; count those with ``cast_rejects``."""
    c = {k: _cast(t, ty, strict) for k, (t, ty) in STATION_CASTS.items()}
    return raw.selectExpr(
        "trim(station_id) AS id",
        f"{c['latitude']} AS latitude",
        f"{c['longitude']} AS longitude",
        f"{c['elevation']} AS elevation",
        "trim(state) AS state_id",
        "substring(station_id, 1, 2) AS country_id",
        "trim(name) AS name",
        "trim(gsn_flag) AS gsn_flag",
        "trim(hcn_crn_flag) AS hcn_crn_flag",
        "trim(wmo_id) AS wmo_id",
    )


def inventory(raw: DataFrame, strict: bool = True) -> DataFrame:
    c = {k: _cast(t, ty, strict) for k, (t, ty) in INVENTORY_CASTS.items()}
    return raw.selectExpr(
        "trim(station_id) AS station_id",
        f"{c['latitude']} AS latitude",
        f"{c['longitude']} AS longitude",
        "trim(element) AS element",
        f"{c['first_year']} AS first_year",
        f"{c['last_year']} AS last_year",
    )


def cast_rejects(raw: DataFrame, casts: dict[str, tuple[str, str]]) -> DataFrame:
    """(column_name, rejects): values present in the text but not castable, in one pass."""
    exprs = [
        f"count_if({t} IS NOT NULL AND {t} != '' AND try_cast({t} as {ty}) IS NULL) AS `{k}`"
        for k, (t, ty) in casts.items()
    ]
    return raw.selectExpr(*exprs).unpivot([], list(casts), "column_name", "rejects")


def observations(raw: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """Typed observations. ``years`` = inclusive (first, last) window on the YEAR
    partition column; applied before anything else so the scan prunes partitions."""
    if years is not None:
        raw = raw.filter(F.col("YEAR").between(int(years[0]), int(years[1])))
    day = parse_yyyymmdd_sql("DATE")
    return raw.selectExpr(
        "cast(YEAR as int) AS observation_year",
        "cast(ID as string) AS station_id",
        f"{day} AS observation_date",
        f"{observed_at_sql(day, 'OBS_TIME')} AS observed_at",
        "cast(DATA_VALUE as int) AS observation_value",
        "M_FLAG AS measurement_flag",
        "Q_FLAG AS quality_flag",
        "S_FLAG AS source_flag",
        "cast(ELEMENT as string) AS measure",
    )


def flags_view(seed: DataFrame) -> DataFrame:
    """Flag lookups are exposed unchanged (a view, ``SELECT *``)."""
    return seed.select("*")
