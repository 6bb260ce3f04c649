"""The declared checks of the weather models (34: 21 not_null, 9 unique,
3 relationships, 1 composite uniqueness)."""

from __future__ import annotations

from lakeweave.operators.quality import Check


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, "not_null", (c,)) for c in cols]


def _uq(model: str, *cols: str) -> list[Check]:
    return [Check(model, "unique", (c,)) for c in cols]


def _rel(model: str, col: str, to_model: str, to_col: str) -> Check:
    return Check(model, "relationships", (col,), to_model, to_col)


# The checks declared next to the models (model, column, test).
DECLARED_CHECKS: list[Check] = [
    # cleansed
    *_nn("cleansed.countries", "id"), *_uq("cleansed.countries", "id"),
    *_nn("cleansed.states", "id"), *_uq("cleansed.states", "id"),
    *_nn("cleansed.stations", "id"), *_uq("cleansed.stations", "id"),
    _rel("cleansed.stations", "country_id", "cleansed.countries", "id"),
    *_nn("cleansed.inventory", "station_id"),
    _rel("cleansed.inventory", "station_id", "cleansed.stations", "id"),
    *_nn("cleansed.inventory", "element"),
    *_nn("cleansed.observations", "station_id"),
    _rel("cleansed.observations", "station_id", "cleansed.stations", "id"),
    *_nn("cleansed.observations", "observation_date", "measure"),
    # curated
    *_nn("curated.stations", "id"), *_uq("curated.stations", "id"),
    *_nn("curated.observations", "station_id", "measure"),
    *_nn("curated.station_year", "station_id"),
    Check("curated.station_year", "unique_combination", ("observation_year", "station_id")),
    # reporting
    *_nn("reporting.country_year", "observation_year", "country_id"),
    *_nn("reporting.global_year", "observation_year"), *_uq("reporting.global_year", "observation_year"),
    *_nn("reporting.snow_cold", "observation_year", "country_id"),
    *_nn("reporting.station_coverage", "country_id"), *_uq("reporting.station_coverage", "country_id"),
    # seeds
    *_nn("raw.measurement_flags", "id"), *_uq("raw.measurement_flags", "id"),
    *_nn("raw.quality_flags", "id"), *_uq("raw.quality_flags", "id"),
    *_nn("raw.source_flags", "id"), *_uq("raw.source_flags", "id"),
]
