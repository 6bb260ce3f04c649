"""Raw layer: parse landed lines into string columns, exactly as the readers do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeweave.plans import bindings
from lakeweave.plans.layouts import CODE_NAME_REGEXP, INVENTORY_LAYOUT, STATION_LAYOUT
from lakeweave.sources.files import read_layout_lines


def parse_code_name(lines: DataFrame) -> DataFrame:
    """``^(.{2}) (.+)$`` -> (code, name); a non-matching line fails the job."""
    pattern = "'" + CODE_NAME_REGEXP.replace("\\", "\\\\").replace("'", "\\'") + "'"
    guarded = (
        f"CASE WHEN line RLIKE {pattern} THEN line "
        f"ELSE raise_error(concat('line does not match regexp: ', line)) END"
    )
    return lines.selectExpr(
        f"regexp_extract({guarded}, {pattern}, 1) AS code",
        f"regexp_extract({guarded}, {pattern}, 2) AS name",
    )


class RawTables:
    """The five raw inputs for one table directory, built lazily on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._obs = None

    def countries(self) -> DataFrame:
        return parse_code_name(bindings.country_lines(self.spark, self.sf_dir))

    def states(self) -> DataFrame:
        return parse_code_name(bindings.state_lines(self.spark, self.sf_dir))

    def stations(self) -> DataFrame:
        return read_layout_lines(bindings.station_lines(self.spark, self.sf_dir), STATION_LAYOUT)

    def observations(self) -> DataFrame:
        if self._obs is None:
            self._obs = bindings.raw_observations(self.spark, self.sf_dir)
        return self._obs

    def inventory(self) -> DataFrame:
        return read_layout_lines(bindings.inventory_lines(self.observations()), INVENTORY_LAYOUT)
