"""Long-form grids: rows of ``variable, lon, lat, time_hours, value`` (lon 0..360)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.functions import clock, moisture
from gapweave.operators.reshape import to_wide

# The station's grid cell and how close a cell centre must be.
CELL_LON, CELL_LAT, CELL_TOLERANCE = -51.5, -1.75, 0.1


def near(lon: float = CELL_LON, lat: float = CELL_LAT, tolerance: float = CELL_TOLERANCE) -> Column:
    """Cell test on the stored columns against constants, so it reaches the scan.

    ``lon`` is counted -180..180; the stored longitude 0..360.
    """
    east = lon + moisture.FULL_CIRCLE_DEG if lon < 0 else lon

    def close(name: str, value: float) -> Column:
        return (F.col(name) > value - tolerance) & (F.col(name) < value + tolerance)

    return close("lon", east) & close("lat", lat)


def select_cell(grid: DataFrame, lon: float = CELL_LON, lat: float = CELL_LAT,
                tolerance: float = CELL_TOLERANCE) -> DataFrame:
    """Series of one cell, longitude signed, UTC and station clock side by side."""
    time_utc = clock.from_grid_hours(F.col("time_hours"), F.col("lead_hours") if "lead_hours" in grid.columns else None)
    signed = F.when(F.col("lon") > 180, moisture.signed_longitude(F.col("lon"))).otherwise(F.col("lon"))
    cell = grid.where(near(lon, lat, tolerance))
    return cell.withColumns({"lon": signed, "time_utc": time_utc, "time_local": clock.to_local(time_utc)})


def exact_cell(grid: DataFrame, lon: float = CELL_LON, lat: float = CELL_LAT) -> DataFrame:
    east = lon + moisture.FULL_CIRCLE_DEG if lon < 0 else lon
    return grid.where((F.col("lon") == east) & (F.col("lat") == lat))


def variables_side_by_side(cell: DataFrame, variables: Sequence[str], time: str = "time_utc") -> DataFrame:
    """One row per cell and time, one column per variable."""
    return to_wide(cell, ["lon", "lat", time], "variable", variables, "value")


def spatial_mean(grid: DataFrame) -> DataFrame:
    return grid.groupBy("variable", "lon", "lat").agg(F.avg("value").alias("val"), F.count(F.lit(1)).alias("n"))


def areal_mean(grid: DataFrame) -> DataFrame:
    return grid.groupBy("variable", "time_hours").agg(F.avg("value").alias("val"), F.count(F.lit(1)).alias("n_cells"))


def lead_means(grid: DataFrame, by: str = "lead_hours") -> DataFrame:
    return grid.groupBy("variable", by).agg(F.avg("value").alias("val"), F.sum("value").alias("total"),
                                            F.count(F.lit(1)).alias("n"))
