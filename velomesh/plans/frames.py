"""Tables behind the maps: area outlines and values per time step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.functions import calendar as cal, geodesy
from velomesh.operators.asof import STEPS_PER_DAY, nearest_time_join
from velomesh.operators.dissolve import dissolve, simplify
from velomesh.operators.history import even_sample


def merged_areas(location: DataFrame, level: str = "neighbourhood") -> DataFrame:
    """(code, name, part_id, geometry): merged outlines per area."""
    keys = [f"{level}_code", f"{level}_name"]
    return dissolve(location.select(*keys, "geometry"), keys)


def area_shapes(location: DataFrame, level: str = "neighbourhood", tolerance: float | None = 0.0001,
                target_crs: int = geodesy.WGS84, merged: DataFrame | None = None) -> DataFrame:
    """(code, name, part_id, geometry): merged and simplified outlines per area; ``merged`` where several are drawn of one merging."""
    keys = [f"{level}_code", f"{level}_name"]
    parts = merged_areas(location, level) if merged is None else merged
    if tolerance is not None:
        parts = simplify(parts, [*keys, "part_id"], tolerance=tolerance)
    return parts.withColumn("geometry", geodesy.reproject_polygon(F.col("geometry"), geodesy.WGS84, target_crs))


def with_frame_times(view: DataFrame, ts: str = "ten_min_datetime") -> DataFrame:
    return view.withColumns({"date": F.to_date(ts), "time": cal.clock_label(F.col(ts)),
                             "hour_float": cal.hour_fraction(F.col(ts)), "label": cal.ordinal_date_label(F.col(ts))})


def slider_frames(view: DataFrame, area: str = "neighbourhood_code") -> DataFrame:
    """Values per date, ten-minute step and area, from the nearest reading in time."""
    rows = nearest_time_join(view, area, "ten_min_datetime", "avg_bike_availability")
    return rows.withColumn("hour_float", F.col("step") * (24.0 / (STEPS_PER_DAY - 1)))


def frame_at(shapes: DataFrame, view: DataFrame, moment: str, keys: list[str]) -> DataFrame:
    """Every area outline with its values at one ten-minute stamp; areas without values stay."""
    values = view.where(F.col("ten_min_datetime") == F.lit(moment).cast("timestamp_ntz"))
    return shapes.join(values, keys, "left")


def animation_frames(view: DataFrame, per_day: int = 32) -> DataFrame:
    """Rows of the view at the evenly spaced stamps of each day."""
    stamps = even_sample(view, "ten_min_datetime", per_day)
    return view.join(stamps.select("ten_min_datetime"), "ten_min_datetime", "left_semi")
