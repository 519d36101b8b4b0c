"""Raw text feeds to typed clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.functions import geodesy, measures, parsing as p
from velomesh.operators.impute import impute
from velomesh.operators.quality import value_counts

INFORMATION_IMPUTED = {"altitude": "median", "capacity": "mode"}
STATUS_IMPUTED = {"num_bikes_available": "median", "mechanical_bikes": "median", "ebikes": "median",
                  "num_docks_available": "median"}
# The imputation of lanes starts when any of these misses too much.
LANE_GATE = ("lane_type", "location", "data_date")


def typed_station_information(raw: DataFrame) -> DataFrame:
    return raw.where(p.is_present(F.col("last_updated"))).select(
        F.col("station_id").try_cast("int").alias("station_id"), "name",
        p.guarded_decimal(F.col("lat")).alias("lat"), p.guarded_decimal(F.col("lon")).alias("lon"),
        p.guarded_decimal(F.col("altitude")).alias("altitude"), p.guarded_int(F.col("capacity")).alias("capacity"),
        p.parse_instant(F.col("last_updated")).alias("last_updated"))


def typed_station_status(raw: DataFrame) -> DataFrame:
    def count(column, name):
        return p.guarded_int(F.col(f"`{column}`")).alias(name)
    return raw.where(p.is_present(F.col("last_updated"))).select(
        F.col("station_id").try_cast("int").alias("station_id"),
        count("num_bikes_available", "num_bikes_available"),
        count("num_bikes_available_types.mechanical", "mechanical_bikes"),
        count("num_bikes_available_types.ebike", "ebikes"),
        count("num_docks_available", "num_docks_available"),
        p.parse_instant(F.col("last_reported")).alias("last_reported"),
        p.na_to_null(F.col("status")).alias("status"),
        p.parse_instant(F.col("last_updated")).alias("last_updated"))


def clean_station_information(raw: DataFrame, threshold_pct: float | None = 0.1) -> DataFrame:
    return impute(typed_station_information(raw), ["station_id"], INFORMATION_IMPUTED, threshold_pct)


def clean_station_status(raw: DataFrame, threshold_pct: float | None = 0.1) -> DataFrame:
    """Counts become double when the imputation runs, since medians can be fractional."""
    return impute(typed_station_status(raw), ["station_id"], STATUS_IMPUTED, threshold_pct)


def typed_lanes(raw: DataFrame) -> DataFrame:
    text = F.col("tooltip")
    return raw.select(
        F.col("mes").try_cast("int").alias("month"), F.col("codi_capa").alias("layer_code"),
        F.col("_any").try_cast("int").alias("year"), F.col("trimestre").alias("trimester"),
        F.col("codi_subca").alias("sublayer_code"), F.col("id").alias("lane_id"), text.alias("description"),
        p.compact_date(F.col("_timestamp")).alias("data_date"), "geometry",
        p.lane_type(text).alias("lane_type"), p.lane_location(text).alias("location"))


def clean_lanes(raw: DataFrame, threshold_pct: float | None = 0.1) -> DataFrame:
    return impute(typed_lanes(raw), ["year", "trimester", "layer_code", "sublayer_code"], {"lane_type": "mode"},
                  threshold_pct, LANE_GATE, default=p.LANE_TYPE_OTHER)


def lane_type_distribution(lanes: DataFrame) -> DataFrame:
    return value_counts(lanes, "lane_type").withColumnsRenamed({"value": "lane_type", "n_rows": "n_lanes"})


def clean_income(raw: DataFrame, section_width: int = 3) -> DataFrame:
    """Tract code and income scaled to 0..1 over the whole table, all years together.

    The neighbourhood's number, where the files have one, becomes its code of two digits.
    """
    euros = F.col("import_euros").try_cast("double")
    span = raw.agg(F.struct(F.min(euros).alias("lo"), F.max(euros).alias("hi"))).scalar()
    places = [p.padded_code(F.col("codi_barri").try_cast("int"), 2).alias("codi_barri")] if "codi_barri" in raw.columns else []
    coded = raw.select("any", *places, p.tract_code_from_income(F.col("codi_districte"), F.col("seccio_censal"),
                                                       section_width).alias("seccio_censal"), euros.alias("import_euros")).withColumn("_s", span)
    return coded.withColumn("income_norm", measures.min_max(
        F.col("import_euros"), F.col("_s.lo"), F.col("_s.hi")).cast("decimal(18,6)")).drop("_s")


def clean_population(raw: DataFrame) -> DataFrame:
    return raw.select("data_referencia", F.col("seccio_censal").try_cast("bigint").alias("seccio_censal"),
                      F.col("valor").try_cast("bigint").alias("valor"))


# Columns kept per boundary level.
BOUNDARY_COLUMNS = {"districts": ("districte", "nom"), "neighbourhoods": ("districte", "barri", "nom"),
                    "census_tracts": ("districte", "barri", "sec_cens")}


def clean_boundaries(layer: DataFrame, level: str, source_crs: int = geodesy.WGS84) -> DataFrame:
    """Kept columns, square kilometres, longitude/latitude; tracts get their composite code."""
    out = layer.toDF(*[c.lower() for c in layer.columns])
    out = out.select(*BOUNDARY_COLUMNS[level], p.square_km(F.col("area").try_cast("double")).alias("area"),
                     geodesy.reproject_polygon(F.col("geometry"), source_crs, geodesy.WGS84).alias("geometry"))
    if level == "census_tracts":
        out = out.withColumn("sec_cens", p.tract_code_from_boundary(F.col("districte"), F.col("sec_cens")))
    return out
