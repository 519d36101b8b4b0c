"""Location and calendar dimensions, population and income facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.operators import dims
from velomesh.operators.skew import unbroadcast


def dim_location(tracts: DataFrame, neighbourhoods: DataFrame, districts: DataFrame) -> DataFrame:
    n = neighbourhoods.select("districte", "barri", F.col("nom").alias("neighbourhood_name"))
    d = districts.select("districte", F.col("nom").alias("district_name"))
    return tracts.join(unbroadcast(n), ["districte", "barri"]).join(d, "districte").select(
        F.col("sec_cens").alias("census_tract_id"), F.col("area").alias("census_tract_area"),
        F.col("barri").alias("neighbourhood_code"), "neighbourhood_name",
        F.col("districte").alias("district_code"), "district_name", "geometry")


def population_dates(population: DataFrame) -> DataFrame:
    return population.select(F.try_to_date("data_referencia", "yyyy-MM-dd").alias("ts")).distinct()


def calendar_from_population(population: DataFrame) -> dict[str, DataFrame]:
    days = population_dates(population).where(F.col("ts").isNotNull())
    return {"dim_year": dims.year_dim(days), "dim_month": dims.month_dim(days), "dim_day": dims.day_dim(days)}


def fact_population_income(population: DataFrame, location: DataFrame, years: DataFrame, income: DataFrame) -> DataFrame:
    """One row per (tract, year): largest reported population and income, income where known.

    Both sides shrink to one row per key before they meet; a maximum does not change by that.
    """
    keyed = population.select(F.col("seccio_censal").alias("census_tract_id"),
                              F.year(F.try_to_date("data_referencia", "yyyy-MM-dd")).alias("year"), "valor")
    people = keyed.groupBy("census_tract_id", "year").agg(F.max("valor").alias("population"))
    people = dims.valid_keys(people, unbroadcast(location), ["census_tract_id"])
    people = dims.valid_keys(people, years, ["year"])
    earned = income.groupBy(F.col("seccio_censal").alias("census_tract_id"), F.year("any").alias("year")).agg(
        F.max("import_euros").alias("income_euros"), F.max("income_norm").alias("income_normalized"))
    return people.join(unbroadcast(earned), ["census_tract_id", "year"], "left")


def averages(fact: DataFrame, location: DataFrame, by_year: bool = False) -> DataFrame:
    """Average population and income per district, per year if asked."""
    keys = [F.col("district_name").alias("district"), *([F.col("year")] if by_year else [])]
    return (fact.join(unbroadcast(location.select("census_tract_id", "district_name")), "census_tract_id")
            .groupBy(*keys).agg(F.avg("population").alias("avg_population"), F.avg("income_euros").alias("avg_income")))
