"""Scores, percentages, bins and classes computed on one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names and limits of the published indicators.
EQUITY_BAND = 0.1
FAIR = "Fair Distribution"
UNDERSERVED = "Potential Underservice"
PRIVILEGED = "Privileged Access"
GOOD_LOW_INCOME = "Good Service Despite Low Income"
POOR_HIGH_INCOME = "Poor Service Despite High Income"
MODERATE = "Moderate Distribution"
DISTANCE_BINS_M = ((1000, "0-1km"), (2000, "1-2km"), (3000, "2-3km"), (4000, "3-4km"), (5000, "4-5km"))
DISTANCE_BEYOND = "5km+"
FILL_LIMITS = ((0.2, "Low availability"), (0.5, "Medium availability"))
FILL_ELSE = "Good availability"


def share_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; zero where the whole is zero, negative or NULL."""
    return F.when(whole > 0, F.try_divide(part.cast("double"), whole) * 100).otherwise(F.lit(0.0))


def availability_pct(bikes: Column, docks: Column) -> Column:
    return share_or_zero(bikes, bikes + docks)


def safe_ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def min_max(value: Column, low: Column, high: Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(value - low, high - low), digits)


def accessibility(metres: Column) -> Column:
    """1 at zero distance, falling with kilometres; 0 when there is nothing to reach."""
    return F.when(metres.isNull(), F.lit(0.0)).otherwise(1.0 / (1.0 + metres / 1000.0))


def equity_class(income: Column, city_income: Column, service: Column, city_service: Column) -> Column:
    low, high = 1 - EQUITY_BAND, 1 + EQUITY_BAND

    def inside(v, ref):
        return v.between(ref * low, ref * high)

    def below(v, ref):
        return v < ref * low

    def above(v, ref):
        return v > ref * high

    poor, rich = below(income, city_income), above(income, city_income)
    scarce, ample = below(service, city_service), above(service, city_service)
    return (F.when(inside(income, city_income) & inside(service, city_service), FAIR)
            .when(poor & scarce, UNDERSERVED).when(rich & ample, PRIVILEGED)
            .when(poor & ample, GOOD_LOW_INCOME).when(rich & scarce, POOR_HIGH_INCOME)
            .otherwise(MODERATE))


def usage_rate(bikes: Column, capacity: Column) -> Column:
    return F.try_divide(bikes.cast("double"), capacity.cast("double")) * 100


def fill_status(bikes: Column, capacity: Column) -> Column:
    ratio = F.when(capacity > 0, F.try_divide(bikes.cast("double"), capacity)).otherwise(F.lit(0.0))
    chain = F
    for limit, label in FILL_LIMITS:
        chain = chain.when(ratio < limit, label)
    return chain.otherwise(FILL_ELSE)


def distance_bin(metres: Column) -> Column:
    """Right-closed kilometre bins; exactly zero falls outside every bin."""
    chain = F.when(metres.isNull() | (metres <= 0), F.lit(None).cast("string"))
    for limit, label in DISTANCE_BINS_M:
        chain = chain.when(metres <= limit, label)
    return chain.otherwise(DISTANCE_BEYOND)


def thousands(c: Column) -> Column:
    """Grouped digits, all decimals kept: ``1234567.5`` becomes ``1,234,567.5``."""
    return F.call_function("format_number", c.cast("double"), F.lit("#,##0.0##############"))


def quote_escape(c: Column) -> Column:
    """Backslash before every single quote, for keys embedded in scripts."""
    return F.replace(c, F.lit("'"), F.lit("\\'"))
