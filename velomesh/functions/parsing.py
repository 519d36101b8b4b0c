"""Guarded parsing of raw text columns (all raw feeds arrive as text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns of the raw feeds and the labels derived from them.
MISSING_TEXT = "NA"
DECIMAL_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
COUNT_PATTERN = r"^[0-9]+$"
COMPACT_DATE_PATTERN = r"^[0-9]{8}$"
EPOCH_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
TIMESTAMP_FORMATS = (
    (r"^[0-9-]+T[0-9:]+\.[0-9]+Z$", "yyyy-M-d'T'H:m:s.SSSSSS'Z'"),
    (r"^[0-9-]+T[0-9:]+Z$", "yyyy-M-d'T'H:m:s'Z'"),
    (r"^[0-9-]+ [0-9:]+$", "yyyy-M-d H:m:s"),
    (r"^[0-9-]+ [0-9:]+\.[0-9]+$", "yyyy-M-d H:m:s.SSSSSS"),
    (r"^[0-9/]+ [0-9:]+$", "d/M/yyyy H:m"),
)
LANE_TYPE_WORDS = (("bidireccional", "bidirectional"), ("unidireccional", "unidirectional"))
LANE_TYPE_OTHER = "unknown"
LANE_PREFIX_PATTERN = r"^(.*?)Carril bici (?:uni|bi)direccional "


def na_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(MISSING_TEXT))


def is_present(c: Column) -> Column:
    """Row filter: the text is there and is not the missing marker."""
    return c.isNotNull() & (c != MISSING_TEXT)


def guarded_decimal(c: Column) -> Column:
    """Plain decimal text to double; anything else, ``1e3`` included, is NULL."""
    return F.when(c.rlike(DECIMAL_PATTERN), c.try_cast("double"))


def guarded_int(c: Column) -> Column:
    """Unsigned integer text to int; negatives and overflow are NULL."""
    return F.when(c.rlike(COUNT_PATTERN), c.try_cast("int"))


def parse_instant(c: Column) -> Column:
    """Epoch seconds (scientific notation too) or timestamp text, decided row by row."""
    epoch = F.round(c.try_cast("decimal(20,3)"), 0).try_cast("bigint")
    return F.coalesce(F.timestamp_seconds(epoch), F.try_to_timestamp(c)).cast("timestamp_ntz")


def parse_sampling_time(c: Column) -> Column:
    """Integer epoch, else the first of five text formats that fits, else NULL."""
    epoch = F.when(c.rlike(EPOCH_PATTERN), F.timestamp_seconds(F.trim(c).try_cast("bigint")))
    # The shape is tested first: a failed parse costs far more than a regular expression.
    texts = [F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(fmt))) for shape, fmt in TIMESTAMP_FORMATS]
    return F.coalesce(epoch, *texts).cast("timestamp_ntz")


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` text to date; impossible dates are NULL."""
    return F.when(c.rlike(COMPACT_DATE_PATTERN), F.try_to_date(c, "yyyyMMdd"))


def lane_type(description: Column) -> Column:
    branches = [(description.contains(word), label) for word, label in LANE_TYPE_WORDS]
    chain = reduce(lambda acc, b: acc.when(b[0], b[1]), branches, F)
    return chain.otherwise(LANE_TYPE_OTHER)


def lane_location(description: Column) -> Column:
    """Text left after dropping the first lane-type phrase, then a leading dash."""
    # The lazy anchored group makes the replacement hit the first phrase only.
    rest = F.regexp_replace(description, LANE_PREFIX_PATTERN, "$1")
    return F.regexp_replace(rest, "^- ", "")


def tract_code_from_boundary(district: Column, section: Column) -> Column:
    return F.concat(F.ltrim(district, F.lit("0")), section).try_cast("bigint")


def tract_code_from_income(district: Column, section: Column, width: int = 3) -> Column:
    """District number followed by the section padded (and cut, as LPAD does) to ``width`` digits."""
    return F.concat(district.try_cast("int").cast("string"),
                    F.lpad(section.try_cast("int").cast("string"), width, "0")).try_cast("bigint")


def padded_code(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def square_km(square_metres: Column) -> Column:
    return square_metres / F.lit(1e6)


def first_token(c: Column, separator: str = "/") -> Column:
    return F.split_part(c, F.lit(separator), F.lit(1))
