"""Text feeds: CSV folders whose headers drift from file to file, projected early."""

from __future__ import annotations

import csv
import itertools
import logging
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomesh.functions import geometry as g
from velomesh.functions.parsing import parse_sampling_time
from velomesh.operators.history import thin_runs
from velomesh.session import checkpointed

# The columns kept of the two station feeds and the schemas of the open-data files.
INFORMATION_COLUMNS = ("station_id", "name", "lat", "lon", "altitude", "capacity", "last_updated")
STATUS_COLUMNS = ("station_id", "num_bikes_available", "num_bikes_available_types.mechanical",
                  "num_bikes_available_types.ebike", "num_docks_available", "last_reported", "status",
                  "last_updated")
TIME_COLUMNS = ("last_updated", "last_reported")
POPULATION_SCHEMA = T.StructType([
    T.StructField("data_referencia", T.StringType()), T.StructField("codi_districte", T.StringType()),
    T.StructField("nom_districte", T.StringType()), T.StructField("codi_barri", T.StringType()),
    T.StructField("nom_barri", T.StringType()), T.StructField("aeb", T.StringType()),
    T.StructField("seccio_censal", T.StringType()), T.StructField("valor", T.LongType())])
INCOME_SCHEMA = T.StructType([
    T.StructField("any", T.StringType()), T.StructField("codi_districte", T.IntegerType()),
    T.StructField("nom_districte", T.StringType()), T.StructField("codi_barri", T.IntegerType()),
    T.StructField("nom_barri", T.StringType()), T.StructField("seccio_censal", T.IntegerType()),
    T.StructField("import_euros", T.DoubleType())])


ORIGIN = ["file_path", "block_start", "line_no"]


def file_lines(spark: SparkSession, paths: Sequence[str] | str, pattern: str = "*.csv",
               years: Sequence[int] | None = None) -> DataFrame:
    """(value, file_path, block_start, line_no) of all text lines of the matching files.

    ``years`` keeps files whose name, folders aside, holds one of them. Lines of one file lie in the order
    (block_start, line_no). Empty lines count, since a quoted value may hold some.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(paths)
             .select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("_name"),
                     F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("line_no")))
    if years:
        lines = lines.where(" OR ".join(f"contains(_name, '{int(y)}')" for y in years))
    return lines.drop("_name")


# A value that begins with a quote runs to the next single one; a quote further on in a value is just a character.
_QUOTED, _PLAIN = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+', r'[^",][^,]*+'
_FIELD = rf'(?:{_QUOTED}|{_PLAIN}|(?=,|$))'
_MORE = rf'(?:,{_FIELD})*+'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+$'
_OUTSIDE = rf'^(?:{_OPEN}|{_FIELD}{_MORE},{_OPEN})'
_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+(?:$|"(?!")[^,]*+{_MORE}(?:,{_OPEN}))'


def _quote_steps(lines: DataFrame) -> DataFrame:
    """Add what a line does to the state "inside quotes": ``_const`` sets it, ``_toggle`` turns it; most lines do neither."""
    quoted = F.contains("value", F.lit('"'))
    out, into = quoted & F.col("value").rlike(_OUTSIDE), ~quoted | F.col("value").rlike(_INSIDE)
    return lines.withColumns({"_const": F.when(out == into, out), "_toggle": (out & ~into).cast("int")})


def _state(start: Column, window: WindowSpec) -> Column:
    """Whether a text is inside quotes after the steps of ``window``, which begin in state ``start``."""
    turns = F.sum("_toggle").over(window)
    # the last line that sets the state, and the turns up to it
    last = F.last(F.when(F.col("_const").isNotNull(), F.struct(F.col("_const").alias("value"), F.col("_turns").alias("turns"))),
                  ignorenulls=True).over(window)
    return F.when(last.isNull(), start != (turns % 2 == 1)).otherwise(last["value"] != ((turns - last["turns"]) % 2 == 1))


def whole_records(lines: DataFrame) -> DataFrame:
    """Lines put together into records whose quoted values may hold line breaks: as ``file_lines``, one row a record.

    Lines of one block are walked in order; between blocks only what a block does to the state travels, one row per
    block, so a file of any size is read by many tasks. A record keeps the place of its first line.
    """
    lines = checkpointed(_quote_steps(lines))
    block, file = Window.partitionBy("file_path", "block_start"), Window.partitionBy("file_path").orderBy("block_start")
    inner, upto = block.orderBy("line_no"), (Window.unboundedPreceding, -1)
    lines = checkpointed(lines.withColumn("_turns", F.sum("_toggle").over(inner)))
    steps = lines.groupBy("file_path", "block_start").agg(
        F.max_by(F.struct(F.col("_const").alias("value"), F.col("_turns").alias("turns")),
                 F.when(F.col("_const").isNotNull(), F.col("line_no"))).alias("last"), F.sum("_toggle").alias("_all"))
    left = F.col("_all") - F.coalesce(F.col("last.turns"), F.lit(0))
    steps = steps.select("file_path", "block_start", F.when(F.col("last").isNotNull(), F.col("last.value") != (left % 2 == 1)).alias("_const"),
                         F.when(F.col("last").isNull(), F.col("_all") % 2).otherwise(0).alias("_toggle"))
    steps = steps.withColumn("_turns", F.sum("_toggle").over(file)).withColumn("_after", _state(F.lit(False), file))
    starts = steps.select("file_path", "block_start", F.lag("_after", 1, False).over(file).alias("_start"))
    ended = checkpointed(lines.join(starts, ["file_path", "block_start"])
                         .withColumn("_ends", (~_state(F.col("_start"), inner)).cast("int")).drop("_const", "_toggle", "_turns", "_start"))
    done = ended.groupBy("file_path", "block_start").agg(F.sum("_ends").alias("_n"))
    done = done.select("file_path", "block_start", F.coalesce(F.sum("_n").over(file.rowsBetween(*upto)), F.lit(0)).alias("_before"))
    record = F.col("_before") + F.coalesce(F.sum("_ends").over(inner.rowsBetween(*upto)), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("block_start", "line_no", "value")))
    return (ended.join(done, ["file_path", "block_start"]).withColumn("_record", record)
            .groupBy("file_path", "_record").agg(parts.alias("p"))
            .select(F.array_join(F.transform("p", lambda r: r["value"]), "\n").alias("value"), "file_path",
                    F.col("p")[0]["block_start"].alias("block_start"), F.col("p")[0]["line_no"].alias("line_no")))


def _cells(value: Column, width: int) -> Column:
    """The values of a record as an array; NULL beyond its end."""
    names = [f"c{k}" for k in range(width)]
    return g.bind(F.from_csv(value, ", ".join(f"{n} string" for n in names), {"escape": '"'}),
                  lambda r: F.array(*[r[n] for n in names]))


def scan_csv_union(spark: SparkSession, paths: Sequence[str] | str, lower: bool = False, pattern: str = "*.csv",
                   years: Sequence[int] | None = None, thinning: bool = False) -> DataFrame:
    """All files as one all-text table, columns matched by name and sorted, absent ones NULL.

    A first pass finds each file's header and whether quotes ever stay open at the end of a line; one row per file, of
    which the different headers and the names of files with open quotes come to the driver. A second pass parses
    every record once, whatever its header, and picks the cells by the places its file's header gives them. Only
    files with open quotes are put together from lines first; of those, a break inside a value becomes a line feed.

    ``file_path``, ``block_start`` and ``line_no`` keep the file order available downstream. With ``thinning``
    the columns ``thin_station`` and ``thin_time`` hold what thinning goes by: the station and the last time column,
    NULL in files that have none.
    """
    lines = file_lines(spark, paths, pattern, years)
    first = F.when((F.length("value") > 0) & (F.col("block_start") == 0), F.struct("line_no", "value"))
    files = checkpointed(_quote_steps(lines).groupBy("file_path").agg(
        F.min(first).alias("_first"), F.max(F.col("_const").isNotNull() | (F.col("_toggle") == 1)).alias("_ragged"))
        .where(F.col("_first").isNotNull()).select("file_path", F.col("_first.value").alias("_header"),
                                                   F.col("_first.line_no").alias("_head_no"), "_ragged"))
    ragged = [r.file_path for r in files.where("_ragged").select("file_path").collect()]
    body = lines
    if ragged:
        # paths are given as they are, so characters that patterns use are escaped
        named = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in ragged]
        records = checkpointed(whole_records(file_lines(spark, named, "*")).where(F.length("value") > 0))
        heads = records.groupBy("file_path").agg(F.min(F.struct("block_start", "line_no", "value")).alias("h")).select(
            "file_path", F.col("h.value").alias("_header"), F.col("h.line_no").alias("_head_no"), F.lit(True).alias("_ragged"))
        even = files.where("NOT _ragged")
        files = checkpointed(even.unionByName(heads))
        body = lines.join(even.select("file_path"), "file_path", "left_semi").unionByName(records)
    headers = [next(csv.reader([row["_header"]])) for row in files.select("_header").distinct().orderBy("_header").collect()]
    if not headers:
        return lines.select(*ORIGIN).where("false")
    # names that differ in case only are one column, as everywhere in Spark unless it is told otherwise
    exact = spark.conf.get("spark.sql.caseSensitive") == "true" and not lower
    columns: dict[str, str] = {}
    for column in itertools.chain(*headers):
        columns.setdefault(column if exact else column.lower(), column.lower() if lower else column)
    width = max(map(len, headers))
    head = _cells(F.col("_header"), width)
    low = F.transform(head, F.lower)
    times = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.get(low, i).isin(*TIME_COLUMNS))
    files = files.select("file_path", "_head_no", F.transform(F.array(*map(F.lit, columns)), lambda c: F.array_position(
        head if exact else low, c).cast("int") - 1).alias("_at"), (F.array_position(low, "station_id").cast("int") - 1).alias("_station"),
        F.array_max(times).alias("_time"))
    # a place of -1 is a column that the file lacks
    cell = lambda at: F.when(at >= 0, F.get("_r", at))
    parsed = (body.where(F.length("value") > 0).join(files, "file_path").where("line_no <> _head_no")
              .withColumn("_r", _cells(F.col("value"), width)))
    found = [cell(F.col("_at")[k]).alias(c) for k, c in enumerate(columns.values())]
    if thinning:
        found += [cell(F.col("_station")).alias("thin_station"), cell(F.col("_time")).alias("thin_time")]
    merged = parsed.select(*found, *ORIGIN)
    return merged.select(*[F.col(f"`{c}`") for c in sorted(set(merged.columns) - set(ORIGIN))], *ORIGIN)


def scan_csv_folder(spark: SparkSession, folder: str, years: Sequence[int] | None = None) -> DataFrame:
    return scan_csv_union(spark, folder, years=years)


def thin_files(spark: SparkSession, folder: str, kind: str = "status", years: Sequence[int] | None = None) -> DataFrame:
    """The rows of a CSV folder that thinning keeps: one per station and ten minutes (``status``) or hour (``information``).

    Runs follow the order of the lines, file by file; rows without a time or a station are kept.
    """
    rows = scan_csv_union(spark, folder, years=years, thinning=True)
    timed = rows.withColumn("_ts", parse_sampling_time(F.col("thin_time")))
    every = {"status": 600, "information": 3600}[kind]
    kept = thin_runs(timed, "thin_station", "_ts", ["line_no"], "block_start", "file_path", every)
    return kept.drop("_ts", "thin_station", "thin_time")


def project(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Listed columns in fixed order; one the input lacks becomes a NULL column and is reported."""
    have = set(df.columns)
    lacking = [c for c in columns if c not in have]
    if lacking:
        logging.getLogger(__name__).warning("missing columns: %s", ", ".join(lacking))
    return df.select(*[F.col(f"`{c}`").alias(c) if c in have else F.lit(None).cast("string").alias(c)
                       for c in columns], *extra)


def scan_population(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Population files with their fixed schema; header names are lower-cased by the schema."""
    return (spark.read.schema(POPULATION_SCHEMA).option("header", "true").option("pathGlobFilter", "*.csv")
            .csv(paths))


def scan_income(spark: SparkSession, folder: str, pattern: str = "income_*.csv") -> DataFrame:
    """Income files; a bare year in ``any`` becomes the first of January."""
    raw = (spark.read.schema(INCOME_SCHEMA).option("header", "true")
           .option("pathGlobFilter", pattern).csv(folder))
    year = F.left(F.trim("any"), F.lit(4)).try_cast("int")
    return raw.withColumn("any", F.when(F.length(F.trim("any")) == 4, F.make_date(year, F.lit(1), F.lit(1)))
                          .otherwise(F.try_to_date("any")))


def normalised(df: DataFrame, casts: Mapping[str, str] | None = None,
               renames: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case names, then renames, then type casts that turn bad text into NULL."""
    out = df.toDF(*[c.lower() for c in df.columns]).withColumnsRenamed(dict(renames or {}))
    return out.withColumns({c: F.col(c).try_cast(t) for c, t in (casts or {}).items()})
