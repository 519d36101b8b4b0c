"""Scans, parsing and cleaning over the derived raw feeds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomesh.functions import calendar as cal, geodesy, measures, parsing as p
from velomesh.operators import dims, quality
from velomesh.operators.history import thin_runs, thinning_report
from velomesh.operators.stats import union_all
from velomesh.plans import cleaning
from velomesh.session import shared_folder
from velomesh.sources import layers, snapshots, tables, tabular
from velomesh.workload import views as v
from velomesh.workload.registry import register, rounded

DAY, SECOND = "'%Y-%m-%d'", "'%Y-%m-%d %H:%M:%S'"


@register("drifting_csv_union", "S1 S2 U2", """
SELECT event_id, station_id, docks AS num_docks_available, CASE WHEN event_id % 2 = 0 THEN status END AS status,
  CASE WHEN event_id % 2 = 1 THEN last_reported END AS last_reported FROM raw_status""")
def drifting_csv_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV generations with different headers, read back as one all-text table."""
    base = shared_folder(spark, "feed")
    raw = v.raw_status(spark, folder).select("event_id", "station_id", "num_docks_available", "status", "last_reported")
    raw.where("event_id % 2 = 0").drop("last_reported").write.option("header", "true").csv(f"{base}/first")
    raw.where("event_id % 2 = 1").drop("status").select(
        "num_docks_available", "last_reported", "event_id", "station_id").write.option("header", "true").csv(f"{base}/second")
    return (tabular.scan_csv_folder(spark, base).drop("file_path", "block_start", "line_no")
            .withColumn("event_id", F.col("event_id").cast("bigint")))


def _named(spark: SparkSession, folder: str, name: str) -> None:
    """Put ``name`` before the names of the files written to a folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for file in [s.getPath() for s in fs.listStatus(path)]:
        if file.getName().startswith("part-"):
            fs.rename(file, hadoop.Path(path, f"{name}_{file.getName()}"))


@register("csv_of_years", "S1", """
SELECT o_orderkey, station_id, CAST(year(last_updated) AS INTEGER) AS year FROM information WHERE year(last_updated) IN (1996, 1998)""")
def csv_of_years(spark: SparkSession, folder: str) -> DataFrame:
    """One CSV folder, a year in each file's name; two years are read."""
    base = shared_folder(spark, "yearly")
    rows = v.information(spark, folder).select("o_orderkey", "station_id", F.year("last_updated").alias("year"))
    for (year,) in rows.select("year").distinct().collect():
        rows.where(F.col("year") == year).write.option("header", "true").csv(f"{base}/{year % 2}/{year}")
        _named(spark, f"{base}/{year % 2}/{year}", f"{year}_information")
    read = tabular.scan_csv_folder(spark, base, years=[1996, 1998])
    return read.select(F.col("o_orderkey").cast("bigint"), F.col("station_id").cast("int"), F.col("year").cast("int"))


@register("quoted_breaks", "S1 S2 U2", """
SELECT s_suppkey, 'line' || chr(10) || CASE WHEN s_suppkey % 3 = 0 THEN chr(10) || '"' || s_name || '", ' || s_suppkey ELSE s_name END AS note,
  CASE WHEN s_suppkey % 2 = 1 THEN 'inch "' || s_suppkey END AS size, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS nation FROM supplier""")
def quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV generations whose quoted values hold line breaks, empty lines, commas and quotes, as in RFC 4180."""
    base = shared_folder(spark, "notes")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    odd = F.concat(F.lit('\n"'), "s_name", F.lit('", '), F.col("s_suppkey").cast("string"))
    rows = v.table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", F.concat(F.lit("line\n"), F.when(
        F.col("s_suppkey") % 3 == 0, odd).otherwise(F.col("s_name"))).alias("note"))
    text = lambda *parts: F.concat_ws(",", *parts).alias("value")
    key = F.col("s_suppkey").cast("string")
    for name, header, part in (
            ("a", "s_suppkey,note,nation", rows.where("s_suppkey % 2 = 0").select(text(key, quoted("note"), F.col("s_nationkey").cast("string")))),
            ("b", "note,size,s_suppkey", rows.where("s_suppkey % 2 = 1").select(text(quoted("note"), quoted(F.concat(F.lit('inch "'), key)), key)))):
        # one file a generation, the header first
        head = spark.range(1).select(F.lit(header).alias("value"))
        head.unionByName(part).coalesce(1).write.text(f"{base}/{name}")
    read = tabular.scan_csv_union(spark, base, pattern="*.txt")
    return read.select(F.col("s_suppkey").cast("bigint"), "note", "size", F.col("nation").cast("bigint"))


# Files of 2,500 events; every fourth has no station column.
_FILES = """SELECT event_id, event_id // 2500 AS file, CASE WHEN event_id // 2500 % 4 <> 3 THEN user_id % 3 END AS station,
  CASE WHEN event_id % 50 <> 7 THEN time_bucket(INTERVAL '10 minutes', ts) END AS bucket FROM events"""


@register("thinned_files", "W5 S1", f"""
SELECT event_id FROM (SELECT *, lag(bucket) OVER (PARTITION BY file, station ORDER BY event_id) AS before
  FROM ({_FILES}) WHERE bucket IS NOT NULL AND station IS NOT NULL) WHERE before IS NULL OR before <> bucket
UNION ALL SELECT event_id FROM ({_FILES}) WHERE bucket IS NULL OR station IS NULL""")
def thinned_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks written as CSV files, read back and thinned in the order of their lines."""
    base = shared_folder(spark, "ticks")
    rows = v.table(spark, folder, "events").selectExpr(
        "event_id", "user_id % 3 AS station_id", "event_id DIV 2500 AS file",
        "CASE WHEN event_id % 50 = 7 THEN 'unreadable' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS last_updated")
    rows = rows.repartition("file").sortWithinPartitions("file", "event_id")
    rows.where("file % 4 <> 3").write.partitionBy("file").option("header", "true").csv(f"{base}/with")
    rows.where("file % 4 = 3").drop("station_id").write.partitionBy("file").option("header", "true").csv(f"{base}/without")
    return tabular.thin_files(spark, base).select(F.col("event_id").cast("bigint").alias("event_id"))


@register("layer_rejects", "S6", """
SELECT CASE s_suppkey % 4 WHEN 1 THEN 'broken' WHEN 2 THEN 'no geometry' ELSE 'other kind: Point' END AS reason, count(*) AS n_features
FROM supplier WHERE s_suppkey % 4 <> 0 GROUP BY 1""")
def layer_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """A lane layer with broken lines, points and features without geometry: what the scan passes over."""
    base = shared_folder(spark, "rejects")
    v.table(spark, folder, "supplier").selectExpr("""CASE s_suppkey % 4
        WHEN 0 THEN '{"type":"Feature","properties":{"ID":"a"},"geometry":{"type":"LineString","coordinates":[[2,41],[3,42]]}}'
        WHEN 1 THEN '{"type":"Feature","properties":{"ID":"a"},"geo' WHEN 2 THEN '{"type":"Feature","properties":{"ID":"a"}}'
        ELSE '{"type":"Feature","properties":{"ID":"a"},"geometry":{"type":"Point","coordinates":[2,41]}}' END AS value""").write.text(base)
    lost = layers.geojson_rejects(spark, base, "ID string", by_line=True)
    return lost.groupBy("reason").agg(F.sum("n_features").alias("n_features"))


@register("feed_projection", "S3", """
SELECT station_id, name, lat, lon, CAST(NULL AS VARCHAR) AS altitude, capacity, last_updated FROM raw_information""")
def feed_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Seven kept columns in fixed order; altitude is absent from this generation."""
    return tabular.project(v.raw_information(spark, folder).drop("altitude"), tabular.INFORMATION_COLUMNS)


@register("population_scan", "S4 Q5", "SELECT data_referencia, seccio_censal, valor FROM population")
def population_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "population")
    raw = v.raw_population(spark, folder)
    raw.select("data_referencia", *[F.lit(None).cast("string").alias(c) if c not in raw.columns else F.col(c) for c in (
        "codi_districte", "nom_districte", "codi_barri", "nom_barri", "aeb")], "seccio_censal", "valor"
    ).write.option("header", "true").csv(base)
    return cleaning.clean_population(tabular.scan_population(spark, base))


@register("income_scan", "S5 P32", f"""
SELECT strftime("any", {DAY}) AS "any", CAST(seccio_censal // 10000000 AS INTEGER) AS codi_districte,
  CAST(seccio_censal % 10000000 AS INTEGER) AS seccio_censal, import_euros FROM income""")
def income_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "income")
    empty = F.lit(None).cast("string")
    v.raw_income(spark, folder).select(
        F.year("any").alias("any"), "codi_districte", empty.alias("nom_districte"), empty.alias("codi_barri"),
        empty.alias("nom_barri"), "seccio_censal", "import_euros").write.option("header", "true").csv(base)
    return tabular.scan_income(spark, base, "*.csv").select("any", "codi_districte", "seccio_censal", "import_euros")


def _write_geojson(df: DataFrame, properties: list[str], kind: str, path: str, by: list[str] | None = None) -> None:
    def pairs(line):
        return F.transform(line, lambda q: F.array(q["x"], q["y"]))
    coordinates = pairs(F.col("geometry")) if kind == "LineString" else F.transform("geometry", pairs)
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"),
                       F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"))
    df.select(F.to_json(feature).alias("value"), *(by or [])).write.partitionBy(*(by or [])).text(path)


@register("lane_layer_scan", "S6 P32 G17", """
SELECT lane_id AS id, CAST(year AS VARCHAR) AS _any, description AS tooltip, 3 AS num_points,
  round(x0, 9) AS start_x, round(y2, 9) AS end_y FROM lanes""")
def lane_layer_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "lanes")
    raw = v.raw_lanes(spark, folder).withColumnsRenamed({"_any": "Any", "id": "ID"})
    _write_geojson(raw, ["ID", "Any", "tooltip"], "LineString", base)
    layer = layers.scan_geojson(spark, base, "ID string, Any string, tooltip string", by_line=True)
    return layer.select("id", "_any", "tooltip", F.size("geometry").alias("num_points"),
                        F.round(F.col("geometry")[0]["x"], 9).alias("start_x"),
                        F.round(F.element_at("geometry", -1)["y"], 9).alias("end_y"))


@register("collections_of_years", "S6 S7 S1", """
SELECT lane_id AS id, description AS tooltip, 3 AS num_points, round(x0, 9) AS start_x, round(y2, 9) AS end_y FROM lanes WHERE year = 1999""")
def collections_of_years(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes as one GeoJSON collection a year, the year in the file's name; one year is read, a collection by many tasks."""
    base = shared_folder(spark, "collections")
    raw = v.raw_lanes(spark, folder).withColumnsRenamed({"id": "ID", "_any": "year"})
    _write_geojson(raw, ["ID", "tooltip"], "LineString", f"{base}/lines", by=["year"])
    head = ('{"type": "FeatureCollection", "name": "lanes {\\"drawn\\"}, [raw", "crs": {"type": "name", "properties": {"name": "CRS84"}},\n'
            '"features": [{"type": "Feature", "properties": {"ID": "x", "tooltip": "}]"}, "geometry": null}')
    lines = spark.read.text(f"{base}/lines")
    one = lambda text: spark.range(1).select(F.lit(text).alias("value"))
    for (year,) in lines.select("year").distinct().collect():
        features = lines.where(F.col("year") == year).select(F.concat(F.lit(", "), "value").alias("value"))
        # a collection is one file, its brackets first and last
        one(head).unionByName(features).unionByName(one("]}")).coalesce(1).write.text(f"{base}/read/{year}")
        _named(spark, f"{base}/read/{year}", f"{year}_lanes")
    layer = layers.scan_geojson(spark, f"{base}/read", "ID string, tooltip string", years=[1999])
    return layer.select("id", "tooltip", F.size("geometry").alias("num_points"), F.round(F.col("geometry")[0]["x"], 9).alias("start_x"),
                        F.round(F.element_at("geometry", -1)["y"], 9).alias("end_y"))


@register("boundary_layer_scan", "S7 S9 G12 G20", """
SELECT district_code AS districte, lpad(CAST(census_tract_id % 10000000 AS VARCHAR), 7, '0') AS sec_cens, CAST(NULL AS VARCHAR) AS nom,
  'tract' AS level, round(x0, 8) AS xmin, round(y1, 8) AS ymax FROM tracts
UNION ALL SELECT lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0'), NULL, r_name, 'district', NULL, NULL FROM region""")
def boundary_layer_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A tract layer stored in UTM 31N, brought back to degrees and stacked with the districts."""
    base = shared_folder(spark, "tracts")
    utm = v.tract_layer(spark, folder).withColumn(
        "geometry", geodesy.reproject_polygon(F.col("geometry"), geodesy.WGS84, geodesy.UTM31_ETRS89))
    _write_geojson(utm, ["DISTRICTE", "SEC_CENS"], "Polygon", base)
    layer = layers.scan_geojson(spark, base, "DISTRICTE string, SEC_CENS string", kind="polygon",
                                source_crs=geodesy.UTM31_ETRS89, by_line=True)
    corner = F.col("geometry")[0]
    layer = layer.select("districte", "sec_cens", F.round(corner[0]["x"], 8).alias("xmin"),
                         F.round(corner[2]["y"], 8).alias("ymax"))
    return layers.concat_layers([layer, v.districts(spark, folder)],
                                ["districte", "sec_cens", "nom", "xmin", "ymax"], ["tract", "district"])


@register("snapshot_scan", "S8 P24", """
SELECT event_id AS station_id, num_bikes_available, mechanical_bikes AS num_mechanical_bikes, ebikes AS num_ebikes,
  num_docks_available, status FROM ticks""")
def snapshot_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Nested snapshots of at most 200 readings each, flattened again."""
    base = shared_folder(spark, "snapshots")
    station = F.struct(F.col("event_id").alias("station_id"), "num_bikes_available", F.struct(
        F.col("mechanical_bikes").alias("mechanical"), F.col("ebikes").alias("ebike")).alias("num_bikes_available_types"),
        "num_docks_available", "status")
    docs = (v.ticks(spark, folder).groupBy(F.expr("event_id DIV 200").alias("doc"))
            .agg(F.struct(F.collect_list(station).alias("stations")).alias("data")))
    docs.select("data").write.json(base)
    scanned = snapshots.flatten_bike_types(
        snapshots.scan_snapshot(spark, base, snapshots.STATUS_STATION, by_line=True))
    return scanned.select("station_id", "num_bikes_available", "num_mechanical_bikes", "num_ebikes",
                          "num_docks_available", "status")


@register("monthly_load", "S10 S11 S14", """
SELECT strftime(last_updated, '%Y-%m') AS year_month, count(*) AS n_rows, CAST(sum(num_bikes_available) AS BIGINT) AS bikes
FROM station_status GROUP BY 1""")
def monthly_load(spark: SparkSession, folder: str) -> DataFrame:
    """Status facts written by month, loaded twice to show that a reload replaces its months."""
    base = shared_folder(spark, "monthly")
    facts = v.station_status(spark, folder)
    tables.write_monthly(facts.limit(0), base, "last_updated")
    for _ in range(2):
        tables.write_monthly(facts, base, "last_updated")
    return (spark.read.schema("num_bikes_available int, year_month string").parquet(base).groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("num_bikes_available").alias("bikes")))


@register("monthly_reload", "S10 S14", """
SELECT strftime(last_updated, '%Y-%m') AS year_month, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM information
WHERE strftime(last_updated, '%Y-%m') <> '1996-03' OR o_orderkey % 2 = 0 GROUP BY 1""")
def monthly_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Station descriptions of all months, then one month again with other rows: only that month changes."""
    base = shared_folder(spark, "reload")
    facts = v.information(spark, folder).select("o_orderkey", "station_id", "capacity", "last_updated")
    tables.write_monthly(facts, base, "last_updated")
    tables.write_monthly(facts.where("o_orderkey % 2 = 0 AND date_format(last_updated, 'yyyy-MM') = '1996-03'"), base, "last_updated")
    return (spark.read.schema("o_orderkey bigint, year_month string").parquet(base).groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys")))


@register("stored_dimension", "S10 S11 S12 S13", """
SELECT DISTINCT strftime(last_updated, '%Y-%m-%d') AS date_value FROM information""")
def stored_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A table built, found, rebuilt by force beside the old one, and extended by the members it lacks."""
    name = f"dim_day_{uuid.uuid4().hex[:12]}"
    days = v.information(spark, folder).select(F.to_date("last_updated").alias("date_value")).distinct()
    build = lambda: days.where(F.year("date_value") < 1998)
    tables.ensure_step(spark, name, lambda: days.limit(0))
    tables.ensure_step(spark, name, build)
    if tables.ensure_step(spark, name, build) or not tables.ensure_step(spark, name, build, force=True, needs=[name]):
        raise AssertionError("a filled table is built again by force only")
    tables.insert_missing(spark, days, name, ["date_value"])
    return spark.table(name)


@register("ensured_dimension", "S12 S10", """
SELECT DISTINCT strftime(last_updated, '%Y-%m-%d') AS date_value, CAST(day(last_updated) AS INTEGER) AS day FROM information""")
def ensured_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension built once; the second request finds it and must not build again."""
    path = shared_folder(spark, "dim-day")

    def build() -> DataFrame:
        return dims.day_dim(v.information(spark, folder).select(F.col("last_updated").alias("ts")))

    def never() -> DataFrame:
        raise AssertionError("the table was there already")
    tables.ensure_files(spark, path, build)
    return tables.ensure_files(spark, path, never).select("date_value", "day")


@register("table_preview", "S15 O5", "SELECT event_id, station_id, status FROM ticks ORDER BY event_id LIMIT 5")
def table_preview(spark: SparkSession, folder: str) -> DataFrame:
    return tables.preview(v.ticks(spark, folder).select("event_id", "station_id", "status").orderBy("event_id"))


@register("guarded_numbers", "P1 P2 P4 F1", f"""
SELECT station_id, name, lat, lon, altitude, capacity, strftime(last_updated, {SECOND}) AS last_updated FROM typed_information""")
def guarded_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.typed_station_information(v.raw_information(spark, folder))


@register("typed_status", "P2 P3 P4 F1", f"""
SELECT station_id, num_bikes_available, mechanical_bikes, ebikes, num_docks_available, status,
  strftime(last_reported, {SECOND}) AS last_reported, strftime(last_updated, {SECOND}) AS last_updated FROM typed_status""")
def typed_status(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.typed_station_status(v.raw_status(spark, folder))


@register("sampling_times", "P5", f"""
SELECT event_id, strftime(CASE WHEN event_id % 7 = 0 THEN make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000)
  WHEN event_id % 7 = 6 THEN NULL WHEN event_id % 7 = 5 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END,
  {SECOND}) AS parsed FROM events""")
def sampling_times(spark: SparkSession, folder: str) -> DataFrame:
    """Six spellings of a time and one that is none."""
    text = F.expr("""CASE event_id % 7
        WHEN 0 THEN CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING)
        WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") WHEN 2 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        WHEN 3 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 4 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
        WHEN 5 THEN date_format(ts, 'dd/MM/yyyy HH:mm') ELSE 'yesterday' END""")
    return v.table(spark, folder, "events").select("event_id", p.parse_sampling_time(text).alias("parsed"))


@register("lane_fields", "P6 P7 P8 Q3", """
SELECT lane_id, year, trimester, month, layer_code, data_date, lane_type, location FROM lanes""")
def lane_fields(spark: SparkSession, folder: str) -> DataFrame:
    return v.lanes(spark, folder).select("lane_id", "year", "trimester", "month", "layer_code", "data_date",
                                         "lane_type", "location")


@register("tract_codes", "P9 P10 P11 Q5", """
SELECT census_tract_id AS sec_cens, district_code AS districte, neighbourhood_code AS barri, round(census_tract_area, 6) AS area,
  CAST(CAST(district_code AS INTEGER) || lpad(CAST(census_tract_id % 1000 AS VARCHAR), 3, '0') AS BIGINT) AS income_code FROM tracts""")
def tract_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Both ways of building a tract code."""
    t = v.tracts(spark, folder)
    code = p.tract_code_from_income(F.col("districte"), (F.col("sec_cens") % 1000).cast("string"))
    return rounded(t.select("sec_cens", "districte", "barri", "area", code.alias("income_code")), 6, "area")


@register("income_neighbourhoods", "P10 Q4", f"""
SELECT strftime("any", {DAY}) AS "any", seccio_censal, lpad(CAST(1 + (seccio_censal % 10000000) // 180 AS VARCHAR), 2, '0') AS codi_barri FROM income""")
def income_neighbourhoods(spark: SparkSession, folder: str) -> DataFrame:
    """Incomes with the codes of tract and neighbourhood, as the boundary layers write them."""
    raw = v.raw_income(spark, folder).withColumn("codi_barri", F.expr("CAST(1 + seccio_censal DIV 180 AS INT)"))
    return cleaning.clean_income(raw, v.SECTION_WIDTH).select("any", "seccio_censal", "codi_barri")


@register("income_normalised", "P18 A6 Q4", f"""
SELECT strftime("any", {DAY}) AS "any", seccio_censal, import_euros, CAST(income_norm AS DOUBLE) AS income_norm FROM income""")
def income_normalised(spark: SparkSession, folder: str) -> DataFrame:
    return v.income(spark, folder)


@register("calendar_parts", "P14 P15 P16 P17 P27", f"""
SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, strftime(ts, '%Y-%m') AS year_month,
  strftime(date_trunc('hour', ts), {SECOND}) AS hour_datetime, strftime(time_bucket(INTERVAL '10 minutes', ts), {SECOND}) AS bucket,
  minute(time_bucket(INTERVAL '10 minutes', ts)) AS minute_bucket,
  CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'afternoon'
    WHEN hour(ts) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS day_part,
  strftime(ts, '%H:%M') AS time, round(hour(ts) + minute(ts) / 60e0, 6) AS hour_float FROM events""")
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    ts, bucket = F.col("ts"), cal.time_floor(F.col("ts"))
    return v.table(spark, folder, "events").select(
        "event_id", F.year(ts).cast("bigint").alias("year"), F.month(ts).cast("bigint").alias("month"),
        F.dayofmonth(ts).cast("bigint").alias("day"), F.hour(ts).cast("bigint").alias("hour"),
        cal.year_month(ts).alias("year_month"), cal.trunc("hour", ts).alias("hour_datetime"), bucket.alias("bucket"),
        F.minute(bucket).cast("bigint").alias("minute_bucket"), cal.day_part(ts).alias("day_part"),
        cal.clock_label(ts).alias("time"), F.round(cal.hour_fraction(ts), 6).alias("hour_float"))


@register("date_labels", "P28 P29", f"""
SELECT o_orderkey, dayname(o_orderdate) || ', ' || day(o_orderdate) || CASE WHEN day(o_orderdate) BETWEEN 4 AND 20
    OR day(o_orderdate) BETWEEN 24 AND 30 THEN 'th' WHEN day(o_orderdate) % 10 = 1 THEN 'st' WHEN day(o_orderdate) % 10 = 2 THEN 'nd'
    WHEN day(o_orderdate) % 10 = 3 THEN 'rd' ELSE 'th' END || ' of ' || monthname(o_orderdate) || ', ' || year(o_orderdate) AS label,
  strftime(make_timestamp(CAST(o_orderkey AS BIGINT) * 60000000), {SECOND}) AS shown FROM orders""")
def date_labels(spark: SparkSession, folder: str) -> DataFrame:
    return v.table(spark, folder, "orders").select(
        "o_orderkey", cal.ordinal_date_label(F.col("o_orderdate")).alias("label"),
        cal.epoch_to_timestamp(F.col("o_orderkey") * 60).alias("shown"))


@register("trimester_keys", "P12 P13 U3", """
SELECT DISTINCT year_trimester, CAST(left(year_trimester, 4) AS INTEGER) AS year FROM lanes""")
def trimester_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = cal.year_trimester(F.col("year"), F.col("trimester"))
    return v.lanes(spark, folder).select(key.alias("year_trimester"), cal.trimester_year(key).alias("year")).distinct()


@register("availability_percentages", "P19", """
SELECT station_id, strftime(ten_min_datetime, '%Y-%m-%d %H:%M:%S') AS ten_min_datetime, round(pct, 6) AS pct, round(epct, 6) AS epct,
  round(mpct, 6) AS mpct FROM scored""")
def availability_percentages(spark: SparkSession, folder: str) -> DataFrame:
    from velomesh.plans.stations import with_availability
    s = with_availability(v.station_status(spark, folder)).select(
        "station_id", "ten_min_datetime", F.col("bike_availability_percentage").alias("pct"),
        F.col("ebike_percentage").alias("epct"), F.col("mechanical_bike_percentage").alias("mpct"))
    return rounded(s, 6, "pct", "epct", "mpct")


@register("usage_and_fill", "P22 P23 P31", """
SELECT event_id, round(CASE WHEN cap > 0 THEN num_bikes_available * 100e0 / cap END, 6) AS usage_rate,
  CASE WHEN cap <= 0 OR num_bikes_available / cap < 0.2e0 THEN 'Low availability'
    WHEN num_bikes_available / cap < 0.5e0 THEN 'Medium availability' ELSE 'Good availability' END AS fill_status,
  status AS district FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN 0 ELSE 40 END AS cap FROM ticks)""")
def usage_and_fill(spark: SparkSession, folder: str) -> DataFrame:
    t = v.ticks(spark, folder).withColumn("cap", F.expr("CASE WHEN event_id % 9 = 0 THEN 0 ELSE 40 END"))
    bikes, street = F.col("num_bikes_available"), F.concat_ws("/", "status", F.col("station_id").cast("string"))
    return t.select("event_id", F.round(measures.usage_rate(bikes, F.col("cap")), 6).alias("usage_rate"),
                    measures.fill_status(bikes, F.col("cap")).alias("fill_status"),
                    p.first_token(street).alias("district"))


@register("display_labels", "P26", r"""
SELECT o_orderkey, format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) || regexp_extract(CAST(o_totalprice AS VARCHAR), '\.[0-9]+') AS price,
  replace('d''' || o_orderpriority, '''', '\''') AS key, round(o_totalprice / 7, 3) AS short FROM orders""")
def display_labels(spark: SparkSession, folder: str) -> DataFrame:
    return v.table(spark, folder, "orders").select(
        "o_orderkey", measures.thousands(F.col("o_totalprice")).alias("price"),
        measures.quote_escape(F.concat(F.lit("d'"), "o_orderpriority")).alias("key"),
        F.round(F.col("o_totalprice") / 7, 3).alias("short"))


@register("defaults_and_ratios", "P30 P31 P32", """
SELECT o_orderkey, coalesce(capacity, 0) AS capacity, round(altitude / nullif(capacity - 20, 0), 6) AS ratio,
  CAST(station_id AS BIGINT) AS station FROM information""")
def defaults_and_ratios(spark: SparkSession, folder: str) -> DataFrame:
    i = tabular.normalised(v.information(spark, folder), {"station_id": "bigint"}, {"station_id": "station_id"})
    return i.select("o_orderkey", F.coalesce("capacity", F.lit(0)).alias("capacity"),
                    F.round(measures.safe_ratio(F.col("altitude"), F.col("capacity") - 20), 6).alias("ratio"),
                    F.col("station_id").alias("station"))


@register("missing_profile", "A1 F14", """
SELECT unnest(['num_bikes_available', 'mechanical_bikes', 'status', 'last_reported']) AS column_name, n AS total_rows,
  unnest([a, b, c, d]) AS missing_count, unnest([round(100e0 * a / n, 2), round(100e0 * b / n, 2), round(100e0 * c / n, 2), round(100e0 * d / n, 2)]) AS missing_pct
FROM (SELECT count(*) AS n, count(*) - count(num_bikes_available) AS a, count(*) - count(mechanical_bikes) AS b,
  count(*) - count(status) AS c, count(*) - count(last_reported) AS d FROM typed_status)""")
def missing_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_profile(cleaning.typed_station_status(v.raw_status(spark, folder)),
                                   ["num_bikes_available", "mechanical_bikes", "status", "last_reported"])


_MEDIAN = "quantile_cont({0}, 0.5) OVER (PARTITION BY station_id)"


@register("cleaned_information", "Q1 A2 A3 A4 J10", f"""
SELECT t.station_id, name, lat, lon, round(coalesce(altitude, med), 6) AS altitude, coalesce(capacity, mode_capacity) AS capacity,
  strftime(last_updated, {SECOND}) AS last_updated
FROM typed_information t LEFT JOIN (SELECT station_id, median(altitude) AS med FROM typed_information GROUP BY 1) m ON t.station_id = m.station_id
LEFT JOIN (SELECT station_id, capacity AS mode_capacity FROM (SELECT station_id, capacity, row_number() OVER (PARTITION BY station_id
  ORDER BY count(*) DESC, capacity) AS rn FROM typed_information WHERE capacity IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) c ON t.station_id = c.station_id""")
def cleaned_information(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.clean_station_information(v.raw_information(spark, folder)), 6, "altitude")


@register("cleaned_status", "Q2 A2 A3 P30", f"""
SELECT station_id, {", ".join(f"round(CAST(coalesce({c}, {_MEDIAN.format(c)}) AS DOUBLE), 6) AS {c}" for c in cleaning.STATUS_IMPUTED)},
  strftime(last_reported, {SECOND}) AS last_reported, status, strftime(last_updated, {SECOND}) AS last_updated FROM typed_status""")
def cleaned_status(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.clean_station_status(v.raw_status(spark, folder)), 6, *cleaning.STATUS_IMPUTED)


@register("cleaned_lanes", "Q3 A4 P30", """
SELECT lane_id, year, trimester, coalesce(spoiled, mode_type, 'unknown') AS lane_type FROM (
  SELECT *, CASE WHEN lane_id LIKE '%5' THEN NULL ELSE lane_type END AS spoiled FROM lanes) l LEFT JOIN (
  SELECT year, trimester, layer_code, sublayer_code, lane_type AS mode_type FROM (SELECT year, trimester, layer_code, sublayer_code, lane_type,
    row_number() OVER (PARTITION BY year, trimester, layer_code, sublayer_code ORDER BY count(*) DESC, lane_type) AS rn
    FROM lanes WHERE lane_id NOT LIKE '%5' GROUP BY 1, 2, 3, 4, 5) WHERE rn = 1) USING (year, trimester, layer_code, sublayer_code)""")
def cleaned_lanes(spark: SparkSession, folder: str) -> DataFrame:
    """Mode imputation where the type of every lane ending in 5 went missing."""
    from velomesh.operators.impute import impute
    spoiled = v.lanes(spark, folder).withColumn("lane_type", F.expr("CASE WHEN lane_id LIKE '%5' THEN NULL ELSE lane_type END"))
    filled = impute(spoiled, ["year", "trimester", "layer_code", "sublayer_code"], {"lane_type": "mode"}, 0.1,
                    cleaning.LANE_GATE, default=p.LANE_TYPE_OTHER)
    return filled.select("lane_id", "year", "trimester", "lane_type")


@register("clean_lane_feed", "Q3 P7", "SELECT lane_id, year, trimester, lane_type FROM lanes")
def clean_lane_feed(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_lanes(v.raw_lanes(spark, folder)).select("lane_id", "year", "trimester", "lane_type")


@register("lane_type_distribution", "A5 O4", """
SELECT lane_type, count(*) AS n_lanes, round(100e0 * count(*) / (SELECT count(*) FROM lanes), 2) AS share_pct FROM lanes GROUP BY 1""")
def lane_type_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.lane_type_distribution(v.lanes(spark, folder))


# Three stations only, so that runs are long; every 50th time is unreadable.
_THIN = """SELECT event_id, CAST(user_id % 3 AS VARCHAR) AS station, CASE WHEN event_id % 50 = 7 THEN NULL
  ELSE time_bucket(INTERVAL '10 minutes', ts) END AS bucket FROM events"""
_KEPT = f"""SELECT event_id, station FROM (SELECT *, lag(bucket) OVER (PARTITION BY station ORDER BY event_id) AS before
  FROM ({_THIN}) WHERE bucket IS NOT NULL) WHERE before IS NULL OR before <> bucket
UNION ALL SELECT event_id, station FROM ({_THIN}) WHERE bucket IS NULL"""


def _thinned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = v.table(spark, folder, "events").selectExpr(
        "event_id", "CAST(user_id % 3 AS STRING) AS station", "event_id DIV 1000 AS chunk", "'events' AS file",
        "CASE WHEN event_id % 50 = 7 THEN 'unreadable' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS text")
    timed = raw.withColumn("ts", p.parse_sampling_time(F.col("text")))
    return timed, thin_runs(timed, "station", "ts", ["event_id"], "chunk", "file")


@register("thinned_ticks", "W5", _KEPT)
def thinned_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return _thinned(spark, folder)[1].select("event_id", "station")


@register("thinning_report", "A41", f"""
SELECT n AS rows_in, k AS rows_kept, n - k AS rows_skipped, round(100e0 * (n - k) / n, 1) AS reduction_pct
FROM (SELECT count(*) AS n FROM events), (SELECT count(*) AS k FROM ({_KEPT}))""")
def thinning_report_query(spark: SparkSession, folder: str) -> DataFrame:
    return thinning_report(*_thinned(spark, folder))


@register("layer_union", "S9 U2", """
SELECT station_id, 'information' AS feed, capacity AS amount FROM information
UNION ALL SELECT station_id, 'status', num_bikes_available FROM ticks""")
def layer_union(spark: SparkSession, folder: str) -> DataFrame:
    a = v.information(spark, folder).select("station_id", F.lit("information").alias("feed"), F.col("capacity").alias("amount"))
    b = v.ticks(spark, folder).select("station_id", F.lit("status").alias("feed"), F.col("num_bikes_available").alias("amount"))
    return union_all([a, b])
