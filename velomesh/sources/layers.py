"""Geometry layers: GeoJSON collections, GeoJSON lines and shapefiles."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomesh.functions import geodesy
from velomesh.operators.stats import union_all
from velomesh.session import checkpointed

LINE_TYPE = "array<struct<x:double,y:double>>"
POLYGON_TYPE = "array<array<struct<x:double,y:double>>>"
# Column names of a layer that clash with reserved words and are renamed.
RENAMES = {"any": "_any", "timestamp": "_timestamp"}


def _point_pairs(coords: Column) -> Column:
    return F.transform(coords, lambda c: F.struct(c[0].alias("x"), c[1].alias("y")))


# The shapes of each kind, in one part and in several, and their coordinates.
_KINDS = {"line": ("LineString", "MultiLineString", "array<array<double>>"),
          "polygon": ("Polygon", "MultiPolygon", "array<array<array<double>>>")}


_BROKEN = "_broken"
# An object that goes on an array, one that opens the features, and the text before it: scalar members only, or the end
# of another member.
_NEXT = r"(?s)^\s*,\s*(\{.*)$"
_OPENING = r'(?s)^\s*(?:\{|[\]}]?\s*,)?(?:[^"{}]++|"(?:[^"\\]++|\\.)*+")*?"features"\s*:\s*\[\s*(\{.*)$'


def _of_years(rows: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Rows of the files whose name, folders aside, holds one of the years."""
    return rows.where(" OR ".join(f"contains(file, '{int(y)}')" for y in years)) if years else rows


def _pieces(spark: SparkSession, paths: Sequence[str] | str, pattern: str, years: Sequence[int] | None) -> DataFrame:
    """Text cut behind every closing brace, with its depth: (path, file, block, no, value, size, _ends, _depth, _open).

    ``_ends`` tells whether an object ends here that lies directly in the collection or in an array of it; ``_depth``
    and ``_open`` are the depth after the piece and whether a string is open there. A block's pieces are walked in order
    for both states a block can begin in; between blocks only the state travels, one row per block.
    """
    raw = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "}").text(paths)
           .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
                   F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("no")))

    def count(text: Column, mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    def opened(text: Column) -> Column:
        return count(F.regexp_replace(text, r'"[^"]*+(?:"|\z)', ""), "{")

    plain = F.regexp_replace("value", r"(?s)\\.", "")
    marks = _of_years(raw, years).select("*", F.struct(
        count(plain, '"').alias("quotes"), opened(plain).alias("outside"),
        opened(F.regexp_replace(plain, r'^[^"]*+(?:"|\z)', "")).alias("inside")).alias("m"))
    inner, file = Window.partitionBy("path", "block").orderBy("no"), Window.partitionBy("path").orderBy("block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.sum("m.quotes").over(inner)
    steps = marks.withColumns({"_after": quotes % 2, "_at": (quotes - F.col("m.quotes")) % 2})

    def step(start: int) -> Column:
        """What a piece adds to the depth where its block begins outside (0) or inside (1) a string."""
        opens = F.when(F.col("_at") == start, F.col("m.outside")).otherwise(F.col("m.inside"))
        return F.sum(opens - (F.col("_after") == start).cast("int")).over(inner)

    walked = checkpointed(steps.withColumns({"_deep0": step(0), "_deep1": step(1)}).drop("m", "_at"))
    blocks = walked.groupBy("path", "block").agg(F.max_by(F.struct("_after", "_deep0", "_deep1"), "no").alias("b")).select("path", "block", "b.*")
    blocks = blocks.withColumn("_start", F.coalesce(F.sum("_after").over(before), F.lit(0)) % 2)
    own = F.when(F.col("_start") == 0, F.col("_deep0")).otherwise(F.col("_deep1"))
    blocks = blocks.select("path", "block", "_start", F.coalesce(F.sum(own).over(before), F.lit(0)).alias("_base"))
    depth = F.col("_base") + F.when(F.col("_start") == 0, F.col("_deep0")).otherwise(F.col("_deep1"))
    inside = (F.col("_start") + F.col("_after")) % 2
    return (walked.join(blocks, ["path", "block"]).withColumns({"_depth": depth, "_open": inside})
            .withColumn("_ends", ((F.col("_open") == 0) & (F.col("_depth") == 1)).cast("int"))
            .select("path", "file", "block", "no", "value", "size", "_ends", "_depth", "_open"))


def collection_features(spark: SparkSession, paths: Sequence[str] | str, pattern: str = "*", years: Sequence[int] | None = None) -> DataFrame:
    """(file, body, _broken): the features of GeoJSON collections as text, each file read by as many tasks as it has blocks.

    A feature whose text goes over a block's border is put together. A file that ends too early, or is no JSON object, has
    one row more with its rest in ``_broken``; one without features has a row without a body.
    """
    pieces = checkpointed(_pieces(spark, paths, pattern, years))
    inner, file = Window.partitionBy("path", "block").orderBy("no"), Window.partitionBy("path").orderBy("block")
    upto = (Window.unboundedPreceding, -1)
    done = pieces.groupBy("path", "block").agg(F.sum("_ends").alias("_n"))
    done = done.select("path", "block", F.coalesce(F.sum("_n").over(file.rowsBetween(*upto)), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.coalesce(F.sum("_ends").over(inner.rowsBetween(*upto)), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("block", "no", "value")))
    objects = (pieces.join(done, ["path", "block"]).withColumn("_number", number).groupBy("path", "file", "_number")
               .agg(parts.alias("p"), F.max("_ends").alias("_whole"))
               .withColumn("text", F.array_join(F.transform("p", lambda r: F.concat(r["value"], F.lit("}"))), "")).drop("p"))
    # members of the collection that hold objects: the features come after the one that opens them, up to the next
    turns = (F.col("_number") == 0) | ~F.col("text").rlike(_NEXT)
    objects = checkpointed(objects.withColumn("_opens", F.when(turns & (F.col("_whole") == 1), F.col("text").rlike(_OPENING))))
    members = objects.where("_opens IS NOT NULL").groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_number").alias("at"), F.col("_opens").alias("opens")))).alias("_members"))
    ruled = objects.join(members, "path").withColumn("_rule", F.element_at(F.filter("_members", lambda m: m["at"] <= F.col("_number")), -1)["opens"])
    bodies = ruled.where("_rule AND _whole = 1").select("file", F.when(F.col("_opens").isNull(), F.regexp_extract("text", _NEXT, 1))
                                                      .otherwise(F.regexp_extract("text", _OPENING, 1)).alias("body"), F.lit(None).cast("string").alias(_BROKEN))
    # the reader does not tell whether the last piece of a file had its brace; the file's size does
    bytes_read = F.sum(F.octet_length("value") + 1)
    last = F.max_by(F.struct("_depth", "_open"), F.struct("block", "no"))
    files = pieces.groupBy("path", "file").agg((bytes_read > F.max("size")).cast("int").alias("_extra"), last.alias("l"))
    files = files.select("path", "file", ((F.col("l._open") == 0) & (F.col("l._depth") + F.col("_extra") == 0)).alias("_complete"))
    seen = objects.groupBy("path").agg(F.max("_opens").alias("_some"), F.max(F.when(F.col("_number") == 0, F.col("text").rlike(r"^\s*\{"))).alias("_object"),
                                       F.max_by("text", "_number").alias("_rest"))
    odd = files.join(seen, "path").withColumn("_good", F.col("_complete") & F.col("_object"))
    odd = odd.where(~F.col("_good") | ~F.coalesce("_some", F.lit(False))).select(
        "file", F.lit(None).cast("string").alias("body"), F.when(~F.col("_good"), F.col("_rest")).alias(_BROKEN))
    return bodies.union(odd)


def _features(spark: SparkSession, paths: Sequence[str] | str, properties: str, by_line: bool, pattern: str = "*",
              years: Sequence[int] | None = None) -> DataFrame:
    """(type, properties, geometry, _broken, file) of every feature; broken text is kept in ``_broken``."""
    fields = [T.StructField("type", T.StringType()), T.StructField("properties", T.StructType.fromDDL(properties)),
              T.StructField("geometry", T.StructType.fromDDL("type string, coordinates string"))]
    feature = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    if by_line:
        lines = spark.read.options(**options).option("pathGlobFilter", pattern).schema(feature).json(paths)
        return _of_years(lines.select("*", F.col("_metadata.file_name").alias("file")), years)
    found = collection_features(spark, paths, pattern, years).withColumn("f", F.from_json("body", feature, options))
    return found.select("f.type", "f.properties", "f.geometry", F.coalesce(F.col(f"f.{_BROKEN}"), F.col(_BROKEN)).alias(_BROKEN), "file")


def _parts(kind: str) -> Column:
    """Parts of a feature as arrays of coordinates; null where it is no shape of this kind."""
    single, multi, depth = _KINDS[kind]
    text, name = F.col("geometry.coordinates"), F.col("geometry.type")
    return (F.when(name == single, F.array(F.from_json(text, depth)))
            .when(name == multi, F.from_json(text, f"array<{depth}>")))


def geojson_rejects(spark: SparkSession, paths: Sequence[str] | str, properties: str, kind: str = "line",
                    by_line: bool = False, pattern: str = "*", years: Sequence[int] | None = None) -> DataFrame:
    """(file, reason, n_features): what ``scan_geojson`` with the same arguments gives no row for."""
    parts = _parts(kind)
    raw = _features(spark, paths, properties, by_line, pattern, years).where(parts.isNull() | (F.size(parts) == 0))
    name = F.col("geometry.type")
    reason = (F.when(F.col("_broken").isNotNull(), "broken").when(name.isNull(), "no geometry")
              .when(name.isin(*_KINDS[kind][:2]), "broken").otherwise(F.concat(F.lit("other kind: "), name)))
    return raw.groupBy("file", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n_features"))


def scan_geojson(spark: SparkSession, paths: Sequence[str] | str, properties: str, kind: str = "line",
                 source_crs: int = geodesy.WGS84, by_line: bool = False, pattern: str = "*",
                 years: Sequence[int] | None = None) -> DataFrame:
    """Features as rows: the named properties plus ``geometry`` in longitude/latitude.

    ``properties`` is a DDL list (``"id string, tooltip string"``). Multi-part shapes give one row
    per part with ``part_id``. With ``by_line`` every text line holds one feature; otherwise a file is a
    collection. Both forms split over tasks. ``pattern`` and ``years`` choose files by name. What cannot be read
    as a shape of this kind gives no row here and is counted by ``geojson_rejects``.
    """
    raw = _features(spark, paths, properties, by_line, pattern, years)
    rows = raw.select("properties.*", F.posexplode(_parts(kind)).alias("part_id", "_c"))
    if kind == "line":
        geom = geodesy.reproject_line(_point_pairs(F.col("_c")), source_crs, geodesy.WGS84)
    else:
        geom = geodesy.reproject_polygon(F.transform("_c", _point_pairs), source_crs, geodesy.WGS84)
    out = rows.withColumn("geometry", geom).drop("_c")
    names = {c: RENAMES.get(c.lower(), c.lower()) for c in out.columns}
    return out.withColumnsRenamed(names)


def concat_layers(layers: Sequence[DataFrame], keep: Sequence[str], levels: Sequence[str] | None = None) -> DataFrame:
    """Stack layers, each reduced to the wanted columns it has; ``level`` names the layer."""
    cut = []
    for i, layer in enumerate(layers):
        have = [c for c in keep if c in layer.columns]
        cut.append(layer.select(*have, *([F.lit(levels[i]).alias("level")] if levels else [])))
    return union_all(cut)


# Record types of the shapefile format.
_POLYLINE_TYPES, _POLYGON_TYPES = (3, 13, 23), (5, 15, 25)


def _shapes(content: bytes) -> Iterator[list[np.ndarray]]:
    """Parts of every record of a .shp file, as arrays of (x, y)."""
    at = 100
    while at + 12 <= len(content):
        words = struct.unpack_from(">i", content, at + 4)[0]
        body = at + 8
        if struct.unpack_from("<i", content, body)[0] in _POLYLINE_TYPES + _POLYGON_TYPES:
            n_parts, n_points = struct.unpack_from("<2i", content, body + 36)
            starts = np.frombuffer(content, "<i4", n_parts, body + 44)
            xy = np.frombuffer(content, "<f8", 2 * n_points, body + 44 + 4 * n_parts).reshape(-1, 2)
            yield np.split(xy, starts[1:])
        else:
            yield []
        at = body + 2 * words


def _twice_area(ring: np.ndarray) -> float:
    """Signed; positive for rings that run anticlockwise."""
    return float(np.sum(ring[:-1, 0] * ring[1:, 1] - ring[1:, 0] * ring[:-1, 1]))


def _around(ring: np.ndarray, x: float, y: float) -> bool:
    """Whether the point lies in the ring, by the crossings of a ray to the right."""
    ax, ay, bx, by = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    side = (ay > y) != (by > y)
    at = ax[side] + (y - ay[side]) * (bx[side] - ax[side]) / (by[side] - ay[side])
    return bool((at > x).sum() % 2)


def _bodies(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings by part: outer rings run clockwise, each with the holes it is the smallest ring around."""
    outer = [r for r in rings if _twice_area(r) <= 0]
    bodies = [[r] for r in outer]
    for hole in (r for r in rings if _twice_area(r) > 0):
        x, y = (hole[0] + hole[1]) / 2
        near = [k for k, r in enumerate(outer) if _around(r, x, y)]
        if near:
            bodies[min(near, key=lambda k: -_twice_area(outer[k]))].append(hole)
        else:
            bodies.append([hole])
    return bodies


def _attributes(content: bytes, encoding: str) -> list[dict[str, str | None]]:
    """Rows of a .dbf file as text."""
    n_rows, header, width = struct.unpack_from("<IHH", content, 4)
    fields, at = [], 32
    while content[at] != 0x0D:
        fields.append((content[at:at + 11].split(b"\0")[0].decode(encoding), content[at + 16]))
        at += 32
    rows = []
    for i in range(n_rows):
        pos, row = header + i * width + 1, {}
        for name, size in fields:
            row[name] = content[pos:pos + size].decode(encoding).strip() or None
            pos += size
        rows.append(row)
    return rows


def scan_shapefiles(spark: SparkSession, folder: str, pattern: str = "*", source_crs: int = geodesy.UTM31_ETRS89,
                    kind: str = "polygon", encoding: str = "latin-1") -> DataFrame:
    """Shapefile records as rows: ``attributes`` map, ``part_id`` and ``geometry`` in longitude/latitude.

    The format caps a file at 2 GB and its records depend on each other's length, so a file is the
    unit of work; files are decoded side by side. The format does not order rings: a hole belongs to the
    smallest part around it.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .where(F.lower("path").rlike(r"\.(shp|dbf)$"))
             .where(F.element_at(F.split("path", "/"), -1).like(pattern.replace("*", "%")))
             .select(F.lower(F.right("path", F.lit(3))).alias("part"),
                     F.regexp_replace("path", r"\.[A-Za-z]{3}$", "").alias("base"), "content"))
    pairs = files.groupBy("base").agg(F.max(F.when(F.col("part") == "shp", F.col("content"))).alias("shp"),
                                      F.max(F.when(F.col("part") == "dbf", F.col("content"))).alias("dbf"))
    ring_based = kind == "polygon"

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for base, shp, dbf in zip(batch["base"], batch["shp"], batch["dbf"]):
                table = _attributes(dbf, encoding) if dbf is not None else None
                out = []
                for i, parts in enumerate(_shapes(shp)):
                    for k, body in enumerate(_bodies(parts) if ring_based else [[xy] for xy in parts]):
                        out.append((base.rsplit("/", 1)[-1], table[i] if table else {}, k,
                                    [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in body]))
                if out:
                    yield pd.DataFrame(out, columns=["layer", "attributes", "part_id", "rings"])
    rows = pairs.where(F.col("shp").isNotNull()).mapInPandas(
        decode, f"layer string, attributes map<string,string>, part_id int, rings {POLYGON_TYPE}")
    if ring_based:
        geom = geodesy.reproject_polygon(F.col("rings"), source_crs, geodesy.WGS84)
    else:
        geom = geodesy.reproject_line(F.col("rings")[0], source_crs, geodesy.WGS84)
    return rows.withColumn("geometry", geom).drop("rings")
