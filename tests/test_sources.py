"""Files in and out."""

import json
import struct

import random

import pytest
from pyspark.sql import functions as F

from velomesh.functions import geodesy, geometry as g
from velomesh.sources import layers, snapshots, tables, tabular


def test_csv_union_by_name_and_year(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "2019_01_INFO.csv").write_text("station_id,lat,V1\n1,41.1,x\n")
    (tmp_path / "sub" / "2020_02_INFO.csv").write_text("lat,station_id,altitude\n41.2,2,\"5,0\"\n")
    (tmp_path / "2018_INFO.csv").write_text("station_id\n3\n")
    df = tabular.scan_csv_folder(spark, str(tmp_path), years=[2019, 2020])
    assert df.columns == ["V1", "altitude", "lat", "station_id", "file_path", "block_start", "line_no"]
    assert {(r.station_id, r.lat, r.altitude, r.V1) for r in df.collect()} == {("1", "41.1", None, "x"), ("2", "41.2", "5,0", None)}
    assert tabular.scan_csv_folder(spark, str(tmp_path)).count() == 3
    cut = tabular.project(df, tabular.INFORMATION_COLUMNS)
    assert tuple(cut.columns) == tabular.INFORMATION_COLUMNS and cut.where("name IS NOT NULL").isEmpty()


def test_thinning_goes_by_each_file(spark, tmp_path):
    """The last time column decides, rows without station, time or time column stay, order is that of the lines."""
    (tmp_path / "a.csv").write_text("last_updated,station_id,n,last_reported\n2020-01-01 09:00:00,1,1,2020-01-01 00:01:00\n"
                                    "2020-01-01 10:00:00,1,2,2020-01-01 00:09:00\n2020-01-01 10:00:00,1,3,bad\n"
                                    "2020-01-01 10:00:00,1,4,2020-01-01 00:11:00\n2020-01-01 10:00:00,1,5,2020-01-01 00:08:00\n"
                                    "2020-01-01 10:00:00,,6,2020-01-01 00:08:00\n2020-01-01 10:00:00,,7,2020-01-01 00:08:00\n")
    (tmp_path / "b.csv").write_text("Last_Updated,n\n2020-01-01 00:01:00,8\n2020-01-01 00:01:00,9\n")
    (tmp_path / "c.csv").write_text("station_id,n\n1,10\n1,11\n")
    kept = lambda kind: sorted(int(r.n) for r in tabular.thin_files(spark, str(tmp_path), kind).collect())
    assert kept("status") == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert kept("information") == [1, 3, 6, 7, 8, 9, 10, 11]


def test_income_and_population_files(spark, tmp_path):
    (tmp_path / "income_2020.csv").write_text("Any,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Seccio_Censal,Import_Euros\n2020,1,A,1,B,7,100.5\n2021-01-01,1,A,1,B,8,\n")
    rows = tabular.scan_income(spark, str(tmp_path)).orderBy("seccio_censal").collect()
    assert [str(r["any"]) for r in rows] == ["2020-01-01", "2021-01-01"] and rows[1].import_euros is None


def test_geojson_collection_with_broken_file(spark, tmp_path):
    good = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ID": "a", "Any": "2020"}, "geometry": {"type": "LineString", "coordinates": [[2.1, 41.4], [2.2, 41.5]]}},
        {"type": "Feature", "properties": {"ID": "b", "Any": "2020"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.geojson").write_text("{ broken")
    rows = layers.scan_geojson(spark, str(tmp_path), "ID string, Any string").collect()
    assert sorted((r.id, r._any, r.part_id) for r in rows) == [("a", "2020", 0), ("b", "2020", 0), ("b", "2020", 1)]
    lost = layers.geojson_rejects(spark, str(tmp_path), "ID string, Any string").collect()
    assert [tuple(r) for r in lost] == [("b.geojson", "broken", 1)]
    other = layers.geojson_rejects(spark, str(tmp_path / "a.geojson"), "ID string, Any string", kind="polygon").collect()
    assert sorted((r.reason, r.n_features) for r in other) == [("other kind: LineString", 1), ("other kind: MultiLineString", 1)]


def _lane(name, at, **more):
    return {"type": "Feature", "properties": {"ID": name, "Any": "a}{\\ \"] é"}, **more,
            "geometry": {"type": "LineString", "coordinates": [[at, 1.5], [at + 1, 2.5]]}}


@pytest.mark.parametrize("block", [60, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_collections_split_anywhere(spark, tmp_path, block, indent):
    """Features are found whatever the blocks, the order of members, and braces, quotes and objects elsewhere."""
    many = {"name": "x } { \" y", "type": "FeatureCollection", "crs": {"type": "name", "properties": {"deep": {"name": "}"}}},
            "other": [{"type": "Feature", "properties": {"ID": "no"}}, {"type": "Feature", "geometry": None}],
            "features": [_lane(f"f{k}", k, **({"extra": {"features": [{"a": {}}]}} if k % 3 else {})) for k in range(20)],
            "after": [_lane("no", 1), _lane("no", 2)], "end": {"features": []}}
    folder = tmp_path / "deep" / "folder"
    folder.mkdir(parents=True)
    (folder / "lanes_2020.json").write_text(json.dumps(many, indent=indent, ensure_ascii=False) + "\n \n", "utf-8")
    (folder / "lanes_2021.json").write_text(json.dumps({"features": [_lane("late", 3)], "type": "FeatureCollection"}, indent=indent))
    (folder / "none_2020.json").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    (folder / "one_2020.json").write_text(json.dumps(_lane("single", 1, extra={"features": [{"a": 1}]})))
    (folder / "text_2020.json").write_text("words")
    (folder / "empty_2020.json").write_text("")
    cut = json.dumps(many, indent=indent)
    (folder / "cut_2020.json").write_text(cut[:cut.index("f4") + 5])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        scan = lambda **o: layers.scan_geojson(spark, str(tmp_path), "ID string, Any string", **o)
        got = sorted((r.id, r._any, r.geometry[0].x) for r in scan(pattern="lanes*", years=[2020]).collect())
        assert got == sorted((f"f{k}", "a}{\\ \"] é", float(k)) for k in range(20))
        assert [r.id for r in scan(years=[2021]).collect()] == ["late"]
        assert sorted(r.id for r in scan(pattern="cut*").collect()) == [f"f{k}" for k in range(4)]
        lost = layers.geojson_rejects(spark, str(tmp_path), "ID string", years=[2020])
        assert sorted(map(tuple, lost.collect())) == [("cut_2020.json", "broken", 1), ("none_2020.json", "no geometry", 1),
                                                      ("one_2020.json", "no geometry", 1), ("text_2020.json", "broken", 1)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _shapefile(base, rings, names):
    """Minimal polygon .shp and .dbf pair."""
    records = b""
    for i, parts in enumerate(rings):
        pts = [p for part in parts for p in part]
        starts, at = [], 0
        for part in parts:
            starts.append(at)
            at += len(part)
        body = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(parts), len(pts)) + struct.pack(f"<{len(parts)}i", *starts)
        body += b"".join(struct.pack("<2d", *p) for p in pts)
        records += struct.pack(">2i", i + 1, len(body) // 2) + body
    (base / "layer.shp").write_bytes(struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(records)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + records)
    field = b"NOM".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10, 0]) + b"\0" * 14
    rows = b"".join(b" " + n.encode("latin-1").ljust(10) for n in names)
    (base / "layer.dbf").write_bytes(struct.pack("<4BIHH20x", 3, 24, 1, 1, len(names), 32 + 32 + 1, 11) + field + b"\x0d" + rows)


def test_shapefile_layer(spark, tmp_path):
    shell = [(430000.0, 4580000.0), (430000.0, 4590000.0), (440000.0, 4590000.0), (440000.0, 4580000.0), (430000.0, 4580000.0)]
    hole = [(432000.0, 4582000.0), (434000.0, 4582000.0), (434000.0, 4584000.0), (432000.0, 4582000.0)]
    far = [(x + 50000.0, y) for x, y in shell]
    _shapefile(tmp_path, [[shell, far, hole], [shell]], ["Gràcia", "Sants"])
    got = layers.scan_shapefiles(spark, str(tmp_path))
    rings = sorted((r.attributes["NOM"], r.part_id, len(r.geometry)) for r in got.collect())
    assert rings == [("Gràcia", 0, 2), ("Gràcia", 1, 1), ("Sants", 0, 1)]  # the hole lies in the first part
    back = got.select(geodesy.utm_from_lonlat(F.col("geometry")[0][0]).alias("p")).first().p
    assert (back.x, back.y) == pytest.approx(shell[0], abs=1e-5)


def test_snapshots(spark, tmp_path):
    info = {"data": {"stations": [{"station_id": 1, "name": "A", "capacity": 20, "is_charging_station": True}]}}
    state = {"data": {"stations": [{"station_id": 1, "num_bikes_available": 3, "num_bikes_available_types": {"mechanical": 1, "ebike": 2}, "is_charging_station": False}]}}
    (tmp_path / "i.json").write_text(json.dumps(info, indent=1))
    (tmp_path / "s.json").write_text(json.dumps(state, indent=1))
    left = snapshots.scan_snapshot(spark, str(tmp_path / "i.json"), snapshots.INFORMATION_STATION)
    right = snapshots.flatten_bike_types(snapshots.scan_snapshot(spark, str(tmp_path / "s.json"), snapshots.STATUS_STATION))
    row = snapshots.merge_snapshots(left, right).first()
    assert (row.num_mechanical_bikes, row.num_ebikes, row.is_charging_station_info) == (1, 2, True)
    assert "is_charging_station_status" not in row
    both = snapshots.merge_snapshots(left, right.withColumn("name", F.lit("B"))).first()
    assert (both.name_info, both.name_status) == ("A", "B")


def test_steps_are_idempotent(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3).select(F.col("id").alias("year"))
    assert tables.ensure_step(spark, "dim_year_t", build) and not tables.ensure_step(spark, "dim_year_t", build)
    assert tables.ensure_step(spark, "dim_year_t", build, force=True) and len(calls) == 2
    with pytest.raises(ZeroDivisionError):
        tables.ensure_step(spark, "dim_year_t", lambda: 1 / 0, force=True)
    assert spark.table("dim_year_t").count() == 3  # a build that fails leaves the old table
    tables.insert_missing(spark, spark.range(5).select(F.col("id").alias("year")), "dim_year_t", ["year"])
    assert sorted(r.year for r in spark.table("dim_year_t").collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(LookupError):
        tables.ensure_step(spark, "dim_x", build, needs=["no_such_table"])
    assert tables.preview(spark.table("dim_year_t"), 2).count() == 2
    spark.sql("DROP TABLE dim_year_t")


def test_monthly_reload_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "facts")
    base = spark.createDataFrame([("2020-01-05", 1), ("2020-02-05", 2)], "d string, v int").withColumn("d", F.to_timestamp_ntz("d"))
    tables.write_monthly(base, path, "d")
    tables.write_monthly(base.where("v = 2").withColumn("v", F.lit(9)), path, "d")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def _plain_csv(folder):
    """Every record of every file by Python's own reader, as name to value."""
    import csv
    out = []
    for file in sorted(folder.rglob("*.csv")):
        with open(file, newline="") as f:
            header, *records = [r for r in csv.reader(f) if r]
        out += [{k: v for k, v in zip(header, r) if v != ""} for r in records]
    return sorted(out, key=str)


def test_quoted_breaks_across_blocks(spark, tmp_path):
    """Records over many lines and many small blocks, stray quotes, doubled quotes, files without any."""
    rng = random.Random(5)
    value = lambda: rng.choice(["x", "7.5", "", '"a\nb"', '"say ""hi""\n\n,ok"', 'in"ch', '"q"', '"\n"', '"' + "long\n" * rng.randint(1, 60) + '"'])
    for k, header in enumerate(("id,a,b", "b,id", "a,c,id,b", "id")):
        n = header.count(",") + 1
        rows = [",".join(f"{k}-{i}" if c == "id" else value() for c in header.split(",")) for i in range(120)]
        (tmp_path / f"f{k}.csv").write_text(header + "\n" + "\n".join(rows) + "\n")
        assert n
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = tabular.scan_csv_folder(spark, str(tmp_path))
        assert df.columns[:4] == ["a", "b", "c", "id"]
        got = sorted(({k: v for k, v in r.asDict().items() if k in "abcid" and v not in (None, "")} for r in df.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert [{k: r[k] for k in sorted(r)} for r in got] == sorted(([{k: r[k] for k in sorted(r)} for r in _plain_csv(tmp_path)]), key=str)


def test_headers_cost_one_scan(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"f{k}.csv").write_text(f"id,c{k}\n{k},x{k}\n")
    df = tabular.scan_csv_folder(spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert {(r.id, r[f"c{r.id}"]) for r in df.collect()} == {(str(k), f"x{k}") for k in range(6)} and len(df.columns) == 10
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "e.csv").write_text("")
    assert tabular.scan_csv_folder(spark, str(empty)).count() == 0


def test_missing_columns_are_reported(spark, caplog):
    with caplog.at_level("WARNING"):
        tabular.project(spark.range(1), ["id", "gone"])
    assert "gone" in caplog.text
