"""Readers over saved files, sidecar mappings, and exports that are read back."""

import json
import struct
import xml.etree.ElementTree as ET

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideway.operators import assemble
from strideway.sinks import exports
from strideway.sources import readers, sidecars

NODES = "id string, lon double, lat double, barrier string, kerb string, ext_source string"
EDGES = "id string, u string, v string, highway string, footway string, surface string, crossing_markings string, width double, incline double, name string, ext_borough string, ext_osm_id string, line array<struct<lon:double,lat:double>>"


@pytest.fixture(scope="module")
def network(spark):
    nodes = spark.createDataFrame([("b", -74.0, 40.7, "kerb", "lowered", "s"), ("a", -74.0, 40.701, None, None, "nan"), (None, 0.0, 0.0, None, None, None)], NODES)
    at = lambda *p: [{"lon": x, "lat": y} for x, y in p]
    rows = [
        ("2", "b", "a", "footway", "crossing", "asphalt", "zebra", 1.5, 0.05, "A & B", "MN", "7", at((-74.0, 40.7), (-74.0, 40.701))),
        ("1", "a", "c", "steps", None, "mud", None, None, None, None, "BX", None, at((-74.0, 40.701), (-74.0, 40.7015), (-74.0, 40.702))),
        ("3", "a", "a", "primary", None, None, None, None, None, "", None, None, at((-74.0, 40.701), (-74.0, 40.702), (-74.0, 40.701))),
    ]
    return nodes, spark.createDataFrame(rows, EDGES)


def test_feature_collection_round_trip(spark, network, tmp_path):
    path = str(tmp_path / "all.geojson")
    n = exports.write_feature_collection(exports.feature_collection(*network), path, {"region": None})
    data = json.load(open(path))
    assert n == 5 and [f["properties"]["_id"] for f in data["features"]] == ["a", "b", "1", "2", "3"]
    assert data["features"][0]["properties"] == {"_id": "a"} and data["features"][3]["properties"]["crossing:markings"] == "zebra"
    back = readers.read_geojson(spark, path, "_id string, `ext:borough` string")
    got = {r["_id"]: (r.geometry_type, r.lon, r.line and len(r.line), r["ext:borough"]) for r in back.collect()}
    assert got["b"] == ("Point", -74.0, None, None) and got["1"] == ("LineString", None, 3, "BX")
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(f) + "," for f in data["features"]) + "\n[]\n")
    assert readers.read_feature_lines(spark, str(lines), "_id string").count() == 5


def test_polygons_and_empty_collections(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    (tmp_path / "p.json").write_text(json.dumps({"features": [{"geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"k": 1}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}, "properties": {"k": 2}}, {"geometry": None, "properties": {"k": 3}}]}))
    (tmp_path / "e.json").write_text('{"features": []}')
    parts = readers.explode_polygons(readers.read_geojson(spark, str(tmp_path / "p.json"), "k int"), "k")
    assert sorted((r.k, r.part, len(r.rings[0])) for r in parts.collect()) == [(1, 0, 4), (2, 0, 4), (2, 1, 4)]
    assert readers.read_geojson(spark, str(tmp_path / "e.json"), "k int").count() == 0


def test_binary_format(network, tmp_path):
    nodes, edges = network
    flagged = assemble.crossing_curb_flags(edges, nodes)
    path = str(tmp_path / "g.bin")
    assert exports.write_binary(nodes.where("id is not null"), flagged, path) == (2, 1)
    data = open(path, "rb").read()
    assert data[:4] == b"OSWB" and struct.unpack("<B3xII", data[4:16]) == (2, 2, 1) and len(data) == 16 + 20 + 18
    n = np.frombuffer(data[16:36], exports.NODE)
    e = np.frombuffer(data[36:], exports.EDGE)[0]
    assert n["attrs"].tolist() == [0, 1] and (e["u"], e["v"], e["incline"], e["footway"], e["surface"], e["flags"], e["width"]) == (1, 0, 500, 1, 1, 5, 8)
    assert exports.write_binary(nodes.where("id is not null"), flagged, path, derive_class=True) == (3, 2)


def test_graph_and_routing_formats(network, tmp_path):
    nodes, edges = network
    path = str(tmp_path / "g.graphml")
    exports.write_graphml(nodes.where("id is not null"), edges, path)
    ns = "{http://graphml.graphdrawing.org/xmlns}"
    graph = ET.parse(path).getroot().find(f"{ns}graph")
    pairs = sorted((e.get("source"), e.get("target")) for e in graph.findall(f"{ns}edge"))
    assert pairs == [("a", "a"), ("a", "b"), ("a", "c"), ("b", "a"), ("c", "a")]
    exports.write_routing_json(nodes.where("id is not null"), edges, str(tmp_path / "r.json"))
    data = json.load(open(tmp_path / "r.json"))
    assert set(data["nodes"]) == {"a", "b"} and data["edges"][1]["length_m"] == pytest.approx(111.32, abs=0.01)


def test_flat_layer_and_region(network):
    nodes, edges = network
    rows = {r.fid: r for r in exports.flat_layer(assemble.curb_flags(edges, nodes)).collect()}
    assert set(rows) == {"1", "2"} and rows["2"].curbramps == 1 and rows["2"].description == "A & B" and rows["1"].description == "steps 1" and rows["1"].subclass == "steps"
    assert tuple(exports.region_of(edges).first()) == (-74.0, 40.7, -74.0, 40.702)


def test_split_sort_and_reports(spark, network, tmp_path):
    nodes, edges = network
    exports.write_split(edges, str(tmp_path / "split"), "ext_borough")
    assert spark.read.parquet(str(tmp_path / "split")).where("ext_borough = 'MN'").count() == 1
    exports.write_spatially_sorted(nodes, str(tmp_path / "z"))
    assert spark.read.parquet(str(tmp_path / "z")).count() == 3
    exports.write_findings(edges.select("id", "u"), str(tmp_path / "csv"), ["id"], 2)
    assert [r.id for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()] == ["1", "2"]
    assert "| id |" in exports.markdown_table(edges.select("id"), "T")


def test_street_index(spark):
    df = spark.createDataFrame([("85-26 123rd St, Queens", 1.0, 2.0), ("7 123rd Street, Queens", 3.0, 4.0), ("nothing", 0.0, 0.0)], "name string, lat double, lng double")
    r = exports.street_index(df).collect()
    assert [(x.street_key, x.borough, [(h.num, h.lat) for h in x.houses]) for x in r] == [("123rd street", "Queens", [(7, 3.0), (8526, 1.0)])]


def test_paged_table_reads_all_pages(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k * 2}.json").write_text(json.dumps([{"a": f"{k}-{j}", "g": {"type": "Point"}} for j in range(2 if k < 2 else 1)]))
    got = readers.read_paged(spark, f"file:{tmp_path}", ["a", "g"], page_size="2")
    assert sorted(r.a for r in got.collect()) == ["0-0", "0-1", "1-0", "1-1", "2-0"] and json.loads(got.first().g) == {"type": "Point"}
    assert readers.read_paged(spark, f"file:{tmp_path}", ["a"], page_size="2", total="5").count() == 5


def test_small_readers(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_id,stop_name,stop_lat,stop_lon,wheelchair_boarding\n1,A,40.7,-74,1\n2,B,0,0,1\n3,C,40.7,-74,2\n")
    assert [(r.stop_id, r.ada) for r in readers.read_stops(spark, str(tmp_path / "stops.txt")).collect()] == [("1", 1)]
    (tmp_path / "dem1.asc").write_text("ncols 2\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 0.5\nNODATA_value -9999\n1 2\n3 -9999\n")
    tiles, cells = readers.read_ascii_grid(spark, str(tmp_path / "dem1.asc"))
    p = spark.createDataFrame([("a", 0.1, 0.9), ("b", 0.6, 0.9), ("c", 0.1, 0.1), ("d", 0.6, 0.1)], "id string, lon double, lat double")
    assert {r.id: r.elevation for r in assemble.sample_raster(p, tiles, cells).collect()} == {"a": 1.0, "b": 2.0, "c": 3.0, "d": None}
    assert readers.read_manifest(spark, str(tmp_path / "none.json")).count() == 0
    none = spark.createDataFrame([], "x int")
    assert readers.first_that_works([lambda: none, lambda: spark.range(2)]).count() == 2
    with pytest.raises(ValueError):
        readers.first_that_works([lambda: none])


def test_sidecars(spark):
    hospitals = spark.createDataFrame([("H", "Acute Care", "1 St", "40.7", "-74.0"), ("Far", "Acute", "2 St", "10", "10")], "facility_name string, facility_type string, location_address string, latitude string, longitude string")
    pool = json.dumps({"coordinates": [[[-74.0, 40.7], [-74.0, 40.8], [-73.9, 40.8], [-74.0, 40.7]]]})
    pools = spark.createDataFrame([("P", "Indoor", "X", pool), ("Q", "Outdoor", "X", pool)], "name string, location string, borough string, polygon string")
    libraries = spark.createDataFrame([("Main", "40.7", "-73.8", "9-5", "", None)], "name string, latitude string, longitude string, mn string, tu string, we string")
    both, summary = sidecars.load_all({"hospitals": lambda: hospitals, "parks_pools": lambda: pools, "queens_library": lambda: libraries, "dhs_dropins": lambda: 1 / 0})
    got = {r.name: r for r in both.collect()}
    assert set(got) == {"H", "P (indoor)", "Main"} and got["H"].id == "hospital:h-40.7000" and got["H"].resource_types == ["medical", "cool_indoor", "warm_indoor"] and got["P (indoor)"].borough == "BX" and json.loads(got["Main"].hours_today) == {"Mon": "9-5"}
    assert [(s["source"], s["count"], s["status"]) for s in summary] == [("hospitals", 1, "ok"), ("parks_pools", 1, "ok"), ("queens_library", 1, "ok"), ("dhs_dropins", 0, "error")]
    assert tuple(both.columns) == sidecars.COLUMNS


def test_every_sidecar_takes_a_table_without_its_columns(spark):
    for name, read in sidecars.SOURCES.items():
        assert read(spark.createDataFrame([("x",)], "unknown string")).count() == 0, name


def test_places_and_addresses(spark):
    e = spark.createDataFrame(
        [(0, "node", 40.7004, -74.0, None, {"name": "A", "tourism": "museum"}), (1, "node", 40.7001, -74.0, None, {"name": "a", "amenity": "cafe"}), (2, "way", None, None, (40.71, -74.0), {"name": "Park", "leisure": "park"}), (3, "node", 40.7, -74.0, None, {"addr:housenumber": "5", "addr:street": "of the FDR"})],
        "ord int, type string, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>",
    )
    assert [(r.name, r.type, r.category) for r in sidecars.pois(e).collect()] == [("Park", "park", "park"), ("A", "museum", "poi")]
    assert [r.name for r in sidecars.addresses(e.withColumn("borough", F.lit("Queens"))).collect()] == ["5 Of the FDR, Queens"]


def test_zip_and_report(network, tmp_path):
    import zipfile

    nodes, edges = network
    assert exports.write_zip(nodes, edges, str(tmp_path / "n.zip"), {"region": 1, "type": "FeatureCollection"}) == (2, 3)
    with zipfile.ZipFile(tmp_path / "n.zip") as z:
        assert "region" not in json.loads(z.read("edges.geojson")) and len(json.loads(z.read("nodes.geojson"))["features"]) == 2
    assert exports.write_report({"edges": edges.select("id").orderBy("id")}, str(tmp_path / "r.json"))["edges"][0] == {"id": "1"}


def test_a_graph_is_read_back(spark, tmp_path):
    nodes = spark.createDataFrame([("a", 1.5, 2.5, "x & <y>"), ("b", 3.0, 4.0, None)], "id string, lon double, lat double, name string")
    edges = spark.createDataFrame([("e", "a", "b", 7.0, "footway")], "id string, u string, v string, length double, highway string").withColumn("line", F.lit(None).cast("array<struct<lon: double, lat: double>>"))
    exports.write_graphml(nodes, edges, str(tmp_path / "g.graphml"))
    n, e = readers.read_graphml(spark, str(tmp_path / "g.graphml"))
    got = {r.id: r.attributes for r in n.collect()}
    assert got["a"] == {"name": "x & <y>", "x": "1.5", "y": "2.5"} and set(got) == {"a", "b"}
    assert sorted((r.source, r.target, r.attributes["highway"]) for r in e.collect()) == [("a", "b", "footway"), ("b", "a", "footway")]
    reads = []
    table = lambda: readers.cached(spark, str(tmp_path / "cache"), lambda: reads.append(1) or n)
    assert table().count() == table().count() == 2 and len(reads) == 1


def test_manifest_schema_and_version(spark, tmp_path):
    path = tmp_path / "raw" / "manifest.json"
    readers.record_source(str(path), "a", "a.json", "00", 3)
    readers.record_source(str(path), "b", "b.json", "11")
    assert sorted((r.source_id, r.row_count, r.retrieved_at[-6:]) for r in readers.read_manifest(spark, str(path)).collect()) == [("a", 3, "+00:00"), ("b", None, "+00:00")]
    (tmp_path / "s.json").write_text('{"required": ["id"]}')
    cache = tmp_path / "cache" / "s.json"
    assert readers.fetch_schema((tmp_path / "s.json").as_uri(), str(cache)) == {"required": ["id"]} and cache.exists()
    (tmp_path / "s.json").unlink()
    assert readers.fetch_schema("file:///nowhere", str(cache)) == {"required": ["id"]}
    with pytest.warns(UserWarning):
        assert readers.fetch_schema("file:///nowhere", str(tmp_path / "none.json")) == {}
    assert readers.git_sha(str(tmp_path)) == "unknown"
