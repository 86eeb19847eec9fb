"""Sources: GeoJSON, line-delimited features, paged REST tables, CSV stops, rasters, manifests."""

from __future__ import annotations

import json
import subprocess
import time
import urllib.request
import uuid
import warnings
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strideway.functions import geometry as G

GEOMETRY = "struct<type:string,coordinates:string>"


def _features(rows: DataFrame, properties: str) -> DataFrame:
    """Typed features from rows with a struct ``f`` of geometry and properties as JSON text."""
    g = F.from_json("f.geometry", GEOMETRY)
    p = F.from_json("f.properties", properties)
    out = rows.select(g.alias("_g"), p.alias("_p")).where(F.col("_g.type").isNotNull() & F.col("_g.coordinates").isNotNull())
    pair = lambda x: F.struct(x[0].alias("lon"), x[1].alias("lat"))
    c, kind = F.col("_g.coordinates"), F.col("_g.type")
    line = F.transform(F.from_json(c, "array<array<double>>"), pair)
    rings = F.transform(F.from_json(c, "array<array<array<double>>>"), lambda r: F.transform(r, pair))
    parts = F.transform(F.from_json(c, "array<array<array<array<double>>>>"), lambda q: F.transform(q, lambda r: F.transform(r, pair)))
    return out.select(
        kind.alias("geometry_type"),
        F.when(kind == "Point", F.from_json(c, "array<double>")[0]).alias("lon"),
        F.when(kind == "Point", F.from_json(c, "array<double>")[1]).alias("lat"),
        F.when(kind == "LineString", line).alias("line"),
        F.when(kind == "Polygon", F.array(rings)).when(kind == "MultiPolygon", parts).alias("polygons"),
        "_p.*",
    )


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of GeoJSON files (whole collections); ``properties`` is the DDL of the wanted ones.

    Columns: geometry_type, lon, lat (points), line (lines), polygons (arrays of rings), and the properties.
    Features without geometry are left out; an empty collection gives no rows.
    """
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "struct<features:array<struct<geometry:string,properties:string>>>")["features"]).alias("f"))
    return _features(rows, properties)


def read_feature_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of line-delimited files, one feature a line: a splittable scan for large data."""
    rows = spark.read.text(path).select(F.from_json(F.regexp_replace("value", r",\s*$", ""), "struct<geometry:string,properties:string>").alias("f"))
    return _features(rows.where("f is not null"), properties)


def explode_polygons(features: DataFrame, key: str) -> DataFrame:
    """(key, part, rings, ...): one row per part of a multi-polygon."""
    rest = [c for c in features.columns if c not in ("polygons", "line", "lon", "lat")]
    return features.select(*rest, F.posexplode("polygons").alias("part", "rings"))


def drop_missing_geometry(rows: DataFrame, field: str = "geometry") -> DataFrame:
    """Rows of a REST table with a geometry, which may be text; computed columns are left out."""
    kept = [c for c in rows.columns if not c.startswith(":@computed")]
    c = F.col(field)
    if dict(rows.dtypes)[field] == "string":
        c = F.from_json(c, GEOMETRY)
    return rows.select(*kept).withColumn(field, c).where(F.col(field).isNotNull())


class _Page(InputPartition):
    def __init__(self, offset: int):
        self.offset = offset


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = options, schema
        self.size = int(options.get("page_size", "50000"))
        self.where: list[str] = [options["where"]] if options.get("where") else []

    def partitions(self) -> list[InputPartition]:
        total = int(self.options.get("total", "0"))
        return [_Page(k) for k in range(0, total, self.size)] or [_Page(-1)]

    def _page(self, offset: int) -> list[dict]:
        import urllib.parse
        import urllib.request

        url = self.options["url"]
        if url.startswith("file:"):  # pages saved as <url>/<offset>.json
            page = Path(urllib.parse.urlparse(url).path) / f"{offset}.json"
            return json.loads(page.read_text()) if page.exists() else []
        query = {"$limit": self.size, "$offset": offset} | ({"$where": " AND ".join(self.where)} if self.where else {})
        request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(query)}", headers={"X-App-Token": self.options["token"]} if self.options.get("token") else {})
        with urllib.request.urlopen(request, timeout=120) as f:
            return json.load(f)

    def read(self, partition: _Page) -> Iterator[tuple]:
        names = [f.name for f in self.schema.fields]
        offset = max(0, partition.offset)
        while True:
            rows = self._page(offset)
            for r in rows:
                yield tuple(json.dumps(v) if isinstance(v, (dict, list)) else None if v is None else str(v) for v in (r.get(n) for n in names))
            offset += self.size
            if partition.offset >= 0 or len(rows) < self.size:
                return


class PagedTable(DataSource):
    """A REST table that is read by limit and offset, ``format("paged_table")``; all columns are text.

    Options: url (or file:, a folder of saved pages), page_size, total (rows, to read pages in parallel), where, token.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_table"

    def schema(self) -> str:
        return self.options.get("columns", "value string")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PagedReader(dict(self.options), schema)


def read_paged(spark: SparkSession, url: str, columns: list[str], box: tuple[float, float, float, float] | None = None, geometry: str = "the_geom", **options: str) -> DataFrame:
    """A paged REST table; a box (south, west, north, east) becomes the server's filter."""
    spark.dataSource.register(PagedTable)
    if box:
        s, w, n, e = box
        options["where"] = f"within_box({geometry}, {n}, {w}, {s}, {e})"
    return spark.read.format("paged_table").schema(", ".join(f"`{c}` string" for c in columns)).options(url=url, **options).load()


def first_that_works(attempts: list[Callable[[], DataFrame]], retries: int = 1, wait: float = 0.0) -> DataFrame:
    """The first source of a chain that gives rows; the last error if none does."""
    error: Exception | None = None
    for attempt in attempts:
        for k in range(retries):
            try:
                df = attempt()
                if df.limit(1).count():
                    return df
            except Exception as e:  # the next source of the chain is tried, and the last error raised
                error = e
            if k + 1 < retries:
                time.sleep(wait)
    raise error or ValueError("no source gave rows")


def union_regions(parts: dict[str, DataFrame], column: str = "ext_borough") -> DataFrame:
    """One table of several regions', each marked with its name; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(column, F.lit(name)) for name, df in parts.items()])


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """Wheelchair-accessible stops of a GTFS ``stops.txt``: stop_id, name, lon, lat, ada; stops at (0, 0) are left out."""
    raw = spark.read.csv(path, header=True)
    lat, lon = F.col("stop_lat").try_cast("double"), F.col("stop_lon").try_cast("double")
    return raw.where((F.trim("wheelchair_boarding") == "1") & lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))).select("stop_id", F.col("stop_name").alias("name"), lon.alias("lon"), lat.alias("lat"), F.lit(1).alias("ada"))


def read_ascii_grid(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(tiles, cells) of Arc/Info ASCII grids, for ``assemble.sample_raster``; files rank in name order."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    head = lambda k: F.regexp_extract("value", rf"(?i){k}\s+(\S+)", 1).cast("double")
    files = text.select("file", "value", *[head(k).alias(k) for k in ("ncols", "nrows", "xllcorner", "yllcorner", "cellsize")], F.regexp_extract("value", r"(?i)nodata_value\s+(\S+)", 1).try_cast("double").alias("nodata"))
    names = sorted(r["file"] for r in files.select("file").collect())
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("file")) - 1 if names else F.lit(0)
    ranked = files.withColumn("tile_rank", rank.cast("int"))
    tiles = ranked.select("tile_rank", F.col("xllcorner").alias("west"), (F.col("yllcorner") + F.col("nrows") * F.col("cellsize")).alias("north"), F.col("cellsize").alias("pixel_width"), F.col("cellsize").alias("pixel_height"), F.col("ncols").cast("long").alias("cols"), F.col("nrows").cast("long").alias("rows"))
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: x.rlike(r"^\s*[-+0-9.]"))
    cells = ranked.select("tile_rank", "nodata", F.posexplode(lines).alias("row", "text")).select("tile_rank", "nodata", "row", F.posexplode(F.split(F.trim("text"), r"\s+")).alias("col", "v"))
    value = F.col("v").try_cast("double")
    return tiles, cells.select("tile_rank", "col", "row", F.when(~value.eqNullSafe(F.col("nodata")), value).alias("elev"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, file_path, content_hash, retrieved_at, row_count) of a manifest file; no rows if there is none."""
    schema = "source_id string, file_path string, content_hash string, retrieved_at string, row_count long"
    p = Path(path)
    data = json.loads(p.read_text()) if p.exists() else {}
    rows = [(k, v.get("file_path"), v.get("content_hash"), v.get("retrieved_at"), v.get("row_count")) for k, v in data.items()]
    return spark.createDataFrame(rows, schema)


def record_source(path: str, source_id: str, file_path: str, content_hash: str, row_count: int | None = None) -> None:
    """Put one source's retrieval into a manifest file, next to what it holds of others; the file is replaced whole."""
    p = Path(path)
    data = json.loads(p.read_text()) if p.exists() else {}
    data[source_id] = {"file_path": file_path, "content_hash": content_hash, "retrieved_at": utc_now(), "row_count": row_count}
    p.parent.mkdir(parents=True, exist_ok=True)
    hidden = p.with_name(f".{p.name}.{uuid.uuid4().hex}")
    hidden.write_text(json.dumps(data, indent=2))
    hidden.replace(p)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def git_sha(folder: str = ".") -> str:
    """The short hash of the commit that a folder is at; ``unknown`` where there is none."""
    try:
        return subprocess.run(["git", "rev-parse", "--short", "HEAD"], cwd=folder, capture_output=True, text=True, check=True).stdout.strip()
    except (subprocess.CalledProcessError, OSError):
        return "unknown"


def fetch_schema(url: str, cache: str, timeout: float = 30.0) -> dict:
    """A JSON schema from its cache file, else from its address, which then fills the cache; empty if neither works."""
    p = Path(cache)
    if p.exists():
        return json.loads(p.read_text())
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            data = answer.read()
        found = json.loads(data)
    except (OSError, ValueError) as e:  # checks of structure go on without a schema
        warnings.warn(f"no schema from {url}: {e}", stacklevel=2)
        return {}
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(data)
    return found


def cached(spark: SparkSession, path: str, read: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path`` if it was written whole, else what ``read`` gives, written there first."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        read().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes: id, attributes; edges: source, target, attributes) of a GraphML file; attributes are a map from their public names to text.

    Spark's XML source splits the file by element, so a large one is read in parallel; names are the file's own few ``key`` elements.
    """
    rows = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    names = {r["_id"]: r["_attr.name"] for r in rows("key", "`_id` string, `_attr.name` string").select("_id", "`_attr.name`").collect()}  # one row for each attribute
    data = "data array<struct<_key: string, _VALUE: string>>"
    public = F.create_map(*[F.lit(x) for k, v in names.items() if k for x in (k, v or k)]) if names else F.create_map().cast("map<string,string>")
    attributes = F.map_from_entries(F.transform(F.coalesce("data", F.array().cast("array<struct<_key: string, _VALUE: string>>")), lambda d: F.struct(F.coalesce(F.try_element_at(public, d["_key"]), d["_key"]), d["_VALUE"])))
    nodes = rows("node", f"_id string, {data}").select(F.col("_id").alias("id"), attributes.alias("attributes"))
    edges = rows("edge", f"_source string, _target string, {data}").select(F.col("_source").alias("source"), F.col("_target").alias("target"), attributes.alias("attributes"))
    return nodes, edges


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def in_study_area(df: DataFrame, box: tuple[float, float, float, float] | None, lon: Column | None = None, lat: Column | None = None) -> DataFrame:
    """Rows inside a box (south, west, north, east); all rows without one."""
    if box is None:
        return df
    s, w, n, e = box
    return df.where(G.in_box(lon if lon is not None else F.col("lon"), lat if lat is not None else F.col("lat"), w, s, e, n))
