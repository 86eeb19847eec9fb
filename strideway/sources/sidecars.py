"""Sidecar sources: each maps the rows of one saved table onto one canonical feature form; a registry names them all.

A mapping takes a table with the source's columns (text, or as its reader gives them; ones it lacks count as
null) and returns ``COLUMNS``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideway.functions import geometry as G
from strideway.functions import mapping as M
from strideway.plans.lineage import cut

COLUMNS = ("id", "source", "name", "address", "resource_types", "amenities", "hours_today", "is_temporarily_closed", "borough", "lon", "lat", "extra")
#: South, north, west and east of the city.
CITY = (40.4774, 40.9176, -74.2591, -73.7004)
# What the sources call boroughs, days and services.
BOROUGH_NAMES = {"manhattan": "MN", "brooklyn": "BK", "queens": "QN", "bronx": "BX", "staten island": "SI"}
BOROUGH_CODES = ("MN", "BK", "QN", "BX", "SI")
PARK_LETTERS = {"M": "MN", "B": "BK", "Q": "QN", "X": "BX", "R": "SI"}
DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
QUEENS_HOURS = ("mn", "tu", "we", "th", "fr", "sa", "su")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SENIOR_HOURS = (
    ("monhouropen", "monhourclose"), ("tuehouropen", "tuehourclose"), ("wedhoursopen", "wedhoursclose"), ("thurhoursopen", "thurhoursclose"),
    ("frihouropen", "frihourclose"), ("satopentime", "satclosetime"), ("sunhouropen", "sunhourclose"),
)
LIBRARY = ("cool_indoor", "warm_indoor", "quiet_indoor", "wifi_power", "bathroom", "seating")


def _get(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _text(df: DataFrame, *names: str) -> Column:
    """The first of the columns that holds anything."""
    return F.coalesce(*[F.nullif(_get(df, n).cast("string"), F.lit("")) for n in names])


def _slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def _in_city(lon: Column, lat: Column) -> Column:
    return G.in_box(lon, lat, CITY[2], CITY[0], CITY[3], CITY[1])


def coordinates(df: DataFrame, lat: tuple[str, ...] = ("latitude",), lon: tuple[str, ...] = ("longitude",)) -> tuple[Column, Column]:
    """(lon, lat) from the candidate columns, else from a GeoJSON location; null outside the city."""
    number = lambda names: F.coalesce(*[_get(df, n).cast("string").try_cast("double") for n in names])
    y, x = number(lat), number(lon)
    for c in ("location", "location_1", "geocoded_column"):
        if c in df.columns and dict(df.dtypes)[c] == "string":
            p = F.from_json(c, "struct<coordinates:array<double>>")["coordinates"]
            fits, lacking = F.size(p) == 2, x.isNull() | y.isNull()
            x, y = F.when(lacking & fits, p[0]).otherwise(x), F.when(lacking & fits, p[1]).otherwise(y)
    return F.when(_in_city(x, y), x), F.when(_in_city(x, y), y)


def by_name(df: DataFrame) -> Column:
    return M.lookup(F.lower(_text(df, "borough")), BOROUGH_NAMES)


def by_code(df: DataFrame, column: str = "boro") -> Column:
    c = F.upper(_text(df, column))
    return F.when(c.isin(*BOROUGH_CODES), c)


def hours_map(pairs: dict[str, Column], closed: tuple[str, ...] = ("",)) -> Column:
    """Day to hours as JSON, without the days that have none; null if all are."""
    keys, values = F.array(*map(F.lit, pairs)), F.array(*[F.coalesce(F.trim(v.cast("string")), F.lit("")) for v in pairs.values()])
    kept = F.map_filter(F.map_from_arrays(keys, values), lambda k, v: ~F.lower(v).isin(*closed))
    return F.when(F.size(kept) > 0, F.to_json(kept))


def _kinds(*names: str) -> Column:
    return F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")


def feature(
    df: DataFrame,
    prefix: str,
    source: str,
    ident: Column,
    name: Column,
    kinds: Column,
    at: tuple[Column, Column],
    address: Column | None = None,
    amenities: Column | None = None,
    hours: Column | None = None,
    closed: Column | None = None,
    borough: Column | None = None,
    extra: Column | None = None,
    with_latitude: bool = True,
) -> DataFrame:
    """Rows of the canonical form; rows without a place in the city are left out. Ids end on the latitude where names repeat."""
    lon, lat = at
    key = F.concat_ws("-", F.coalesce(ident, F.lit("")), F.format_string("%.4f", lat)) if with_latitude else F.coalesce(ident, F.lit(""))
    out = df.select(
        F.concat(F.lit(prefix + ":"), key).alias("id"), F.lit(source).alias("source"), name.alias("name"), F.trim(F.coalesce(address, F.lit(""))).alias("address") if address is not None else F.lit("").alias("address"),
        kinds.alias("resource_types"), (amenities if amenities is not None else _kinds()).alias("amenities"), F.coalesce(hours, F.lit("unknown")).alias("hours_today") if hours is not None else F.lit("unknown").alias("hours_today"),
        (F.coalesce(closed, F.lit(False)) if closed is not None else F.lit(False)).alias("is_temporarily_closed"), (F.coalesce(borough, F.lit("?")) if borough is not None else F.lit("?")).alias("borough"), lon.alias("lon"), lat.alias("lat"),
        (extra if extra is not None else F.lit(None)).cast("map<string,string>").alias("extra"),
    )
    return out.where("lon is not null and lat is not null")


def _named(df: DataFrame, *columns: str, default: str) -> Column:
    return F.coalesce(_text(df, *columns), F.lit(default))


def _joined(df: DataFrame, *columns: str) -> Column:
    return F.concat_ws(" ", *[_text(df, c) for c in columns])


def nypl(df: DataFrame) -> DataFrame:
    """Branches with a location as a pair or as two named numbers."""
    kind = dict(df.dtypes).get("geolocation", "string")
    g = F.from_json(_get(df, "geolocation") if kind == "string" else F.to_json("geolocation"), "struct<coordinates:array<double>,latitude:double,longitude:double>")
    pair = F.size(g["coordinates"]) == 2
    lon, lat = F.when(pair, g["coordinates"][0]).otherwise(g["longitude"]), F.when(pair, g["coordinates"][1]).otherwise(g["latitude"])
    listed = _get(df, "amenities") if dict(df.dtypes).get("amenities", "string") == "string" else F.to_json("amenities")
    names = F.filter(F.transform(F.from_json(listed, "array<struct<name:string>>"), lambda a: a["name"]), lambda n: n.isNotNull() & (n != ""))
    return feature(
        df, "nypl", "NYPL", _text(df, "slug", "id"), _named(df, "name", default="NYPL branch"), _kinds(*LIBRARY), (F.when(_in_city(lon, lat), lon), F.when(_in_city(lon, lat), lat)), _text(df, "street_address"),
        F.coalesce(names, _kinds()), _text(df, "hours_today"), _get(df, "is_temporarily_closed").cast("boolean"), F.coalesce(by_code(df, "region"), F.lit("MN")), with_latitude=False,
    )


def bpl(df: DataFrame) -> DataFrame:
    ident = F.coalesce(_text(df, "branch_id", "id", "slug"), _slug(_text(df, "name")))
    return feature(df, "bpl", "BPL", ident, _named(df, "name", default="BPL branch"), _kinds(*LIBRARY), coordinates(df, ("lat", "latitude"), ("lng", "longitude")), _text(df, "street_address", "address"), hours=_text(df, "hours_today"), borough=F.lit("BK"), with_latitude=False)


def queens_library(df: DataFrame) -> DataFrame:
    hours = hours_map({d: _get(df, c) for d, c in zip(DAYS, QUEENS_HOURS, strict=True)})
    return feature(df, "qpl", "Queens Library", F.coalesce(_text(df, "id"), _slug(_text(df, "name"))), _named(df, "name", default="Queens Library branch"), _kinds(*LIBRARY), coordinates(df), _joined(df, "address", "city"), hours=hours, borough=F.lit("QN"), with_latitude=False)


def nycha(df: DataFrame) -> DataFrame:
    own = df.where(_text(df, "borough").isin("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"))
    program = F.trim(F.coalesce(_text(df, "program_type"), F.lit("")))
    base = ("cool_indoor", "warm_indoor", "seating")
    kinds = F.when(F.lower(program).contains("senior"), _kinds(*base, "senior_center", "quiet_indoor")).otherwise(_kinds(*base, "community_center"))
    closed = F.lower(F.trim(_text(df, "status"))) == "vacant"
    return feature(own, "nycha", "NYCHA", _slug(_text(df, "sponsor", "development")), _named(df, "sponsor", "development", default="NYCHA facility"), kinds, coordinates(df), _text(df, "address"), closed=closed, borough=by_name(df), extra=F.create_map(F.lit("program_type"), program))


def dhs_dropins(df: DataFrame) -> DataFrame:
    comments = F.coalesce(_text(df, "comments"), F.lit(""))
    base = ("cool_indoor", "warm_indoor", "bathroom", "seating")
    kinds = F.when(comments.contains("24"), _kinds(*base, "shelter_24h")).otherwise(_kinds(*base))
    return feature(df, "dhs", "DHS", _slug(_text(df, "center_name")), _named(df, "center_name", default="Drop-in center"), kinds, coordinates(df), _text(df, "address"), _kinds("showers", "meals"), F.substring(comments, 1, 120), borough=by_name(df), with_latitude=False)


def parks_pools(df: DataFrame) -> DataFrame:
    rings = F.from_json(_text(df, "polygon", "the_geom", "geom"), "struct<coordinates:array<array<array<double>>>>")["coordinates"]
    c = G.ring_mean(F.transform(F.get(rings, F.lit(0)), lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))
    at = (F.when(_in_city(c["lon"], c["lat"]), c["lon"]), F.when(_in_city(c["lon"], c["lat"]), c["lat"]))
    own = df.where(_text(df, "location") == "Indoor")
    name = F.concat(_named(df, "name", default="Parks pool"), F.lit(" (indoor)"))
    return feature(own, "pool", "NYC Parks", F.coalesce(_text(df, "gispropnum"), _slug(_text(df, "name"))), name, _kinds("cool_indoor", "warm_indoor", "pool_indoor", "bathroom"), at, None, _kinds("locker_rooms", "showers"), F.lit("check nycgovparks.org"), borough=M.lookup(F.upper(_text(df, "borough")), PARK_LETTERS), with_latitude=False)


def restrooms(df: DataFrame) -> DataFrame:
    extra = F.create_map(F.lit("accessibility"), F.coalesce(_text(df, "accessibility"), F.lit("")))
    return feature(df.where(_text(df, "status") == "Operational"), "restroom", "NYC Public Restrooms", _slug(_text(df, "facility_name")), _named(df, "facility_name", default="Public restroom"), _kinds("bathroom"), coordinates(df), _text(df, "location_type"), hours=_text(df, "hours_of_operation"), extra=extra)


def linknyc(df: DataFrame) -> DataFrame:
    lon, lat = coordinates(df)
    first, second = _text(df, "cross_street_1"), _text(df, "cross_street_2")
    corner = F.when(first.isNotNull(), F.concat_ws(" & ", first, second))
    works = lambda c: F.lower(_text(df, c)) == "operational"
    extras = F.array_compact(F.array(F.lit("free_wifi"), F.when(works("tablet_status"), "tablet"), F.when(works("phone_status"), "free_phone")))
    ident = F.coalesce(_text(df, "site_id"), F.format_string("%.5f", lat))
    return feature(df.where(_text(df, "wifi_status") == "up"), "linknyc", "LinkNYC", ident, F.lit("LinkNYC Kiosk"), _kinds("linknyc", "wifi_power"), (lon, lat), F.coalesce(_text(df, "address"), corner), extras, F.lit("24/7"), borough=by_code(df), with_latitude=False)


def senior_centers(df: DataFrame) -> DataFrame:
    def span(opens: str, closes: str) -> Column:
        a, b = _text(df, opens), _text(df, closes)
        return F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit("-"), b))

    hours = hours_map({d: span(*c) for d, c in zip(DAYS, SENIOR_HOURS, strict=True)})
    own = df.where(_text(df, "providertype") == "OLDER ADULT CENTER CONTRACTS")
    kinds = _kinds("senior_center", "cool_indoor", "warm_indoor", "quiet_indoor", "seating")
    return feature(own, "senior", "NYC Aging", F.coalesce(_text(df, "bin"), _slug(_text(df, "programname"))), _named(df, "programname", "sponsorname", default="Senior center"), kinds, coordinates(df), _text(df, "programaddress"), _kinds("meals"), F.coalesce(hours, F.lit("call ahead")), borough=by_name(df))


def harm_reduction(df: DataFrame) -> DataFrame:
    hours = hours_map({d: _get(df, c) for d, c in zip(DAYS, WEEKDAYS, strict=True)}, ("", "closed", "n/a"))
    return feature(df, "harm", "DOHMH", F.coalesce(_text(df, "facilityid"), _slug(_text(df, "facility_name"))), _named(df, "facility_name", default="Harm reduction site"), _kinds("harm_reduction"), coordinates(df), _text(df, "address"), hours=F.coalesce(hours, F.lit("call ahead")), borough=by_name(df))


def hospitals(df: DataFrame) -> DataFrame:
    kind = F.lower(F.coalesce(_text(df, "facility_type"), F.lit("")))
    kinds = F.when(kind.contains("acute") | kind.contains("hospital"), _kinds("medical", "cool_indoor", "warm_indoor")).otherwise(_kinds("medical"))
    return feature(df, "hospital", "NYC H+H", F.coalesce(_text(df, "facilityid"), _slug(_text(df, "facility_name"))), _named(df, "facility_name", default="NYC Health + Hospitals"), kinds, coordinates(df), _text(df, "cross_streets"), hours=F.lit("24/7 emergency"), borough=by_name(df))


def facilities(subgroup: str, prefix: str, default: str, *kinds: str) -> Callable[[DataFrame], DataFrame]:
    """A source that is one subgroup of the facilities table."""

    def read(df: DataFrame) -> DataFrame:
        ident = F.coalesce(_text(df, "uid"), _slug(_text(df, "facname")))
        return feature(df.where(_text(df, "facsubgrp") == subgroup), prefix, "NYC Facilities", ident, _named(df, "facname", default=default), _kinds(*kinds), coordinates(df), _joined(df, "address", "zipcode"), hours=F.lit("call ahead"), borough=by_code(df))

    return read


SOURCES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "nypl": nypl, "bpl": bpl, "queens_library": queens_library, "nycha": nycha, "dhs_dropins": dhs_dropins, "parks_pools": parks_pools, "restrooms": restrooms, "linknyc": linknyc,
    "food_pantries": facilities("SOUP KITCHENS AND FOOD PANTRIES", "food", "Food pantry", "food_pantry"), "senior_centers": senior_centers, "harm_reduction": harm_reduction, "hospitals": hospitals,
    "mental_health": facilities("MENTAL HEALTH", "mh", "mental health", "mental_health"),
    "community_centers": facilities("COMMUNITY CENTERS AND COMMUNITY PROGRAMS", "cc", "community centers", "community_center", "cool_indoor", "warm_indoor", "seating"),
}


def load_all(tables: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame | None, list[dict]]:
    """(union of the sources that work, one summary per source: source, count, status, error)."""
    parts, summary = [], []
    for name, read in tables.items():
        try:
            part = cut(SOURCES[name](read()), f"sidecar-{name}")  # counted and read again, but computed once
            n = part.count()
        except Exception as e:  # one source's failure is its summary's, not the others'
            summary.append({"source": name, "count": 0, "status": "error", "error": str(e)[:200]})
            continue
        parts.append(part)
        summary.append({"source": name, "count": n, "status": "ok", "error": None})
    return (reduce(DataFrame.unionByName, parts) if parts else None), summary


def _place(df: DataFrame) -> tuple[Column, Column]:
    return F.when(F.col("type") == "node", F.col("lat")).otherwise(F.col("center.lat")), F.when(F.col("type") == "node", F.col("lon")).otherwise(F.col("center.lon"))


def _dedup(df: DataFrame, bucket: float, order: str) -> DataFrame:
    by = Window.partitionBy(F.lower("name"), F.rint(F.col("lat") * bucket), F.rint(F.col("lng") * bucket)).orderBy(order)
    return df.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r")


def pois(elements: DataFrame, order: str = "ord") -> DataFrame:
    """Named places of map elements (type, lat, lon, center, tags, ord): name, lat, lng, type, category; by category and name."""
    lat, lon = _place(elements)
    kind = M.classify_poi(F.col("tags"))
    rows = elements.select(order, F.try_element_at("tags", F.lit("name")).alias("name"), lat.alias("lat"), lon.alias("lng"), kind["type"].alias("type"), kind["category"].alias("category"))
    kept = _dedup(rows.where("name is not null and name <> '' and lat is not null and lng is not null"), 1e3, order)
    rank = M.lookup(F.col("category"), {c: k for k, c in enumerate(M.POI_ORDER)}, F.lit(99))
    return kept.select("name", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "type", "category").orderBy(rank, "name")


def addresses(elements: DataFrame, order: str = "ord") -> DataFrame:
    """Address points of map elements with a ``borough`` column: name, lat, lng, type, category; by name."""
    lat, lon = _place(elements)
    tag = lambda k: F.nullif(F.try_element_at("tags", F.lit(k)), F.lit(""))
    rows = elements.select(order, M.address_string(tag("addr:housenumber"), tag("addr:street"), F.col("borough")).alias("name"), lat.alias("lat"), lon.alias("lng"))
    inside = G.in_box(F.col("lng"), F.col("lat"), CITY[2], CITY[0], CITY[3], CITY[1])
    kept = _dedup(rows.where(F.col("name").isNotNull() & inside), 1e4, order)
    return kept.select("name", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), F.lit("address").alias("type"), F.lit("address").alias("category")).orderBy("name")
