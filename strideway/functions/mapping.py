"""Mapping of source attributes onto the node and edge model: enums, tags, tolerant casts, names, addresses, ids."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The enumerations of the data model, and what source values become in it.
SURFACES = ("asphalt", "concrete", "dirt", "grass", "grass_paver", "gravel", "paved", "paving_stones", "unpaved")
SURFACE_OF = {
    "tar": "asphalt", "tarmac": "asphalt", "bituminous": "asphalt", "cobblestone": "paving_stones", "sett": "paving_stones", "stone": "paving_stones", "brick": "paving_stones",
    "compacted": "unpaved", "fine_gravel": "gravel", "sand": "unpaved", "earth": "dirt", "mud": "dirt", "wood": "paved", "metal": "paved",
}
MARKINGS = (
    "zebra", "zebra:double", "zebra:paired", "zebra:bicolour", "lines", "lines:paired", "lines:rainbow", "dashes", "dots", "ladder", "ladder:paired", "ladder:skewed",
    "pictograms", "rainbow", "surface", "yes", "no",
)
MARKINGS_AUDIT = (*MARKINGS, "skewed", "zebra:rainbow")
MARKING_OF = {"marked": "yes", "uncontrolled": "zebra", "traffic_signals": "yes", "toucan": "yes", "pelican": "yes", "pegasus": "yes", "zebra_old_style": "zebra"}
FOOTWAYS = ("footway", "path", "pedestrian", "steps")
STREETS = ("residential", "service", "tertiary", "secondary", "primary", "living_street", "unclassified")
BOROUGH_OF_SLUG = {"manhattan": "MN", "brooklyn": "BK", "queens": "QN", "bronx": "BX", "bronx_county": "BX", "the_bronx": "BX", "staten_island": "SI"}
BOROUGH_OF_NUMBER = {"1": "Manhattan", "2": "Bronx", "3": "Brooklyn", "4": "Queens", "5": "Staten Island"}
# The second set of enumerations, of the repair of finished data.
REPAIR_SURFACES = ("paved", "asphalt", "concrete", "paving_stones", "gravel", "dirt", "grass", "wood", "metal")
REPAIR_SURFACE_OF = {
    "unpaved": "dirt", "grass_paver": "grass", "compacted": "gravel", "fine_gravel": "gravel", "ground": "dirt", "earth": "dirt", "sand": "dirt", "tarmac": "asphalt",
    "cobblestone": "paving_stones", "sett": "paving_stones", "bricks": "paving_stones", "brick": "paving_stones", "pebblestone": "gravel",
}
REPAIR_MARKINGS = ("zebra", "lines", "dashes", "surface", "no")
REPAIR_MARKING_OF = {"yes": "surface", "marked": "surface", "unmarked": "no", "uncontrolled": "no"}
# Codes of the binary format.
FOOTWAY_CODE = {"sidewalk": 0, "crossing": 1, "footway": 2, "steps": 3}
SURFACE_CODE = {"asphalt": 1, "concrete": 2, "paving_stones": 3, "cobblestone": 4, "sett": 4, "gravel": 5, "unpaved": 6, "dirt": 6, "grass": 6, "mud": 6, "sand": 6}
MARKING_CODE = {"yes": 1, "zebra": 2}
# Names: street suffixes in the order they are expanded, and words with a fixed case.
SUFFIXES = (("st", "street"), ("ave?", "avenue"), ("blvd", "boulevard"), ("rd", "road"), ("dr", "drive"), ("pl", "place"), ("pkwy", "parkway"), ("ln", "lane"), ("ct", "court"), ("ter", "terrace"), ("tpke?", "turnpike"), ("sq", "square"))
LOWER_WORDS = ("of", "the", "and", "at")
UPPER_WORDS = ("jfk", "fdr", "lic", "nyc", "moma")
POI_ORDER = ("borough", "transit", "neighborhood", "park", "amenity_priority", "poi", "amenity", "building", "other")
#: A house number, and an address with its house, street and borough.
HOUSE = r"^\s*(\d+(?:-\d+)?)([A-Za-z]?)\s*$"
ADDRESS = r"^\s*(\S+)\s+(.+?),\s*([^,]+)\s*$"
MISSING = ("nan", "none", "<na>", "nat", "")
SENTINEL = 999.0


def lookup(key: Column, table: dict[str, object], default: Column | None = None) -> Column:
    """The table's value for a key, as one CASE expression."""
    out = reduce(lambda w, kv: w.when(key == kv[0], F.lit(kv[1])), list(table.items())[1:], F.when(key == next(iter(table)), F.lit(table[next(iter(table))])))
    return out if default is None else out.otherwise(default)


def present(c: Column) -> Column:
    """The value as a string, null for every spelling of a missing one."""
    s = c.cast("string")
    return F.when(~F.lower(F.trim(s)).isin(*MISSING), s)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces and dashes."""
    return df.toDF(*[re.sub(r"[ \-]", "_", c.strip().lower()) for c in df.columns])


def first_of(c: Column) -> Column:
    """The first of values that are joined by pipes."""
    return F.split(c, r"\|")[0]


def flatten_list(c: Column) -> Column:
    return F.concat_ws("|", c)


def sentinel_to_null(df: DataFrame, sentinel: float = SENTINEL) -> DataFrame:
    """Null for the sentinel in every numeric column."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return df.select(*[F.nullif(F.col(c), F.lit(sentinel).cast(t)).alias(c) if t in numeric else F.col(c) for c, t in df.dtypes])


def slope(c: Column) -> Column:
    """A slope from text or a number; null for text that is no number, and for the sentinel in any spelling."""
    return F.nullif(F.nanvl(c.cast("string").try_cast("double"), F.lit(None).cast("double")), F.lit(SENTINEL))


def classify_edge(highway: Column, footway: Column, crossing: Column) -> Column:
    """sidewalk, crossing, footway or street; null for what is neither. A crossing tag outranks the footway tag."""
    way = F.trim(first_of(F.lower(F.coalesce(highway, F.lit("")))))
    foot = F.trim(F.lower(F.coalesce(F.when(~footway.isin("nan", "None", ""), footway), F.lit(""))))
    crosses = crossing.isNotNull() & ~crossing.isin("nan", "None", "no", "")
    walk = F.when((foot == "crossing") | crosses, "crossing").when(foot == "sidewalk", "sidewalk").otherwise("footway")
    return F.when(way.isin(*FOOTWAYS), walk).when(way.isin(*STREETS), "street")


def highway_of(kind: Column, highway: Column) -> Column:
    """The model's highway value: footway for walks, but steps stay steps; streets keep their own."""
    first = first_of(highway)
    return F.when((kind == "footway") & (first == "steps"), "steps").when(kind.isin("sidewalk", "crossing", "footway"), "footway").otherwise(first)


def surface(c: Column) -> Column:
    s = first_of(F.trim(F.lower(c)))
    return F.when(s.isin(*SURFACES), s).otherwise(lookup(s, SURFACE_OF))


def crossing_markings(c: Column) -> Column:
    s = F.trim(F.lower(c))
    return F.when(s.isin(*MARKINGS), s).otherwise(lookup(s, MARKING_OF))


def repair_surface(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return F.when(s.isin(*REPAIR_SURFACES), s).otherwise(lookup(s, REPAIR_SURFACE_OF, s))


def repair_markings(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return F.when(s.isin(*REPAIR_MARKINGS), s).otherwise(lookup(s, REPAIR_MARKING_OF, s))


def width_metres(c: Column) -> Column:
    """A width in metres from text such as ``2.5 m``; null for other units and for missing values."""
    return F.nanvl(F.trim(F.replace(present(c), F.lit("m"), F.lit(""))).try_cast("double"), F.lit(None).cast("double"))


def borough_code(c: Column) -> Column:
    """The two-letter code of a borough's name in any spelling; other values pass."""
    return lookup(F.replace(F.trim(F.lower(c)), F.lit(" "), F.lit("_")), BOROUGH_OF_SLUG, c)


def borough_name(c: Column) -> Column:
    """The name of a borough's number; other values pass as text."""
    s = c.cast("string")
    return lookup(F.regexp_replace(s, r"\.0$", ""), BOROUGH_OF_NUMBER, s)


def provenance(source: str, timestamp: str | None, version: str) -> dict[str, Column]:
    return {"ext_source": F.lit(source), "ext_source_timestamp": F.lit(timestamp or "unknown"), "ext_pipeline_version": F.lit(version)}


def manifest_provenance(df: DataFrame, source: Column, manifest: DataFrame, version: str) -> DataFrame:
    """Provenance columns from the manifest (source_id, retrieved_at); an unknown source's time is ``unknown``."""
    when = manifest.select(F.col("source_id").alias("ext_source"), F.col("retrieved_at").alias("ext_source_timestamp"))
    out = df.withColumn("ext_source", source).join(when, "ext_source", "left")
    return out.withColumns({"ext_source_timestamp": F.coalesce("ext_source_timestamp", F.lit("unknown")), "ext_pipeline_version": F.lit(version)})


def heuristic_source(is_line: Column, osm_id: Column, barrier: Column, kerb: Column) -> Column:
    """Where a feature without a stated source comes from."""
    curb = F.coalesce(barrier == "kerb", F.lit(False)) | F.coalesce(kerb.isin("lowered", "raised", "flush"), F.lit(False))
    line = F.when(osm_id.isNotNull() & (osm_id != ""), "osm_walk").otherwise("nyc_planimetric_sidewalks")
    return F.when(is_line, line).when(curb, "nyc_dot_ramps").otherwise("osm_walk")


def normalize_street(c: Column) -> Column:
    """Lower-case, suffixes spelt out, single spaces."""
    out = F.lower(F.trim(c))
    for short, long in SUFFIXES:
        out = F.regexp_replace(out, rf"\b{short}\.?(\s|$)", f"{long}$1")
    return F.trim(F.regexp_replace(out, r"\s{2,}", " "))


def house_number(c: Column) -> Column:
    """(number, suffix): 85-26 is 8526, 12a is 12 and A; anything else is 0 and itself."""
    s = F.trim(c)
    fits = s.rlike(HOUSE)
    digits = F.replace(F.regexp_extract(s, HOUSE, 1), F.lit("-"), F.lit(""))
    return F.struct(
        F.when(fits, F.coalesce(digits.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("number"),
        F.when(fits, F.upper(F.regexp_extract(s, HOUSE, 2))).otherwise(s).alias("suffix"),
    )


def parse_address(c: Column) -> Column:
    """(house, street, borough) of ``85-26 123rd Street, Queens``; null if the text has another form."""
    parts = [F.regexp_extract(c, ADDRESS, k) for k in (1, 2, 3)]
    return F.when(c.rlike(ADDRESS), F.struct(parts[0].alias("house"), parts[1].alias("street"), F.trim(parts[2]).alias("borough")))


def title_street(c: Column) -> Column:
    """Title case, but for words that are always lower-case (unless first) or upper-case."""
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")

    def one(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return F.when(low.isin(*UPPER_WORDS), F.upper(w)).when((i > 0) & low.isin(*LOWER_WORDS), low).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))

    return F.array_join(F.transform(words, one), " ")


def address_string(house: Column, street: Column, borough: Column) -> Column:
    return F.concat(F.trim(house), F.lit(" "), title_street(F.trim(street)), F.lit(", "), borough)


def classify_poi(tags: Column) -> Column:
    """(type, category) of a place from its tag map; the first rule that fits counts."""
    t = lambda k: F.try_element_at(tags, F.lit(k))
    has = lambda k: t(k).isNotNull() & (t(k) != "")
    rules = [
        (t("place").isin("city", "borough"), t("place"), "borough"),
        (has("place"), t("place"), "neighborhood"),
        (t("railway") == "station", F.lit("station"), "transit"),
        (t("public_transport") == "station", F.lit("station"), "transit"),
        (t("aeroway").isin("aerodrome", "terminal"), F.lit("airport"), "transit"),
        (has("tourism"), t("tourism"), "poi"),
        (t("leisure").isin("park", "playground", "garden"), t("leisure"), "park"),
        (t("amenity").isin("library", "hospital", "university", "community_centre"), t("amenity"), "amenity_priority"),
        (has("amenity"), t("amenity"), "amenity"),
        (t("shop") == "mall", F.lit("mall"), "poi"),
        (t("boundary") == "administrative", F.lit("admin"), "neighborhood"),
        (has("building"), F.lit("building"), "building"),
    ]
    pair = lambda kind, category: F.struct(kind.alias("type"), F.lit(category).alias("category"))
    out = F.when(rules[0][0], pair(*rules[0][1:]))
    for test, kind, category in rules[1:]:
        out = out.when(test, pair(kind, category))
    return out.otherwise(pair(F.lit("other"), "other"))


def _sixteen(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def fixed_units(c: Column, places: int) -> Column:
    """c * 10^places as an integer, rounded half to even from the exact value of the double, not from its rounded product."""
    scale = float(10**places)
    product = c * scale
    # What the product's rounding lost: the double is split into two halves whose products are exact.
    spread = c * 134217729.0
    high = spread - (spread - c)
    lost = (high * scale - product) + (c - high) * scale
    floor = F.floor(product)
    tie = product - floor == 0.5
    return F.when(tie & (lost > 0), floor + 1).when(tie & (lost < 0), floor).otherwise(F.rint(product)).cast("long")


def fixed(c: Column, places: int) -> Column:
    """A coordinate with so many decimals, as text."""
    n = F.abs(fixed_units(c, places))
    sign = F.when(c.cast("string").startswith("-"), "-").otherwise("")
    part = F.lpad((n % 10**places).cast("string"), places, "0")
    return F.concat(sign, F.floor(n / 10**places).cast("string"), F.lit("."), part)


def node_id(lon: Column, lat: Column) -> Column:
    """Sixteen hex digits of the SHA-256 of a place; which source named it doesn't matter."""
    return _sixteen(F.concat(F.lit("node|"), fixed(lon, 7), F.lit("|"), fixed(lat, 7)))


def edge_id(u_lon: Column, u_lat: Column, v_lon: Column, v_lat: Column, kind: Column, source: Column) -> Column:
    at = lambda lon, lat: F.concat(fixed(lon, 7), F.lit(","), fixed(lat, 7))
    return _sixteen(F.concat_ws("|", F.lit("edge"), kind, source, at(u_lon, u_lat), at(v_lon, v_lat)))


def feature_id(wkt: Column, kind: Column, source: Column) -> Column:
    return _sixteen(F.concat_ws("|", kind, source, wkt))


def middle_signature(line: Column) -> Column:
    """Eight hex digits of the MD5 of a line's inner vertices, which tell parallel edges apart."""
    inner = F.slice(line, 2, F.greatest(F.size(line) - 2, F.lit(0)))
    return F.substring(F.md5(F.array_join(F.transform(inner, lambda p: F.concat_ws(",", fixed(p["lon"], 6), fixed(p["lat"], 6))), "|")), 1, 8)


def subclass(highway: Column) -> Column:
    """The flat layer's class: footway, steps or street."""
    return F.when(highway == "footway", "footway").when(highway == "steps", "steps").otherwise("street")


def flat_footway(highway: Column, footway: Column) -> Column:
    return F.when(highway == "footway", F.nullif(footway, F.lit("")))


def description(name: Column, kind: Column, edge: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.trim(F.concat_ws(" ", kind, F.coalesce(edge, F.lit("")))))


def class_code(kind: Column) -> Column:
    """0 to 3 for sidewalk, crossing, footway and street, 4 for anything else."""
    return lookup(kind, {"sidewalk": 0, "crossing": 1, "footway": 2, "street": 3}, F.lit(4))


def binary_incline(c: Column) -> Column:
    return F.greatest(F.lit(-10000), F.least(F.lit(10000), F.rint(F.coalesce(c, F.lit(0.0)) * 10000))).cast("int")


def binary_width(c: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(255), F.rint(F.coalesce(c, F.lit(0.0)) * 5))).cast("int")


def binary_flags(has_ramp: Column, markings: Column) -> Column:
    """Bit 0: a curb ramp; bits 1 and 2: the kind of markings."""
    code = F.coalesce(lookup(F.trim(F.lower(markings)), MARKING_CODE), F.lit(0))
    return F.when(has_ramp, 1).otherwise(0).bitwiseOR(F.shiftleft(code, 1)).cast("int")


def binary_node(kerb: Column, tactile: Column) -> Column:
    """Bit 0: a lowered or flush kerb; bit 1: a raised one; bit 2: tactile paving."""
    curb = F.when(kerb.isin("lowered", "flush"), 1).when(kerb == "raised", 2).otherwise(0)
    return curb.bitwiseOR(F.when(tactile.cast("string").isin("yes", "true"), 4).otherwise(0)).cast("int")


def feature_kind(is_point: Column, barrier: Column, kerb: Column, highway: Column, footway: Column) -> Column:
    """The schema definition that a feature must satisfy; null if none fits."""
    curb = lookup(kerb, {"lowered": "CurbRamp", "flush": "FlushCurb", "raised": "RaisedCurb", "rolled": "RolledCurb"}, F.lit("GenericCurb"))
    walk = lookup(footway, {"sidewalk": "Sidewalk", "crossing": "Crossing", "traffic_island": "TrafficIsland"}, F.lit("Footway"))
    road = lookup(
        highway,
        {
            "primary": "PrimaryStreet", "secondary": "SecondaryStreet", "tertiary": "TertiaryStreet", "residential": "ResidentialStreet", "service": "ServiceRoad",
            "unclassified": "UnclassifiedRoad", "steps": "Steps", "trunk": "TrunkRoad", "living_street": "LivingStreet", "pedestrian": "Pedestrian",
        },
    )
    point = F.when(F.coalesce(barrier == "kerb", F.lit(False)), curb).otherwise("BareNode")
    return F.when(is_point, point).otherwise(F.when(highway == "footway", walk).otherwise(road))
