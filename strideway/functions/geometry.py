"""Geometry as plain columns: points are (lon, lat) or (x, y) doubles, lines arrays of such structs, polygons arrays of rings.

All functions build Column expressions, so they stay inside Catalyst. Points' fields are named ``lon`` and
``lat`` on the globe and ``x`` and ``y`` on the plane; ``fields`` says which.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres per degree of latitude in the equirectangular lengths, and the Earth's mean radius for haversines.
METRES_PER_DEGREE = 111_319.0
EARTH_RADIUS = 6_371_000.0
_LONLAT, _XY = ("lon", "lat"), ("x", "y")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def point(lon: Column | str, lat: Column | str, fields: tuple[str, str] = _LONLAT) -> Column:
    return F.struct(_c(lon).cast("double").alias(fields[0]), _c(lat).cast("double").alias(fields[1]))


def start_point(line: Column | str) -> Column:
    return F.get(_c(line), F.lit(0))


def end_point(line: Column | str) -> Column:
    return F.element_at(_c(line), -1)


def _segments(line: Column, start, step) -> Column:
    """Fold ``step(sum, first, second)`` over neighbouring vertices; 0.0 for fewer than two."""
    n = F.size(line)
    return F.when(n >= 2, F.aggregate(F.sequence(F.lit(1), n - 1), start, lambda s, i: s + step(F.get(line, i - 1), F.get(line, i)))).otherwise(F.lit(0.0))


def length_mid_latitude(line: Column | str) -> Column:
    """Equirectangular length in metres, scaled at each segment's middle latitude."""

    def step(a: Column, b: Column) -> Column:
        dx = (b["lon"] - a["lon"]) * METRES_PER_DEGREE * F.cos(F.radians((a["lat"] + b["lat"]) / 2))
        return F.hypot(dx, (b["lat"] - a["lat"]) * METRES_PER_DEGREE)

    return _segments(_c(line), F.lit(0.0), step)


def length_start_latitude(line: Column | str) -> Column:
    """Equirectangular length in metres, scaled at each segment's first latitude."""

    def step(a: Column, b: Column) -> Column:
        dx = (b["lon"] - a["lon"]) * METRES_PER_DEGREE * F.cos(F.radians(a["lat"]))
        return F.hypot(dx, (b["lat"] - a["lat"]) * METRES_PER_DEGREE)

    return _segments(_c(line), F.lit(0.0), step)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def length_haversine(line: Column | str) -> Column:
    return _segments(_c(line), F.lit(0.0), lambda a, b: haversine(a["lon"], a["lat"], b["lon"], b["lat"]))


def length_planar(line: Column | str) -> Column:
    """Length of a line of projected (x, y) vertices."""
    return _segments(_c(line), F.lit(0.0), lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))


def ring_area(ring: Column | str, fields: tuple[str, str] = _XY) -> Column:
    """Unsigned shoelace area of a closed ring."""
    x, y = fields
    return F.abs(_segments(_c(ring), F.lit(0.0), lambda a, b: a[x] * b[y] - b[x] * a[y])) / 2


def polygon_area(rings: Column | str, fields: tuple[str, str] = _XY) -> Column:
    """The exterior's area less the holes'."""
    r = _c(rings)
    holes = F.aggregate(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.lit(0.0), lambda s, h: s + ring_area(h, fields))
    return F.coalesce(ring_area(F.get(r, F.lit(0)), fields), F.lit(0.0)) - holes


def exterior_perimeter(rings: Column | str) -> Column:
    return F.coalesce(length_planar(F.get(_c(rings), F.lit(0))), F.lit(0.0))


def strip_width(area: Column, perimeter: Column) -> Column:
    """The width of a long strip of this area and perimeter, to the centimetre; null without a perimeter."""
    return F.round(2 * area / F.nullif(perimeter, F.lit(0.0)), 2)


def line_centroid(line: Column | str, fields: tuple[str, str] = _XY) -> Column:
    """Length-weighted mean of the segments' middles; of a line without length, the mean of its vertices."""
    c, (x, y) = _c(line), fields
    n = F.size(c)
    weight = lambda a, b: F.hypot(b[x] - a[x], b[y] - a[y])
    total = _segments(c, F.lit(0.0), weight)
    along = lambda f: _segments(c, F.lit(0.0), lambda a, b: weight(a, b) * (a[f] + b[f]) / 2)
    plain = lambda f: F.aggregate(c, F.lit(0.0), lambda s, p: s + p[f]) / n
    return F.struct(*[F.when(total > 0, along(f) / total).otherwise(plain(f)).alias(f) for f in (x, y)])


def ring_mean(ring: Column | str, fields: tuple[str, str] = _LONLAT) -> Column:
    """The mean of a ring's vertices, the closing one included."""
    c = _c(ring)
    total = lambda f: F.aggregate(c, F.lit(0.0), lambda s, p: s + p[f])
    return F.struct(*[(total(f) / F.size(c)).alias(f) for f in fields])


def polygon_centroid(ring: Column | str, fields: tuple[str, str] = _XY) -> Column:
    """Area-weighted centroid of a closed ring."""
    c, (x, y) = _c(ring), fields
    cross = lambda a, b: a[x] * b[y] - b[x] * a[y]
    twice = _segments(c, F.lit(0.0), cross)
    moment = lambda f: _segments(c, F.lit(0.0), lambda a, b: (a[f] + b[f]) * cross(a, b))
    return F.struct(*[(moment(f) / F.nullif(3 * twice, F.lit(0.0))).alias(f) for f in (x, y)])


def contains_point(rings: Column | str, px: Column, py: Column, fields: tuple[str, str] = _LONLAT, boundary: bool | None = False) -> Column:
    """Does the polygon hold the point strictly inside? Holes count as outside; the boundary too, unless asked for.

    With ``boundary`` None, polygons that share a border share no point of it: one on a border belongs to the polygon on its right, or above it.
    """
    x, y = fields

    def edges(ring: Column):
        return F.sequence(F.lit(1), F.size(ring) - 1)

    def crossing(a: Column, b: Column) -> Column:
        straddles = (a[y] > py) != (b[y] > py)
        return F.when(straddles & (px < (b[x] - a[x]) * (py - a[y]) / (b[y] - a[y]) + a[x]), 1).otherwise(0)

    def touches(a: Column, b: Column) -> Column:
        cross = (b[x] - a[x]) * (py - a[y]) - (b[y] - a[y]) * (px - a[x])
        return (cross == 0) & px.between(F.least(a[x], b[x]), F.greatest(a[x], b[x])) & py.between(F.least(a[y], b[y]), F.greatest(a[y], b[y]))

    whole = F.filter(_c(rings), lambda r: F.size(r) >= 2)
    count = F.aggregate(whole, F.lit(0), lambda s, r: s + F.aggregate(edges(r), F.lit(0), lambda t, i: t + crossing(F.get(r, i - 1), F.get(r, i))))
    inside = count % 2 == 1
    if boundary is None:
        return inside
    on = F.exists(whole, lambda r: F.exists(edges(r), lambda i: touches(F.get(r, i - 1), F.get(r, i))))
    return inside | on if boundary else inside & ~on


def point_segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    t = F.when(square == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / square)))
    return F.hypot(px - (ax + t * dx), py - (ay + t * dy))


def segment_distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Distance between the segments a-b and c-d of (x, y) points; 0 if they cross."""

    def side(p: Column, q: Column, r: Column) -> Column:
        return (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])

    cross = (side(a, b, c) * side(a, b, d) < 0) & (side(c, d, a) * side(c, d, b) < 0)
    ends = [(a, c, d), (b, c, d), (c, a, b), (d, a, b)]
    return F.when(cross, 0.0).otherwise(F.least(*[point_segment_distance(p["x"], p["y"], q["x"], q["y"], r["x"], r["y"]) for p, q, r in ends]))


def bounds(line: Column | str, fields: tuple[str, str] = _LONLAT) -> Column:
    """Struct of the smallest and largest coordinates: min_x, min_y, max_x, max_y."""
    c, (x, y) = _c(line), fields
    xs, ys = F.transform(c, lambda p: p[x]), F.transform(c, lambda p: p[y])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def bounds_polygon(west: float, south: float, east: float, north: float) -> Column:
    """A rectangle as a polygon of one closed ring."""
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.array(F.array(*[point(F.lit(a), F.lit(b)) for a, b in corners]))


def in_box(lon: Column, lat: Column, west: float, south: float, east: float, north: float) -> Column:
    return lon.between(float(west), float(east)) & lat.between(float(south), float(north))


def intersects_box(line: Column | str, west: float, south: float, east: float, north: float, fields: tuple[str, str] = _LONLAT) -> Column:
    """Does the line meet the closed rectangle? Exact: a vertex inside, or a segment that crosses it (Liang-Barsky)."""
    c, (x, y) = _c(line), fields

    def meets(a: Column, b: Column) -> Column:
        lo, hi, possible = F.lit(0.0), F.lit(1.0), F.lit(True)
        for f, low, high in ((x, float(west), float(east)), (y, float(south), float(north))):
            d = b[f] - a[f]
            t1, t2 = (low - a[f]) / F.nullif(d, F.lit(0.0)), (high - a[f]) / F.nullif(d, F.lit(0.0))
            flat = d == 0
            possible = possible & (~flat | a[f].between(low, high))
            lo = F.when(flat, lo).otherwise(F.greatest(lo, F.least(t1, t2)))
            hi = F.when(flat, hi).otherwise(F.least(hi, F.greatest(t1, t2)))
        return possible & (lo <= hi)

    inside = F.exists(c, lambda p: in_box(p[x], p[y], west, south, east, north))
    return inside | F.when(F.size(c) >= 2, F.exists(F.sequence(F.lit(1), F.size(c) - 1), lambda i: meets(F.get(c, i - 1), F.get(c, i)))).otherwise(False)


def outside_globe(line: Column | str) -> Column:
    """Is any vertex outside the valid range of longitudes and latitudes?"""
    return F.exists(_c(line), lambda p: ~(p["lon"].between(-180.0, 180.0) & p["lat"].between(-90.0, 90.0)))


def first_outside(line: Column | str) -> Column:
    """The first vertex outside the valid range, or null."""
    return F.get(F.filter(_c(line), lambda p: ~(p["lon"].between(-180.0, 180.0) & p["lat"].between(-90.0, 90.0))), F.lit(0))


def set_endpoints(line: Column | str, first: Column, last: Column) -> Column:
    """The line with its first and last vertex replaced, where a replacement is known."""
    c = _c(line)
    n = F.size(c)
    middle = F.slice(c, 2, F.greatest(n - 2, F.lit(0)))
    return F.when(n >= 2, F.concat(F.array(F.coalesce(first, F.get(c, F.lit(0)))), middle, F.array(F.coalesce(last, F.element_at(c, -1))))).otherwise(c)


def incline(rise: Column, run: Column) -> Column:
    """Rise over run to four decimals; null without a run or where it exceeds one either way."""
    slope = F.round(rise / F.nullif(run, F.lit(0.0)), 4)
    return F.when(F.abs(rise / F.nullif(run, F.lit(0.0))) <= 1.0, slope)


def pixel_grid(west: float, south: float, east: float, north: float, resolution: float, limit: int = 3000) -> tuple[int, int, float]:
    """(columns, rows, metres per pixel that result) of a raster over the box, each side capped."""
    width = (east - west) * METRES_PER_DEGREE * math.cos(math.radians((south + north) / 2))
    height = (north - south) * METRES_PER_DEGREE
    cols, rows = (min(limit, max(1, int(d / resolution))) for d in (width, height))
    return cols, rows, max(width / cols, height / rows)


def ring_is_valid(ring: Column | str, fields: tuple[str, str] = _LONLAT) -> Column:
    """At least four vertices, the last equal to the first, and all coordinates finite."""
    c, (x, y) = _c(ring), fields
    finite = F.forall(c, lambda p: p[x].isNotNull() & p[y].isNotNull() & ~F.isnan(p[x]) & ~F.isnan(p[y]) & (F.abs(p[x]) < float("inf")) & (F.abs(p[y]) < float("inf")))
    return (F.size(c) >= 4) & (F.get(c, F.lit(0)) == F.element_at(c, -1)) & finite
