"""Shapes that need more than a fold over vertices: convex hulls, smallest rectangles, centre lines, repair of rings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A centre line shorter than this is no line.
LEAST_LENGTH = 0.5


def hull(points: np.ndarray) -> np.ndarray:
    """Counter-clockwise convex hull, by sorted chains."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(rows) -> list:
        out: list = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(chain(p) + chain(p[::-1]))


def smallest_rectangle(points: np.ndarray) -> np.ndarray | None:
    """The four corners of the rectangle of least area around the points; it shares a side's direction with the hull."""
    h = hull(points)
    if len(h) < 3:
        return None
    best = None
    for side in np.roll(h, -1, axis=0) - h:
        size = np.hypot(*side)
        if not size:
            continue
        axes = np.array([side / size, [-side[1] / size, side[0] / size]])
        along = h @ axes.T
        low, high = along.min(axis=0), along.max(axis=0)
        area = float(np.prod(high - low))
        if best is None or area < best[0] - 1e-9:
            corners = np.array([[low[0], low[1]], [high[0], low[1]], [high[0], high[1]], [low[0], high[1]]])
            best = (area, corners @ axes)
    return None if best is None else best[1]


def centre_line(points: np.ndarray) -> np.ndarray | None:
    """The line between the middles of the two short sides of the smallest rectangle; null if it is too short."""
    c = smallest_rectangle(points)
    if c is None:
        return None
    sides = np.hypot(*(np.roll(c, -1, axis=0) - c).T)
    k = 0 if sides[0] + sides[2] <= sides[1] + sides[3] else 1
    line = np.array([(c[k] + c[k + 1]) / 2, (c[k + 2] + c[(k + 3) % 4]) / 2])
    return line if np.hypot(*(line[1] - line[0])) >= LEAST_LENGTH else None


def _points(*fields: str) -> T.ArrayType:
    """An array of points as a type object: workers import this module without a session to parse one."""
    return T.ArrayType(T.StructType([T.StructField(f, T.DoubleType()) for f in fields]))


@F.pandas_udf(_points("x", "y"))
def centerline(rings: pd.Series) -> pd.Series:
    """Centre line of a polygon of (x, y) rings, from its outer ring."""

    def one(value):
        if value is None or not len(value) or value[0] is None or len(value[0]) < 3:
            return None
        line = centre_line(np.array([[p["x"], p["y"]] for p in value[0]], dtype=float))
        return None if line is None else [{"x": float(x), "y": float(y)} for x, y in line]

    return rings.map(one)


@F.pandas_udf(_points("lon", "lat"))
def repair_ring(ring: pd.Series) -> pd.Series:
    """Best effort on one ring: drops unusable and repeated vertices, closes it; null if fewer than three places are left."""

    def one(value):
        out: list = []
        for p in value if value is not None else []:
            if p is None or p["lon"] is None or p["lat"] is None or not np.isfinite([p["lon"], p["lat"]]).all():
                continue
            q = {"lon": float(p["lon"]), "lat": float(p["lat"])}
            if not out or q != out[-1]:
                out.append(q)
        if len(out) > 1 and out[0] == out[-1]:
            out.pop()
        return [*out, out[0]] if len(out) > 2 else None

    return ring.map(one)
