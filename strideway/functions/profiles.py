"""Cost profiles: functions of parameters that give a cost column; a null cost means that an edge can't be passed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance() -> Column:
    """The edge's length."""
    return F.col("length")


def wheelchair(avoid_curbs: bool = True, uphill: float = 0.083, downhill: float = -0.1, honour_avoid_curbs: bool = False) -> Column:
    """The length, unless the edge is a crossing without a ramp or too steep; an unknown length costs nothing.

    ``avoid_curbs`` has no effect on its own, as crossings without ramps are always closed; with
    ``honour_avoid_curbs`` they are closed only if it is set.
    """
    no_ramp = F.coalesce(F.col("footway") == "crossing", F.lit(False)) & ~F.coalesce(F.col("curbramps") == 1, F.lit(False))
    steep = F.coalesce((F.col("incline") > uphill) | (F.col("incline") < downhill), F.lit(False))
    closed = steep if honour_avoid_curbs and not avoid_curbs else no_ramp | steep
    return F.when(~closed, F.coalesce(F.col("length"), F.lit(0.0)))


PROFILES: dict[str, Callable[..., Column]] = {"distance": distance, "wheelchair": wheelchair}


def register(name: str, profile: Callable[..., Column]) -> None:
    """Add a profile of one's own."""
    PROFILES[name] = profile
