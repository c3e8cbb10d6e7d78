"""Column expressions for points, cells and distances.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell_side(D: float) -> float:
    """Side of a grid cell whose diagonal is D/2."""
    if not D > 0:
        raise ValueError(f"distance D must be > 0, got {D!r}")
    return D / (2 * 2 ** 0.5)


def cell_index(v: Column | str, side: float) -> Column:
    """Cell index along one axis.

    ``v/side`` shifted down by one for negative values, then truncated toward
    zero (a cast, not ``floor``). Negative cells are therefore ``(lo, hi]``
    and an exact negative boundary lands one cell lower than ``floor``.
    """
    v = F.col(v) if isinstance(v, str) else v
    return ((v / F.lit(side)) + F.when(v < 0, F.lit(-1)).otherwise(F.lit(0))).cast("bigint")


def sq_dist(ax: Column | str, ay: Column | str, bx: Column | str, by: Column | str) -> Column:
    ax, ay, bx, by = (F.col(c) if isinstance(c, str) else c for c in (ax, ay, bx, by))
    dx = ax - bx
    dy = ay - by
    return dx * dx + dy * dy


def dist(ax: Column | str, ay: Column | str, bx: Column | str, by: Column | str) -> Column:
    """Euclidean distance, written as ``sqrt(dx*dx + dy*dy)``.

    Same form as the SQL oracles so both engines round identically.
    """
    return F.sqrt(sq_dist(ax, ay, bx, by))


def offsets(r: int) -> Column:
    """Array ``[-r .. r]`` to explode a stencil along one axis."""
    return F.sequence(F.lit(-r), F.lit(r))


def min_sq_dist_to_box(px: Column, py: Column, x0: Column, x1: Column,
                       y0: Column, y1: Column) -> Column:
    dx = F.greatest(x0 - px, F.lit(0.0), px - x1)
    dy = F.greatest(y0 - py, F.lit(0.0), py - y1)
    return dx * dx + dy * dy


def max_sq_dist_to_box(px: Column, py: Column, x0: Column, x1: Column,
                       y0: Column, y1: Column) -> Column:
    dx = F.greatest(F.abs(px - x0), F.abs(px - x1))
    dy = F.greatest(F.abs(py - y0), F.abs(py - y1))
    return dx * dx + dy * dy
