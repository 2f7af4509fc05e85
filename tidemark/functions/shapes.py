"""Columns for boxes, segments, packed dots, rotations and colours."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """The area that two boxes (x0, y0, x1, y1) share."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def segment_hits_box(p: tuple[Column, Column], q: tuple[Column, Column], box: tuple[Column, ...], pad: float = 0.5) -> Column:
    """Whether a segment passes through a box with some room around it: its clipped part isn't empty."""
    dx, dy = q[0] - p[0], q[1] - p[1]
    sides = ((-dx, p[0] - box[0] + pad), (dx, box[2] + pad - p[0]), (-dy, p[1] - box[1] + pad), (dy, box[3] + pad - p[1]))
    enter, leave, outside = F.lit(0.0), F.lit(1.0), F.lit(False)
    for speed, room in sides:
        at = room / F.nullif(speed, F.lit(0.0))
        enter = F.when(speed < 0, F.greatest(enter, at)).otherwise(enter)
        leave = F.when(speed > 0, F.least(leave, at)).otherwise(leave)
        outside = outside | ((speed == 0) & (room < 0))
    return ~outside & (enter <= leave)


def segments_cross(p1: tuple, p2: tuple, q1: tuple, q2: tuple) -> Column:
    """Whether each segment's ends lie on different sides of the other."""
    turn = lambda a, b, c: F.signum((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    return (turn(p1, p2, q1) != turn(p1, p2, q2)) & (turn(q1, q2, p1) != turn(q1, q2, p2))


def ring_capacity(ring: int) -> int:
    """Dots on a ring: floor(2 pi ring^2)."""
    return int(2 * math.pi * ring * ring)


def packed(clusters: DataFrame, key: str, n: str, step: float, hexagonal: bool = False) -> DataFrame:
    """(key, dot, dx, dy) of every dot of a cluster of n: the centre, then rings with their capacity, evenly spaced.

    The last ring holds what is left; a hexagonal packing's rings hold 6 ring
    dots and keep their spacing.  A dot's ring follows from its number alone.
    """
    dots = clusters.select(key, F.col(n).alias("__n"), F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("dot")).where("__n > 0")
    at = F.col("dot")
    if hexagonal:
        ring = F.ceil((F.sqrt(F.lit(9.0) + 12 * at.cast("double")) - 3) / 6)  # dots up to ring r: 1 + 3 r (r + 1)
        before = 1 + 3 * ring * (ring - 1)
        size = 6 * ring
    else:
        # capacities of rings that any cluster here can need: the sum of them grows with ring cubed
        most = clusters.agg(F.max(n)).first()[0] or 1  # one number
        first, rows, r = 1, [], 1
        while first < most:
            rows.append((r, first, ring_capacity(r)))
            first, r = first + ring_capacity(r), r + 1
        table = F.array(*[F.struct(F.lit(a).alias("ring"), F.lit(b).alias("first"), F.lit(c).alias("size")) for a, b, c in rows or [(1, 1, 6)]])
        mine = F.element_at(F.filter(table, lambda t: t["first"] <= F.greatest(at, F.lit(1))), -1)
        ring, before = mine["ring"], mine["first"]
        size = F.least(mine["size"], F.col("__n") - before)
    angle = 2 * math.pi * (at - before) / size
    centre = at == 0
    return dots.select(key, "dot", F.when(centre, 0.0).otherwise(ring * step * F.cos(angle)).alias("dx"), F.when(centre, 0.0).otherwise(ring * step * F.sin(angle)).alias("dy"))


def inward_shift(low: Column, high: Column, radius: float, limit: float) -> Column:
    """How far to move a cluster that spans low to high so that all its dots lie within the limit."""
    return F.when(high + radius > limit, limit - radius - high).when(low - radius < -limit, -limit + radius - low).otherwise(0.0)


def rotation(degrees: Column, reflect: Column) -> tuple[Column, Column, Column, Column]:
    """The rows of the matrix that mirrors x, if asked, and then rotates row vectors."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    side = F.when(reflect, -1.0).otherwise(1.0)
    return side * c, side * s, -s, c


def decomposed(m: tuple[Column, Column, Column, Column]) -> tuple[Column, Column]:
    """(degrees, reflected) of such a matrix."""
    reflected = m[0] * m[3] - m[1] * m[2] < 0
    side = F.when(reflected, -1.0).otherwise(1.0)
    return F.degrees(F.atan2(side * m[1], side * m[0])), reflected


def pale(colour: Column, factor: float = 0.4) -> Column:
    """A colour `#rrggbb` with less saturation and more value; greys are lightened, black becomes mid grey."""
    part = [F.conv(F.substring(colour, at, 2), 16, 10).cast("double") / 255 for at in (2, 4, 6)]
    value, least = F.greatest(*part), F.least(*part)
    grey = value == least
    lighter = F.when(value == 0, 0.5).otherwise(F.least(F.lit(1.0), value / factor))
    new_value = value + (1 - value) * (1 - factor)
    # hue and the order of the parts stay: each part keeps its share of the distance from the largest
    new = [F.when(grey, lighter).otherwise(new_value * (1 - factor * (value - p) / F.nullif(value, F.lit(0.0)))) for p in part]
    digits = [F.lower(F.lpad(F.hex(F.round(p * 255).cast("long")), 2, "0")) for p in new]
    return F.when(colour.isin("none", "transparent"), colour).otherwise(F.concat(F.lit("#"), *digits))


def grey_of(greyed: Column, colour: Column, reference: Column, marked: Column) -> Column:
    """The grey that a point is drawn in: the window's, open for a plain reference point without a colour, else grey; NULL for its own colour."""
    return F.when(greyed, "window").when(colour.isNull(), F.when(reference & ~marked, "open").otherwise("grey"))
