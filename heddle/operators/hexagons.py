"""Hexagonal cells of one area everywhere: a lattice in an equal-area projection.

Places are projected onto a cylinder that keeps areas (true to scale at 16 degrees,
the middle of Vietnam), and the plane is covered with hexagons, named by level and
axial coordinates. Each level's hexagons have a quarter of the area of those of the
level above. Cells don't wrap around the globe: neighbours stop at 180 degrees.
"""

from math import cos, radians, sqrt

from pyspark.sql import Column, functions as F

EARTH_KM = 6371.0088
_SCALE = cos(radians(16))
#: Kilometres of a hexagon's side at level 0; at level 8 cells have 0.65 square kilometres.
SIDE_KM = 128.0
#: Steps in axial coordinates to the six neighbours, in order around a cell.
STEPS = ((1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))


def side_km(level: int) -> float:
    return SIDE_KM / 2**level


def area_km2(level: int) -> float:
    return 1.5 * sqrt(3) * side_km(level) ** 2


def _rounded(q: Column, r: Column) -> tuple[Column, Column]:
    """The cell that holds a point, given in axial coordinates: of three that sum to zero the one most rounded is set by the others."""
    near = lambda v: F.floor(v + 0.5)
    s = -q - r
    a, b, c = near(q), near(s), near(r)
    da, db, dc = F.abs(a - q), F.abs(b - s), F.abs(c - r)
    first = (da > db) & (da > dc)
    return F.when(first, -b - c).otherwise(a), F.when(~first & (db <= dc), -a - b).otherwise(c)


def _axial(latitude: Column, longitude: Column, level: int) -> tuple[Column, Column]:
    x, y = F.radians(longitude) * (EARTH_KM * _SCALE), F.sin(F.radians(latitude)) * (EARTH_KM / _SCALE)
    return _rounded((x * (sqrt(3) / 3) - y / 3) / side_km(level), y * (2 / 3) / side_km(level))


def _name(level: int | Column, q: Column, r: Column) -> Column:
    return F.concat_ws(":", F.lit(level).cast("string") if isinstance(level, int) else level.cast("string"), q.cast("string"), r.cast("string"))


def hexagon(latitude: Column, longitude: Column, level: int = 8) -> Column:
    """``level:q:r`` of the cell of a place; null for null or impossible coordinates."""
    inside = latitude.between(-90, 90) & longitude.between(-180, 180)
    return F.when(inside, _name(level, *_axial(latitude, longitude, level)))


def coordinates(cell: Column) -> tuple[Column, Column]:
    parts = F.split(cell, ":")
    return F.get(parts, F.lit(1)).cast("long"), F.get(parts, F.lit(2)).cast("long")


def centre(cell: Column, level: int = 8) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre; null where that lies beyond a pole."""
    q, r = coordinates(cell)
    y, x = 1.5 * side_km(level) * r, sqrt(3) * side_km(level) * (q + r / 2)
    sine = y * (_SCALE / EARTH_KM)
    return F.when(F.abs(sine) <= 1, F.degrees(F.asin(sine))), F.degrees(x / (EARTH_KM * _SCALE))


def parent(cell: Column, level: int = 8) -> Column:
    """The cell of the level above that holds the centre of a cell of ``level``."""
    if level < 1:
        raise ValueError("cells of level 0 have no parent")
    q, r = coordinates(cell)
    # the lattice of the level above has twice the spacing and a centre in common
    return F.when(cell.isNotNull(), _name(level - 1, *_rounded(q / 2, r / 2)))


def ring(cell: Column, k: int = 1, level: int = 8) -> Column:
    """The 6 k cells at distance ``k``, in order around; the cell itself for 0."""
    q, r = coordinates(cell)
    if k == 0:
        return F.when(cell.isNotNull(), F.array(cell))
    made, at = [], (STEPS[4][0] * k, STEPS[4][1] * k)
    for step in STEPS:
        for _ in range(k):
            made.append(at)
            at = (at[0] + step[0], at[1] + step[1])
    return F.when(cell.isNotNull(), F.array(*(_name(level, q + dq, r + dr) for dq, dr in made)))


def disk(cell: Column, k: int = 1, level: int = 8) -> Column:
    """The cell and all within distance ``k``."""
    return F.concat(*(ring(cell, i, level) for i in range(k + 1)))


def distance(a: Column, b: Column) -> Column:
    """Steps between two cells of one level."""
    (aq, ar), (bq, br) = coordinates(a), coordinates(b)
    return F.greatest(F.abs(aq - bq), F.abs(ar - br), F.abs(aq - bq + ar - br))


def cell_sql(latitude: str, longitude: str, level: int) -> tuple[str, str]:
    """SQL of a cell's q and r, for other engines: the projection and the rounding as above."""
    x, y = f"(radians({longitude}) * {EARTH_KM * _SCALE!r})", f"(sin(radians({latitude})) * {EARTH_KM / _SCALE!r})"
    q, r = f"(({x} * {sqrt(3) / 3!r} - {y} / 3) / {side_km(level)!r})", f"({y} * {2 / 3!r} / {side_km(level)!r})"
    return rounded_sql(q, r)


def rounded_sql(q: str, r: str) -> tuple[str, str]:
    s = f"(-{q} - {r})"
    a, b, c = (f"floor({v} + 0.5)" for v in (q, s, r))
    da, db, dc = f"abs({a} - {q})", f"abs({b} - {s})", f"abs({c} - {r})"
    first = f"({da} > {db} AND {da} > {dc})"
    return f"CAST(CASE WHEN {first} THEN -{b} - {c} ELSE {a} END AS BIGINT)", f"CAST(CASE WHEN NOT {first} AND {db} <= {dc} THEN -{a} - {b} ELSE {c} END AS BIGINT)"
