"""The 1 km equal-area lattice, map tiles and keys, as SQL expressions over columns.

Every function returns SQL text built from other SQL text, so the same closed forms serve
DataFrames (``F.expr``) and the oracles. Cells are pairs of integers on an Albers equal-area
conic lattice for North America; joins use the integers, never the id string.
"""

from __future__ import annotations

import math

# GRS 80 ellipsoid; parallels 20 and 60 N, origin 40 N 96 W; Web-Mercator radius.
A, F_INV = 6378137.0, 298.257222101
LAT1, LAT2, LAT0, LON0 = 20.0, 60.0, 40.0, -96.0
MERCATOR_R = 6378137.0
CELL_M = 1000.0

E2 = (2 - 1 / F_INV) / F_INV
E = math.sqrt(E2)


def _q(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))


def _m(lat: float) -> float:
    return math.cos(math.radians(lat)) / math.sqrt(1 - E2 * math.sin(math.radians(lat)) ** 2)


N = (_m(LAT1) ** 2 - _m(LAT2) ** 2) / (_q(LAT2) - _q(LAT1))
C = _m(LAT1) ** 2 + N * _q(LAT1)
RHO0 = A * math.sqrt(C - N * _q(LAT0)) / N


def num(x: float) -> str:
    """A double literal that both engines read as a double."""
    return f"{x:.17e}"


def albers(lat: str, lon: str) -> tuple[str, str]:
    """Projected x and y in metres."""
    s = f"sin(radians({lat}))"
    q = f"({num(1 - E2)} * ({s} / (1 - {num(E2)} * {s} * {s}) - ln((1 - {num(E)} * {s}) / (1 + {num(E)} * {s})) * {num(1 / (2 * E))}))"
    rho = f"({num(A / N)} * sqrt({num(C)} - {num(N)} * {q}))"
    theta = f"({num(N)} * radians({lon} - ({num(LON0)})))"
    return f"({rho} * sin({theta}))", f"({num(RHO0)} - {rho} * cos({theta}))"


def cell_xy(lat: str, lon: str) -> tuple[str, str]:
    x, y = albers(lat, lon)
    return tuple(f"cast(floor({v} / {num(CELL_M)}) as int)" for v in (x, y))


def centre_lon(x: str, y: str) -> str:
    """Longitude of a cell's centre."""
    px, py = (f"({v} + {num(0.5)}) * {num(CELL_M)}" for v in (x, y))
    return f"({num(LON0)} + degrees(atan2({px}, {num(RHO0)} - ({py}))) / {num(N)})"


def centre_lat(x: str, y: str) -> str:
    """Latitude of a cell's centre, by the series of the authalic latitude."""
    px, py = (f"({v} + {num(0.5)}) * {num(CELL_M)}" for v in (x, y))
    rho2 = f"(({px}) * ({px}) + ({num(RHO0)} - ({py})) * ({num(RHO0)} - ({py})))"
    beta = f"asin(({num(C)} - {rho2} * {num(N * N / A / A)}) / {num(N * _q(90))})"
    c1 = E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040
    c2 = 23 * E2**2 / 360 + 251 * E2**3 / 3780
    c3 = 761 * E2**3 / 45360
    return f"degrees({beta} + {num(c1)} * sin(2 * {beta}) + {num(c2)} * sin(4 * {beta}) + {num(c3)} * sin(6 * {beta}))"


def cell_bounds(x: str, y: str) -> tuple[str, str, str, str]:
    """Sides of a cell in projected metres: least x and y, then largest."""
    return tuple(f"(({v} + {k}) * {num(CELL_M)})" for k in (0, 1) for v in (x, y))


def cell_id(x: str, y: str) -> str:
    return f"concat('naea-1km:x=', {x}, ':y=', {y})"


def solar_offset_us(lon: str) -> str:
    """Microseconds from a local-solar snapshot, stored as UTC, to the physical cutoff at ``lon``."""
    return f"cast(rint(({num(1.5)} - {lon} / 15) * {num(3.6e9)}) as bigint)"


def mercator_tile(lat: str, lon: str, metres: float) -> tuple[str, str]:
    """Indices of a square Web-Mercator tile of ``metres``."""
    x = f"({num(MERCATOR_R)} * radians({lon}))"
    y = f"({num(MERCATOR_R)} * ln(tan({num(math.pi / 4)} + radians({lat}) / 2)))"
    return tuple(f"cast(floor({v} / {num(metres)}) as int)" for v in (x, y))


def mercator_point(tx: str, ty: str, metres: float) -> tuple[str, str]:
    """Longitude and latitude of a place in tiles."""
    x, y = (f"({v} * {num(metres)} / {num(MERCATOR_R)})" for v in (tx, ty))
    return f"degrees({x})", f"degrees(2 * atan(exp({y})) - {num(math.pi / 2)})"


def ecef(lat: str, lon: str) -> tuple[str, str, str]:
    """Earth-centred coordinates on the ellipsoid, in metres."""
    nu = f"({num(A)} / sqrt(1 - {num(E2)} * sin(radians({lat})) * sin(radians({lat}))))"
    return (
        f"({nu} * cos(radians({lat})) * cos(radians({lon})))",
        f"({nu} * cos(radians({lat})) * sin(radians({lon})))",
        f"({nu} * {num(1 - E2)} * sin(radians({lat})))",
    )


def region_key(x: str, y: str, cells: int = 1000) -> str:
    return f"concat(cast(floor({x} / {num(cells)}) as int), ':', cast(floor({y} / {num(cells)}) as int))"


def stable_fraction(text: str) -> str:
    """The first 13 hex digits of sha256 as a share of 16^13 (Spark)."""
    return f"(cast(conv(substring(sha2({text}, 256), 1, 13), 16, 10) as double) / {num(16.0**13)})"


def wind_uv(speed: str, direction: str) -> tuple[str, str]:
    return f"(-{speed} * sin(radians({direction})))", f"(-{speed} * cos(radians({direction})))"


def logit(p: str, eps: float = 1e-6) -> str:
    held = f"least(greatest({p}, {num(eps)}), {num(1 - eps)})"
    return f"ln({held} / (1 - {held}))"


def evidence_score(brightness: str, count: str, age_h: str, anchor_h: float = 24.0, rounding: str = "") -> str:
    """Rounded half to even at the sixth place; ``rounding`` is another engine's name for that.

    Spark's own ``bround`` rounds the shortest decimal text of a double, so a sum that ends in a half is up to the last bit of its
    parts. Here the millionfold is rounded, which is what the other engine does.
    """
    score = (
        f"{num(0.55)} * least(greatest({brightness} / {num(400)}, {num(0)}), {num(1)})"
        f" + {num(0.25)} * least({num(1)}, ln(1 + {count}) / {num(math.log(11))})"
        f" + {num(0.2)} * greatest({num(0)}, 1 - {age_h} / {num(anchor_h)})"
    )
    return f"{rounding}({score}, 6)" if rounding else f"(rint(({score}) * {num(1e6)}) / {num(1e6)})"
