"""WGS 84 to UTM in plain SQL arithmetic (sixth-order Krueger series of the transverse Mercator projection), valid in any SQL engine."""

from __future__ import annotations

import math

# The WGS 84 ellipsoid and the scale on the central meridian.
A, FLAT, K0 = 6_378_137.0, 1 / 298.257223563, 0.9996


def zone(lat: str, lon: str) -> str:
    """SQL of the UTM zone, with the exceptions of south-west Norway and Svalbard; null outside of -80..84 and -180..180."""
    usual = f"least(60, cast(floor(({lon} + 180) / 6) as int) + 1)"
    svalbard = f"case when {lon} < 9 then 31 when {lon} < 21 then 33 when {lon} < 33 then 35 else 37 end"
    return f"case when not ({lat} between -80 and 84 and {lon} between -180 and 180) then null when {lat} >= 56 and {lat} < 64 and {lon} >= 3 and {lon} < 12 then 32 when {lat} >= 72 and {lon} >= 0 and {lon} < 42 then ({svalbard}) else {usual} end"


def _series() -> tuple[float, float, list[float]]:
    n = FLAT / (2 - FLAT)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    return n, radius, alpha


def utm(lat: str, lon: str, zone_col: str) -> tuple[str, str]:
    """SQL of easting and northing in metres of a position in degrees and its zone."""
    n, radius, alpha = _series()
    c = 2 * math.sqrt(n) / (1 + n)
    s = f"sin(radians({lat}))"
    atanh = lambda x: f"(0.5 * ln((1.0 + {x}) / (1.0 - {x})))"
    q = f"({atanh(s)} - {c!r} * {atanh(f'({c!r} * {s})')})"
    t = f"((exp({q}) - exp(-{q})) / 2)"
    dl = f"radians({lon} - ({zone_col} * 6 - 183))"
    xi = f"atan2({t}, cos({dl}))"
    u = f"(sin({dl}) / sqrt(1.0 + {t} * {t}))"
    eta = atanh(u)
    east, north = [eta], [xi]
    for j, a in enumerate(alpha, 1):
        k = 2 * j
        ex = f"exp({k} * {eta})"
        east.append(f"{a!r} * cos({k} * {xi}) * (({ex} - 1.0 / {ex}) / 2)")
        north.append(f"{a!r} * sin({k} * {xi}) * (({ex} + 1.0 / {ex}) / 2)")
    scale = K0 * radius
    return f"(500000.0 + {scale!r} * ({' + '.join(east)}))", f"(case when {lat} < 0 then 10000000.0 else 0.0 end + {scale!r} * ({' + '.join(north)}))"
