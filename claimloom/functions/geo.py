"""Grids, projections, polygons and Plus Codes as Column expressions."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimloom.functions.scalar import haversine_m, let

# The national grid (EPSG:2039) on GRS80, and the shift from WGS84 by seven parameters (metres, arc seconds, ppm).
_A, _F = 6378137.0, 1 / 298.257222101
_LAT0, _LON0, _K0, _FE, _FN = math.radians(31.7343936111111), math.radians(35.2045169444444), 1.0000067, 219529.584, 626907.39
_SHIFT, _TURN, _PPM = (-24.0024, -17.1032, -17.8444), (-0.33077, -1.85269, 1.66969), 5.4248
_E2 = _F * (2 - _F)
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORWARD = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
#: The boxes (lat, lon) of the country and of the area. A projection outside its box is refused.
BOX, AREA = (29.4, 33.4, 34.2, 35.9), (32.45, 32.95, 34.95, 35.60)


def _total(terms: list):
    return reduce(lambda a, b: a + b, terms)


def detect_grid(x: Column, y: Column) -> Column:
    """'itm', 'ics' or 'unknown' by the ranges of the two grids."""
    itm = y.between(300_000, 820_000) & x.between(100_000, 300_000)
    ics = y.between(-60_000, 299_999) & x.between(60_000, 260_000)
    return F.when(itm, "itm").when(ics, "ics").otherwise("unknown")


def _conformal(lat):
    e, s = math.sqrt(_E2), np.sin(lat)
    return np.arctan(np.sinh(np.arctanh(s) - e * np.arctanh(e * s)))


def _meridian0() -> float:
    chi = float(_conformal(_LAT0))
    return chi + sum(a * math.sin(2 * k * chi) for k, a in enumerate(_FORWARD, 1))


def _cartesian(lat, lon) -> tuple:
    v = _A / np.sqrt(1 - _E2 * np.sin(lat) ** 2)
    return v * np.cos(lat) * np.cos(lon), v * np.cos(lat) * np.sin(lon), v * (1 - _E2) * np.sin(lat)


def _geodetic(x, y, z) -> tuple:
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - _E2))
    for _ in range(4):
        s = np.sin(lat)
        lat = np.arctan2(z + _E2 * _A / np.sqrt(1 - _E2 * s * s) * s, p)
    return lat, np.arctan2(y, x)


def _turned(x, y, z, sign: int) -> tuple:
    rx, ry, rz = (sign * math.radians(t / 3600) for t in _TURN)
    return x + rz * y - ry * z, -rz * x + y + rx * z, ry * x - rx * y + z


@F.pandas_udf(StructType().add("x", "double").add("y", "double"))
def to_itm(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
    """struct(x, y), metres to one decimal."""
    scale = 1 + _PPM * 1e-6
    local = ((c - t) / scale for c, t in zip(_cartesian(np.radians(lat.to_numpy(float)), np.radians(lon.to_numpy(float))), _SHIFT))
    phi, lam = _geodetic(*_turned(*local, 1))
    t, away = np.tan(_conformal(phi)), lam - _LON0
    xi, eta = np.arctan2(t, np.cos(away)), np.arcsinh(np.sin(away) / np.hypot(t, np.cos(away)))
    north = xi + _total([a * np.sin(2 * k * xi) * np.cosh(2 * k * eta) for k, a in enumerate(_FORWARD, 1)])
    east = eta + _total([a * np.cos(2 * k * xi) * np.sinh(2 * k * eta) for k, a in enumerate(_FORWARD, 1)])
    return pd.DataFrame({"x": np.round(_FE + _K0 * _RADIUS * east, 1), "y": np.round(_FN + _K0 * _RADIUS * (north - _meridian0()), 1)})


@F.pandas_udf(StructType().add("lat", "double").add("lon", "double"))
def _to_wgs84(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    north, east = (y.to_numpy(float) - _FN) / (_K0 * _RADIUS) + _meridian0(), (x.to_numpy(float) - _FE) / (_K0 * _RADIUS)
    xi = north - _total([b * np.sin(2 * k * north) * np.cosh(2 * k * east) for k, b in enumerate(_BACK, 1)])
    eta = east - _total([b * np.cos(2 * k * north) * np.sinh(2 * k * east) for k, b in enumerate(_BACK, 1)])
    chi, e = np.arcsin(np.clip(np.sin(xi) / np.cosh(eta), -1, 1)), math.sqrt(_E2)
    phi = chi
    for _ in range(5):
        phi = np.arctan(np.sinh(np.arctanh(np.sin(chi)) + e * np.arctanh(e * np.sin(phi))))
    local = _turned(*_cartesian(phi, _LON0 + np.arctan2(np.sinh(eta), np.cos(xi))), -1)
    lat, lon = _geodetic(*(c * (1 + _PPM * 1e-6) + t for c, t in zip(local, _SHIFT)))
    return pd.DataFrame({"lat": np.round(np.degrees(lat), 6), "lon": np.round(np.degrees(lon), 6)})


def try_to_wgs84(x: Column, y: Column, box: tuple[float, ...] = BOX) -> Column:
    """struct(lat, lon) of a national grid point, six decimals; null outside the box."""
    at = _to_wgs84(x.cast("double"), y.cast("double"))
    return F.when(at["lat"].between(*box[:2]) & at["lon"].between(*box[2:]), at)


# ---------------------------------------------------------------- polygons


def edges(rings: list[list[tuple[float, float]]]) -> Column:
    """All edges of closed rings as one array literal of structs (x1, y1, x2, y2). A boundary is a few thousand edges; keep it that small."""
    found = [(*p, *q) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1]) if p != q]
    text = ",".join(f"named_struct('x1',{float(a)!r}D,'y1',{float(b)!r}D,'x2',{float(c)!r}D,'y2',{float(d)!r}D)" for a, b, c, d in found)
    return F.expr(f"array({text})")


def signed_distance(x: Column, y: Column, shape: Column) -> Column:
    """Distance to the nearest edge, one decimal: positive inside (an odd number of crossings, so holes and parts count), else negative."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        return spans & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])

    def apart(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / (dx * dx + dy * dy)))
        return F.sqrt((x - e["x1"] - t * dx) ** 2 + (y - e["y1"] - t * dy) ** 2)

    odd = F.size(F.filter(shape, crosses)) % 2 == 1
    d = F.round(F.array_min(F.transform(shape, apart)), 1)
    return F.when(odd, d).otherwise(-d)


def jurisdiction(rows: DataFrame, shape: Column, x: str = "itm_x", y: str = "itm_y", near: float = 300.0) -> DataFrame:
    """rows with in_council, in_council_method, dist_to_boundary_m and near_boundary; null and 'no_coordinate' without a position."""
    d = F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), signed_distance(F.col(x), F.col(y), shape))
    out = rows.withColumn("dist_to_boundary_m", d)
    d = F.col("dist_to_boundary_m")
    return out.withColumns({"in_council": d > 0, "in_council_method": F.when(d.isNull(), "no_coordinate").otherwise("point_in_polygon"), "near_boundary": F.abs(d) <= near})


# ---------------------------------------------------------------- Plus Codes

# The alphabet, and the sizes of the grid below ten digits.
_DIGITS, _ROWS, _COLUMNS = "23456789CFGHJMPQRVWX", 5, 4


def plus_encode(lat: Column, lon: Column) -> Column:
    """Ten digits with the plus sign. Integer steps of 1/8000 degree avoid rounding at the edges of cells."""
    y = F.greatest(F.lit(0), F.least(F.floor((lat + 90) * 8000 + 1e-6), F.lit(180 * 8000 - 1))).cast("long")
    x = F.pmod(F.floor((lon + 180) * 8000 + 1e-6), F.lit(360 * 8000)).cast("long")
    out = []
    for k in range(5):
        unit = 20 ** (4 - k)
        for v in (y, x):
            out.append(F.substring(F.lit(_DIGITS), (F.floor(v / unit) % 20 + 1).cast("int"), F.lit(1)))
    return F.concat(*out[:8], F.lit("+"), *out[8:])


def plus_valid(code: Column) -> Column:
    """One plus sign after an even number of at most eight digits or zeros, and a digit at least."""
    return F.coalesce(F.upper(code).rlike(f"^(?=.*[{_DIGITS}0])(?:[{_DIGITS}0]{{2}}){{0,4}}\\+[{_DIGITS}0]*$"), F.lit(False))


def plus_parse(text: Column) -> Column:
    """The first valid code among the words of a text."""
    words = F.split(F.upper(F.translate(text, ",", " ")), r"\s+")
    return F.try_element_at(F.filter(words, plus_valid), F.lit(1))


def plus_center(code: Column) -> Column:
    """struct(lat, lon): centre of a full code's cell, five-by-four digits beyond the tenth included; null for other texts."""

    def centre(body: Column) -> Column:
        n = F.length(body)
        digit = lambda k: F.call_function("locate", F.substring(body, k + 1, 1), F.lit(_DIGITS)) - 1
        there = lambda k, v: F.when(n > k, v).otherwise(0.0)
        fine = range(1, 6)
        lat = _total([F.lit(-90.0), *(there(2 * k + 1, digit(2 * k) * (20.0 / 20**k)) for k in range(5)), *(there(9 + j, F.floor(digit(9 + j) / _COLUMNS) * (1 / 8000 / _ROWS**j)) for j in fine)])
        lon = _total([F.lit(-180.0), *(there(2 * k + 1, digit(2 * k + 1) * (20.0 / 20**k)) for k in range(5)), *(there(9 + j, digit(9 + j) % _COLUMNS * (1 / 8000 / _COLUMNS**j)) for j in fine)])
        pair = F.pow(F.lit(20.0), 2 - F.least(F.lit(5), F.floor(n / 2)))
        more = F.greatest(F.lit(0), F.least(F.lit(5), n - 10))
        return F.struct((lat + pair / F.pow(F.lit(float(_ROWS)), more) / 2).alias("lat"), (lon + pair / F.pow(F.lit(float(_COLUMNS)), more) / 2).alias("lon"))

    body = F.regexp_replace(F.translate(F.upper(code), "+", ""), "0+$", "")
    return F.when(plus_valid(code) & (F.instr(code, "+") == 9) & (F.length(body) >= 2), let(body, centre))


def plus_recover(code: Column, lat: Column, lon: Column) -> Column:
    """struct(lat, lon), seven decimals: the cell of a short or full code that lies nearest to a reference point."""
    code = F.upper(F.trim(code))
    missing = 9 - F.instr(code, "+")
    step = F.pow(F.lit(20.0), 2 - missing / 2)

    def moved(at: Column, ref: Column, edge: float) -> Column:
        to = F.when(at - ref > step / 2, at - step).when(ref - at > step / 2, at + step).otherwise(at)
        return F.when((missing > 0) & (F.abs(to) <= edge), to).otherwise(at)

    near = let(F.concat(F.substr(plus_encode(lat, lon), F.lit(1), missing), code), plus_center)
    found = let(near, lambda c: F.when(c.isNotNull(), F.struct(F.round(moved(c["lat"], lat, 90.0), 7).alias("lat"), F.round(moved(c["lon"], lon, 540.0), 7).alias("lon"))))
    return F.when(missing % 2 == 0, found)


def coords_from_plus_code(text: Column, lat: Column, lon: Column, metres: float = 8000.0) -> Column:
    """struct(lat, lon) of a code inside a text, unless it is out of the box or too far from the reference."""

    def near(at: Column) -> Column:
        inside = at["lat"].between(*AREA[:2]) & at["lon"].between(*AREA[2:])
        return F.when(inside & (haversine_m(lat, lon, at["lat"], at["lon"]) <= metres), at)

    return let(plus_recover(plus_parse(text), lat, lon), near)
