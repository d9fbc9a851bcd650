"""Distances, projections and magnitudes as Column functions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM, DEGREE_KM = 6371.0, 111.19
CENTRE_LAT, CENTRE_LON, HALF_WIDTH_DEG = 31.778, -106.408, 1.0
ML = {"freq_hz": 5.0, "wa_gain": 2800.0, "a": 1.110, "b": 0.00189, "c": 3.0, "ref_distance_km": 100.0, "min_distance_km": 10.0}


def _chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    s1, s2 = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = _chord(lat1, lon1, lat2, lon2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def great_circle_km(lat0: Column, lon0: Column, lat: Column, lon: Column) -> Column:
    return 2 * EARTH_KM * F.asin(F.sqrt(_chord(lat0, lon0, lat, lon)))


def local_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Local plane with the cosine of the mid latitude."""
    x = (lon2 - lon1) * DEGREE_KM * F.cos(F.radians((lat1 + lat2) / 2))
    return F.hypot(x, (lat2 - lat1) * DEGREE_KM)


def hypo_km(distance: Column, depth: Column) -> Column:
    return F.sqrt(distance * distance + depth * depth)


def ml_station(velocity: Column, r: Column, cfg: dict = ML) -> Column:
    """Station magnitude; null for a missing, NaN or non-positive amplitude and within the least distance."""
    wa_mm = velocity * (cfg["wa_gain"] * 1000.0) / (2 * pi * cfg["freq_hz"])
    ml = F.log10(wa_mm) + cfg["a"] * F.log10(r / cfg["ref_distance_km"]) + cfg["b"] * (r - cfg["ref_distance_km"]) + cfg["c"]
    return F.when((velocity > 0) & ~F.isnan(velocity) & (r >= cfg["min_distance_km"]), ml)


def stere_forward(lat: Column, lon: Column, lat0: float = CENTRE_LAT, lon0: float = CENTRE_LON) -> tuple[Column, Column]:
    """Spherical stereographic x and y in km around a centre."""
    f0, p, d = F.radians(F.lit(lat0)), F.radians(lat), F.radians(lon - lon0)
    k = 2 * EARTH_KM / (1 + F.sin(f0) * F.sin(p) + F.cos(f0) * F.cos(p) * F.cos(d))
    return k * F.cos(p) * F.sin(d), k * (F.cos(f0) * F.sin(p) - F.sin(f0) * F.cos(p) * F.cos(d))


def stere_inverse(x: Column, y: Column, lat0: float = CENTRE_LAT, lon0: float = CENTRE_LON) -> tuple[Column, Column]:
    f0, rho = F.radians(F.lit(lat0)), F.hypot(x, y)
    c = 2 * F.atan2(rho, F.lit(2 * EARTH_KM))
    lat = F.when(rho == 0, lat0).otherwise(F.degrees(F.asin(F.cos(c) * F.sin(f0) + y * F.sin(c) * F.cos(f0) / rho)))
    lon = lon0 + F.degrees(F.atan2(x * F.sin(c), rho * F.cos(f0) * F.cos(c) - y * F.sin(f0) * F.sin(c)))
    return lat, F.when(rho == 0, lon0).otherwise(lon)


def box_km(half_deg: Column, lat: Column) -> tuple[Column, Column]:
    """Half extents of a box in whole km."""
    return F.rint(half_deg * DEGREE_KM * F.cos(F.radians(lat))), F.rint(half_deg * DEGREE_KM)


def inside_area(lat: Column, lon: Column, margin: float = 0.0) -> Column:
    half = HALF_WIDTH_DEG - margin
    return (F.abs(lat - CENTRE_LAT) <= half) & (F.abs(lon - CENTRE_LON) <= half)


def normalise_coords(lat: Column, lon: Column, half: float = HALF_WIDTH_DEG) -> tuple[Column, Column]:
    """Into the unit box around the centre; null outside it."""
    inside = inside_area(lat, lon, HALF_WIDTH_DEG - half)
    return F.when(inside, (lat - CENTRE_LAT + half) / (2 * half)), F.when(inside, (lon - CENTRE_LON + half) / (2 * half))


#: Tops of layers (km) with P and S velocities (km/s), the deepest a half-space.
LAYERS = ((0.0, 3.30, 1.88), (1.0, 4.85, 2.80), (3.0, 5.50, 3.15), (10.0, 6.20, 3.58), (20.0, 6.60, 3.81), (35.0, 7.90, 4.56))


def layer_velocity(depth: Column, phase: str, layers=LAYERS) -> Column:
    """Velocity at a depth; the top layer reaches up."""
    at = 1 if phase == "P" else 2
    out = F.lit(layers[0][at])
    for layer in layers[1:]:
        out = F.when(depth >= layer[0], F.lit(layer[at])).otherwise(out)
    return F.when(depth.isNotNull(), out)
