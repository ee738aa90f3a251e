"""Distances on the WGS84 ellipsoid, for a whole Arrow batch at once.

Vincenty's series (third order in the flattening) relate the longitude difference on the ellipsoid to that on the auxiliary
sphere. His fixed-point iteration fails for nearly antipodal points, so the difference on the sphere is found there by
bisection, which always ends; and for points that are antipodal on the sphere the azimuth is. The error is below a millimetre.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Semi-major axis in metres and flattening of WGS84.
A, FLATTENING = 6_378_137.0, 1 / 298.257223563
B = A * (1 - FLATTENING)


def _shift(sin_a: np.ndarray, sigma: np.ndarray, cos_2m: np.ndarray) -> np.ndarray:
    """What the longitude difference on the sphere exceeds that on the ellipsoid by."""
    cos2 = 1 - sin_a**2
    c = FLATTENING / 16 * cos2 * (4 + FLATTENING * (4 - 3 * cos2))
    return (1 - c) * FLATTENING * sin_a * (sigma + c * np.sin(sigma) * (cos_2m + c * np.cos(sigma) * (2 * cos_2m**2 - 1)))


def _sphere(u1: np.ndarray, u2: np.ndarray, lam: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(arc, sine of the azimuth at the equator, cosine of twice the arc to the middle) of two points on the auxiliary sphere."""
    x, y = np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam)
    sin_s, cos_s = np.hypot(x, y), np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
    with np.errstate(divide="ignore", invalid="ignore"):
        sin_a = np.where(sin_s > 0, np.cos(u1) * np.cos(u2) * np.sin(lam) / sin_s, 0.0)
        cos2 = 1 - sin_a**2
        cos_2m = np.where(cos2 > 1e-15, cos_s - 2 * np.sin(u1) * np.sin(u2) / cos2, 0.0)
    return np.arctan2(sin_s, cos_s), np.clip(sin_a, -1, 1), np.clip(cos_2m, -1, 1)


def distance_m(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Metres between points in degrees; NaN where a coordinate is missing or a latitude is beyond 90."""
    lat1, lon1, lat2, lon2 = (np.atleast_1d(np.asarray(x, dtype=float)) for x in (lat1, lon1, lat2, lon2))
    bad = ~(np.isfinite(lat1 + lon1 + lat2 + lon2) & (np.abs(lat1) <= 90) & (np.abs(lat2) <= 90))
    lat1, lon1, lat2, lon2 = (np.where(bad, 0.0, x) for x in (lat1, lon1, lat2, lon2))
    u1, u2 = (np.arctan((1 - FLATTENING) * np.tan(np.radians(x))) for x in (lat1, lat2))
    turn = np.mod(np.abs(lon2 - lon1), 360.0)
    goal = np.radians(np.minimum(turn, 360.0 - turn))
    lam = goal.copy()
    for _ in range(12):
        sigma, sin_a, cos_2m = _sphere(u1, u2, lam)
        new = goal + _shift(sin_a, sigma, cos_2m)
        step, lam = np.abs(new - lam), np.minimum(new, np.pi)
    hard = (step > 1e-14) | (new > np.pi)
    if hard.any():
        lo, hi = goal[hard], np.full(hard.sum(), np.pi)
        for _ in range(60):
            mid = (lo + hi) / 2
            sigma, sin_a, cos_2m = _sphere(u1[hard], u2[hard], mid)
            short = mid - _shift(sin_a, sigma, cos_2m) < goal[hard]
            lo, hi = np.where(short, mid, lo), np.where(short, hi, mid)
        lam[hard] = (lo + hi) / 2
    sigma, sin_a, cos_2m = _sphere(u1, u2, lam)

    # Antipodal on the sphere: the arc is half a turn whatever the azimuth, and the azimuth follows from the longitudes.
    half = hard & (np.abs(u1 + u2) < 1e-12) & (np.abs(lam - np.pi) < 1e-9)
    if half.any():
        lo, hi = np.zeros(half.sum()), np.cos(u1[half])
        for _ in range(60):
            mid = (lo + hi) / 2
            m2 = 1 - mid**2
            c2 = np.where(m2 > 1e-15, np.clip(-1 + 2 * np.sin(u1[half]) ** 2 / np.maximum(m2, 1e-15), -1, 1), 0.0)
            far = np.pi - _shift(mid, np.full(len(mid), np.pi), c2) > goal[half]
            lo, hi = np.where(far, mid, lo), np.where(far, hi, mid)
        sin_a[half], sigma[half] = lo, np.pi
        m2 = 1 - lo**2
        cos_2m[half] = np.where(m2 > 1e-15, np.clip(-1 + 2 * np.sin(u1[half]) ** 2 / np.maximum(m2, 1e-15), -1, 1), 0.0)

    k = (1 - sin_a**2) * (A**2 - B**2) / B**2
    big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    sin_s, cos_s = np.sin(sigma), np.cos(sigma)
    d = small * sin_s * (cos_2m + small / 4 * (cos_s * (2 * cos_2m**2 - 1) - small / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)))
    return np.where(bad, np.nan, B * big * (sigma - d))


@F.pandas_udf(DoubleType())
def _udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    return pd.Series(distance_m(lat1, lon1, lat2, lon2)).replace({np.nan: None})


def geodesic_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """distance_m as a column; null where it is NaN."""
    return _udf(lat1.cast("double"), lon1.cast("double"), lat2.cast("double"), lon2.cast("double"))


def register(spark: SparkSession) -> None:
    """SQL function geodesic_m(lat1, lon1, lat2, lon2)."""
    spark.udf.register("geodesic_m", _udf)
