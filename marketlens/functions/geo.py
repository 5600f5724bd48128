"""Distances between two positions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

EARTH_RADIUS_M = 6_371_008.8
# Half axes in metres and flattening of the reference ellipsoid.
AXIS_A, AXIS_B, FLATTENING = 6378137.0, 6356752.314245, 1 / 298.257223563


def haversine(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres, evaluated inside generated code."""
    lat1, lat2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (lat2 - lat1) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin(half_lon), 2)
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def ellipsoid_metres(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Vincenty inverse formula over whole arrays; NaN where it does not converge."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, dtype="float64")) for v in (lon1, lat1, lon2, lat2))
    f, diff = FLATTENING, lon2 - lon1
    u1, u2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    lam = diff.copy()
    done = np.zeros(lam.shape, dtype=bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(100):
            cross = np.hypot(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam))
            dot = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
            sigma = np.arctan2(cross, dot)
            sin_a = np.where(cross == 0, 0.0, np.cos(u1) * np.cos(u2) * np.sin(lam) / cross)
            cos2_a = 1 - sin_a ** 2
            mid = np.where(cos2_a == 0, 0.0, dot - 2 * np.sin(u1) * np.sin(u2) / cos2_a)
            c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
            new = diff + (1 - c) * f * sin_a * (sigma + c * cross * (mid + c * dot * (2 * mid ** 2 - 1)))
            done |= np.abs(new - lam) <= 1e-12
            lam = new
            if done.all():
                break
        u_sq = cos2_a * (AXIS_A ** 2 - AXIS_B ** 2) / AXIS_B ** 2
        big_a = 1 + u_sq / 16384 * (4096 + u_sq * (-768 + u_sq * (320 - 175 * u_sq)))
        big_b = u_sq / 1024 * (256 + u_sq * (-128 + u_sq * (74 - 47 * u_sq)))
        step = big_b * cross * (mid + big_b / 4 * (dot * (2 * mid ** 2 - 1)
               - big_b / 6 * mid * (4 * cross ** 2 - 3) * (4 * mid ** 2 - 3)))
    metres = AXIS_B * big_a * (sigma - step)
    metres = np.where(cross == 0, 0.0, np.where(done, metres, np.nan))
    return metres


@F.pandas_udf(DoubleType())
def ellipsoid(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Ellipsoid distance in metres kept to eight significant digits, one Arrow batch at a time."""
    metres = ellipsoid_metres(lon1, lat1, lon2, lat2)
    with np.errstate(divide="ignore", invalid="ignore"):
        places = 7 - np.floor(np.log10(np.where(metres > 0, metres, 1.0)))
        out = np.round(metres * 10.0 ** places) / 10.0 ** places
    missing = lon1.isna() | lat1.isna() | lon2.isna() | lat2.isna()
    return pd.Series(out, index=lon1.index).mask(missing)
