"""Column expressions: missing values, sky geometry, rounding."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MAD_TO_SIGMA = 1.4826
C_KMS = 299792.458


def fixed(value: Column, digits: int = 6) -> Column:
    """Value on a decimal grid, ties always upward; stable against the last bits of a sum."""
    scale = 10.0**digits
    return F.floor(value * scale + F.lit(0.50001)) / F.lit(scale)


def usable(x: Column) -> Column:
    """Not NULL and not NaN."""
    return x.isNotNull() & ~F.isnan(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0."""
    return a / F.nullif(b, F.lit(0.0))


def clean_text(x: Column) -> Column:
    return F.upper(F.trim(x))


def angular_distance_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance (haversine); inputs in degrees."""
    sd = F.sin(F.radians(dec2 - dec1) / 2)
    sr = F.sin(F.radians(ra2 - ra1) / 2)
    h = sd * sd + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * sr * sr
    return F.degrees(F.lit(2.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))) * 3600.0


def lens_area(d: Column, r1: float, r2: float) -> Column:
    """Area common to two circles whose centres are ``d`` apart."""
    small = min(r1, r2)

    def unit(x: Column) -> Column:
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))

    dd = F.nullif(d, F.lit(0.0))
    a1 = F.acos(unit((dd * dd + r1 * r1 - r2 * r2) / (dd * 2 * r1)))
    a2 = F.acos(unit((dd * dd + r2 * r2 - r1 * r1) / (dd * 2 * r2)))
    k = (-dd + (r1 + r2)) * (dd + (r1 - r2)) * (dd - (r1 - r2)) * (dd + (r1 + r2))
    lens = a1 * (r1 * r1) + a2 * (r2 * r2) - F.sqrt(F.greatest(k, F.lit(0.0))) * 0.5
    return F.when(d >= r1 + r2, 0.0).when(d <= abs(r1 - r2), math.pi * small * small).otherwise(lens)
