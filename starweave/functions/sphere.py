"""Positions on the unit sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCSEC_PER_DEGREE = 3600.0


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    """Degrees → Cartesian unit vector; exact at the poles and across ra = 0/360."""
    lon, lat = F.radians(ra), F.radians(dec)
    return F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)


def chord(radius_arcsec: float) -> float:
    """Straight-line distance between two points ``radius_arcsec`` apart (180° at most)."""
    angle = min(radius_arcsec / ARCSEC_PER_DEGREE, 180.0)
    return 2.0 * math.sin(math.radians(angle) / 2.0)


def separation_arcsec(squared_chord: Column) -> Column:
    """Squared straight-line distance → angle on the sky."""
    half = F.least(F.lit(1.0), F.sqrt(squared_chord) / 2.0)
    return F.degrees(F.asin(half)) * (2.0 * ARCSEC_PER_DEGREE)
