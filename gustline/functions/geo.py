"""Coordinates: UTM to latitude and longitude, planar distance, spread radius, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid and the UTM grid.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0

# Accepted names of the coordinate columns, first match wins.
LATITUDE_NAMES = ("lat", "latitude")
LONGITUDE_NAMES = ("lon", "long", "lng", "longitude")


def _third_flattening() -> float:
    return FLATTENING / (2 - FLATTENING)


def utm_to_latlon(zone: int, easting: Column, northing: Column, zone_letter: str = "",
                  northern: bool = True) -> tuple[Column, Column]:
    """Latitude and longitude in degrees by the Krüger series; coordinates off the grid give null.

    A zone letter from N on means the northern half and overrides ``northern``.
    """
    letter = zone_letter.upper()
    if not 1 <= zone <= 60 or (letter and letter not in "CDEFGHJKLMNPQRSTUVWX"):
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    north = letter >= "N" if letter else northern
    n = _third_flattening()
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    on_grid = (easting >= 100000) & (easting < 1000000) & (northing >= 0) & (northing <= 10000000)
    xi = (northing - (0.0 if north else FALSE_NORTHING)) / (SCALE * radius)
    eta = (easting - FALSE_EASTING) / (SCALE * radius)
    xi_1, eta_1 = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_1 = xi_1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_1 = eta_1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_1) / F.cosh(eta_1))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.lit(float(6 * zone - 183)) + F.degrees(F.atan2(F.sinh(eta_1), F.cos(xi_1)))
    return F.when(on_grid, F.degrees(lat)), F.when(on_grid, lon)


def with_latlon(df: DataFrame, zone: int, easting: str, northing: str, **options) -> DataFrame:
    """Replace the two grid columns by ``lat`` and ``lon``."""
    lat, lon = utm_to_latlon(zone, F.col(easting), F.col(northing), **options)
    kept = [F.col(c) for c in df.columns if c not in (easting, northing)]
    return df.select(*kept, lat.alias("lat"), lon.alias("lon"))


def planar_distance(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Plain Euclidean distance in degrees."""
    return F.sqrt((lat - lat2) * (lat - lat2) + (lon - lon2) * (lon - lon2))


def spread_radius(spread: Column) -> Column:
    """Hectares to metres: half the side of the square of that area; unknown gives 1."""
    return F.coalesce(F.sqrt(spread * 10000) / 2, F.lit(1.0))


def given_radius(radius: Column) -> Column:
    return F.coalesce(radius.cast("double"), F.lit(1.0))


def coordinate_columns(columns, suffix: str = "") -> tuple[str, str] | None:
    """Names of the latitude and longitude columns, None if one is missing."""
    present = set(columns)
    lat = next((c for c in LATITUDE_NAMES if c + suffix in present), None)
    lon = next((c for c in LONGITUDE_NAMES if c + suffix in present), None)
    return None if lat is None or lon is None else (lat + suffix, lon + suffix)


def with_standard_coordinates(df: DataFrame) -> DataFrame:
    """Rename the coordinate columns to ``lat`` and ``lon``."""
    found = coordinate_columns(df.columns)
    if found is None:
        raise ValueError("no latitude and longitude columns")
    return df.withColumnsRenamed({found[0]: "lat", found[1]: "lon"})
