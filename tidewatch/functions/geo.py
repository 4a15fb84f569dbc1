"""Great-circle distance and the fixed cell grid used to join by distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed


def valid_coordinates(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres; the root is clamped so rounding never gives NaN."""
    h = (
        F.pow(F.sin(F.radians((lat2 - lat1) / 2)), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians((lon2 - lon1) / 2)), 2)
    )
    # a comparison instead of least() keeps NULL in, NULL out
    root = F.sqrt(h)
    return 2 * fixed.EARTH_RADIUS_KM * F.asin(F.when(root > 1.0, 1.0).otherwise(root))


class Reach:
    """Test of the radius that needs the great circle only at the cap's very edge.

    Points are also places on the unit sphere (``place``), and the square of the chord between two grows with their distance.
    Chords shorter or longer than the radius' by more than rounding decide; the others, and points with a
    longitude far out of range, whose place would be rounded, take the exact test.
    """

    FAR_DEGREES = 1000.0
    OFF_SPHERE = 10.0

    def __init__(self, radius_km: float):
        self.radius = radius_km
        chord = 2 * math.sin(min(radius_km / (2 * fixed.EARTH_RADIUS_KM), math.pi / 2))
        slack = 1e-9 * chord * chord + 1e-12 * chord
        self.inner, self.outer = chord * chord - slack, chord * chord + slack

    def place(self, lat: Column, lon: Column) -> list[Column]:
        near = F.abs(lon) <= self.FAR_DEGREES
        cosine, turn = F.cos(F.radians(lat)), F.radians(lon)
        axes = (cosine * F.cos(turn), cosine * F.sin(turn), F.sin(F.radians(lat)))
        return [F.when(near, axis).otherwise(self.OFF_SPHERE) for axis in axes]

    def holds(self, one: list[Column], other: list[Column], distance_km: Column) -> Column:
        """Whether ``distance_km``, which belongs to the two places, is within the radius."""
        squares = [(a - b) * (a - b) for a, b in zip(one, other, strict=True)]
        chord = squares[0] + squares[1] + squares[2]
        off = (one[0] == self.OFF_SPHERE) | (other[0] == self.OFF_SPHERE)
        return ((chord <= self.outer) | off) & ((chord < self.inner) | (distance_km <= self.radius))


class Grid:
    """Latitude/longitude cells whose size follows from the search radius.

    A point lies in exactly one cell; a cap of the radius touches a list of
    cells. The number of cells is fixed by the radius and does not depend on
    the data.
    """

    PAD = 1e-6  # degrees, so that points on a cap's edge are never lost

    def __init__(self, radius_km: float, degrees: float | None = None):
        self.radius = radius_km
        self.reach = math.degrees(radius_km / fixed.EARTH_RADIUS_KM) + self.PAD
        # whole number of columns around the globe, each at least half the reach
        self.columns = max(1, int(360 / (degrees or max(self.reach / 2, 0.25))))
        self.size = 360.0 / self.columns

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.size).cast("int")

    def column(self, lon: Column) -> Column:
        return F.pmod(F.floor((lon + 180) / self.size).cast("int"), F.lit(self.columns))

    def cells_of_point(self, lat: Column, lon: Column) -> Column:
        """Cell number of a point."""
        return self.row(lat) * self.columns + self.column(lon)

    def cells_of_cap(self, lat: Column, lon: Column) -> Column:
        """Array of the cell numbers the cap around the point may touch."""
        rows = F.sequence(
            self.row(F.greatest(lat - self.reach, F.lit(-90.0))), self.row(F.least(lat + self.reach, F.lit(90.0)))
        )
        polar = (F.abs(lat) + self.reach) >= 90
        sine = math.sin(math.radians(self.reach))
        # half-width in longitude of the cap; cells at +-180 meet by the modulo
        half = F.degrees(F.asin(F.least(F.lit(1.0), sine / F.cos(F.radians(lat))))) + self.PAD
        whole = polar | (half >= 180 - self.size)
        first = F.floor((lon - half + 180) / self.size).cast("int")
        last = F.floor((lon + half + 180) / self.size).cast("int")
        columns = F.when(whole, F.sequence(F.lit(0), F.lit(self.columns - 1))).otherwise(
            F.array_distinct(F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.lit(self.columns))))
        )
        return F.flatten(F.transform(rows, lambda r: F.transform(columns, lambda c: r * self.columns + c)))
