"""Planar geometry as column expressions: projections, distances, polygon centroids."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0
_DEGREE = math.pi / 180.0

MULTIPOLYGON = "struct<type:string, coordinates:array<array<array<array<double>>>>>"
POLYGON = "struct<type:string, coordinates:array<array<array<double>>>>"


def mercator_x(lon: Column) -> Column:
    return lon.cast("double") * F.lit(_DEGREE) * F.lit(EARTH_RADIUS)


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(F.lit(math.pi / 4) + lat.cast("double") * F.lit(_DEGREE) / F.lit(2.0))) * F.lit(EARTH_RADIUS)


def usable(value: Column) -> Column:
    """Neither null, NaN nor infinite; never null itself.

    Zero times NaN or infinity is NaN, so one product tells all, and a costly ``value`` is
    computed only once.
    """
    return F.coalesce(value.cast("double") * F.lit(0.0) == F.lit(0.0), F.lit(False))


def usable_point(x: Column, y: Column) -> Column:
    return usable(x) & usable(y)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def grid_index(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(float(side))).cast("bigint")


@dataclass(frozen=True)
class ConformalConic:
    """Lambert conformal conic projection with two standard parallels."""

    lat_origin: float
    lon_origin: float
    parallel_1: float
    parallel_2: float
    false_easting: float
    false_northing: float
    unit: float  # metres per map unit
    semi_major: float = 6378137.0
    inverse_flattening: float = 298.257222101

    def _constants(self):
        flat = 1.0 / self.inverse_flattening
        ecc = math.sqrt(2 * flat - flat * flat)

        def scale(lat):
            return math.cos(lat) / math.sqrt(1 - (ecc * math.sin(lat)) ** 2)

        def conformal(lat):
            ratio = (1 - ecc * math.sin(lat)) / (1 + ecc * math.sin(lat))
            return math.tan(math.pi / 4 - lat / 2) / ratio ** (ecc / 2)

        lat0, lat1, lat2 = (math.radians(v) for v in (self.lat_origin, self.parallel_1, self.parallel_2))
        n = (math.log(scale(lat1)) - math.log(scale(lat2))) / (
            math.log(conformal(lat1)) - math.log(conformal(lat2))
        )
        big_f = scale(lat1) / (n * conformal(lat1) ** n)
        rho0 = self.semi_major * big_f * conformal(lat0) ** n
        return ecc, n, big_f, rho0

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        ecc, n, big_f, rho0 = self._constants()
        phi = F.radians(lat)
        es = F.lit(ecc) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(ecc / 2))
        rho = F.lit(self.semi_major * big_f) * F.pow(t, F.lit(n))
        theta = F.lit(n) * (F.radians(lon) - F.lit(math.radians(self.lon_origin)))
        x = (rho * F.sin(theta)) / F.lit(self.unit) + F.lit(self.false_easting)
        y = (F.lit(rho0) - rho * F.cos(theta)) / F.lit(self.unit) + F.lit(self.false_northing)
        return x, y

    def inverse(self, x: Column, y: Column, rounds: int = 5) -> tuple[Column, Column]:
        """Longitude and latitude in degrees; each round gains about four digits."""
        ecc, n, big_f, rho0 = self._constants()
        dx = (x - F.lit(self.false_easting)) * F.lit(self.unit)
        dy = F.lit(rho0) - (y - F.lit(self.false_northing)) * F.lit(self.unit)
        rho = F.sqrt(dx * dx + dy * dy) * F.lit(math.copysign(1.0, n))
        t = F.pow(rho / F.lit(self.semi_major * big_f), F.lit(1.0 / n))
        lon = F.degrees(F.atan2(dx, dy) / F.lit(n)) + F.lit(self.lon_origin)
        phi = F.lit(math.pi / 2) - 2 * F.atan(t)
        for _ in range(rounds):
            es = F.lit(ecc) * F.sin(phi)
            phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - es) / (1 + es), F.lit(ecc / 2)))
        return lon, F.degrees(phi)


# The state-plane grid of the city in US survey feet (EPSG 2263).
STATE_PLANE = ConformalConic(
    lat_origin=40.0 + 10.0 / 60.0,
    lon_origin=-74.0,
    parallel_1=41.0 + 2.0 / 60.0,
    parallel_2=40.0 + 40.0 / 60.0,
    false_easting=984250.0,
    false_northing=0.0,
    unit=1200.0 / 3937.0,
)


def parse_polygons(text: Column) -> Column:
    """GeoJSON-like text to an array of polygons, each an array of rings of [x, y].

    Single quotes and tuple brackets, as in printed literals, are accepted.
    """
    json = F.translate(text, "'()", '"[]')
    parts = F.from_json(json, MULTIPOLYGON, {"mode": "PERMISSIVE"})
    single = F.from_json(json, POLYGON, {"mode": "PERMISSIVE"})
    return F.when(single["type"] == "Polygon", F.array(single["coordinates"])).otherwise(parts["coordinates"])


def _ring_sums(ring: Column, x0: Column, y0: Column) -> Column:
    """Twice the signed area and its moments, relative to one anchor point of the shape."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def add(acc, i):
        p, q = F.get(ring, i - 1), F.get(ring, i)
        px, py = F.get(p, F.lit(0)) - x0, F.get(p, F.lit(1)) - y0
        qx, qy = F.get(q, F.lit(0)) - x0, F.get(q, F.lit(1)) - y0
        cross = px * qy - qx * py
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + (px + qx) * cross).alias("mx"),
            (acc["my"] + (py + qy) * cross).alias("my"),
        )

    steps = F.when(F.size(ring) > 1, F.sequence(F.lit(1), F.size(ring) - 1))
    return F.aggregate(steps, zero, add)


def polygons_centroid(polygons: Column) -> tuple[Column, Column]:
    """Area-weighted centroid; the first ring of a polygon is its shell, the others are holes."""
    first = F.get(F.get(F.get(polygons, F.lit(0)), F.lit(0)), F.lit(0))
    x0, y0 = F.get(first, F.lit(0)), F.get(first, F.lit(1))

    def signed(ring, index):
        sums = _ring_sums(ring, x0, y0)
        sign = F.signum(sums["a"]) * F.when(index == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.struct(
            (sums["a"] * sign).alias("a"), (sums["mx"] * sign).alias("mx"), (sums["my"] * sign).alias("my")
        )

    rings = F.flatten(F.transform(polygons, lambda polygon: F.transform(polygon, signed)))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    total = F.aggregate(
        rings,
        zero,
        lambda acc, r: F.struct(
            (acc["a"] + r["a"]).alias("a"), (acc["mx"] + r["mx"]).alias("mx"), (acc["my"] + r["my"]).alias("my")
        ),
    )
    area = F.nullif(total["a"], F.lit(0.0))
    return x0 + total["mx"] / (3 * area), y0 + total["my"] / (3 * area)
