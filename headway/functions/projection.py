"""Transverse Mercator in general, both ways, as column expressions.

Krueger's series in the third flattening to its fourth power: well under a millimetre within some
thousand kilometres of the central meridian. ``geo.with_xy`` keeps the one zone the engine itself measures in.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from headway import constants as K


def _powers(n: float, rows: tuple[tuple[float, ...], ...]) -> tuple[float, ...]:
    """Each row of factors as a polynomial in n; the first factor goes with the power the row starts at."""
    return tuple(sum(c * n ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(rows, 1))


class TransverseMercator(NamedTuple):
    """A projection by its parameters: ellipsoid, origin in degrees, scale on the meridian, false origin in metres."""

    a: float
    inv_f: float
    lat0: float
    lon0: float
    k0: float
    false_easting: float
    false_northing: float

    @property
    def _n(self) -> float:
        f = 1.0 / self.inv_f
        return f / (2.0 - f)

    @property
    def _radius(self) -> float:
        """Metres of scaled rectifying radius."""
        n = self._n
        return self.k0 * self.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    # The factors of the published series, by rising powers of n.
    def _forward(self) -> tuple[float, ...]:
        return _powers(self._n, ((1 / 2, -2 / 3, 5 / 16, 41 / 180), (13 / 48, -3 / 5, 557 / 1440), (61 / 240, -103 / 140), (49561 / 161280,)))

    def _backward(self) -> tuple[float, ...]:
        return _powers(self._n, ((1 / 2, -2 / 3, 37 / 96, -1 / 360), (1 / 48, 1 / 15, -437 / 1440), (17 / 480, -37 / 840), (4397 / 161280,)))

    def _latitude(self) -> tuple[float, ...]:
        return _powers(self._n, ((2.0, -2 / 3, -2.0, 116 / 45), (7 / 3, -8 / 5, -227 / 45), (56 / 15, -136 / 35), (4279 / 630,)))

    @property
    def _e(self) -> float:
        n = self._n
        return 2 * math.sqrt(n) / (1 + n)

    def _origin(self) -> float:
        """Rectifying latitude of the origin."""
        s = math.sin(math.radians(self.lat0))
        xi = math.atan(math.sinh(math.atanh(s) - self._e * math.atanh(self._e * s)))
        return xi + sum(c * math.sin(2 * j * xi) for j, c in enumerate(self._forward(), 1))

    def project(self, df: DataFrame, lat: str = "lat", lon: str = "lon", x: str = "x_m", y: str = "y_m") -> DataFrame:
        """Add metres for degrees. Each step is a column of its own, so no term is computed twice."""
        lit, e = F.lit, self._e
        s, turn = F.sin(F.radians(lat)), F.radians(F.col(lon) - lit(self.lon0))
        steps = (
            df.withColumn("__t", F.sinh(F.atanh(s) - lit(e) * F.atanh(lit(e) * s)))
            .withColumn("__xi", F.atan2(F.col("__t"), F.cos(turn)))
            .withColumn("__eta", F.atanh(F.sin(turn) / F.sqrt(lit(1.0) + F.col("__t") * F.col("__t"))))
        )
        xi, eta = self._shifted(self._forward(), 1.0)
        out = steps.withColumns({
            x: lit(self.false_easting) + lit(self._radius) * eta,
            y: lit(self.false_northing) + lit(self._radius) * (xi - lit(self._origin())),
        })
        return out.drop("__t", "__xi", "__eta")

    def unproject(self, df: DataFrame, x: str = "x_m", y: str = "y_m", lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Add degrees for metres."""
        lit = F.lit
        scaled = df.withColumns({
            "__xi": (F.col(y) - lit(self.false_northing)) / lit(self._radius) + lit(self._origin()),
            "__eta": (F.col(x) - lit(self.false_easting)) / lit(self._radius),
        })
        xi, eta = self._shifted(self._backward(), -1.0)
        moved = scaled.withColumns({"__xi2": xi, "__eta2": eta})
        conformal = moved.withColumn("__chi", F.asin(F.sin("__xi2") / F.cosh("__eta2")))
        series: Column = F.col("__chi")
        for j, c in enumerate(self._latitude(), 1):
            series = series + lit(c) * F.sin(lit(2.0 * j) * F.col("__chi"))
        out = conformal.withColumns({
            lat: F.degrees(series), lon: lit(self.lon0) + F.degrees(F.atan2(F.sinh("__eta2"), F.cos("__xi2"))),
        })
        return out.drop("__xi", "__eta", "__xi2", "__eta2", "__chi")

    @staticmethod
    def _shifted(factors: tuple[float, ...], sign: float) -> tuple[Column, Column]:
        xi, eta = F.col("__xi"), F.col("__eta")
        north, east = xi, eta
        for j, c in enumerate(factors, 1):
            k = F.lit(2.0 * j)
            north = north + F.lit(sign * c) * F.sin(k * xi) * F.cosh(k * eta)
            east = east + F.lit(sign * c) * F.cos(k * xi) * F.sinh(k * eta)
        return north, east


#: The zone ``geo.with_xy`` measures in.
STATE_PLANE = TransverseMercator(
    K.GRS80_A, K.GRS80_INV_F, K.TM_LAT0_DEG, K.TM_LON0_DEG, K.TM_K0, K.TM_FALSE_EASTING, K.TM_FALSE_NORTHING
)


def utm(zone: int, south: bool = False) -> TransverseMercator:
    """A UTM zone on WGS 84."""
    return TransverseMercator(6378137.0, 298.257223563, 0.0, 6.0 * zone - 183.0, 0.9996, 500000.0, 1e7 if south else 0.0)


def of_prj(text: str) -> TransverseMercator:
    """The projection a ``.prj`` text describes, in metres or in whatever its unit is worth of them."""
    number = r"\s*,\s*([-+0-9.eE]+)"
    spheroid = re.search(rf'SPHEROID\["[^"]*"{number}{number}', text, re.IGNORECASE)
    named = {name.lower(): float(v) for name, v in re.findall(rf'PARAMETER\["([^"]+)"{number}', text, re.IGNORECASE)}
    kind = re.search(r'PROJECTION\["([^"]+)"', text, re.IGNORECASE)
    if not spheroid or not kind or "transverse_mercator" not in kind[1].lower():
        raise ValueError("no transverse Mercator projection")
    # The projected unit stands last.
    unit = float(re.findall(rf'UNIT\["[^"]*"{number}', text, re.IGNORECASE)[-1])
    return TransverseMercator(
        float(spheroid[1]), float(spheroid[2]), named.get("latitude_of_origin", 0.0), named["central_meridian"],
        named.get("scale_factor", 1.0), named.get("false_easting", 0.0) * unit, named.get("false_northing", 0.0) * unit,
    )
