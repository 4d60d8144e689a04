"""Surface thermal, terrain-class and road formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import PREVAILING_WIND_DEG, SOLAR_IRRADIANCE_WM2, TERRAIN_MULTIPLIERS
from .cols import ColumnLike, angle_diff, c, clip


def impervious_clean(raw: ColumnLike) -> Column:
    """Sentinels first, then clamp: 126 and 128 become 100, 127 and 255 become missing."""
    return F.when(~c(raw).isin(127, 255), clip(c(raw).cast("double"), 0.0, 100.0))


def lst_celsius(dn: ColumnLike) -> Column:
    return c(dn) * 0.00341802 + 149.0 - 273.15


def surface_albedo(impervious_pct: ColumnLike) -> Column:
    return clip(0.20 - c(impervious_pct) / 100.0 * 0.15, 0.05, 0.20)


def solar_aspect(aspect_deg: ColumnLike) -> Column:
    return 1.0 + 0.2 * F.cos(F.radians(F.pmod(c(aspect_deg), F.lit(360.0)) - 180.0))


def uhi_offset(albedo: ColumnLike, irradiance: float = SOLAR_IRRADIANCE_WM2) -> Column:
    return (0.20 - c(albedo)) * irradiance / 5.5 * 9.0 / 5.0


def road_temp_offset(flux_wm2: ColumnLike) -> Column:
    return F.coalesce(c(flux_wm2) / 5.5 * 9.0 / 5.0, F.lit(0.0))


def road_buffer_m(aadt: ColumnLike) -> Column:
    return F.when(c(aadt) < 10000, 50.0).when(c(aadt) <= 50000, 100.0).otherwise(200.0)


def wind_shadow(tpi: ColumnLike, aspect_deg: ColumnLike,
                wind_deg: float = PREVAILING_WIND_DEG) -> Column:
    """1 where a hollow faces away from the wind, 0 elsewhere."""
    lee = (wind_deg + 180.0) % 360.0
    inside = (c(tpi) < 0) & (angle_diff(aspect_deg, lee) <= 90.0)
    return F.when(c(tpi).isNotNull() & c(aspect_deg).isNotNull(), F.when(inside, 1).otherwise(0))


def terrain_position(tpi: ColumnLike, slope_deg: ColumnLike, aspect_deg: ColumnLike,
                     wind_deg: float = PREVAILING_WIND_DEG) -> Column:
    """Ridge, windward, valley, leeward in that order of precedence."""
    known = c(tpi).isNotNull() & c(slope_deg).isNotNull() & c(aspect_deg).isNotNull()
    return F.when(known, F.when((c(tpi) > 0) & (c(slope_deg) > 25.0), "ridge")
                  .when(angle_diff(aspect_deg, wind_deg) <= 90.0, "windward")
                  .when(c(tpi) < 0, "valley").otherwise("leeward"))


def terrain_multiplier(position: ColumnLike,
                       multipliers: dict[str, float] = TERRAIN_MULTIPLIERS) -> Column:
    out = F.lit(None).cast("double")
    for name, value in multipliers.items():
        out = F.when(c(position) == name, F.lit(float(value))).otherwise(out)
    return out


def drainage_multiplier(intensity: ColumnLike, max_increase: float = 0.15) -> Column:
    return 1.0 + c(intensity) * max_increase
