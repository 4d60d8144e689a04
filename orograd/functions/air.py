"""Wind, boundary-layer and upper-air formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import BL_DECAY_FT, GORGE_STATIONS, ROUGHNESS_THRESHOLD, UHI_DECAY_FT, VON_KARMAN, Z0_RURAL
from .cols import ColumnLike, c, floor_zero, floor_zero_or_null


def wind_power_law(v80: ColumnLike) -> Column:
    """80 m wind brought down to 10 m."""
    return c(v80) * F.pow(F.lit(10.0 / 80.0), F.lit(0.143))


def stagnation(wind_ms: ColumnLike, shadow: ColumnLike) -> Column:
    return F.when(c(wind_ms).isNotNull() & c(shadow).isNotNull(),
                  F.when((c(wind_ms) > 5) & (c(shadow) == 0), 0.7)
                  .when((c(wind_ms) < 3) & (c(shadow) == 1), 1.3).otherwise(1.0))


def infiltration(wind_ms: ColumnLike, base_station: ColumnLike) -> Column:
    mult = 1.0 + 0.015 * floor_zero_or_null(c(wind_ms) - 3.0)
    floored = F.when(mult.isNotNull(), F.greatest(mult, F.lit(1.15)))
    return F.when(c(base_station).isin(*GORGE_STATIONS), floored).otherwise(mult)


def wind_speed(u: ColumnLike, v: ColumnLike) -> Column:
    return F.sqrt(c(u) * c(u) + c(v) * c(v))


def wind_direction(u: ColumnLike, v: ColumnLike) -> Column:
    """Bearing the wind blows toward, 0..360."""
    return F.pmod(F.degrees(F.atan2(c(u), c(v))) + 360.0, F.lit(360.0))


def pressure_altitude_ft(mb: ColumnLike, surface_mb: ColumnLike, surface_k: ColumnLike) -> Column:
    """Scale height is T0 / lapse rate, as published."""
    return F.when(c(mb) >= c(surface_mb), 0.0).otherwise(
        c(surface_k) / 0.0065 * F.ln(c(surface_mb) / c(mb)) * 3.28084)


def altitude_pressure_mb(alt_ft: ColumnLike, surface_mb: ColumnLike, surface_k: ColumnLike,
                         lo: ColumnLike = 500.0, hi: ColumnLike = 1000.0) -> Column:
    z = c(alt_ft) / 3.28084
    p = c(surface_mb) * F.exp(-9.81 * z / (287.05 * (c(surface_k) - 0.0065 * z)))
    return F.greatest(c(lo), F.least(c(hi), p))


def tke(wind_ms: ColumnLike, z0: ColumnLike, z0_rural: float = Z0_RURAL) -> Column:
    log_ratio = F.ln(10.0 / c(z0))
    u_star = c(wind_ms) * VON_KARMAN / F.nullif(log_ratio, F.lit(0.0))
    energy = 0.5 * u_star * u_star * (1.0 + 2.0 * (c(z0) / z0_rural))
    return (F.when((c(wind_ms) <= 0) | (c(z0) <= 0), 0.0)
            .when(log_ratio == 0, float("inf")).otherwise(floor_zero(energy)))


def tke_from_friction(u_star: ColumnLike, z0: ColumnLike) -> Column:
    return F.when((c(u_star) < 0) | (c(z0) < 0), 0.0).otherwise(
        0.5 * c(u_star) * c(u_star) * (1.0 + 2.0 * (c(z0) / Z0_RURAL)))


def density_altitude(temp_f: ColumnLike, pressure_mb: ColumnLike = 1013.25) -> Column:
    pa = 145442.0 * (1.0 - F.pow(c(pressure_mb) * 0.02953 / 29.92126, F.lit(0.190263)))
    isa_f = (15.0 - (pa / 1000.0) * 0.0065 * 1000.0 / 0.3048) * 9.0 / 5.0 + 32.0
    return floor_zero(pa + 120.0 * (c(temp_f) - isa_f))


def turbulence(tke_col: ColumnLike) -> Column:
    return (F.when(c(tke_col) < 0.5, "smooth").when(c(tke_col) < 1.5, "light")
            .when(c(tke_col) < 3.0, "moderate").otherwise("severe"))


def friction_velocity(wind_ms: ColumnLike, z0: ColumnLike, d: ColumnLike = 0.0) -> Column:
    return c(wind_ms) * VON_KARMAN / F.ln((10.0 - c(d)) / c(z0))


def forest_wind(wind_ms: ColumnLike, z_m: ColumnLike, z0: ColumnLike, d: ColumnLike,
                u_star: ColumnLike | None = None) -> Column:
    """Displaced log-law wind; zero at and below the displacement height."""
    given = c(u_star)
    absent = given.isNull() | (given == 0)
    friction = F.when(absent, friction_velocity(wind_ms, z0, d)).otherwise(given)
    dead = (c(z_m) <= c(d)) | (c(z0) <= 0) | (absent & (c(d) >= 10.0))
    return F.when(dead, 0.0).otherwise(
        floor_zero(friction / VON_KARMAN * F.ln((c(z_m) - c(d)) / c(z0))))


def uhi_decay(uhi_f: ColumnLike, z_ft: ColumnLike) -> Column:
    return F.when(c(z_ft) >= 1000.0, 0.0).otherwise(c(uhi_f) * F.exp(-c(z_ft) / UHI_DECAY_FT))


def wind_shear_kt(wind_ms: ColumnLike, z_ft: ColumnLike, z0_local: ColumnLike, z0_upwind: ColumnLike,
                  u_star: ColumnLike | None = None) -> Column:
    """Log-law speed change at a roughness transition, in knots."""
    given, z = c(u_star), c(z_ft) * 0.3048
    absent = given.isNull() | (given == 0)
    friction = F.when(absent, friction_velocity(wind_ms, z0_upwind)).otherwise(given)

    def log_term(z0: ColumnLike) -> Column:
        return F.when(c(z0) > 0, friction / VON_KARMAN * F.ln(z / c(z0))).otherwise(0.0)

    none = ((c(z_ft) > 1000.0) | (F.abs(c(z0_local) - c(z0_upwind)) < ROUGHNESS_THRESHOLD)
            | (absent & (c(z0_upwind) <= 0)) | (z <= c(z0_local)) | (z <= c(z0_upwind)))
    return F.when(none, 0.0).otherwise((log_term(z0_local) - log_term(z0_upwind)) * 1.944)


def subsidence(anomaly_f: ColumnLike, z_ft: ColumnLike, is_water: Column) -> Column:
    return F.when(is_water & (c(z_ft) <= 1000.0), -c(anomaly_f) * F.exp(-c(z_ft) / BL_DECAY_FT)).otherwise(0.0)


def boundary_layer(temp_f: ColumnLike, wind_ms: ColumnLike, z_ft: ColumnLike, z0_local: ColumnLike = 0.1,
                   z0_upwind: ColumnLike = 0.03, is_water: Column | None = None) -> tuple[Column, Column]:
    """Temperature with over-water cooling, and the shear correction in knots."""
    water = F.lit(False) if is_water is None else is_water
    u_star = F.when(c(z0_upwind) > 0, friction_velocity(wind_ms, z0_upwind)).otherwise(0.0)
    return (c(temp_f) + subsidence(5.0, z_ft, water),
            wind_shear_kt(wind_ms, z_ft, z0_local, z0_upwind, u_star))


def shear_per_100ft(shear_kt: ColumnLike, alt_ft: ColumnLike) -> Column:
    return F.when(c(alt_ft) > 0, c(shear_kt) / (c(alt_ft) / 100.0)).otherwise(0.0)
