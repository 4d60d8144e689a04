"""Heating/cooling degree-day formulas and their uncertainty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import HDD_PER_DEGREE_F, LAPSE_HDD_PER_1000FT, SIGMAS
from .cols import ColumnLike, c, floor_zero, m_to_ft


def effective_hdd(base: ColumnLike, mult: ColumnLike, elev: ColumnLike, uhi: ColumnLike,
                  traffic: ColumnLike) -> Column:
    """Not clamped: warm urban cells may go below zero."""
    return c(base) * c(mult) + c(elev) - c(uhi) - c(traffic)


def effective_cdd(base: ColumnLike, mult: ColumnLike, elev: ColumnLike, uhi: ColumnLike,
                  traffic: ColumnLike) -> Column:
    """The caller supplies the elevation term with its sign."""
    return c(base) * c(mult) + c(elev) + c(uhi) + c(traffic)


def offset_to_degree_days(offset_f: ColumnLike) -> Column:
    """Annual degree days of a temperature offset; a missing offset counts as none."""
    return F.coalesce(c(offset_f) * HDD_PER_DEGREE_F, F.lit(0.0))


def cell_effective_hdd(base: ColumnLike, mult: ColumnLike, elev: ColumnLike, uhi: ColumnLike,
                       traffic: ColumnLike, cold_air: ColumnLike = 1.0) -> Column:
    """Missing where base, multiplier or elevation term is missing; a missing reduction counts as none."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return (c(base) * c(mult) * F.coalesce(c(cold_air), one) + c(elev)
            - F.coalesce(c(uhi), zero) - F.coalesce(c(traffic), zero))


def lapse_addition(elev_m: ColumnLike, station_ft: ColumnLike,
                   per_1000ft: float = LAPSE_HDD_PER_1000FT) -> Column:
    return (m_to_ft(elev_m) - c(station_ft)) / 1000.0 * per_1000ft


def daily_effective_hdd(temp_f: ColumnLike, mult: ColumnLike, elev: ColumnLike, uhi: ColumnLike,
                        traffic: ColumnLike) -> Column:
    return floor_zero(floor_zero(65.0 - c(temp_f)) * c(mult) + c(elev) - c(uhi) - c(traffic))


def altitude_hdd(temp_f: ColumnLike, base_f: float = 65.0) -> Column:
    return floor_zero(base_f - c(temp_f))


def hourly_hdd(temp_f: ColumnLike) -> Column:
    return floor_zero(65.0 - c(temp_f)) / 24.0


def hdd_sigma(base: ColumnLike, mult: ColumnLike, sigmas: dict[str, float] = SIGMAS) -> Column:
    """Root-sum-square of the five independent terms."""
    product = F.pow(sigmas["base"] * c(mult), 2) + F.pow(c(base) * sigmas["mult"], 2)
    return F.sqrt(product + sigmas["elev"] ** 2 + sigmas["uhi"] ** 2 + sigmas["traffic"] ** 2)


def hdd_bounds(base: ColumnLike, mult: ColumnLike, elev: ColumnLike, uhi: ColumnLike,
               traffic: ColumnLike, sigmas: dict[str, float] = SIGMAS) -> tuple[Column, Column]:
    nominal = effective_hdd(base, mult, elev, uhi, traffic)
    sigma = hdd_sigma(base, mult, sigmas)
    return nominal - sigma, nominal + sigma


def weather_ratio(actual: ColumnLike, normal: ColumnLike) -> Column:
    return F.when(c(normal) <= 0, F.lit(1.0)).otherwise(c(actual) / c(normal))
