"""Hourly analyses: daily means, climatology, bias correction, vertical profiles."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import air, degree_days
from ..functions.cols import bind, c, kelvin_to_f
from ..types import ALTITUDES_FT, MIN_CLIMATOLOGY_YEARS

CELL = ("gy", "gx")


def daily_mean(hourly: DataFrame, *, keys: tuple[str, ...] = CELL, temp_k: str = "t2m_k") -> DataFrame:
    """Mean 2 m temperature per day and cell, in Fahrenheit; missing hours are skipped."""
    return (hourly.groupBy(F.to_date("ts").alias("date"), *keys)
            .agg(kelvin_to_f(F.avg(temp_k)).alias("temp_f"), F.count(temp_k).alias("num_hours")))


def climatology(hourly: DataFrame, *, keys: tuple[str, ...] = CELL, temp: str = "temp_f",
                min_years: int = MIN_CLIMATOLOGY_YEARS, check: bool = True) -> DataFrame:
    """Monthly mean per cell: the mean of yearly means, so every year weighs the same.

    With `check`, an empty input is an error and fewer than `min_years` years give a warning.
    """
    yearly = hourly.groupBy(F.month("ts").alias("month"), F.year("ts").alias("year"), *keys).agg(
        F.avg(temp).alias("_year_mean"))
    if check:
        n = hourly.select(F.year("ts").alias("y")).distinct().count()
        if n == 0:
            raise ValueError("no hours to build a climatology from")
        if n < min_years:
            warnings.warn(f"climatology rests on {n} years, fewer than {min_years}", stacklevel=2)
    return yearly.groupBy("month", *keys).agg(F.avg("_year_mean").alias("clim_f"), F.count(F.lit(1)).alias("num_years"))


def bias_field(normals: DataFrame, clim: DataFrame, *, keys: tuple[str, ...] = CELL) -> DataFrame:
    """normal - climatology per month and cell."""
    return (normals.join(clim, ["month", *keys])
            .select("month", *keys, (F.col("normal_f") - F.col("clim_f")).alias("bias_f")))


def bias_correct(daily: DataFrame, normals: DataFrame, clim: DataFrame | None = None, *,
                 keys: tuple[str, ...] = CELL, strict: bool = True) -> DataFrame:
    """Add bias_f and adjusted_f = temp + (normal - climatology).

    Where no climatology exists, the mean of the daily field itself stands in. With `strict`, the
    cells of the daily field and of the normals must be the same.
    """
    if strict:
        a, b = daily.select(*keys).distinct(), normals.select(*keys).distinct()
        if (a.join(b, list(keys), "left_anti").limit(1).count()
                or b.join(a, list(keys), "left_anti").limit(1).count()):
            raise ValueError("daily field and normals cover different cells")
    on = ["month", *keys]
    d = daily.withColumn("month", F.month("date"))
    own = d.groupBy(*keys).agg(F.avg("temp_f").alias("_own"))
    ref = normals.select(*on, "normal_f").join(own, list(keys), "left")
    if clim is not None:
        ref = (ref.join(clim.select(*on, "clim_f"), on, "left")
               .withColumn("clim_f", F.coalesce("clim_f", "_own")))
    else:
        ref = ref.withColumn("clim_f", F.col("_own"))
    ref = ref.select(*on, (F.col("normal_f") - F.col("clim_f")).alias("bias_f"))
    return d.join(ref, on, "left").withColumn("adjusted_f", F.col("temp_f") + F.col("bias_f"))


def bias_validate(df: DataFrame, *, adjusted: str = "adjusted_f", normal: str = "normal_f",
                  tolerance: float = 2.0) -> DataFrame:
    """Signed mean, largest absolute difference and share within tolerance; missing counts as outside."""
    diff = F.col(adjusted) - F.col(normal)
    inside = F.count(F.when(F.abs(diff) <= tolerance, 1))
    out = df.agg(F.avg(diff).alias("mean_diff"), F.max(F.abs(diff)).alias("max_diff"),
                 (100.0 * inside / F.count(F.lit(1))).alias("pct_within_tolerance"),
                 (F.count(F.lit(1)) - inside).alias("num_outliers"))
    return out.withColumn("passed", F.coalesce(
        (F.col("mean_diff") < tolerance) & (F.col("pct_within_tolerance") > 95), F.lit(False)))


def wind_profiles(sfc: DataFrame, prs: DataFrame, *, keys: tuple[str, ...] = ("zip_code", "ts"),
                  altitudes: list[int] = ALTITUDES_FT, levels_unique: bool = False) -> DataFrame:
    """Wind and temperature at each altitude: the surface row at 0 ft, above it linear in ln(p).

    `sfc(keys, t2m_k, u10, v10, sp_mb)`, `prs(keys, level_mb, u, v, t_k)`. A group is one place and
    hour, so its array holds no more than the pressure levels. Repeated levels are averaged first;
    with `levels_unique` the caller vouches that there are none, which saves a shuffle. The target pressure is clipped to the given levels, so nothing is extrapolated.
    """
    level = prs if levels_unique else prs.groupBy(*keys, "level_mb").agg(*[F.avg(k).alias(k) for k in ("u", "v", "t_k")])
    column = level.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.ln("level_mb").alias("lnp"), "u", "v", "t_k"))).alias("levels"),
        F.min("level_mb").cast("double").alias("_lo"), F.max("level_mb").cast("double").alias("_hi"))

    def at_altitude(alt: int) -> Column:
        if alt == 0:
            return F.struct(F.lit(0).alias("altitude_ft"), F.col("u10").alias("u"), F.col("v10").alias("v"),
                            F.col("t2m_k").alias("t_k"))
        q = F.ln(air.altitude_pressure_mb(float(alt), "sp_mb", "t2m_k", "_lo", "_hi"))
        # one pass finds the last level at or below the target and the first one at or above it
        return bind(F.struct(q.alias("q"), F.col("levels").alias("lv")), lambda s: bind(F.struct(
            s["q"].alias("q"), F.filter(s["lv"], lambda x: x["lnp"] <= s["q"]).alias("below"), s["lv"].alias("lv")),
            lambda t: bind(F.struct(
                t["q"].alias("q"), F.coalesce(F.get(t["below"], F.size(t["below"]) - 1), F.get(t["lv"], F.lit(0))).alias("lo"),
                F.coalesce(F.get(t["lv"], F.size(t["below"])), F.get(t["lv"], F.size(t["lv"]) - 1)).alias("hi")),
                lambda b: _mix(alt, b))))

    out = (sfc.join(column, list(keys), "left")
           .select(*keys, F.explode(F.array(*[at_altitude(a) for a in altitudes])).alias("p"))
           .select(*keys, "p.altitude_ft", "p.u", "p.v", F.col("p.t_k").alias("temperature_k")))
    return out.select(*keys, "altitude_ft", air.wind_speed("u", "v").alias("wind_speed_ms"),
                      air.wind_direction("u", "v").alias("wind_direction_deg"), "temperature_k",
                      kelvin_to_f("temperature_k").alias("temperature_f"))


def _mix(alt: int, b: Column) -> Column:
    """Values at `q` between the levels `lo` and `hi` of a bracket."""
    gap = F.nullif(b["hi"]["lnp"] - b["lo"]["lnp"], F.lit(0.0))
    share = F.coalesce((b["q"] - b["lo"]["lnp"]) / gap, F.lit(0.0))
    return F.struct(F.lit(alt).alias("altitude_ft"), *[
        (b["lo"][k] + share * (b["hi"][k] - b["lo"][k])).alias(k) for k in ("u", "v", "t_k")])


def altitude_process(profiles: DataFrame, *, bias: Column | str | float, base_f: float = 65.0,
                     temp: str = "temperature_f") -> DataFrame:
    """The surface bias added at every level, and the HDD of each level."""
    return (profiles.withColumn("temp_adjusted_f", c(temp) + c(bias))
            .withColumn("hdd", F.when(F.col("temp_adjusted_f").isNotNull(),
                                      degree_days.altitude_hdd("temp_adjusted_f", base_f))))


def profile_monotonic(profile: DataFrame, *, keys: tuple[str, ...], temp: str = "temp_adjusted_f",
                      hdd: str = "hdd", slack: float = 0.0) -> DataFrame:
    """Per profile: number of steps where temperature rises or HDD falls with height."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("altitude_ft")
    steps = profile.select(*keys, (F.col(temp) - F.lag(temp).over(w)).alias("_dt"),
                           (F.col(hdd) - F.lag(hdd).over(w)).alias("_dh"))
    return steps.groupBy(*keys).agg(F.count(F.when(F.col("_dt") > slack, 1)).alias("temp_rises"),
                                    F.count(F.when(F.col("_dh") < -slack, 1)).alias("hdd_falls"))
