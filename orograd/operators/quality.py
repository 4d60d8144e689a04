"""Data-quality checks.

Every check yields issue rows `(check_name, zip_code, cell_id, metric, value, detail)`; results are
one row per check. The row-level checks (range, hard limits, reliability, monthly profile) share a
single scan of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bounded_join, checkpoint
from .quantiles import exact_quantiles
from ..types import ALTITUDES_FT, MIN_CELL_PIXELS, MONTHS, TURBULENCE_FLAGS, require_columns

# check name -> severity when it fails, hard failure (fixed values)
CHECKS = {
    "Aggregate HDD Consistency": ("error", False),
    "Effective HDD Range": ("warning", False),
    "Directional Sanity": ("warning", False),
    "Cell Reliability": ("warning", False),
    "Hard Failure Check": ("error", True),
    "Billing Comparison": ("warning", False),
    "Monthly HDD Profiles": ("warning", False),
    "Data File Availability": ("warning", False),
}
ISSUE_SCHEMA = "check_name string, zip_code string, cell_id string, metric string, value double, detail string"


def _issue(check: str, when: Column, metric: str, value: Column, detail: Column) -> Column:
    return F.when(when, F.struct(
        F.lit(check).alias("check_name"), F.lit(metric).alias("metric"),
        value.cast("double").alias("value"), detail.alias("detail")))


def row_issues(t: DataFrame, *, hdd: str = "effective_hdd", hdd_range: tuple[float, float] = (2000.0, 8000.0),
               hard_range: tuple[float, float] = (0.0, 15000.0), min_pixels: int = MIN_CELL_PIXELS,
               month_range: tuple[float, float] = (0.0, 1000.0), annual_tolerance: float = 0.01) -> DataFrame:
    """Issues that one row shows by itself. Missing values never raise one."""
    v = F.col(hdd)
    found = [
        _issue("Effective HDD Range", (v < hdd_range[0]) | (v > hdd_range[1]), hdd, v, F.lit("outside range")),
        _issue("Hard Failure Check", v < hard_range[0], hdd, v, F.lit("below hard minimum")),
        _issue("Hard Failure Check", v > hard_range[1], hdd, v, F.lit("above hard maximum")),
    ]
    if "num_valid_pixels" in t.columns:
        n = F.col("num_valid_pixels")
        found.append(_issue("Cell Reliability", (n < min_pixels) & (F.col("cell_id") != "aggregate"),
                            "num_valid_pixels", n, F.lit("too few pixels")))
    months = [f"effective_hdd_{m}" for m in MONTHS if f"effective_hdd_{m}" in t.columns]
    for k in months:  # a negative month is also out of range: two issues
        found.append(_issue("Monthly HDD Profiles", F.col(k) < month_range[0], k, F.col(k), F.lit("negative")))
        found.append(_issue("Monthly HDD Profiles", (F.col(k) < month_range[0]) | (F.col(k) > month_range[1]),
                            k, F.col(k), F.lit("outside range")))
    if len(months) == 12 and "effective_hdd_annual" in t.columns:
        total = sum((F.col(k) for k in months[1:]), F.col(months[0]))  # NULL unless all twelve are present
        annual = F.col("effective_hdd_annual")
        found.append(_issue("Monthly HDD Profiles",
                            (annual > 0) & (F.abs(total - annual) > annual * annual_tolerance),
                            "effective_hdd_annual", total - annual, F.lit("months do not sum to annual")))
    return (t.select("zip_code", "cell_id", F.explode(F.filter(F.array(*found), lambda s: s.isNotNull())).alias("i"))
            .select("i.check_name", "zip_code", "cell_id", "i.metric", "i.value", "i.detail"))


def consistency_issues(t: DataFrame, *, hdd: str = "effective_hdd", tolerance: float = 0.1) -> DataFrame:
    """The aggregate row of each ZIP must equal the mean of its cells."""
    agg = F.col("cell_id") == "aggregate"
    z = t.groupBy("zip_code").agg(
        F.count(F.when(agg, 1)).alias("n_agg"), F.count(F.when(~agg, 1)).alias("n_cells"),
        F.count(F.when(~agg, F.col(hdd))).alias("n_values"),
        F.max(F.when(agg, F.col(hdd))).alias("agg_hdd"), F.avg(F.when(~agg, F.col(hdd))).alias("mean_hdd"))
    gap = F.abs(F.col("agg_hdd") - F.col("mean_hdd"))
    detail = (F.when(F.col("n_agg") == 0, "no aggregate row").when(F.col("n_agg") > 1, "multiple aggregate rows")
              .when(F.col("n_cells") == 0, "no cell rows").when(F.col("n_values") == 0, "all cell values missing")
              .when(gap > tolerance, "aggregate differs from mean of cells"))
    return (z.withColumn("detail", detail).where("detail is not null")
            .select(F.lit("Aggregate HDD Consistency").alias("check_name"), "zip_code",
                    F.lit("aggregate").alias("cell_id"), F.lit(hdd).alias("metric"), gap.alias("value"), "detail"))


def directional(t: DataFrame, *, keys: tuple[str, ...] = (), hdd: str = "effective_hdd",
                tolerance: float = 0.0) -> DataFrame:
    """Group means behind the directional check and its issue flags, overall or per key.

    Urban should not exceed rural, windward should not fall below leeward, high ground should not
    fall below low ground (split at the exact median). A part counts only if both groups exist.
    """
    has_elev = "mean_elevation_ft" in t.columns
    if has_elev:
        # a mean that is computed again may end in other digits, and the row that is the median would leave its side
        t = checkpoint(t.select(*keys, *[k for k in (hdd, "mean_elevation_ft", "cell_type", "terrain_position") if k in t.columns]))
        med = exact_quantiles(t, "mean_elevation_ft", {"_med": 0.5}, keys=keys)
        if keys:
            t = bounded_join(t, med, list(keys), "left")
        else:
            t = t.withColumn("_med", med.scalar())  # one number for the whole table
    groups = {"urban": ("cell_type", F.lit("urban")), "rural": ("cell_type", F.lit("rural")),
              "windward": ("terrain_position", F.lit("windward")), "leeward": ("terrain_position", F.lit("leeward"))}
    tests = {k: (F.col(col) == val) if col in t.columns else F.lit(False) for k, (col, val) in groups.items()}
    tests["high"] = (F.col("mean_elevation_ft") > F.col("_med")) if has_elev else F.lit(False)
    tests["low"] = (F.col("mean_elevation_ft") <= F.col("_med")) if has_elev else F.lit(False)
    out = t.groupBy(*keys).agg(*[F.avg(F.when(test, F.col(hdd))).alias(f"{k}_hdd") for k, test in tests.items()])

    def bad(warm: str, cold: str, name: str) -> Column:
        return F.coalesce(F.col(f"{warm}_hdd") > F.col(f"{cold}_hdd") * (1.0 + tolerance), F.lit(False)).alias(name)

    return out.select("*", bad("urban", "rural", "urban_issue"), bad("leeward", "windward", "wind_issue"),
                      bad("low", "high", "elevation_issue"))


def directional_issues(t: DataFrame, *, hdd: str = "effective_hdd") -> DataFrame:
    d = directional(t, hdd=hdd)
    flag = F.array(*[F.when(F.col(f"{k}_issue"), F.lit(k)) for k in ("urban", "wind", "elevation")])
    return d.select(F.explode(F.filter(flag, lambda s: s.isNotNull())).alias("metric")).select(
        F.lit("Directional Sanity").alias("check_name"), F.lit(None).cast("string").alias("zip_code"),
        F.lit(None).cast("string").alias("cell_id"), "metric", F.lit(None).cast("double").alias("value"),
        F.lit("unexpected direction").alias("detail"))


def divergence(t: DataFrame, billing: DataFrame, *, level: str = "zip", hdd: str = "effective_hdd") -> DataFrame:
    """Rows matched to billing with their relative divergence; no or negative therms count as infinite."""
    want = F.col("cell_id") == "aggregate" if level == "zip" else F.col("cell_id") != "aggregate"
    b = billing.select(F.col("zip_code").cast("string").alias("zip_code"), "therms_per_customer")
    therms = F.col("therms_per_customer")
    return (t.where(want).select(F.col("zip_code").cast("string").alias("zip_code"), "cell_id", F.col(hdd))
            .join(b, "zip_code")
            .withColumn("divergence", F.when(therms > 0, F.abs(F.col(hdd) - therms) / therms)
                        .otherwise(F.lit(float("inf")))))


def billing_summary(t: DataFrame, billing: DataFrame | None, *, level: str = "zip", hdd: str = "effective_hdd",
                    threshold: float = 0.15) -> DataFrame:
    """Counts and mean/max/min divergence; passes when nothing diverges or nothing matches."""
    if billing is None or not {"zip_code", "therms_per_customer"} <= set(billing.columns):
        billing = t.sparkSession.createDataFrame([], "zip_code string, therms_per_customer double")
    d = divergence(t, billing, level=level, hdd=hdd)
    far = F.count(F.when(F.col("divergence") > threshold, 1))
    zero = F.lit(0.0)
    return d.agg(F.count(F.lit(1)).alias("num_matched"), far.alias("num_divergent"),
                 F.coalesce(F.avg("divergence"), zero).alias("mean_divergence"),
                 F.coalesce(F.max("divergence"), zero).alias("max_divergence"),
                 F.coalesce(F.min("divergence"), zero).alias("min_divergence"), (far == 0).alias("passed"))


def billing_divergent(t: DataFrame, billing: DataFrame, *, level: str = "zip", hdd: str = "effective_hdd",
                      threshold: float = 0.15) -> DataFrame:
    return divergence(t, billing, level=level, hdd=hdd).where(F.col("divergence") > threshold).withColumn(
        "divergence_pct", F.col("divergence") * 100.0)


def billing_issues(t: DataFrame, billing: DataFrame | None, *, hdd: str = "effective_hdd",
                   threshold: float = 0.15) -> DataFrame:
    if billing is None or not {"zip_code", "therms_per_customer"} <= set(billing.columns):
        return t.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    return billing_divergent(t, billing, hdd=hdd, threshold=threshold).select(
        F.lit("Billing Comparison").alias("check_name"), "zip_code", "cell_id",
        F.lit("divergence").alias("metric"), F.col("divergence").alias("value"), F.lit("above threshold").alias("detail"))


def input_profile(inputs: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Presence and row count of every named input table."""
    out = None
    for name, df in inputs.items():
        row = (spark.createDataFrame([(name, False, 0)], "table_name string, present boolean, num_rows long")
               if df is None else df.agg(F.count(F.lit(1)).alias("num_rows")).select(
                   F.lit(name).alias("table_name"), F.lit(True).alias("present"), "num_rows"))
        out = row if out is None else out.unionByName(row)
    return out


def availability_issues(profile: DataFrame) -> DataFrame:
    return profile.where("not present or num_rows = 0").select(
        F.lit("Data File Availability").alias("check_name"), F.lit(None).cast("string").alias("zip_code"),
        F.lit(None).cast("string").alias("cell_id"), F.col("table_name").alias("metric"),
        F.col("num_rows").cast("double").alias("value"), F.lit("missing or empty").alias("detail"))


def all_issues(t: DataFrame, *, billing: DataFrame | None = None, profile: DataFrame | None = None) -> DataFrame:
    out = (row_issues(t).unionByName(consistency_issues(t)).unionByName(directional_issues(t))
           .unionByName(billing_issues(t, billing)))
    return out if profile is None else out.unionByName(availability_issues(profile))


def results(issues: DataFrame, checks: list[str] | None = None) -> DataFrame:
    """One row per check: passed, number of issues, severity, hard failure."""
    names = checks or list(CHECKS)
    dim = issues.sparkSession.createDataFrame(
        [(k, *CHECKS[k]) for k in names], "check_name string, _severity string, _hard boolean")
    n = issues.groupBy("check_name").agg(F.count(F.lit(1)).alias("_n"))
    # at most eight rows on either side
    return dim.join(n, "check_name", "left").select(
        "check_name", F.col("_n").isNull().alias("passed"), F.coalesce("_n", F.lit(0)).alias("num_issues"),
        F.when(F.col("_n").isNull(), "info").otherwise(F.col("_severity")).alias("severity"),
        (F.col("_hard") & F.col("_n").isNotNull()).alias("is_hard_failure"))


def run_all_checks(t: DataFrame, *, billing: DataFrame | None = None,
                   profile: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    t = checkpoint(t)  # five checks read it; written once instead of derived five times
    issues = checkpoint(all_issues(t, billing=billing, profile=profile))
    return results(issues), issues


def qa_summary(res: DataFrame) -> DataFrame:
    return res.agg(F.count(F.lit(1)).alias("num_checks"), F.count(F.when(F.col("passed"), 1)).alias("num_passed"),
                   F.count(F.when(~F.col("passed"), 1)).alias("num_failed"),
                   F.count(F.when(F.col("is_hard_failure"), 1)).alias("num_hard_failures"),
                   F.sum("num_issues").alias("num_issues"))


def top_issues(issues: DataFrame, n: int = 10) -> DataFrame:
    """The first n issues of each check, for reports.

    A row number per spread-out part first keeps at most n rows of each part, so the final
    ranking sees few rows even if one check raised nearly all issues.
    """
    order = [F.col(k).asc_nulls_first() for k in ("zip_code", "cell_id", "metric", "detail", "value")]
    part = F.pmod(F.xxhash64("zip_code", "cell_id", "metric"), F.lit(64))
    pre = Window.partitionBy("check_name", "_part").orderBy(*order)
    fin = Window.partitionBy("check_name").orderBy(*order)
    return (issues.withColumn("_part", part).withColumn("_k", F.row_number().over(pre)).where(F.col("_k") <= n)
            .drop("_part").withColumn("issue_no", F.row_number().over(fin)).where(F.col("issue_no") <= n).drop("_k"))


def qa_stats(t: DataFrame, *, hdd: str = "effective_hdd") -> DataFrame:
    """Statistics of cell rows and of ZIP rows: count, mean, min, max, std, quartiles, cells per ZIP."""
    cells = F.col("num_cells") if "num_cells" in t.columns else F.lit(None).cast("double")
    # written once and narrow: the sketch, the counts and the statistics each read it
    t = checkpoint(t.select("cell_id", hdd, cells.alias("num_cells"), F.when(F.col("cell_id") == "aggregate", "zip").otherwise("cell").alias("level")))
    quartiles = exact_quantiles(t, hdd, {"hdd_p25": 0.25, "hdd_median": 0.5, "hdd_p75": 0.75}, keys=("level",))
    per_zip = F.when(F.col("cell_id") == "aggregate", F.col("num_cells"))
    stats = t.groupBy("level").agg(
        F.count(F.lit(1)).alias("num_rows"), F.avg(hdd).alias("hdd_mean"), F.min(hdd).alias("hdd_min"),
        F.max(hdd).alias("hdd_max"), F.stddev_samp(hdd).alias("hdd_std"),
        F.avg(per_zip).alias("cells_per_zip_mean"), F.min(per_zip).alias("cells_per_zip_min"),
        F.max(per_zip).alias("cells_per_zip_max"))
    return stats.join(quartiles, "level", "left")


def correction_stats(t: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, min, max and std of correction columns over cell rows, one row per column."""
    cells = t.where(F.col("cell_id") != "aggregate")
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("v")) for k in cols])
    return (cells.select(F.explode(pairs).alias("p")).where("p.v is not null").groupBy("p.metric")
            .agg(F.avg("p.v").alias("mean"), F.min("p.v").alias("min"), F.max("p.v").alias("max"),
                 F.stddev_samp("p.v").alias("std")))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of missing values per column; an absent column is reported with NULL."""
    row = df.agg(*[F.sum(F.col(k).isNull().cast("long")).alias(k) for k in cols if k in df.columns])
    entries = [F.struct(F.lit(k).alias("column_name"),
                        (F.col(k) if k in df.columns else F.lit(None).cast("long")).alias("num_missing")) for k in cols]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def terrain_validate(t: DataFrame) -> DataFrame:
    """Issues of the terrain table: `issue, num_rows` with one row per kind found.

    Aggregates must match the mean of their cells within 1e-5 relative plus 1e-8 absolute.
    """
    required = ["microclimate_id", "zip_code", "cell_id", "effective_hdd"]
    spark = t.sparkSession
    missing = [k for k in required if k not in t.columns]
    lost = spark.createDataFrame([(f"missing column {k}", 1) for k in missing], "issue string, num_rows long")
    counts = {}
    if "effective_hdd" in t.columns:
        counts["effective_hdd outside 2000-8000"] = (F.col("effective_hdd") < 2000) | (F.col("effective_hdd") > 8000)
    if "effective_cdd" in t.columns:
        counts["effective_cdd outside 0-3000"] = (F.col("effective_cdd") < 0) | (F.col("effective_cdd") > 3000)
    for k in ("microclimate_id", "zip_code", "effective_hdd"):
        if k in t.columns:
            counts[f"missing values in {k}"] = F.col(k).isNull()
    row = t.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, cond in enumerate(counts.values())])
    out = row.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("issue"), F.col(f"c{i}").alias("num_rows")) for i, k in enumerate(counts)])).alias("e")
    ).select("e.*").where("num_rows > 0").unionByName(lost)
    if {"cell_id", "zip_code"} <= set(t.columns):
        for k in ("effective_hdd", "effective_cdd"):
            if k in t.columns:
                agg = F.col("cell_id") == "aggregate"
                z = t.groupBy("zip_code").agg(F.min_by(F.when(agg, F.col(k)), F.when(agg, F.col("microclimate_id"))).alias("a"),
                                              F.count(F.when(agg, 1)).alias("na"), F.count(F.when(~agg, 1)).alias("nc"),
                                              F.avg(F.when(~agg, F.col(k))).alias("m"))
                close = F.coalesce(F.abs(F.col("a") - F.col("m")) <= 1e-8 + 1e-5 * F.abs(F.col("m")), F.lit(False))
                off = z.where((F.col("na") > 0) & (F.col("nc") > 0) & ~close)
                out = out.unionByName(off.agg(F.count(F.lit(1)).alias("num_rows")).where("num_rows > 0").select(
                    F.lit(f"aggregate {k} differs from mean of cells").alias("issue"), "num_rows"))
    return out


FINDING_SCHEMA = "severity string, rule string, num_rows long"


def findings(df: DataFrame, *, required: list[str], rules: list[tuple[str, str, Column]],
             groups: list[tuple[str, list[str], Column, int]] = ()) -> DataFrame:
    """Run validation rules: missing columns, missing values, row rules, and group-size rules.

    A row rule counts offending rows; a group rule counts groups whose number of distinct values
    differs from the expected one. All row rules share one scan. A table passes when no finding
    has severity `error`.
    """
    spark = df.sparkSession
    lost = spark.createDataFrame([("error", f"missing column {k}", 1) for k in required if k not in df.columns],
                                 FINDING_SCHEMA)
    present = [k for k in required if k in df.columns]
    all_rules = [("warning", f"missing values in {k}", F.col(k).isNull()) for k in present] + list(rules)
    row = df.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, (_, _, cond) in enumerate(all_rules)])
    out = row.select(F.explode(F.array(*[
        F.struct(F.lit(sev).alias("severity"), F.lit(name).alias("rule"), F.col(f"c{i}").alias("num_rows"))
        for i, (sev, name, _) in enumerate(all_rules)])).alias("e")).select("e.*").where("num_rows > 0")
    for name, keys, value, expected in groups:
        # distinct (key, value) pairs first: a hot key never gathers its rows in one task
        pairs = df.select(*keys, value.alias("_v")).distinct()
        bad = pairs.groupBy(*keys).agg(F.count("_v").alias("_n")).where(F.col("_n") != expected)
        out = out.unionByName(bad.agg(F.count(F.lit(1)).alias("num_rows")).where("num_rows > 0").select(
            F.lit("warning").alias("severity"), F.lit(name).alias("rule"), "num_rows"))
    return out.unionByName(lost)


def passed(found: DataFrame) -> DataFrame:
    return found.agg((F.count(F.when(F.col("severity") == "error", 1)) == 0).alias("passed"),
                     F.count(F.when(F.col("severity") == "error", 1)).alias("num_errors"),
                     F.count(F.when(F.col("severity") == "warning", 1)).alias("num_warnings"))


def _outside(name: str, lo: float, hi: float) -> Column:
    return (F.col(name) < lo) | (F.col(name) > hi)


def daily_validate(daily: DataFrame) -> DataFrame:
    required = ["date", "zip_code", "raw_temp_f", "adjusted_temp_f", "daily_effective_hdd"]
    rules = []
    if "daily_effective_hdd" in daily.columns:
        rules += [("error", "negative daily_effective_hdd", F.col("daily_effective_hdd") < 0),
                  ("warning", "very high daily_effective_hdd", F.col("daily_effective_hdd") > 10000)]
    if "adjusted_temp_f" in daily.columns:
        rules.append(("warning", "unusual surface temperature", _outside("adjusted_temp_f", -50, 120)))
    absent = []
    for a in (3000, 6000, 9000, 12000, 18000):
        if f"temp_{a}ft_adjusted_f" in daily.columns:
            rules.append(("warning", f"unusual temperature at {a} ft", _outside(f"temp_{a}ft_adjusted_f", -80, 100)))
        absent += [k for k in (f"temp_{a}ft_raw_f", f"temp_{a}ft_adjusted_f", f"hdd_{a}ft") if k not in daily.columns]
    out = findings(daily, required=required, rules=rules)
    extra = daily.sparkSession.createDataFrame([("warning", f"missing altitude column {k}", 1) for k in absent],
                                               FINDING_SCHEMA)
    return out.unionByName(extra)


def _altitude_rule(df: DataFrame) -> list[tuple[str, str, Column]]:
    return [("warning", "unexpected altitude", ~F.col("altitude_ft").isin(*ALTITUDES_FT))] if (
        "altitude_ft" in df.columns) else []


def hourly_validate(cube: DataFrame, *, complete: bool = True) -> DataFrame:
    """Hourly cube rules; `complete` adds 8 altitudes per ZIP and hour, and 24 hours per date."""
    required = ["datetime_utc", "zip_code", "altitude_ft", "temp_adjusted_f", "wind_speed_kt", "hourly_hdd",
                "turbulence_flag"]
    rules = [("error", "negative hourly_hdd", F.col("hourly_hdd") < 0),
             ("warning", "very high hourly_hdd", F.col("hourly_hdd") > 2.5),
             ("warning", "unusual temperature", _outside("temp_adjusted_f", -80, 120))]
    cols = set(cube.columns)
    rules = [r for r, need in zip(rules, ("hourly_hdd", "hourly_hdd", "temp_adjusted_f")) if need in cols]
    groups = []
    if complete and {"datetime_utc", "zip_code", "altitude_ft"} <= cols:
        groups = [("not 8 altitudes per ZIP and hour", ["datetime_utc", "zip_code"], F.col("altitude_ft"), 8)]
        groups.append(("not 24 hours per date", ["_date"], F.col("datetime_utc"), 24))
        cube = cube.withColumn("_date", F.to_date("datetime_utc"))
    return findings(cube, required=required, rules=rules + _altitude_rule(cube), groups=groups)


def cube_validate(cube: DataFrame, *, complete: bool = True) -> DataFrame:
    """Safety cube rules; `complete` adds 8 altitudes per ZIP and date."""
    required = ["date", "zip_code", "altitude_ft", "temp_adjusted_f", "wind_speed_kt", "tke_m2s2",
                "density_altitude_ft", "turbulence_flag"]
    rules = [("temp_adjusted_f", ("warning", "unusual temperature", lambda: _outside("temp_adjusted_f", -80, 120))),
             ("wind_speed_kt", ("warning", "very high wind", lambda: F.col("wind_speed_kt") > 200)),
             ("tke_m2s2", ("warning", "very high TKE", lambda: F.col("tke_m2s2") > 10)),
             ("turbulence_flag", ("error", "invalid turbulence flag", lambda: ~F.col("turbulence_flag").isin(*TURBULENCE_FLAGS)))]
    ready = [(s, n, f()) for col, (s, n, f) in rules if col in cube.columns]
    groups = [("not 8 altitudes per ZIP and date", ["date", "zip_code"], F.col("altitude_ft"), 8)] if (
        complete and {"date", "zip_code", "altitude_ft"} <= set(cube.columns)) else []
    return findings(cube, required=required, rules=ready + _altitude_rule(cube), groups=groups)


def cube_completeness(cube: DataFrame) -> DataFrame:
    """Per date: distinct hours, and ZIP-hours without all eight altitudes."""
    per = (cube.select("datetime_utc", "zip_code", "altitude_ft").distinct()
           .groupBy("datetime_utc", "zip_code").agg(F.count("altitude_ft").alias("n")))
    hours = per.groupBy(F.to_date("datetime_utc").alias("date"), "datetime_utc").agg(
        F.count(F.when(F.col("n") != len(ALTITUDES_FT), 1)).alias("gaps"))
    return hours.groupBy("date").agg(F.count(F.lit(1)).alias("num_hours"), F.sum("gaps").alias("incomplete_zip_hours"))


def registry_uniqueness(registry: DataFrame) -> DataFrame:
    """ZIPs whose station belongs to no region or to more than one."""
    require_columns(registry, ["zip_code", "base_station", "region_code"])
    per = (registry.where("base_station is not null and region_code is not null")
           .select("base_station", "region_code").distinct()
           .groupBy("base_station").agg(F.count("region_code").alias("num_regions")))
    return (registry.select("zip_code", "base_station").distinct().join(per, "base_station", "left")
            .withColumn("num_regions", F.coalesce("num_regions", F.lit(0))).where("num_regions <> 1"))


def station_coverage(registry: DataFrame, dim: DataFrame) -> DataFrame:
    """Registry stations without an elevation or an HDD normal."""
    used = registry.select(F.col("base_station").alias("station_id")).where("station_id is not null").distinct()
    parts = [used.join(dim.where(f"{k} is not null"), "station_id", "left_anti").select(
        "station_id", F.lit(k).alias("missing")) for k in ("elevation_ft", "hdd_normal")]
    return parts[0].unionByName(parts[1])


def registry_checks(registry: DataFrame, dim: DataFrame) -> DataFrame:
    """Both configuration checks as result rows."""
    n = F.count(F.lit(1)).alias("num_issues")
    a = registry_uniqueness(registry).agg(n).select(F.lit("zipcode_region_uniqueness").alias("check_name"), "num_issues")
    b = station_coverage(registry, dim).agg(n).select(F.lit("station_coverage").alias("check_name"), "num_issues")
    return a.unionByName(b).withColumn("passed", F.col("num_issues") == 0)
