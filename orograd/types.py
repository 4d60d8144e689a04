"""Constants, table schemas and the small fixed dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values (must equal the published constants for equal results) -----
CELL_SIZE_M = 500
MIN_CELL_PIXELS = 10
LAPSE_HDD_PER_1000FT = 630.0
HDD_PER_DEGREE_F = 180.0
SOLAR_IRRADIANCE_WM2 = 200.0
PREVAILING_WIND_DEG = 225.0
PIPELINE_VERSION = "1.0.0"
LIDAR_VINTAGE = 2021
NLCD_VINTAGE = 2021
PRISM_PERIOD = "1991-2020"
VON_KARMAN = 0.41
BL_DECAY_FT = 500.0
UHI_DECAY_FT = 300.0
ROUGHNESS_THRESHOLD = 0.3
Z0_RURAL = 0.03
EARLIEST_ANALYSIS_DATE = "2014-07-30"
MIN_CLIMATOLOGY_YEARS = 3
GB_PER_HOUR = 0.075
ALTITUDES_FT = [0, 500, 1000, 3000, 6000, 9000, 12000, 18000]
PRESSURE_LEVELS_MB = [1000, 975, 950, 925, 900, 875, 850, 825, 800, 775, 750, 700, 650, 600, 550, 500]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_DAYS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
TURBULENCE_FLAGS = ["smooth", "light", "moderate", "severe"]
GORGE_STATIONS = ["KDLS", "KTTD"]

# station id, annual HDD normal, elevation ft, lat, lon (fixed values)
STATIONS = [
    ("KPDX", 4850, 30, 45.5898, -122.5951),
    ("KEUG", 4650, 374, 44.1246, -123.2190),
    ("KSLE", 4900, 214, 44.9095, -123.0032),
    ("KAST", 5200, 10, 46.1579, -123.8787),
    ("KDLS", 5800, 247, 45.6185, -121.1670),
    ("KOTH", 4400, 17, 43.4171, -124.2461),
    ("KONP", 4600, 50, 44.5804, -124.0579),
    ("KCVO", 4750, 250, 44.4971, -123.2896),
    ("KHIO", 4900, 208, 45.5404, -122.9498),
    ("KTTD", 5100, 22, 45.5494, -122.4013),
    ("KVUO", 4950, 20, 45.6205, -122.6565),
]

# land-cover class, roughness length m, albedo, emissivity, displacement height m (fixed values)
LANDCOVER = [
    (11, 0.0002, 0.08, 0.98, 0.0),
    (12, 0.0005, 0.10, 0.98, 0.0),
    (21, 0.05, 0.20, 0.95, 0.0),
    (22, 0.50, 0.15, 0.92, 2.0),
    (23, 0.80, 0.12, 0.90, 4.0),
    (24, 1.20, 0.10, 0.88, 6.0),
    (31, 0.01, 0.25, 0.94, 0.0),
    (41, 1.50, 0.12, 0.98, 15.0),
    (42, 1.80, 0.10, 0.98, 18.0),
    (43, 1.60, 0.11, 0.98, 16.0),
    (51, 0.30, 0.20, 0.96, 0.5),
    (52, 0.20, 0.22, 0.96, 1.0),
    (71, 0.10, 0.25, 0.97, 0.0),
    (72, 0.08, 0.24, 0.97, 0.0),
    (73, 0.12, 0.26, 0.97, 0.0),
    (74, 0.05, 0.23, 0.97, 0.0),
    (81, 0.15, 0.24, 0.97, 0.5),
    (82, 0.08, 0.25, 0.97, 0.0),
    (90, 0.40, 0.18, 0.97, 2.0),
    (95, 0.30, 0.20, 0.97, 1.0),
]

# terrain-position class -> HDD multiplier; a default, every caller can override it
TERRAIN_MULTIPLIERS = {"windward": 1.08, "leeward": 0.98, "valley": 1.02, "ridge": 1.15}

# one-sigma uncertainty of each term (fixed values)
SIGMAS = {"base": 200.0, "mult": 0.05, "elev": 50.0, "uhi": 100.0, "traffic": 75.0}

# output column order of the terrain table (fixed values)
TERRAIN_COLUMNS = (
    "microclimate_id zip_code cell_id cell_type cell_area_sqm base_station terrain_position "
    "mean_elevation_ft dominant_aspect_deg mean_wind_ms wind_infiltration_mult prism_annual_hdd "
    "lst_summer_c mean_impervious_pct surface_albedo uhi_offset_f road_heat_flux_wm2 "
    "road_temp_offset_f hdd_terrain_mult hdd_elev_addition hdd_uhi_reduction effective_hdd"
).split() + [f"effective_hdd_{m}" for m in MONTHS] + (
    "effective_hdd_annual base_cdd uhi_cdd_addition traffic_cdd_addition effective_cdd num_cells "
    "cell_hdd_min cell_hdd_max cell_hdd_std cell_cdd_min cell_cdd_max cell_cdd_std run_date "
    "pipeline_version lidar_vintage nlcd_vintage prism_period"
).split()

STATION_SCHEMA = "station_id string, hdd_normal int, elevation_ft int, lat double, lon double, is_gorge boolean"
LANDCOVER_SCHEMA = "nlcd_class int, z0_m double, albedo double, emissivity double, displacement_height_m double"
RINGS_TYPE = T.ArrayType(T.ArrayType(T.StructType([
    T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
REGISTRY_SCHEMA = ("zip_code string, state string, region_code string, region_name string, "
                   "base_station string, lidar_vintage int")
CENTROID_SCHEMA = ("zip_code string, state string, po_name string, region_code string, "
                   "centroid_lon double, centroid_lat double")
MANIFEST_SCHEMA = "datetime_utc string, status string, file_size_bytes long, source_url string"
BILLING_SCHEMA = "zip_code string, therms_per_customer double"
WEATHER_SCHEMA = "station_code string, actual_hdd double"


@dataclass(frozen=True)
class Grid:
    """Affine placement of one grid: x = c + a*col, y = f + e*row (north-up, e < 0)."""

    a: float
    c: float
    e: float
    f: float
    n_rows: int | None = None
    n_cols: int | None = None
    crs: str = "utm10"


PLACEMENT_SCHEMA = "grid_id string, a double, c double, e double, f double, n_rows long, n_cols long, crs string"


def placements(spark: SparkSession, grids: dict[str, Grid]) -> DataFrame:
    """The placement table of several grids; operators take it wherever they take one `Grid`."""
    return spark.createDataFrame([(k, float(g.a), float(g.c), float(g.e), float(g.f), g.n_rows, g.n_cols, g.crs) for k, g in grids.items()], PLACEMENT_SCHEMA)


def stations(spark: SparkSession) -> DataFrame:
    """The 11-row station dimension."""
    return spark.createDataFrame(
        [(s, n, ft, la, lo, s in GORGE_STATIONS) for s, n, ft, la, lo in STATIONS], STATION_SCHEMA)


def landcover(spark: SparkSession) -> DataFrame:
    """The 20-row land-cover property dimension."""
    return spark.createDataFrame(LANDCOVER, LANDCOVER_SCHEMA)


def require_columns(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
