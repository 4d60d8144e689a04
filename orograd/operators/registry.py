"""ZIP registry, regions and map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cols import c
from ..session import bounded_join
from ..types import LIDAR_VINTAGE, REGISTRY_SCHEMA, require_columns
from . import geometry
from .stations import nearest_station

# region of the published registry (fixed values)
REGION = ("R1", "region_1")


def registry_generate(centroids: DataFrame, *, region_code: str = REGION[0], region_name: str = REGION[1],
                      lidar_vintage: int = LIDAR_VINTAGE) -> DataFrame:
    """Every ZIP assigned to one region and its nearest station."""
    return nearest_station(centroids).select(
        "zip_code", "state", F.lit(region_code).alias("region_code"), F.lit(region_name).alias("region_name"),
        "base_station", F.lit(lidar_vintage).alias("lidar_vintage"))


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def registry_blank(zips: DataFrame | None, spark: SparkSession, *, region_code: str = REGION[0],
                   region_name: str = REGION[1]) -> DataFrame:
    """Registry whose stations are filled in later; without ZIPs an empty one."""
    if zips is None:
        return empty_registry(spark)
    return zips.select("zip_code", "state", F.lit(region_code).alias("region_code"),
                       F.lit(region_name).alias("region_name"), F.lit("").alias("base_station"),
                       F.lit(LIDAR_VINTAGE).alias("lidar_vintage"))


def registry_bbox(registry: DataFrame, centroids: DataFrame, *, pad: float = 0.5) -> DataFrame:
    """Per region: padded bounding box of its ZIP centroids, sorted stations, ZIP count, name, vintage.

    The full ZIP list of a region stays a table (`registry` itself), not one giant cell.
    """
    j = registry.join(centroids.select("zip_code", "centroid_lon", "centroid_lat"), "zip_code", "left")
    return j.groupBy("region_code").agg(
        (F.min("centroid_lon") - pad).alias("minx"), (F.min("centroid_lat") - pad).alias("miny"),
        (F.max("centroid_lon") + pad).alias("maxx"), (F.max("centroid_lat") + pad).alias("maxy"),
        F.array_sort(F.collect_set("base_station")).alias("base_stations"),
        F.count("zip_code").alias("num_zips"), F.min_by("region_name", "zip_code").alias("region_name"),
        F.min_by("lidar_vintage", "zip_code").alias("lidar_vintage"))


def find_region(registry: DataFrame, name: str) -> DataFrame:
    out = registry.where((F.col("region_name") == name) | (F.col("region_code") == name))
    if out.isEmpty():
        raise ValueError(f"region not found: {name}")
    return out


def region_row(polygons: DataFrame, *, region: str = "region_code", name: str = "region_name",
               states: str = "state") -> DataFrame:
    """One row per region: name, sorted states, part count and extent."""
    require_columns(polygons, [region, name, states, "rings"])
    info = polygons.groupBy(region).agg(F.min(name).alias(name), F.array_join(
        F.array_sort(F.collect_set(states)), ",").alias("states"))
    return geometry.dissolve(polygons, region=region).join(info, region)


def zip_priority_merge(*sources: DataFrame) -> DataFrame:
    """Union of ZIP tables in order of trust; a ZIP comes only from the first table that has it."""
    tagged = None
    for rank, df in enumerate(sources):
        part = df.withColumn("_rank", F.lit(rank))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    best = tagged.groupBy("zip_code").agg(F.min("_rank").alias("_rank"))
    return tagged.join(best, ["zip_code", "_rank"]).drop("_rank")


def add_zip_metadata(zips: DataFrame, *, region_code: str = REGION[0]) -> DataFrame:
    """Region code, place name and centroid of ZIP polygons (keyed `id` = ZIP code)."""
    out = zips.withColumn("region_code", F.lit(region_code))
    if "po_name" not in out.columns:
        out = out.withColumn("po_name", F.lit(""))
    mid = geometry.polygon_centroid(zips.select("id", "rings")).select(
        "id", F.col("centroid_x").alias("centroid_lon"), F.col("centroid_y").alias("centroid_lat"))
    return out.join(mid, "id")


# colour ramps as RGB in 0..1, low to high (fixed values)
RAMPS = {
    "viridis": [(0.267, 0.004, 0.329), (0.282, 0.140, 0.458), (0.254, 0.265, 0.530), (0.206, 0.371, 0.553),
                (0.163, 0.471, 0.558), (0.127, 0.567, 0.550), (0.134, 0.658, 0.517), (0.266, 0.748, 0.440),
                (0.477, 0.821, 0.318), (0.741, 0.873, 0.149), (0.993, 0.906, 0.144)],
    "plasma": [(0.050, 0.030, 0.529), (0.275, 0.005, 0.592), (0.493, 0.014, 0.606), (0.649, 0.084, 0.580),
               (0.759, 0.176, 0.492), (0.827, 0.280, 0.370), (0.865, 0.387, 0.235), (0.878, 0.498, 0.101),
               (0.878, 0.610, 0.000), (0.941, 0.757, 0.131), (0.940, 0.975, 0.131)],
    "rdylbu": [(0.404, 0.000, 0.122), (0.706, 0.016, 0.150), (0.837, 0.188, 0.153), (0.956, 0.427, 0.263),
               (0.992, 0.682, 0.380), (1.000, 0.910, 0.596), (0.816, 0.898, 0.773), (0.569, 0.816, 0.914),
               (0.267, 0.647, 0.910), (0.192, 0.502, 0.745), (0.192, 0.404, 0.659)],
    "rdylgn": [(0.404, 0.000, 0.122), (0.706, 0.016, 0.150), (0.837, 0.188, 0.153), (0.956, 0.427, 0.263),
               (0.992, 0.682, 0.380), (1.000, 0.910, 0.596), (0.816, 0.898, 0.773), (0.569, 0.898, 0.569),
               (0.267, 0.816, 0.267), (0.192, 0.659, 0.192), (0.000, 0.404, 0.000)],
}
# category -> colour (fixed values)
CATEGORY_COLOURS = {
    "terrain_position": {"windward": "#1f77b4", "leeward": "#ff7f0e", "valley": "#2ca02c", "ridge": "#d62728"},
    "cell_type": {"urban": "#e41a1c", "suburban": "#377eb8", "rural": "#4daf4a", "valley": "#984ea3",
                  "ridge": "#ff7f00", "gorge": "#a65628"},
}
NO_COLOUR = "#999999"


def ramp_colours(scheme: str) -> list[str]:
    return ["#" + "".join(f"{int(v * 255):02x}" for v in rgb) for rgb in RAMPS.get(scheme, RAMPS["viridis"])]


def ramp_colour(value: Column, lo: Column, hi: Column, scheme: str = "viridis") -> Column:
    colours = ramp_colours(scheme)
    share = F.when(lo == hi, 0.5).otherwise((value - lo) / F.nullif(hi - lo, F.lit(0.0)))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    return F.element_at(F.array(*map(F.lit, colours)), (F.floor(share * (len(colours) - 1)) + 1).cast("int"))


def category_colour(value: str, kind: str) -> Column:
    out = F.lit(NO_COLOUR)
    for name, colour in CATEGORY_COLOURS.get(kind, {}).items():
        out = F.when(F.col(value) == name, colour).otherwise(out)
    return out


def with_colours(df: DataFrame, value: str, *, keys: tuple[str, ...] = ("region_code",),
                 scheme: str = "viridis") -> DataFrame:
    """Add `color` from the value's place between its region's minimum and maximum."""
    rng = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return (bounded_join(df, rng, list(keys), "left")
            .withColumn("color", F.when(c(value).isNotNull(), ramp_colour(c(value), c("_lo"), c("_hi"), scheme)))
            .drop("_lo", "_hi"))


def geojson_features(cells: DataFrame, *, properties: list[str], rings: str = "rings") -> DataFrame:
    """`feature`: one GeoJSON Feature per row; rows without geometry are dropped.

    Rings are closed. One shell with its holes is a Polygon, several are a MultiPolygon.
    """
    parts = F.transform(geometry.shells_with_holes(rings), lambda poly: F.transform(poly, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))))
    keep = [k for k in ("id", "zip_code", "cell_id") if k in cells.columns]
    rows = cells.where(f"exists({rings}, r -> size(r) > 0)").withColumn("_parts", parts)
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get("_parts", F.lit(0)).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.col("_parts").alias("coordinates")))
    shape = F.when(F.size("_parts") == 1, one).otherwise(many)
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), F.to_json(F.struct(*properties)), F.lit("}"))
    return rows.select(*keep, feature.alias("feature"))


def title_label(name: Column | str) -> Column:
    """A column or check name as a label: underscores become spaces, words are capitalised."""
    return F.initcap(F.replace(c(name), F.lit("_"), F.lit(" ")))
