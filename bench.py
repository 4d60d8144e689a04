"""Time every catalogue query; prints one JSON line.

Each query runs once to warm up and once timed into the `noop` sink, so every column is computed
and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from orograd import catalog
from orograd.session import local_session

HEADLINE = ("zip_aggregate_union cell_zonal cell_monthly terrain tpi aspect_slope surface_mask cold_air_drainage clip_boundary "
            "road_rasterize create_cells bilinear station_bias station_wind nearest_station wind_profiles daily_combine "
            "safety_cube hourly_cube bias_correct qa_all qa_stats billing_cell terrain_attributes normals_run st_cycle_cube "
            "normals_full regions_run region_boundary station_bias_table roads_two_grids").split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(catalog.queries())
    times = {}
    for name in names:
        run = catalog.queries()[name]
        run(spark, folder).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total warm seconds over the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
