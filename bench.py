"""Wall time of the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``. Each query runs twice and its whole
result is computed; the second run is measured.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from quartergrid.session import build_session

HEADLINE = (
    "scan_events", "city_range_join", "geohash_cell", "cell_step_counts", "nearest_cell_airports",
    "next_obs_fill", "weather_cell_mean", "dense_grid", "grid_project", "doc_vector_mean",
    "cell_text_vector", "poi_minmax", "split_minmax", "lookback_sequence", "negative_sample",
    "assemble_example", "class_metrics", "fit_logreg",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g", spark__ui__enabled="false",
        # The tables are small files: read them in more than one task.
        spark__sql__files__maxPartitionBytes="1m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cpus": int(cpus), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
