"""Headline queries at one scale. Prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

Each query runs once on the smallest tables to load classes, then once timed, with its
whole result consumed by Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "win01_agg01_engine_input",
    "spa02_joi01_bbox_join",
    "spa03_sample_depth",
    "spa06_joi06_cell_prefilter",
    "spa09_assign_county",
    "dmg16_many_rasters",
    "dmg19_run_damage",
    "agg02_dedup_predictions",
    "agg03_damage_counts_tract",
    "agg06_prediction_summary",
    "agg09_imp05_population_by_zone",
    "agg13_threshold_sensitivity",
    "imp15_end_to_end",
    "imp15_population_by_event",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from registry import catalog
    from tidemark import get_session

    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    times = {}
    for name in HEADLINE:
        if os.path.isdir(small):
            run(name, small)
        times[name] = round(run(name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
