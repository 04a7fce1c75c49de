"""Headline queries, timed end to end; prints one JSON line.

Every query is materialised in full through the no-op sink. Tables shared by several queries are
written on first use, so the first query that needs one pays for it.
"""

from __future__ import annotations

import json
import os
import time

from pelagia.queries import load
from pelagia.session import get_spark

HEADLINE = ["a04_doy_climatology", "m11_anomaly_percentile", "a01_hourly_resample", "a07_tide_features_widened", "build_conditions", "build_scores",
            "climatological_curve", "w12_annual_percentile", "build_labels", "a19_evaluation_report", "j14_walk_forward_calibration",
            "a21_block_bootstrap", "build_outlook", "w05_outlook_scores_ratchet", "x01_parse_counts", "j11_point_in_polygon"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                      spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"), spark__ui__showConsoleProgress="false",
                      spark__sql__adaptive__coalescePartitions__minPartitionSize="64KB")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    registry, times = load(), {}
    for name in HEADLINE:
        t0 = time.time()
        registry[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": sf_dir.rstrip("/").split("sf")[-1], "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
