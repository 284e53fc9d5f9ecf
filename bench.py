"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from airmart import schemas as S  # noqa: E402
from airmart.operators.windows import with_windows  # noqa: E402
from airmart.plans import marts  # noqa: E402
from airmart.session import build_session, materialize  # noqa: E402
from airmart.sources import sensors  # noqa: E402
from workload.queries import all_queries  # noqa: E402

HEADLINE = [
    "ingest_rename_cast", "hourly_payload_inline", "history_cutoff", "stg_weather_as_written",
    "stg_weather_unified", "fact_hourly", "fact_by_station", "clf_training",
    "clf_training_by_station", "clf_training_blocked", "clf_training_by_station_blocked",
    "clf_inference", "clf_inference_by_station", "anomaly_training", "anomaly_inference",
    "dq_summary", "ds_aqi_series", "ds_heatmap", "ds_wind_bins", "ds_hist_vs_rt", "ds_drivers",
    "anomaly_hourly_band", "clf_predict", "anomaly_detect", "store_full_refresh",
    "stream_snapshot", "stream_hours_joined", "anomaly_smoothed", "anomaly_detect_by_station",
    "clf_training_time_frames",
]


def long_series(spark, sf_dir: str) -> dict[str, float]:
    """Classifier windows over one series of the events, 10 and 100 times as long, plain and in blocks."""
    events = sensors.read_events(spark, sf_dir)
    seconds = {}
    for times in (10, 100):
        copies = events.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(times))))
        longer = materialize(copies.withColumn("ts", F.expr("ts + make_dt_interval(40 * _n)")).drop("_n"), "long")
        base = sensors.event_weather(longer).select(S.TIME, "TEMPERATURE").withColumn("PM2_5", F.col("TEMPERATURE"))
        for strategy in ("series", "blocked"):
            start = time.perf_counter()
            found = with_windows(base, marts.pm_features(), [S.TIME], preceding=24, strategy=strategy)
            found.write.format("noop").mode("overwrite").save()
            seconds[f"long_{strategy}_x{times}"] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):  # the first run also compiles the generated code
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    if os.environ.get("BENCH_LONG"):
        seconds |= long_series(spark, sf_dir)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
