"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default sf0.1) and BENCH_CPUS choose the data and the cores. With `--loop` the
default batch run, 24 hourly periods, is also timed the way a job per slice would do it; with
`--rows N`, hourly insights of the events repeated as other devices up to N rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import process_metrics, window_metrics
from tidegauge.plans import run_lookback
from tidegauge.plans.given_tables import metrics
from tidegauge.plans.queries import END, QUERIES, START, ingested
from tidegauge.session import build_session, shared_dir
from tidegauge.sources import scan_metrics

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
REPEATS = 2

HEADLINE = (
    "window_insights",
    "device_summary",
    "clipped_windows",
    "lookback_scan",
    "recent_metrics",
    "hourly_trends",
    "device_statistics",
    "device_kpis",
    "alerts_flat",
    "metrics_total",
    "valid_metrics",
    "trend_vs_history",
    "enriched_insights",
    "capacity_forecast",
    "stream_ingest",
    "live_tail",
)


def run(df: DataFrame) -> None:
    """Compute every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def best(work: Callable[[], None], repeats: int = REPEATS) -> float:
    times = []
    for _ in range(repeats):
        begin = time.perf_counter()
        work()
        times.append(time.perf_counter() - begin)
    return round(min(times), 3)


def main() -> None:
    spark = build_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__driver__memory="8g",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__sql__shuffle__partitions=CPUS,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["window_insights"](spark, SF_DIR))

    times = {name: best(lambda q=QUERIES[name]: run(q(spark, SF_DIR))) for name in HEADLINE}
    table = ingested(spark, SF_DIR)
    as_of = datetime.fromisoformat(END) - timedelta(hours=12)
    times["batch_day"] = best(
        lambda: run_lookback(spark, table, shared_dir(spark, "insights"), as_of)
    )
    result = {
        "metric": "headline queries, best of 2, sum",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
        "metrics_per_sec": {
            name: round(scan_metrics(spark, table).count() / times[name])
            for name in ("window_insights", "stream_ingest")
        },
    }
    if "--loop" in sys.argv:
        start = as_of - timedelta(hours=24)

        def one_pass() -> None:
            run(window_metrics(scan_metrics(spark, table, start, as_of), start, as_of))

        def loop() -> None:
            for hour in range(24):
                begin = start + timedelta(hours=hour)
                upto = begin + timedelta(hours=1)
                run(process_metrics(scan_metrics(spark, table, begin, upto), begin, upto))

        result["one_pass"], result["loop"] = best(one_pass), best(loop)
    if "--rows" in sys.argv:
        # the events again and again, as other devices, until there are that many
        events = metrics(spark, SF_DIR)
        again = -(-int(sys.argv[sys.argv.index("--rows") + 1]) // events.count())
        copies = events.repartition(int(CPUS)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(again))))
        path = shared_dir(spark, "many")
        copies.withColumn("device_id", F.concat_ws("-", "device_id", "copy")).drop("copy").write.parquet(path)
        many = spark.read.parquet(path)
        result["rows"] = many.count()
        result["many_rows"] = best(lambda: run(window_metrics(many, START, END)))
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
