"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is fully executed with the ``noop`` sink (every row produced,
nothing collected to the driver). ``training`` is the end-to-end batch run
(prepare, split, forest + boosted trees, choice, importance, coverage,
horizon submission, per-store lag forecast) with the reference's model sizes:
400 trees of depth 25 and 500 steps of 0.03 and depth 8.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["clean_panel", "promo_lift", "kpis", "daily_mean_sales", "weekday_mean", "distance_band_mean",
            "spend_median", "corr_matrix", "engineered_features", "sample_fraction", "regression_metrics",
            "daily_resample", "interpolate", "acf", "pacf", "adf", "sliding_windows", "lag_forecast",
            "forecast_requests", "qq_points"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from shelfcast.session import get_spark
    spark = get_spark("shelfcast-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                  "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfcast-bench-ckpt-")})
    spark.sparkContext.setLogLevel("ERROR")
    from shelfcast.queries import QUERIES
    from shelfcast.session import ship_package
    ship_package(spark)  # Python workers import the package whatever the working directory
    # Untimed JVM warm-up that touches no test data (session start, first codegen).
    spark.range(1_000_000).selectExpr("sum(id % 7) as s").collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    from shelfcast.plans.training import TrainingConfig, train_and_compare
    from shelfcast.sources.fixture import load_panel
    p = load_panel(spark, sf_dir)
    t0 = time.time()
    res = train_and_compare(p.fact, p.store, p.horizon, TrainingConfig())
    res.submission.write.format("noop").mode("overwrite").save()
    res.coverage.collect()
    res.lag_metrics.write.format("noop").mode("overwrite").save()
    times["training"] = round(time.time() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "best_model": res.best_name,
                      "best_rmspe": round(res.metrics["best"]["RMSPE"], 4)}))
    spark.stop()


if __name__ == "__main__":
    main()
