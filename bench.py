"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (every row computed,
nothing collected to the driver); ``etl_layers`` writes all four layers, and the
analyses of gold read the layer it has just written, as in production.
Every query is first run once, untimed, on sf0.001 so JIT compilation,
codegen and Python worker start-up are not counted (steady state, as on a
long-running cluster). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from abtest_spark.operators import bayes as B  # noqa: E402
from abtest_spark.operators import chi2 as C  # noqa: E402
from abtest_spark.operators import conversion as CV  # noqa: E402
from abtest_spark.operators import results as R  # noqa: E402
from abtest_spark.plans.catalog import QUERIES  # noqa: E402
from abtest_spark.plans.etl import run_pipeline  # noqa: E402
from abtest_spark.session import get_spark  # noqa: E402
from abtest_spark.sources.layers import read_layer  # noqa: E402
from abtest_spark.sources.raw import load_raw  # noqa: E402

HEADLINE = [
    "quality_report",
    "silver",
    "gold_aggregated",
    "gold_tunnel",
    "buy_group",
    "funnel",
]

# Analyses of the written gold layer.
ON_GOLD = {
    "conversion_ranking": CV.conversion_ranking,
    "chi2_test": C.chi2_test,
    "bayes_summary": B.bayes_summary,
    "bayes_hdi": B.bayes_hdi,
    "bayes_comparison": lambda gold: B.bayes_comparison(B.bayes_report(gold)),
    "experiment_result_lookup": lambda gold: R.lookup_results(R.experiment_results(gold), R.calendar_requests(gold)),
}

# The same analyses from the raw stream, reported beside the total (rounds before the gold layer was read measured these).
FROM_RAW = ["conversion_ranking", "chi2_test", "bayes_summary", "bayes_hdi", "bayes_comparison", "experiment_result_lookup"]


def _sf_label(sf_dir: str) -> str:
    base = os.path.basename(sf_dir.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="abtest-bench-")
    extra = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.local.dir": scratch,
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
    }
    if os.environ.get("BENCH_EVENT_LOG") == "1":
        # Stage and task timings for offline inspection (no UI is started).
        os.makedirs(f"{scratch}/events", exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"{scratch}/events"})
    spark = get_spark(
        app="abtest_bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(2 * cpus, 8))),
        extra=extra,
    )

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Warm-up on the smallest input, not timed.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    sc = spark.sparkContext
    sc.setJobDescription("warm-up")
    run_pipeline(spark, load_raw(spark, warm), f"{scratch}/warmup")
    for name in HEADLINE:
        run(QUERIES[name](spark, warm))
    for fn in ON_GOLD.values():
        run(fn(read_layer(spark, f"{scratch}/warmup", "gold_aggregated")))

    times: dict[str, float] = {}
    failed: list[str] = []

    def timed(name, fn):
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        try:
            fn()
        except Exception as e:  # noqa: BLE001 - report and go on with the others
            failed.append(name)
            print(f"{name} failed: {type(e).__name__}: {str(e)[:500]}", file=sys.stderr)
            return
        times[name] = time.perf_counter() - t0

    timed("etl_layers", lambda: run_pipeline(spark, load_raw(spark, sf_dir), f"{scratch}/layers"))
    for name in HEADLINE:
        timed(name, lambda name=name: run(QUERIES[name](spark, sf_dir)))
    for name, fn in ON_GOLD.items():
        timed(name, lambda fn=fn: run(fn(read_layer(spark, f"{scratch}/layers", "gold_aggregated"))))

    total = sum(times.values())
    on_gold = dict(times)
    for name in FROM_RAW:
        timed(f"{name}_from_raw", lambda name=name: run(QUERIES[name](spark, sf_dir)))
    from_raw = {k.removesuffix("_from_raw"): v for k, v in times.items() if k not in on_gold}
    result = {
        "metric": "total_query_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in on_gold.items()},
        "from_raw": {k: round(v, 3) for k, v in from_raw.items()},
        "sf": _sf_label(sf_dir),
        "cpus": cpus,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
