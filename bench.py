"""Time the headline queries.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bankweave.plans import catalog  # noqa: E402
from bankweave.session import build_session  # noqa: E402

HEADLINE = [
    "a1_movement_trends", "a1_movement_trends_long", "a2_daily_liquidity", "a3_branch_metrics", "a4_daily_summary", "a7_kpi_windows",
    "a8_consolidated_report", "a12_branch_utilization", "a13_regulator_totals", "a14_channel_type_cube", "j1_enrich", "j3_cross_bank_fraud",
    "j4_after_suspicion", "j5_follow_ups", "j8_fx_normalised", "w1_day_over_day", "w2_month_over_month", "w3_velocity", "w4_k6_last_transaction",
    "w5_top_suspects", "w8_customer_rank", "m9_liquidity_forecast", "m10_recommendations", "r6_sliding_velocity", "r7_sessions", "t6_top_customers",
    "p4_error_list", "p5_verdicts", "p12_p14_scores", "s10_lake_layers", "k8_append_new", "k16_erase_customers", "r1_score_stream", "r2_multi_sink",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = catalog.queries(), {}
    for name in names:
        taken = []
        for _ in range(runs + 1):  # the first run only warms up
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    print(json.dumps({
        "metric": "headline queries, sum of median seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
