"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_REPEAT
(runs per query; the fastest counts), BENCH_ONLY (comma-separated prefixes).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rollcall.plans.registry import queries  # noqa: E402
from rollcall.session import build_session  # noqa: E402

# The report statements, and the heaviest query of every other group.
HEADLINE = (
    *("q1_", "q2_", "k", "q4_", "q5_", "q6_", "q7_", "v", "d1_", "d2_", "d3_", "d4_", "d5_", "d6_", "d7_", "d8_", "w"),
    "dq1_validation_report",
    "a8_salary_profile",
    "m7_scorecard",
    "t1_survival_input",
    "t5_cohort_summary",
    "t7_college_tier_curves",
    "t11_logrank_statistic",
    "t13_executive_summary",
    "g10_feature_matrix",
    "z3_attrition_score",
    "h4_metrics",
    "h2_boosted_trees",
    "h5_scored_employees",
    "n1_contributions",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    chosen = tuple(os.environ.get("BENCH_ONLY", "").split(",")) if os.environ.get("BENCH_ONLY") else HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus), app_name="rollcall-bench")
    spark.read.parquet(f"{directory}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name, build in queries().items():
        if not name.startswith(chosen):
            continue
        runs = []
        for _ in range(repeat):
            start = time.perf_counter()
            build(spark, directory).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(directory).name.removeprefix("sf"),
        "cpus": int(cpus),
        "repeat": repeat,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
