"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is the median of three runs after one that warms the JVM up. The five cv_* entries are
the wall clock of one 5-fold cross validation with default parameters, on 8 selected features.
"""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lapsewise.operators.selection import best_features  # noqa: E402
from lapsewise.operators.weighting import train_test_split  # noqa: E402
from lapsewise.plans import catalog, modelling  # noqa: E402
from lapsewise.session import local_session  # noqa: E402

HEADLINE = [
    "feature_table",
    "churn_rate_table",
    "churn_rate_all",
    "chi2_scores",
    "feature_correlation",
    "numeric_summary_table",
    "page_mix",
    "page_box_stats",
    "churn_flagged_log",
    "length_by_churn",
    "user_counts_by_category",
    "missing_values",
]
RUNS = 3


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("OFF")
    queries = catalog.queries()
    timings: dict[str, float] = {}

    for name in HEADLINE:
        run = lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        run()
        timings[name] = statistics.median(seconds(run) for _ in range(RUNS))

    table = catalog.written_features(spark, sf_dir)
    chosen = best_features(table, catalog.candidates(table), 8)
    frame = modelling.model_frame(table, chosen, class_weight=True)
    train_df = train_test_split(frame)[0].persist()
    train_df.count()
    for kind in modelling.SWEPT:
        timings[f"cv_{kind}"] = modelling.train(kind, train_df, chosen, modelling.Training()).seconds

    scale = re.search(r"sf([0-9.]+)", os.path.basename(sf_dir.rstrip("/")))
    result = {
        "metric": "headline queries and five 5-fold cross validations, total wall clock",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in timings.items()},
        "sf": float(scale.group(1)) if scale else None,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
