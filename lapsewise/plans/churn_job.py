"""Batch run: log -> clean -> features -> pruning -> model sweep -> metrics -> importances.

    spark-submit lapsewise/plans/churn_job.py LOG OUT [--format json|parquet] [--policy named|identified]
        [--tune] [--unweighted] [--seeds N ...] [--ks N ...] [--parallelism N]
"""

import argparse

from pyspark.sql import SparkSession

from lapsewise.operators.selection import features_to_keep
from lapsewise.plans.features import create_features, load_features, table_features
from lapsewise.plans.modelling import (
    SWEPT,
    TUNED,
    Training,
    feature_importance,
    swept_feature_counts,
    sweep,
    train_and_evaluate,
)
from lapsewise.plans.reports import cumulative_importance
from lapsewise.session import SETTINGS
from lapsewise.sources.tables import read_json_log, read_parquet_log, unreadable_lines, write_parquet_table


def run(
    spark: SparkSession,
    log_path: str,
    out: str,
    fmt: str = "json",
    policy: str = "named",
    training: Training | None = None,
    ks: list[int] | None = None,
    importance_of: str = "GBTClassifier",
    importance_k: int = 8,
    seeds: list[int] | None = None,
) -> None:
    """A run that was stopped goes on where its sweep ended if it is started again with the same folder."""
    seeds = seeds or [42]
    training = training or Training()
    log = read_json_log(spark, log_path) if fmt == "json" else read_parquet_log(spark, log_path)
    if fmt == "json":
        write_parquet_table(unreadable_lines(spark, log_path), f"{out}/unreadable")
    create_features(log, f"{out}/features", policy)
    table = load_features(spark, f"{out}/features")
    candidates = features_to_keep(table, table_features(table))

    metrics = sweep(table, candidates, ks or swept_feature_counts(candidates), training, seeds, f"{out}/jobs")
    write_parquet_table(metrics, f"{out}/metrics")

    final = Training(**{**training.__dict__, "kinds": [importance_of]})
    best = train_and_evaluate(table, candidates, importance_k, final).models[0]
    write_parquet_table(cumulative_importance(feature_importance(best)), f"{out}/importance")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("log")
    parser.add_argument("out")
    parser.add_argument("--format", default="json", choices=["json", "parquet"])
    parser.add_argument("--policy", default="named", choices=["named", "identified"])
    parser.add_argument("--tune", action="store_true", help="search the grids of the tuned classifiers")
    parser.add_argument("--unweighted", action="store_true", help="train without class weights")
    parser.add_argument("--seeds", type=int, nargs="+", default=[42])
    parser.add_argument("--ks", type=int, nargs="+", help="numbers of features")
    parser.add_argument("--parallelism", type=int, default=Training.parallelism, help="fits side by side")
    args = parser.parse_args()
    training = Training(
        kinds=list(TUNED if args.tune else SWEPT), tune=args.tune, class_weight=not args.unweighted,
        parallelism=args.parallelism,
    )
    builder = SparkSession.builder.appName("lapsewise")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    run(builder.getOrCreate(), args.log, args.out, args.format, args.policy, training, args.ks, seeds=args.seeds)


if __name__ == "__main__":
    main()
