"""Every operator as a named query over the star-schema tables: (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.operators import cleaning, labels, numeric, profiling, ranking, segments, selection, sessions, weighting
from lapsewise.plans import features, modelling, reports
from lapsewise.schema import EVENT_SCHEMA
from lapsewise.sources import (
    activity_log,
    read_csv_table,
    read_json_log,
    read_parquet_log,
    write_csv_table,
    write_json_table,
    write_parquet_table,
)
from lapsewise.storage import new_path, write_and_reload

Query = Callable[[SparkSession, str], DataFrame]

SEGMENT_FEATURES = ["gender", "level", "status", "method", "page", "device", "browser", "state", "date"]
RATE_FEATURES = ["gender", "level", "status", "device", "browser", "state", "weekday", "day", "hour"]
ACTIVITY_BINS = {"interactions": 25, "sessions": 25, "session_minutes": 25}
BINS = {m: (50 if m == "num_sessions" else 25) for m in numeric.METRICS}


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Columns made from sums of doubles, whose last bits depend on the order of summing."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


SUM_OF_LENGTHS = {"sum_length_minutes": 7}
SUMMARY_DIGITS = {"mean": 6, "std": 6, "q1": 8, "median": 8, "q3": 8}
BOX_DIGITS = {"q1": 8, "median": 8, "q3": 8}
CONFUSION_DIGITS = {c: 8 for c in ("accuracy", "f1_score", "precision", "recall", "auc_hard")}


# Logs

def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    return activity_log(spark, sf)


def user_log(spark: SparkSession, sf: str) -> DataFrame:
    """Identified events without the name and location columns: a scan of events alone."""
    return cleaning.clean(activity_log(spark, sf, profile=False))


def segmented_log(spark: SparkSession, sf: str, profile: bool) -> DataFrame:
    log = cleaning.with_time_columns(cleaning.clean(activity_log(spark, sf, profile)))
    log = cleaning.with_agent_columns(log)
    return cleaning.with_place_columns(log) if profile else log


def on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(raw_log(spark, sf))


def on_events(operator: Callable[[DataFrame], DataFrame], digits: dict[str, int] | None = None) -> Query:
    return lambda spark, sf: rounded(operator(user_log(spark, sf)), digits or {})


def on_segments(operator: Callable[[DataFrame], DataFrame], profile: bool = False) -> Query:
    return lambda spark, sf: operator(segmented_log(spark, sf, profile))


def on_features(operator: Callable[[DataFrame], DataFrame], digits: dict[str, int] | None = None) -> Query:
    return lambda spark, sf: rounded(operator(written_features(spark, sf)), digits or {})


# Sources and sinks

def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    events = read_parquet_log(spark, f"{sf}/events.parquet")
    return events.withColumn("ts", F.unix_millis(F.col("ts").cast("timestamp")))


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "log-json")
    write_json_table(raw_log(spark, sf), path)
    return read_json_log(spark, path)


def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    return json_round_trip(spark, sf).groupBy("page", "auth").agg(
        F.count("*").alias("n_logs"), F.count("song").alias("n_songs"), F.max("ts").alias("last_ts")
    )


def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "log-parquet")
    write_parquet_table(cleaning.with_time_columns(raw_log(spark, sf)), path, partition_by=["date"])
    return read_parquet_log(spark, path).select(*EVENT_SCHEMA.names)


_RATE_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("churn_rate", T.DoubleType()),
        T.StructField("dataset", T.StringType()),
    ]
)


def csv_round_trip(table: DataFrame, schema: T.StructType) -> DataFrame:
    path = new_path(table.sparkSession, "report-csv")
    write_csv_table(table, path)
    return read_csv_table(table.sparkSession, path, schema)


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    return csv_round_trip(rate_table(spark, sf), _RATE_TABLE_SCHEMA)


def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    return csv_round_trip(session_rows(spark, sf), session_rows(spark, sf).schema)


def load_features(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "features")
    features.create_features(activity_log(spark, sf, profile=False), path)
    return rounded(features.load_features(spark, path), SUM_OF_LENGTHS)


# Reports

def session_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_duration(user_log(spark, sf))


def rate_table(spark: SparkSession, sf: str) -> DataFrame:
    return reports.churn_rate_table(segmented_log(spark, sf, False), "all")


def all_rates(spark: SparkSession, sf: str) -> DataFrame:
    return segments.churn_rates(segmented_log(spark, sf, True), RATE_FEATURES)


def rate_of(feature: str) -> Query:
    by_users = feature not in ("weekday", "day", "hour")
    return on_segments(lambda log: segments.churn_rate(log, feature, by_users), profile=feature == "state")


def log_periods(log: DataFrame) -> dict[str, DataFrame]:
    """The log as two data sets, one per half of the month."""
    early = F.dayofmonth(F.timestamp_millis("ts")) <= 15
    return {"early": log.where(early), "late": log.where(~early)}


def compare_numeric(log: DataFrame) -> DataFrame:
    tables = {d: reports.numeric_summary_table(part, d) for d, part in log_periods(log).items()}
    return reports.compare_numeric(tables)


def compare_categories(log: DataFrame) -> DataFrame:
    tables = {d: reports.churn_rate_table(part, d) for d, part in log_periods(log).items()}
    return reports.compare_categories(tables)


def metric_histogram(log: DataFrame) -> DataFrame:
    return numeric.histogram(numeric.metrics_long(numeric.user_metrics(log), numeric.METRICS), BINS)


def rule_based_metrics(table: DataFrame) -> DataFrame:
    """Metrics of a stated rule, per level: users with few songs per session are said to leave."""
    rule = F.when(F.col("avg_songs_per_session") < 0.5, 1.0).otherwise(0.0)
    return weighting.confusion_metrics(table.withColumn("prediction", rule), ["level"])


def ranked_area(table: DataFrame) -> DataFrame:
    """Area under the curve of a stated score, per level: the more songs per session, the likelier to leave."""
    return ranking.area_under_curve(table, "avg_songs_per_session", by=["level"])


def fold_sizes(table: DataFrame) -> DataFrame:
    """Users of the training part by cross-validation fold and label."""
    training = weighting.train_test_split(table)[0]
    return weighting.with_fold(training, modelling.Training().folds).groupBy("fold", "churn").agg(F.count("*").alias("n_users"))


def split_sizes(table: DataFrame) -> DataFrame:
    part = F.when(weighting.in_training_set(), "train").otherwise("test")
    return table.select("userId", "churn", part.alias("part"))


# Selection and models. All of them read one feature table, written once per session and input.

_written: dict[tuple[str, str, str], DataFrame] = {}


def once(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _written:
        _written[key] = write_and_reload(build(), name)
    return _written[key]


def written_features(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "features", lambda: features.feature_table(user_log(spark, sf)))


def candidates(table: DataFrame) -> list[str]:
    return selection.features_to_keep(table, features.table_features(table))


#: Feature counts of the tuning sweep.
TUNED_COUNTS = range(4, 25, 4)


def one_round(spark: SparkSession, sf: str, training: modelling.Training, k: int = 8) -> modelling.Round:
    table = written_features(spark, sf)
    return modelling.train_and_evaluate(table, candidates(table), k, training)


def predict(kind: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        done = one_round(spark, sf, modelling.Training(kinds=[kind], cross_validate=False))
        return modelling.predictions(done.models[0], done.test_df).select("userId", "churn", "prediction")

    return query


def cv_metrics(spark: SparkSession, sf: str) -> DataFrame:
    table = written_features(spark, sf)
    return modelling.grid_scores(table, candidates(table), 8, modelling.Training(kinds=["LogisticRegression"]))


def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validated F1 of every point of the four grids."""
    table = written_features(spark, sf)
    return modelling.grid_scores(table, candidates(table), 8, modelling.Training(kinds=modelling.TUNED, tune=True))


def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    done = one_round(spark, sf, modelling.Training())
    return modelling.metric_table(spark, done.metrics)


def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    done = one_round(spark, sf, modelling.Training(kinds=["RandomForestClassifier"], cross_validate=False))
    return modelling.evaluation_with_auc(done.models[0], done.train_df, done.test_df)


def experiment_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Default grids of all classifiers over every fourth feature count. A stopped run goes on where it ended."""
    table = written_features(spark, sf)
    names = candidates(table)
    return modelling.sweep(table, names, modelling.swept_feature_counts(names), modelling.Training())


def tuning_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Searched grids over the tuned feature counts that the table has, best F1 first."""

    table = written_features(spark, sf)
    names = candidates(table)
    counts = [k for k in TUNED_COUNTS if k <= len(names)]
    swept = modelling.sweep(table, names, counts, modelling.Training(kinds=modelling.TUNED, tune=True))
    return swept.orderBy(F.desc("f1_score"), "num_best_features")


def metric_curves(spark: SparkSession, sf: str) -> DataFrame:
    return reports.metric_curves(experiment_sweep(spark, sf), modelling.SWEPT)


def time_per_param(spark: SparkSession, sf: str) -> DataFrame:
    return reports.time_per_param(tuning_sweep(spark, sf))


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    return reports.best_model(experiment_sweep(spark, sf).unionByName(tuning_sweep(spark, sf)))


def best_model_refit(spark: SparkSession, sf: str) -> DataFrame:
    """Forest of depth 5 on the 12 best features, with running importances."""
    training = modelling.Training(
        kinds=["RandomForestClassifier"],
        params={"RandomForestClassifier": {"maxDepth": 5, "numTrees": 100}},
    )
    done = one_round(spark, sf, training, k=12)
    return reports.cumulative_importance(modelling.feature_importance(done.models[0]))


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    done = one_round(spark, sf, modelling.Training(kinds=["GBTClassifier"], cross_validate=False))
    return reports.cumulative_importance(modelling.feature_importance(done.models[0]))


def queries() -> dict[str, Query]:
    table = {
        # sources and sinks
        "scan_parquet": scan_parquet,
        "scan_json": scan_json,
        "scan_csv": scan_csv,
        "sink_json": json_round_trip,
        "sink_parquet": sink_parquet,
        "sink_csv": sink_csv,
        "load_features": load_features,
        # profiling
        "table_shape": on_raw(profiling.table_shape),
        "schema_table": lambda s, sf: profiling.schema_table(read_parquet_log(s, f"{sf}/events.parquet")),
        "duplicate_rows": on_raw(profiling.duplicate_rows),
        "duplicate_actions": on_events(
            lambda log: profiling.duplicate_rows(log, ["userId", "sessionId", "page", "level"])
        ),
        "missing_values": on_raw(profiling.missing_values),
        "null_attribute_users": on_raw(profiling.null_attribute_users),
        "auth_by_anonymity": lambda s, sf: profiling.auth_by_anonymity(activity_log(s, sf, profile=False)),
        "pages_without_media": on_events(profiling.pages_without_media),
        "pages_with_media": on_events(profiling.pages_with_media),
        "range_summary": on_segments(
            lambda log: profiling.range_summary(
                log, ["time", "registration_time", "date", "registration_date", "weekday", "day", "hour"]
            )
        ),
        "activity_totals": on_events(profiling.activity_totals),
        "sample_agents": on_events(lambda log: profiling.sample_column(log, "userAgent", 5, 42, ["userId", "sessionId", "ts", "page"])),
        "preview": on_events(lambda log: profiling.preview(log, ["ts", "userId", "page", "level"], 20)),
        # cleaning and scalar columns
        "clean_identified": on_raw(cleaning.clean),
        "clean_named": on_raw(lambda log: cleaning.clean(log, "named")),
        "clean_log": on_raw(cleaning.clean_log),
        "time_columns": on_events(
            lambda log: cleaning.with_time_columns(log).select(
                "userId", "ts", "time", "registration_time", "date", "registration_date", "hour", "day", "weekday"
            )
        ),
        "split_location": on_raw(
            lambda log: cleaning.with_place_columns(log).groupBy("location", "city", "state").agg(
                F.count("*").alias("n_logs")
            )
        ),
        "agent_columns": lambda s, sf: cleaning.with_agent_columns(activity_log(s, sf, profile=False)).groupBy(
            "userAgent", "device", "browser"
        ).agg(F.count("*").alias("n_logs")),
        "days_since_registration_events": on_events(
            lambda log: cleaning.with_account_age(log).select("userId", "ts", "days_since_registration")
        ),
        # labels
        "churned_users": on_events(labels.churned_users),
        "downgraded_users": on_events(labels.downgraded_users),
        "cancelled_and_downgraded": on_events(labels.cancelled_and_downgraded),
        "churn_label": on_events(labels.churn_labels),
        "churn_flagged_log": on_events(
            lambda log: labels.churn_flagged_log(log).select(
                "userId", "sessionId", "ts", "page", "churn_event", "churn", "downgrade_event", "downgrade_count"
            )
        ),
        "downgrade_logs": on_events(labels.downgrade_logs),
        "downgrade_users": on_events(labels.downgrade_users),
        "churn_summary": on_events(labels.churn_summary),
        # segments
        "log_counts_by_category": on_segments(lambda log: segments.log_counts(log, SEGMENT_FEATURES), True),
        "user_counts_by_category": on_segments(lambda log: segments.user_counts(log, SEGMENT_FEATURES), True),
        **{f"churn_rate_{f}": rate_of(f) for f in RATE_FEATURES},
        "churn_rate_all": all_rates,
        "churn_log_counts": on_segments(
            lambda log: segments.churn_log_counts(log, ["status", "state", "weekday", "day", "hour"]), True
        ),
        "page_mix": on_events(segments.page_mix),
        "page_pivot": on_events(features.page_pivot),
        "page_box_stats": on_events(numeric.page_box_stats),
        # sessions and per-user numbers
        "interactions_per_user": on_events(sessions.interactions_per_user),
        "sessions_per_user": on_events(sessions.sessions_per_user),
        "session_duration": session_rows,
        "eda_num_sessions": on_events(numeric.num_sessions),
        "eda_unique_songs": on_events(numeric.unique_songs),
        "eda_unique_artists": on_events(numeric.unique_artists),
        "eda_count_songs": on_events(numeric.count_songs),
        "eda_days_since_registration": on_events(numeric.days_since_registration),
        "eda_avg_session_length": on_events(numeric.avg_session_length),
        "eda_session_interval": on_events(numeric.session_interval_hours),
        "length_by_churn": on_events(lambda log: numeric.length_by_churn(log, digits=6)),
        "numeric_summary": on_events(numeric.numeric_summary, SUMMARY_DIGITS),
        "histogram_by_churn": on_events(metric_histogram),
        "activity_histogram": on_events(
            lambda log: numeric.histogram(numeric.activity_long(log), ACTIVITY_BINS, by=None)
        ),
        "activity_box_stats": on_events(
            lambda log: numeric.box_stats(numeric.activity_long(log), ["metric"], "value"), BOX_DIGITS
        ),
        # features
        "user_info": on_events(features.user_info),
        "device_usage": on_events(features.device_usage),
        "browser_usage": on_events(features.browser_usage),
        "page_counts": on_events(features.page_counts),
        "overall_stats": on_events(features.overall_stats, SUM_OF_LENGTHS),
        "session_stats": on_events(sessions.session_stats),
        "page_rates_hourly": on_events(features.page_rates_hourly),
        "session_interval": on_events(sessions.session_interval),
        "feature_table": on_events(features.feature_table, SUM_OF_LENGTHS),
        "feature_table_inner": on_events(lambda log: features.feature_table(log, join="inner"), SUM_OF_LENGTHS),
        # selection
        "feature_correlation": on_features(lambda t: selection.feature_correlation(t, features.table_features(t)), {"r": 6}),
        "correlated_features_dropped": on_features(
            lambda t: selection.names_table(t.sparkSession, selection.correlated_features(t, features.table_features(t)), "feature")
        ),
        "chi2_scores": on_features(lambda t: selection.chi2_scores(t, features.table_features(t)), {"score": 6}),
        "select_k_best": on_features(lambda t: selection.select_k_best(t, features.table_features(t), 16), {"score": 6}),
        "class_weights": on_features(weighting.class_weights),
        "class_weighted": on_features(
            lambda t: weighting.with_class_weight(t).select("userId", "churn", "weight")
        ),
        "minmax_scaled": on_features(lambda t: selection.min_max_scaled(t, features.table_features(t)), SUM_OF_LENGTHS),
        "train_test_split": on_features(split_sizes),
        "fold_sizes": on_features(fold_sizes),
        "area_under_curve": on_features(ranked_area, {"auc": 9}),
        "confusion_metrics": on_features(rule_based_metrics, CONFUSION_DIGITS),
        # report tables
        "churn_rate_table": rate_table,
        "numeric_summary_table": on_events(lambda log: reports.numeric_summary_table(log, "all")),
        "compare_datasets_num": on_events(compare_numeric),
        "compare_datasets_cat": on_segments(compare_categories),
        # models
        "predict_rf": predict("RandomForestClassifier"),
        "predict_lr": predict("LogisticRegression"),
        "predict_gbt": predict("GBTClassifier"),
        "predict_svc": predict("LinearSVC"),
        "predict_dt": predict("DecisionTreeClassifier"),
        "evaluation": evaluation,
        "cv_metrics": cv_metrics,
        "grid_search": grid_search,
        "model_metrics": model_metrics,
        "experiment_sweep": experiment_sweep,
        "tuning_sweep": tuning_sweep,
        "metric_curves": metric_curves,
        "time_per_param": time_per_param,
        "best_model": best_model,
        "best_model_refit": best_model_refit,
        "feature_importance": feature_importance,
    }
    return table
