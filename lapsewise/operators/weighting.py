"""Class weights, the train/test split and metrics of predictions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def class_weights(table: DataFrame) -> DataFrame:
    """Size and weight n / (classes * size) of each label value."""
    sizes = table.groupBy("churn").agg(F.count("*").alias("n_users"))
    # One row per label value.
    classes = Window.partitionBy()
    balanced = F.sum("n_users").over(classes).cast("double") / F.count("*").over(classes)
    return sizes.withColumn("weight", balanced / F.col("n_users"))


def with_class_weight(table: DataFrame) -> DataFrame:
    # One row per label value.
    return table.join(F.broadcast(class_weights(table).select("churn", "weight")), "churn")


def _digest(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("userId")))


def _bucket(digest: Column, start: int, buckets: int) -> Column:
    """A number below ``buckets`` from eight hex digits of a digest."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("long") % buckets


def in_training_set(train_share: float = 0.7, seed: int = 42) -> Column:
    return _bucket(_digest(seed), 1, 1000) < round(1000 * train_share)


def train_test_split(table: DataFrame, train_share: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the user, so it does not depend on partitions, order or retries."""
    train = in_training_set(train_share, seed)
    return table.where(train), table.where(~train)


def random_split(table: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's own seeded split; its result depends on how the table is partitioned."""
    return table.randomSplit(weights, seed)


def with_fold(table: DataFrame, folds: int, seed: int = 42) -> DataFrame:
    """Cross-validation fold from other digits of the same hash."""
    return table.withColumn("fold", _bucket(_digest(seed), 9, folds).cast("int"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_metrics(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Confusion counts and class-weighted metrics, from one aggregation.

    ``auc_hard`` is the area under the two-segment curve of the hard prediction.
    """
    actual, predicted = F.col("churn") == 1, F.col("prediction") == 1
    counts = predictions.groupBy(*(by or [])).agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(actual & ~predicted).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    share_1, share_0 = _ratio(tp + fn, n), _ratio(tn + fp, n)
    precision = share_1 * _ratio(tp, tp + fp) + share_0 * _ratio(tn, tn + fn)
    f1 = share_1 * _ratio(2 * tp, 2 * tp + fp + fn) + share_0 * _ratio(2 * tn, 2 * tn + fp + fn)
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, n),
            "f1_score": f1,
            "precision": precision,
            "recall": share_1 * _ratio(tp, tp + fn) + share_0 * _ratio(tn, tn + fp),
            "auc_hard": (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2.0,
        }
    )
