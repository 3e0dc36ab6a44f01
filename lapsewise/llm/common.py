"""Small helpers of the text models: hashed character n-grams, a linear SVM, bounded samples."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows per Arrow batch: whole texts may be long, so batches hold few of them.
BATCH_ROWS = 256
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


def small_batches(spark) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fold(doc_id: Column) -> Column:
    """0 to 4; rows of fold 0 are held out of every fit. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def hash_share(*columns: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the values and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def letters_only(text: str) -> str:
    """Lower case, every run of other characters one space, a space at both ends."""
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def ngram_buckets(text: str, sizes: tuple[int, ...], dims: int) -> np.ndarray:
    """Bucket of each character n-gram of the whole text; ``dims`` is a power of two."""
    codes = code_points(text)
    found = []
    for size in sizes:
        if len(codes) < size:
            continue
        value = np.full(len(codes) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            value = (value ^ codes[i : i + len(value)]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        found.append(value & np.uint64(dims - 1))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, dtype=np.int64)


def ngram_vector(text: str, sizes: tuple[int, ...], dims: int) -> np.ndarray:
    """Square roots of the bucket counts, scaled to length one."""
    counts = np.sqrt(np.bincount(ngram_buckets(text, sizes, dims), minlength=dims)).astype(np.float32)
    length = np.linalg.norm(counts)
    return counts / length if length else counts


def fit_linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 300) -> np.ndarray:
    """Weights (bias last) of a squared-hinge SVM with balanced classes, by accelerated descent."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    # Power iteration for the step size.
    v = np.ones(x.shape[1])
    for _ in range(20):
        v = x.T @ (share * (x @ v))
        v /= np.linalg.norm(v) or 1.0
    size = 1.0 / (1.0 / c / 100 + 2 * np.linalg.norm(x.T @ (share * (x @ v))) + 1e-9)
    w, z, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ z))
        step = z - size * (z / c / 100 - 2 * x.T @ (share * y * slack))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = step + (t - 1) / t_next * (step - w), step, t_next
    return w


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def bounded_sample(df: DataFrame, group: str, key: str, bound: int, seed: int) -> DataFrame:
    """About ``bound`` rows of each value of ``group`` (a column of few values) by the hash of ``key``."""
    sizes = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    share = F.lit(0.0)
    for value, size in sorted(sizes.items(), key=str):
        share = F.when(F.col(group).eqNullSafe(F.lit(value)), F.lit(min(1.0, bound / size))).otherwise(share)
    return df.where(hash_share(F.col(key), seed=seed) < share)
