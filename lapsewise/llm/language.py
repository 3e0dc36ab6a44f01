"""Language identification in two steps: the family, then one-versus-one linear SVMs within it.

Null texts and texts without a letter give ``und`` and score 0. Equal votes go to the name first
in the alphabet. Repeated rows get equal answers. An empty training table gives ``und`` everywhere.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm import common

SIZES, DIMS = (1, 2, 3), 2048
#: Family of each language code; codes not listed form the family "other".
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "uk", "pl", "cs", "bg", "sr"],
}
#: Training rows per language, at most about so many.
TRAIN_ROWS = 1000


def family(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), "other")


class OneVersusOne:
    """A linear SVM for each pair of classes; most votes win."""

    def __init__(self, x: np.ndarray, names: np.ndarray):
        self.names = sorted(set(names))
        self.pairs, weights = list(combinations(range(len(self.names)), 2)), []
        for a, b in self.pairs:
            first, second = names == self.names[a], names == self.names[b]
            rows = first | second
            weights.append(common.fit_linear_svm(x[rows], np.where(first[rows], 1.0, -1.0)))
        self.weights = np.array(weights)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Winner and how sure its closest pair is."""
        if not self.pairs:
            return self.names[0], 1.0
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        votes = np.zeros(len(self.names))
        for (a, b), margin in zip(self.pairs, margins):
            votes[a if margin >= 0 else b] += 1
        best = int(np.argmax(votes))
        own = [m if a == best else -m for (a, b), m in zip(self.pairs, margins) if best in (a, b)]
        return self.names[best], float(common.sigmoid(3 * min(own)))


def fit(docs: DataFrame, rows_per_language: int = TRAIN_ROWS, seed: int = 7):
    """(family model, language model of each family), from about ``rows_per_language`` texts each."""
    common.small_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (common.fold(F.col("doc_id")) != 0))
    sample = common.bounded_sample(known, "lang", "doc_id", rows_per_language, seed).select("lang", "text")

    def vectors(batches):
        for batch in batches:
            kept = [(g, common.letters_only(t)) for g, t in zip(batch["lang"], batch["text"]) if common.has_letter(t)]
            yield pd.DataFrame({
                "lang": [g for g, _ in kept],
                "x": [common.ngram_vector(t, SIZES, DIMS).tobytes() for _, t in kept],
            })

    rows = sample.mapInPandas(vectors, "lang string, x binary").collect()
    if not rows:
        return None
    rows.sort()
    x = np.array([np.frombuffer(r.x, dtype=np.float32) for r in rows])
    names = np.array([r.lang for r in rows], dtype=object)
    families = np.array([family(n) for n in names], dtype=object)
    return (
        OneVersusOne(x, families),
        {f: OneVersusOne(x[families == f], names[families == f]) for f in sorted(set(families))},
    )


def predict(docs: DataFrame, model) -> DataFrame:
    """``docs`` with lang_pred and score, from the text alone."""
    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            if model is None or not text or not common.has_letter(text):
                out.append(("und", 0.0))
                continue
            x = common.ngram_vector(common.letters_only(text), SIZES, DIMS)
            top, within = model
            name, sure = top.predict(x)
            lang, closer = within[name].predict(x)
            out.append((lang, sure * closer))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.withColumn("_p", run("text")).select(*[F.col(c) for c in docs.columns], "_p.lang_pred", "_p.score")
