"""Toxicity by a subsequence string-kernel SVM with Nystrom landmarks, trained on labelled sentences.

The kernel of two words sums, over common subsequences of three letters within ``SPAN``, a decay for
each letter passed over, so gaps and inserted characters cost little; it is scaled to length one and raised
to ``POWER``, which keeps apart words that merely share a stem. The kernel of two sentences adds
up the kernels of their words. Landmark words taken from sentences of both labels turn a sentence
into a vector (Nystrom), and a linear SVM separates the sentences of toxic texts from those of clean
ones. A toxic text also has harmless sentences: after the first fit those that look clean no longer
count as toxic, but each text keeps its worst one. Equal sentences count once, so copies weigh nothing extra, and a
sentence that also stands in a clean text is clean.

The SVM then folds into one weight per word, a sentence scores the sum over its distinct words, a text that of its most toxic
sentence. The limit is set on texts that no weight has seen. Null, empty and wordless texts score
below 0.5. Equal texts score alike. Texts of any length are read whole. A training table without one of the two labels
gives no model and scores of 0; an empty table gives an empty table. An input column with the output's name is replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm import common

SPAN, DECAY, WIDTH, POWER = 5, 0.6, 20, 3
BITS = 20
LANDMARKS = 900
#: Standard errors by which a word's share of toxic sentences must exceed that of clean ones to mark toxicity.
LEAST_APART = 3.0
#: Weight of the errors against that of the SVM's length.
SLACK, STEPS = 1000.0, 300
#: Labelled rows used to fit, at most, of each label; of these a share sets the limit only.
TRAIN_ROWS, LIMIT_SHARE = 4000, 4
#: Training sentences, at most, of each label, and words of a sentence (longer ones are cut into several).
TRAIN_SENTENCES, SENTENCE_WORDS = 12_000, 40
ROUNDS = 3
#: Words whose kernel values are added up together.
WORDS_AT_ONCE = 128
#: Places of words in sentences whose vectors are added up together.
PLACES_AT_ONCE = 4096
#: Words whose weights a worker remembers, at most.
KNOWN_WORDS = 400_000
_INNER = re.compile(r"[\W\d_]+")
# A mark ends a sentence only before a space: letters with a mark after each (i.d.i.o.t) are one word.
_ENDS = re.compile(r"[.!?]+\s+|\n+")
_known: dict[int, WordWeights] = {}


def words_of(sentence: str) -> list[str]:
    """Lower-case words without inner marks; letters standing alone in a row form one word."""
    found = [token if token.isalpha() else _INNER.sub("", token) for token in sentence.lower().split()]
    if 1 not in map(len, found):
        return [word for word in found if len(word) > 2]
    out: list[str] = []
    single: list[str] = []
    for word in found:
        if len(word) == 1:
            single.append(word)
            continue
        if single:
            if len(single) > 2:
                out.append("".join(single))
            single = []
        if len(word) > 2:
            out.append(word)
    if len(single) > 2:
        out.append("".join(single))
    return out


def sentences(text: str | None) -> list[list[str]]:
    """Distinct words of each sentence, sorted; words beyond ``SENTENCE_WORDS`` form further sentences."""
    out = []
    for part in _ENDS.split(text or ""):
        words = words_of(part)
        for i in range(0, len(words), SENTENCE_WORDS):
            some = words[i : i + SENTENCE_WORDS]
            if max(map(len, some)) > WIDTH:
                some = [p for w in some for p in pieces(w)]
            out.append(sorted(set(some)))
    return out


def pieces(word: str) -> list[str]:
    """Words longer than ``WIDTH`` as overlapping pieces."""
    if len(word) <= WIDTH:
        return [word]
    return [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and weight of each gapped three-letter subsequence, one row per word of length <= WIDTH."""
    codes = np.zeros((len(words), WIDTH + SPAN), dtype=np.uint64)
    for i, word in enumerate(words):
        codes[i, : len(word)] = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    buckets, weights = [], []
    for b in range(2, SPAN + 1):
        for a in range(1, b):
            x, y, z = codes[:, :WIDTH], codes[:, a : a + WIDTH], codes[:, b : b + WIDTH]
            h = ((x * np.uint64(0x9E3779B1) + y) * np.uint64(0x85EBCA77) + z) * np.uint64(0xC2B2AE3D27D4EB4F)
            buckets.append((h >> np.uint64(64 - BITS)).astype(np.int32))
            weights.append(np.where(z > 0, np.float32(DECAY ** (b - 2)), np.float32(0)))
    buckets, weights = np.concatenate(buckets, axis=1), np.concatenate(weights, axis=1)
    return buckets, weights


class Landmarks:
    """Landmark words, indexed by the subsequences they hold."""

    def __init__(self, words: list[str]):
        buckets, weights = subsequences(words)
        owner = np.repeat(np.arange(len(words)), buckets.shape[1])
        used = weights.ravel() > 0
        keys, at = np.unique(buckets.ravel()[used].astype(np.int64) * len(words) + owner[used], return_inverse=True)
        sums = np.bincount(at, weights=weights.ravel()[used])
        self.words, self.owner, self.weight = words, keys % len(words), sums
        self.norm = np.sqrt(np.maximum(np.bincount(self.owner, weights=sums**2, minlength=len(words)), 1e-12))
        self.first = np.searchsorted(keys // len(words), np.arange((1 << BITS) + 1)).astype(np.int32)

    def overlaps(self, words: list[str]):
        """A few words at a time, their first and last number: sums over the subsequences shared with each landmark,
        and the words' own lengths."""
        buckets, weights = subsequences(words)
        used = np.flatnonzero(weights.ravel() > 0)
        row, bucket = used // buckets.shape[1], buckets.ravel()[used].astype(np.int64)
        # A subsequence that stands in a word several times counts with its summed weight.
        keys, at = np.unique((row << BITS) | bucket, return_inverse=True)
        sums = np.bincount(at, weights=weights.ravel()[used])
        row, bucket = keys >> BITS, keys & ((1 << BITS) - 1)
        norm = np.sqrt(np.maximum(np.bincount(row, weights=sums**2, minlength=len(words)), 1e-12))
        size = len(self.words)
        width = self.first[bucket + 1] - self.first[bucket]
        start = self.first[bucket].astype(np.int64)
        # A few words at a time: what is spread out then stays in the processor's cache.
        for i in range(0, len(words), WORDS_AT_ONCE):
            n = min(WORDS_AT_ONCE, len(words) - i)
            a, b = np.searchsorted(row, [i, i + n])
            of = width[a:b]
            place = np.repeat(start[a:b] - (np.cumsum(of) - of), of)
            place += np.arange(len(place))
            value = np.repeat(sums[a:b], of) * self.weight[place]
            at = np.repeat((row[a:b] - i) * size, of)
            at += self.owner[place]
            # Without entries numpy counts in whole numbers.
            part = np.bincount(at, weights=value, minlength=n * size).astype(np.float64, copy=False).reshape(n, size)
            yield i, i + n, part, norm[i : i + n]

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel values of words against the landmarks, between 0 and 1."""
        out = np.empty((len(words), len(self.words)))
        for i, j, part, norm in self.overlaps(words):
            part /= norm[:, None]
            part /= self.norm
            # Few words share subsequences with a landmark, and powers are dear.
            alike = part != 0
            part[alike] = part[alike] ** POWER
            out[i:j] = part
        return out

    def weigh(self, words: list[str], alpha: np.ndarray) -> np.ndarray:
        """Kernel values times ``alpha``, summed over the landmarks; lengths are divided out before and after."""
        out, scaled = np.empty(len(words)), alpha / self.norm**POWER
        for i, j, part, norm in self.overlaps(words):
            power = part.copy()
            for _ in range(POWER - 1):
                power *= part
            out[i:j] = power @ scaled / norm**POWER
        return out


def choose_landmarks(rows: list[list[str]], y: np.ndarray) -> list[str]:
    """Words that most set toxic sentences apart, the commonest words, and the clean words most like the first."""
    bad, good = Counter(), Counter()
    for words, label in zip(rows, y):
        (bad if label > 0 else good).update(words)
    n_bad, n_good = max(1, int((y > 0).sum())), max(1, int((y < 0).sum()))
    every = sorted(set(bad) | set(good))
    b, g = (np.array([c[w] for w in every], dtype=np.float64) for c in (bad, good))
    share = (b + g) / (n_bad + n_good)
    apart = (b / n_bad - g / n_good) / np.sqrt(share * (1 - share) * (1 / n_bad + 1 / n_good) + 1e-12)
    third = LANDMARKS // 3
    marked = [every[i] for i in np.argsort(-apart, kind="stable")[:third] if apart[i] > LEAST_APART]
    chosen = dict.fromkeys(marked + [every[i] for i in np.argsort(-(b + g), kind="stable")[:third]])
    clean = [w for w, n in zip(every, g) if n > 0 and w not in chosen]
    if marked and clean:
        near, index = np.zeros(len(clean)), Landmarks(marked)
        for i in range(0, len(clean), 4096):
            near[i : i + 4096] = index.kernel(clean[i : i + 4096]).max(axis=1)
        chosen |= dict.fromkeys(clean[i] for i in np.argsort(-near, kind="stable")[:third])
    return list(chosen)


class WordWeights:
    """Weights of words; of those remembered, the ones that came again stay when there are too many."""

    def __init__(self, landmarks: list[str], alpha: np.ndarray):
        self.index, self.alpha = Landmarks(landmarks), alpha
        self.known: dict[str, float] = {}
        self.again: set[str] = set()

    def of(self, words: set[str]) -> dict[str, float]:
        new = words.difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:
            stay = self.again if 4 * len(self.again) < 3 * KNOWN_WORDS else ()
            self.known, self.again = {w: self.known[w] for w in stay}, set()
            new = words.difference(self.known)
        self.again |= words - new
        ordered = sorted(new)
        for i in range(0, len(ordered), 2048):
            some = ordered[i : i + 2048]
            self.known.update(zip(some, self.index.weigh(some, self.alpha).tolist()))
        return self.known


def fit_sentences(rows: list[list[str]], y: np.ndarray, text: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Landmark words, their weights and the bias from sentences (distinct words), labels +-1 and text numbers."""
    index = Landmarks(choose_landmarks(rows, y))
    among = index.kernel(index.words)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    place: dict[str, int] = {}
    flat = np.array([place.setdefault(w, len(place)) for words in rows for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(words) for words in rows])
    every, x = list(place), np.zeros((len(rows), root.shape[1]), dtype=np.float32)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i in range(0, len(every), 2048):
        part = (index.kernel(every[i : i + 2048]) @ root).astype(np.float32)
        a, b = np.searchsorted(flat, [i, i + 2048])
        # The commonest words come first and stand in most sentences: their rows are added a few at a time.
        for j in range(a, b, PLACES_AT_ONCE):
            k = min(j + PLACES_AT_ONCE, b)
            np.add.at(x, owner[j:k], part[flat[j:k] - i])
    used = np.ones(len(rows), dtype=bool)
    for _ in range(ROUNDS):
        w = fit_svm(x, y, used)
        # A part at a time: numpy copies what it multiplies into doubles.
        margin = np.concatenate([x[i : i + 2048] @ w[:-1] for i in range(0, len(x), 2048)]) + w[-1]
        worst = np.full(int(text.max(initial=0)) + 1, -np.inf)
        np.maximum.at(worst, text[y > 0], margin[y > 0])
        used = (y < 0) | (margin > 0) | (margin >= worst[text])
    return index.words, root @ w[:-1], float(w[-1])


def fit_svm(x: np.ndarray, y: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a squared-hinge SVM on the used rows, classes balanced, by accelerated descent; ``x`` is
    not copied."""
    y = y.astype(np.float32)
    share = np.where(y > 0, 0.5 / max(1, (used & (y > 0)).sum()), 0.5 / max(1, (used & (y < 0)).sum())) * used
    share, ridge = share.astype(np.float32), 1.0 / SLACK / 100

    def both(r):
        return np.append(x.T @ r, r.sum())

    v = np.ones(x.shape[1] + 1, dtype=np.float32)
    for _ in range(20):
        v = both(share * (x @ v[:-1] + v[-1]))
        v /= np.linalg.norm(v) or 1.0
    size = 1.0 / (ridge + 2 * np.linalg.norm(both(share * (x @ v[:-1] + v[-1]))) + 1e-9)
    w = z = np.zeros_like(v)
    t = 1.0
    for _ in range(STEPS):
        slack = np.maximum(0.0, 1.0 - y * (x @ z[:-1] + z[-1]))
        step = (z - size * (z * ridge - 2 * both(share * y * slack))).astype(np.float32)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = (step + (t - 1) / t_next * (step - w)).astype(np.float32), step, t_next
    return w.astype(np.float64)


def text_margins(texts, weights: WordWeights, bias: float) -> list[float]:
    """Largest sentence margin of each text, -3 without words."""
    found = [sentences(t) for t in texts]
    weight = weights.of(set().union(*(words for rows in found for words in rows))).__getitem__
    return [max((sum(map(weight, words)) for words in rows), default=-3.0 - bias) + bias for rows in found]


def labelled_texts(docs: DataFrame, labels: DataFrame, rows_per_label: int, seed: int) -> DataFrame:
    """(y, share, text): equal texts once, at most ``rows_per_label`` of each label, by the hash of the text."""
    given = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (common.fold(F.col("doc_id")) != 0))
    given = given.groupBy("doc_id").agg(F.max("toxic").alias("y"))
    sample = common.bounded_sample(given, "y", "doc_id", 2 * rows_per_label, seed)  # bounded
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest")).agg(
        F.max("y").alias("y"), F.first("text").alias("text")
    )
    place = F.row_number().over(Window.partitionBy("y").orderBy("digest"))
    few = texts.withColumn("_place", place).where(F.col("_place") <= rows_per_label)
    return few.select("y", (F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % LIMIT_SHARE).alias("share"), "digest", "text")


def fit(docs: DataFrame, labels: DataFrame, rows_per_label: int = TRAIN_ROWS, seed: int = 5):
    """(landmark words, weights, bias, limit); None if one of the labels is missing."""
    common.small_batches(docs.sparkSession)
    given = labelled_texts(docs, labels, rows_per_label, seed).persist()

    def spread(batches):
        for batch in batches:
            rows = [(s, d, int(y)) for t, d, y in zip(batch["text"], batch["digest"], batch["y"]) for s in map(" ".join, sentences(t))]
            yield pd.DataFrame(rows, columns=["sentence", "digest", "y"])

    # In a task: the vectors of the sentences are several times what the driver needs otherwise.
    def learn(batches):
        told = pd.concat([pd.DataFrame(columns=["y", "_place"]), *batches]).sort_values(["y", "_place"])
        if told["y"].nunique() < 2:
            return
        y = np.where(told["y"] > 0, 1.0, -1.0)
        words, alpha, bias = fit_sentences([s.split(" ") for s in told["sentence"]], y, pd.factorize(told["digest"])[0])
        yield pd.DataFrame({"words": [words], "alpha": [alpha], "bias": [bias]})

    try:
        told = given.where("share > 0").mapInPandas(spread, "sentence string, digest string, y int").where("sentence <> ''")
        told = told.groupBy("sentence").agg(F.min("y").alias("y"), F.min("digest").alias("digest"))
        place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("sentence"), "sentence"))
        told = told.withColumn("_place", place).where(F.col("_place") <= TRAIN_SENTENCES).repartition(1)  # bounded
        found = told.mapInPandas(learn, "words array<string>, alpha array<double>, bias double").first()
        if found is None:
            return None
        model = list(found.words), np.array(found.alpha), found.bias
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def margins(batches):
            words, alpha, bias = shared.value
            weights = WordWeights(words, alpha)
            for batch in batches:
                yield pd.DataFrame({"m": text_margins(batch["text"], weights, bias), "y": batch["y"]})

        unseen = given.where("share = 0")
        held = [tuple(r) for r in unseen.mapInPandas(margins, "m double, y int").collect()]  # bounded
    finally:
        given.unpersist()
    seen = np.array(held or [(0.0, 0.0)])
    return *model, best_cut(seen[:, 0], seen[:, 1]) if len(set(seen[:, 1])) == 2 else 0.0


def best_cut(margins: np.ndarray, y: np.ndarray) -> float:
    """Cut between margins with the best balanced accuracy, in the middle of its gap."""
    order = np.argsort(margins, kind="stable")
    m, y = margins[order], y[order]
    below_bad = np.concatenate([[0], np.cumsum(y)]) / max(1, y.sum())
    below_good = np.concatenate([[0], np.cumsum(1 - y)]) / max(1, (1 - y).sum())
    edges = np.concatenate([[True], m[1:] > m[:-1], [True]])
    best = int(np.argmax(np.where(edges, below_good - below_bad, -9)))
    low, high = (m[best - 1] if best else m[0] - 1), (m[best] if best < len(m) else m[-1] + 1)
    return float((low + high) / 2)


def score(docs: DataFrame, model, text: str = "text", out: str = "toxic_score") -> DataFrame:
    """``docs`` with a score in 0..1, 0.5 at the limit; without a model every score is 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        if shared.value is None:
            return pd.Series([0.0] * len(texts))
        words, alpha, bias, limit = shared.value
        key = hash((tuple(words), alpha.tobytes()))
        if key not in _known:
            _known.clear()
            _known[key] = WordWeights(words, alpha)
        margins = np.array(text_margins(texts, _known[key], bias))
        return pd.Series(common.sigmoid(4 * (margins - limit)))

    return docs.withColumn(out, run(F.col(text)))
