"""Mixing does not depend on its pieces, digests equal encoding and decoding, toxicity finds disguised insults."""

import hashlib
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import bpe, catalog, common, mixing, quality, toxicity

DATA = "/root/testdata"


def test_the_mix_does_not_depend_on_the_size_of_its_pieces(spark, monkeypatch):
    rows = [(i % 5000, "en", f"s{i % 2}", "d", 1 + i % 7) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, domain string, n_tokens long")
    taken = []
    for size in (97, 1024, 1 << 20):
        monkeypatch.setattr(mixing, "PIECE_ROWS", size)
        found = mixing.select(docs.repartition(size % 7 + 1), {}, share=0.5, epochs=2)
        taken.append(sorted(tuple(r) for r in found.select("doc_id", "lang", "source", "n_tokens", "epoch").collect()))
    assert taken[0] == taken[1] == taken[2] and 0 < len(taken[0]) < 12_000


def test_the_mix_is_a_prefix_of_the_hash_order(spark):
    rows = [(i, "en", "s", "d", 1 + i % 3) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, domain string, n_tokens long")
    order = F.shiftrightunsigned(F.xxhash64(F.lit(17), F.lit(0), "doc_id", "n_tokens"), 1)
    ordered = docs.orderBy(order).collect()
    budget, want, used = sum(r[4] for r in rows) // 2, [], 0
    for r in ordered:
        used += r.n_tokens
        if used <= budget:
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in mixing.select(docs, {}, share=0.5).collect()) == sorted(want)


def test_digests_equal_encoding_and_decoding(spark):
    path, pattern = catalog.default_vocabulary()
    texts = [None, "", " \n\t", "Hello wörld, it's 12345!", "a" * 5000, "𝒳 日本語 <|endoftext|>", "x y " * 3000]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, digests string")
    both = bpe.decode(bpe.encode(docs, path, pattern), path, pattern).orderBy("doc_id").collect()
    found = bpe.digests(docs, path, pattern).orderBy("doc_id").collect()
    for a, b in zip(both, found, strict=True):
        assert b.digests.n_tokens == len(a.ids)
        assert b.digests.ids_sha256 == hashlib.sha256(",".join(map(str, a.ids)).encode()).hexdigest()
        assert b.digests.decoded_sha256 == hashlib.sha256((texts[a.doc_id] or "").encode()).hexdigest()
    assert bpe.digests(docs.where("false"), path, pattern).count() == 0


def test_trusted_rows_are_bounded_and_counted_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "abc abd" if i < 6 else "xyz") for i in range(9)] + [(None, "q")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in (0, 0, 1, 2, 7)] + [(None, 1), (8, 0)], "doc_id long, quality int")
    counts = quality.count_ngrams(docs, labels)
    grams = lambda t: len(common.ngram_buckets(t, quality.SIZES, quality.DIMS))
    assert counts[0].sum() == 6 * grams("abc abd") + 3 * grams("xyz") + grams("q")
    assert counts[1].sum() == 3 * grams("abc abd") + grams("xyz")
    monkeypatch.setattr(quality, "TRUSTED_ROWS", 1)
    assert quality.count_ngrams(docs, labels)[1].sum() in (grams("abc abd"), grams("xyz"))


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    return docs, spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")


def test_toxicity_on_held_out_rows(spark, labelled):
    """Recall is bounded by the few labelled texts of the smaller languages here; see README for larger tables."""
    docs, labels = labelled
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model).where(common.fold(F.col("doc_id")) == 0)
    rows = scored.join(labels, "doc_id").where("toxic in (0, 1)").select("toxic", "toxic_score").collect()
    called = {y: np.mean([r.toxic_score >= 0.5 for r in rows if r.toxic == y]) for y in (0, 1)}
    assert called[1] > 0.7 and called[0] < 0.1
    clean = "It was a fine morning and the river ran past the old mill."
    tests = [clean, f"{clean} You idiot.", f"{clean} You i.d.i.o.t there.", f"{clean} You idiiot there.", "", None, "you id-iot"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "doc_id long, text string")
    score = [r.toxic_score for r in toxicity.score(frame, model).orderBy("doc_id").collect()]
    assert all(s >= 0.5 for s in (score[1], score[2], score[3], score[6]))
    assert all(s < 0.5 for s in (score[0], score[4], score[5]))


def test_group_counts_are_added_up_once_per_group_number(spark):
    from lapsewise.llm import divergence

    rows = [(0, bytearray(b"65:"), bytearray(b"One two two")), (1, bytearray(b"65:"), bytearray(b"two x")), (0, bytearray(b"66:"), bytearray(b"one"))]
    docs = spark.createDataFrame(rows, "place long, tag binary, data binary").repartition(3)
    counts, _ = divergence.group_counts(docs, b"65:one\n65:two\n66:none", 0)
    assert sorted(map(tuple, counts.select("place", "no", "n").collect())) == [(0, 0, 1), (0, 1, 2), (1, 1, 1)]


def test_kernel_values_do_not_depend_on_the_words_beside():
    import numpy as np

    from lapsewise.llm import toxicity

    words = [f"{a}{b}word{a}" for a in "abcdefghij" for b in "klmnopqrstuvwxyz"] + ["zzz"]
    index = toxicity.Landmarks(["wordless", "swordfish", "abide"])
    whole = index.kernel(words)
    assert len(words) > toxicity.WORDS_AT_ONCE and whole.shape == (161, 3)
    assert np.array_equal(whole, np.vstack([index.kernel([w]) for w in words]))


def test_the_fit_of_sentences_holds_little_beside_its_vectors():
    rng = np.random.default_rng(2)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(rng.choice(letters, 7)) for _ in range(1500)]
    rows = [sorted(set(rng.choice(words, 30))) for _ in range(6000)]
    y = np.where(np.arange(6000) % 2, 1.0, -1.0)
    tracemalloc.start()
    try:
        chosen, _, _ = toxicity.fit_sentences(rows, y, np.arange(6000))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # The vectors take 4 bytes for each sentence and landmark; kernels of a part of the words come on top.
    assert peak < 4 * len(rows) * len(chosen) * 4 + 60e6


def test_the_driver_does_not_hold_the_vectors_of_the_sentences(spark, monkeypatch):
    from pyspark import TaskContext

    fit_sentences = toxicity.fit_sentences

    def in_a_task(*given):
        assert TaskContext.get() is not None
        return fit_sentences(*given)

    monkeypatch.setattr(toxicity, "fit_sentences", in_a_task)
    rows = [(i, f"you rotten idiot number{i}" if i % 2 else f"a kind friendly letter number{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    words, alpha, bias, limit = toxicity.fit(docs, labels)
    assert len(words) == len(alpha) and "idiot" in words
    scored = toxicity.score(docs, (words, alpha, bias, limit)).collect()
    assert all((r.toxic_score >= 0.5) == (r.doc_id % 2 == 1) for r in scored)
    # One label alone gives no model.
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None


def test_words_that_came_again_are_weighed_once(monkeypatch):
    weighed, subsequences = [], toxicity.subsequences
    monkeypatch.setattr(toxicity, "subsequences", lambda words: (weighed.extend(words), subsequences(words))[1])
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 60)
    landmarks, alpha = ["wordless", "swordfish", "abide"], np.array([0.5, -1.0, 2.0])
    weights, common = toxicity.WordWeights(landmarks, alpha), [f"sword{a}ide" for a in "abcdefgh"]
    kernel = toxicity.Landmarks(landmarks).kernel
    weighed.clear()
    for i in range(40):
        words = {*common, *(f"word{chr(97 + i % 26)}{i}{b}" for b in "abcdefghij")}
        known = weights.of(words)
        assert words <= known.keys() and len(known) <= 60
    assert all(weighed.count(word) == 1 for word in common) and len(weighed) == 8 + 400
    assert np.allclose([known[w] for w in sorted(words)], kernel(sorted(words)) @ alpha, rtol=1e-12, atol=1e-12)
