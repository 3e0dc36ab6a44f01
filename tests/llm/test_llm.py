"""The numbered operators against brute force, on small tables with nulls, empty texts, ties and repeats."""

import collections
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lapsewise.llm import (
    bpe, catalog, dedup, html_text, language, licenses, mixing, neighbours, quality, secrets, toxicity,
)

TEXT = "doc_id long, text string"
LONG = " ".join(f"word{i % 97} other{i}" for i in range(4000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a repeated row, a long text, a column whose name may clash."""
    rows = [(1, None, "x"), (2, "", "x"), (3, "one two", None), (3, "one two", None), (4, LONG, "x"), (5, " \n\t", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans_note string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def test_neighbours_equal_brute_force_on_few_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).round(3)
    x[40:80] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (None, [1.0] * 8), (920, [0.0] * 8), (940, [float("nan")] * 8), (960, [1.0]), (980, [None] + [1.0] * 7)]
    table = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in sorted(neighbours.search(table).collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    assert sorted(found) == list(range(0, 300, 20))
    for q, got in found.items():
        scores = (x * x[q]).sum(axis=1)
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        assert [i for i, _ in got] == [i for _, i in want]
        assert np.allclose([s for _, s in got], [-s for s, _ in want], rtol=0, atol=1e-12)
    assert neighbours.search(table.where("false")).count() == 0
    assert neighbours.search(table.where("vec_id = 0").limit(1)).count() == 0


def brute_secrets(text):
    assign = re.compile(secrets.ASSIGN)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, text) if len(m[0]) >= 16])


def test_secret_rules_equal_brute_force_and_the_model_adds(spark, odd, none):
    texts = [
        "token=secret:abcdefghijklmnop", "é Password : 'abcDEF123456' AKIAABCDEFGHIJKLMN x", "api_key=short",
        "0123456789abcdef 0123456789abcde", "AKIAAKIAAKIAAKIA12 tokentoken = a=b=c=d=e=f=g",
        "see Zq8Xv2Lw9Tb4Rk7Yp1Gh5 in the_ordinary_function_name_of_it",
    ]
    train = ["secret=" + "".join(np.random.default_rng(i).choice(list(string.ascii_letters + string.digits), 40)) for i in range(300)]
    prose = ["the ordinary function name of it is read in an ordinary place of the function"] * 30
    docs = spark.createDataFrame(list(enumerate(texts + train + prose)), TEXT)
    got = {r.doc_id: r.spans for r in secrets.scan(docs, secrets.fit(docs)).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.rank, s.end) for s in got[i] if s.kind != "random"] == brute_secrets(t)
    assert [s.value for s in got[5]] == ["Zq8Xv2Lw9Tb4Rk7Yp1Gh5"]
    masked = secrets.scan(docs, None).select("doc_id", secrets.redact(F.col("text"), F.col("spans")).alias("t"))
    assert {r.doc_id: r.t for r in masked.collect()}[1] == "é <SECRET>' <SECRET> x"
    out = secrets.scan(odd, secrets.fit(odd))
    assert out.columns == [*odd.columns, "spans"] and out.count() == 6
    assert secrets.scan(none, secrets.fit(none)).count() == 0


def test_bpe_equals_merging_by_rank(spark, odd, none):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = catalog.default_vocabulary()
    ranks = {e: i for i, e in enumerate(bpe.read_ranks(path))}
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["Straße né  \n\n 12345 don't", "日本 <|endoftext|> 🙂", "a" * 300, "\x00﻿ x", LONG, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), TEXT).union(odd.select("doc_id", "text"))
    for r in bpe.decode(bpe.encode(docs, path, pattern), path, pattern).collect():
        assert r.ids == plain.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(none, path, pattern).count() == 0


def test_quality_rules(spark, odd, none):
    assert quality.text_rules("a b c a b c\n\na b c a b c\nx #$") == (14, 15, 2, 1, 12)
    labels = spark.createDataFrame([(3, 1), (4, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(odd, labels).collect()}
    assert got[1].n_words == got[2].n_words == 0 and got[1].base_failed and not got[1].kept
    assert quality.judge(none, labels).count() == 0


def test_license_figures_and_templates(spark, odd, none):
    filler = [(i, f"plain words number {i} with the and of") for i in range(50, 80)]
    texts = [
        (10, "MIT-License mit license x General Public LICENSE"), (11, "word " + licenses.TEMPLATES["bsd"].upper()),
        (12, " ".join(reversed(licenses.TEMPLATES["bsd"].split()))), (13, "the MİT license"),
    ]
    docs = spark.createDataFrame(texts + filler, TEXT)
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.build_index(docs)).collect()}
    assert (got[10].n_words, got[10].n_base, got[10].first_word, got[10].last_word) == (8, 3, 0, 5)
    assert sorted(got[10].base_labels) == ["gpl", "mit"]
    assert [t.template for t in got[11].templates] == ["bsd"] and got[12].templates == []
    assert got[13].n_base == 0
    assert licenses.scan(odd, licenses.build_index(odd)).count() == 6
    assert licenses.scan(none, licenses.build_index(none)).count() == 0


def test_html_main_text(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><a>Menu</a></nav><div class='ad'>Buy</div><div class='post-{0}'>"
        "<h1>Head &amp; tail</h1><p>One  <b>two\n</b>three {1}<br>four<ul><li>five<li>six</ul><!-- x --><script>'</p>'</script>"
        "<div class='comments'>Nice</div></div><footer>End</footer></body></html>"
    )
    rows = [(i, "http://a.b/x", page.format(i, "word " * 50)) for i in range(4)]
    rows += [(9, "http://a.b/y", page.format(9, "w")), (10, None, None), (11, "http://c/", ""), (12, "x", "plain <b>text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert got[9] == "Head & tail\nOne two three w\nfour\nfive\nsix"
    assert got[10] == got[11] == "" and got[12] == "plain text"
    assert html_text.main_text(pages.where("false")).count() == 0


def test_language_and_toxicity_hold_out(spark, odd, none):
    rng = np.random.default_rng(2)
    parts = {"en": ["the", "and", "ing", "th"], "de": ["der", "sch", "ein", "ich"], "fr": ["eau", "que", "les", "oui"]}
    rows = []
    for i in range(400):
        lang = sorted(parts)[i % 3]
        words = ["".join(rng.choice(parts[lang], 2)) for _ in range(40)]
        rows.append((i, " ".join(words + (["stup-id"] if i % 4 == 0 else [])), lang, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, TEXT + ", lang string, toxic int")
    out = language.predict(docs, language.fit(docs)).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    scored = toxicity.score(docs.select("doc_id", "text", F.col("toxic").alias("real")), toxicity.fit(docs, docs)).collect()
    assert np.mean([(r.toxic_score >= 0.5) == (r.real == 1) for r in scored]) > 0.97
    for r in language.predict(odd, None).collect():
        assert (r.lang_pred, r.score) == ("und", 0.0)
    labels = docs.select("doc_id", "toxic")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert {r.toxic_score for r in toxicity.score(odd, None).collect()} == {0.0}


def test_registers_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    bags, real = [], []
    for _ in range(20):
        v = np.unique(rng.integers(1, 2**62, 40).astype(np.uint64))
        a = rng.integers(1, 9, len(v))
        b = np.where(rng.random(len(v)) < 0.7, a, rng.integers(1, 9, len(v)))
        bags += [(v, a), (v, b)]
        real.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    found = dedup.signatures(bags, 512)
    errors = np.array([(found[2 * i] == found[2 * i + 1]).mean() for i in range(20)]) - real
    assert abs(errors.mean()) < 0.02 and np.abs(errors).max() < 0.1


def brute_classes(texts):
    bags = {k: collections.Counter(dedup.shingle_hashes(t or "").tolist()) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in bags:
        for b in bags:
            if a < b and bags[a] and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in texts}


def test_classes_equal_brute_force(spark, odd, none):
    rng = np.random.default_rng(5)
    texts = {1: None, 2: "", 3: "one two", 4: "one  two", 5: " "}
    for group in range(12):
        words = [f"g{group}w{i}" for i in range(int(rng.integers(60, 200)))]
        for _ in range(6):
            texts[len(texts) + 1] = " ".join(words)
            for at in rng.integers(0, len(words), 1):
                words[at] = f"n{rng.integers(1 << 30)}"
    docs = spark.createDataFrame([*texts.items(), (3, "one two"), (None, "x y")], TEXT)
    got = {r.doc_id: r.class_id for r in dedup.classes(docs).collect()}
    assert got == brute_classes(texts)
    assert dedup.classes(none).count() == 0


def test_budgets_go_to_siblings_before_ancestors():
    leaves = {("a", "x"): 10.0, ("a", "y"): 100.0, ("b", "z"): 100.0}
    out = mixing.leaf_budgets(leaves, {}, 100.0)
    assert out == {("a", "x"): 10.0, ("a", "y"): 40.0, ("b", "z"): 50.0}
    out = mixing.leaf_budgets(leaves, {}, 180.0)
    assert out == {("a", "x"): 10.0, ("a", "y"): 80.0, ("b", "z"): 90.0}


def test_mix_takes_token_prefixes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE_ROWS", 16)
    rows = [(i, f"d{i % 2}", None if i % 5 == 0 else "en", f"s{i % 3}", 1 + i % 7) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n_tokens long")
    taken = mixing.select(docs, {("d0",): 2.0}, share=0.7, epochs=2).collect()
    sums, budgets = collections.Counter(), {}
    for r in taken:
        leaf = (r.domain, r.lang, r.source)
        sums[leaf] += r.n_tokens
        budgets[leaf] = r.leaf_budget
    # No leaf passes its budget, and none stops more than one row short of it.
    assert all(0 <= budgets[leaf] - n < 7 for leaf, n in sums.items())
    assert len({(r.doc_id, r.epoch) for r in taken}) == len(taken)
    assert mixing.select(docs.where("false"), {}, share=0.7).count() == 0


def test_pipeline_keeps_columns_and_takes_decisions(spark, tmp_path):
    words = [" ".join(f"t{i}w{j}" for j in range(60)) for i in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(words)]
    rows += [(100, words[0], "en", "s", 1), (101, words[1] + " password=abcdef0123456789", "en", "s", 1), (102, None, None, None, None)]
    rows[2] = (2, words[2] + " token=0123456789abcdef0123", "en", "s", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not {100, 101} & set(out) and 0.8 * 41 < len(out)
    masked = {r.doc_id: r for r in corpus_pipeline.mask_secrets(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), "").collect()}
    assert masked[2].text == words[2] + " <SECRET>" and masked[2].n_chars == len(masked[2].text)
