"""Ids that stand on rows with different texts."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lapsewise.llm import dedup

A, B, C, D = (" ".join(f"{name}{i}" for i in range(40)) for name in "abcd")


def test_a_reused_id_does_not_tie_texts_together_and_loses_none(spark, monkeypatch):
    rows = [(2, A), (5, A), (5, B), (9, B), (11, C), (11, D), (11, D)]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    ).coalesce(1)
    found = dedup.classes(docs).collect()
    classes = {r.doc_id: r.class_id for r in found}
    assert sorted(classes) == [2, 5, 9, 11] and len(found) == 4
    # Every class holds its own smallest id, and texts that differ stay apart.
    assert all(classes[c] == c for c in classes.values()) and classes[2] != classes[9]
    again = spark.createDataFrame(found)
    monkeypatch.setattr(dedup, "classes", lambda docs: again)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.text for r in kept) == [A, B, C, D]


def test_the_items_of_all_texts_are_not_moved_to_compare_a_few(spark):
    sketches = spark.range(50).selectExpr("id as rep", "array(id, id + 1) as items")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = dedup.write_bucketed(sketches, "sketches-test", "rep")
        found = dedup.verified(pairs, held, 0.3)
        assert [tuple(r) for r in found.collect()] == [(1, 2)]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.split("\n") if "FileScan" in line and "items" in line]
    assert scans and all("Bucketed: true" in line for line in scans)


def test_texts_of_ids_with_several_texts_and_without_words(spark):
    rows = [(1, " "), (2, None), (3, A + "  "), (3, A), (4, " " + A), (5, B), (5, C), (6, C), (7, B), (None, A)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in dedup.classes(docs).collect())
    of_five = min((B, 7), (C, 6), key=lambda p: __import__("hashlib").sha256(p[0].encode()).hexdigest())[1]
    classes = {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7} | {of_five: 5}
    assert got == sorted(classes.items())


def test_items_move_only_for_pairs_that_may_be_alike(spark, monkeypatch):
    # Ten pairs of texts that share about 60 % of their shingles, so that most share a band, and one pair alike.
    texts = {}
    for n in range(10):
        words = [f"w{n}x{i}" for i in range(400)]
        texts[2 * n], texts[2 * n + 1] = words, words[:300] + [f"z{n}x{i}" for i in range(100)]
    texts[100], texts[101] = (words := [f"v{i}" for i in range(400)]), [*words[:390], *"abcdefghij"]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in texts.items()], "doc_id long, text string")
    compared, verified = [], dedup.verified

    def watched(pairs, *rest):
        compared.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return verified(pairs, *rest)

    monkeypatch.setattr(dedup, "verified", watched)
    classes = {r.doc_id: r.class_id for r in dedup.classes(docs).collect()}
    assert compared == [(100, 101)]
    assert classes == {i: i for i in texts} | {101: 100}


def test_parities_never_tell_less_than_the_similarity(spark):
    rng = np.random.default_rng(3)
    rows = []
    for shared, a, b in [(0, 1, 1), (1, 0, 0), (40, 5, 5), (4000, 500, 500), (9000, 900, 1200), (5, 3000, 4), (300, 40, 60)]:
        found = rng.integers(-(2**63), 2**63, shared + a + b)
        left, right = found[: shared + a], np.concatenate([found[:shared], found[shared + a :]])
        rows.append((shared / (shared + a + b), *(dedup.parities(side).tolist() for side in (left, right))))
    frame = spark.createDataFrame(rows, "similarity double, a array<long>, b array<long>")
    told = frame.select("similarity", dedup.most_alike(F.col("a"), F.col("b")).alias("most")).collect()
    assert all(r.most >= r.similarity for r in told)
    assert told[0].most < 0.1 and told[1].most == 1.0 and told[6].most < 0.8


def test_large_buckets_make_no_row_per_pair_and_lose_none(spark, monkeypatch):
    monkeypatch.setattr(dedup, "JOINED", 4)
    monkeypatch.setattr(dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 900)
    # Texts that share most of one base with each other; components of one to three texts.
    own = {i: i % 9 * 15 for i in range(70)}
    held = {i: dedup.parities(np.concatenate([base[: 900 - n], rng.integers(-(2**63), 2**63, n)])) for i, n in own.items()}
    comps = {i: i - i % (1 + i % 3) for i in held}
    placed = [(i, 0, h, comps[i], n) for h, n, ids in ((7, 70, range(70)), (8, 4, range(4)), (9, 5, range(60, 65))) for i in ids]
    placed = spark.createDataFrame(placed, "rep long, band int, hash long, comp long, texts long")
    sketches = spark.createDataFrame([(i, p.tolist()) for i, p in held.items()], "rep long, parities array<long>")
    near = dedup._near_open(placed, sketches, 0.8)
    pair = sketches.alias("x").crossJoin(sketches.alias("y")).where("x.rep < y.rep")
    alike = pair.where(dedup.most_alike(F.col("x.parities"), F.col("y.parities")) >= 0.8).select("x.rep", "y.rep").collect()
    found = [tuple(r) for r in near.collect()]
    assert sorted(found) == sorted((a, b) for a, b in alike if comps[a] != comps[b])
    assert 100 < len(found) < 70 * 69 // 2
    counted = spark.createDataFrame([(i, 0, 7, i, 70) for i in range(70)], "rep long, band int, hash long, comp long, texts long")
    plan = dedup._near_in_blocks(counted, sketches, 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in line and "comp" in line for line in plan.split("\n"))


def test_the_items_of_a_pair_are_attached_with_few_shuffles(spark):
    # Text 0 is in so many pairs that it is handed to several parts.
    sketches = spark.range(1200).selectExpr("id as rep", "if(id % 2 = 0, array(1L, 2L, 3L, 4L, 5L), array(id)) as items")
    pairs = spark.range(1, 1200).selectExpr("0L as a", "id as b").union(spark.createDataFrame([(2, 4), (3, 5)], "a long, b long"))
    held = dedup.write_bucketed(sketches, "sketches-shuffles", "rep")
    pairs = dedup.write_and_reload(pairs, "pairs-shuffles")
    found = dedup.verified(pairs, held, 0.8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum("+- Exchange" in line or ":- Exchange" in line for line in plan.split("\n")) <= 6
    assert sorted(map(tuple, found.collect())) == [(0, b) for b in range(2, 1200, 2)] + [(2, 4)]


def test_known_components_are_not_worked_out_again(spark, monkeypatch):
    rounds, write = [], dedup.write_and_reload
    monkeypatch.setattr(dedup, "write_and_reload", lambda df, name: (rounds.append(name), write(df, name))[1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = dedup.components(chain)
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 41)]
    # Edges that form stars already need one round, and each round writes one table.
    rounds.clear()
    stars = found.selectExpr("comp as a", "node as b")
    assert sorted(map(tuple, dedup.components(stars).collect())) == [(i, 0) for i in range(1, 41)]
    assert rounds == ["dedup-components"]
    # A further link between two stars.
    two = spark.createDataFrame([(0, 3), (0, 7), (1, 5), (1, 6), (5, 7)], "a long, b long")
    assert sorted(map(tuple, dedup.components(two).collect())) == [(i, 0) for i in (1, 3, 5, 6, 7)]
