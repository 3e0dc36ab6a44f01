"""Divergence audit, personal data and ranked lexical search against brute force; odd rows of every kind."""

import collections
import hashlib
import math
import re
import time

import pytest
from pyspark.sql import functions as F

from lapsewise.llm import catalog, divergence, lexical, pii, terms

DOCS = "doc_id long, text string, lang string, source string"
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS_DIGITS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LONG = " ".join(f"word{i % 97} Other{i} a@b.c{i}" for i in range(30_000))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text, pattern):
    return pattern.findall(lower(text))


@pytest.mark.parametrize("text", ["Öl ist ÄÖÜ, l'eau 12ab ß!x", "", None, "a b c d", "A1b2\x7fC"])
def test_terms_are_those_of_the_pattern(text):
    data = text.encode() if text is not None else None
    for digits, pattern in ((False, LETTERS), (True, LETTERS_DIGITS)):
        assert [t.decode() for t in terms.terms(data, terms.byte_table(digits))] == words(text, pattern)


def brute_audit(rows):
    groups, lang_docs = collections.defaultdict(list), collections.defaultdict(list)
    for _, text, lang, source in rows:
        found = words(text, LETTERS)
        groups[lang or "", source or ""].append(found)
        lang_docs[lang or ""].append(found)
    out = []
    for lang, docs in lang_docs.items():
        df = collections.Counter(t for d in docs for t in set(d))
        kept = sorted(t for t, n in df.items() if n >= divergence.MIN_DOCS)

        def p_of(texts):
            n = collections.Counter(t for d in texts for t in d if df[t] >= divergence.MIN_DOCS)
            total = sum(n.values())
            return n, {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        sources = [s for g, s in groups if g == lang]
        shares = {s: p_of(groups[lang, s]) for s in sources}
        q = p_of(docs)[1]
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(shares[s][1][t], shares[o][1][t]) for t in kept), o) for o in sources if o != s]
            top = [(f(p, q[t]), t) for t, p in shares[s][1].items() if shares[s][0][t] > 0 and p > q[t]]
            for part, found in (("pair", pairs), ("term", top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                found = found if part == "pair" else found[: divergence.TOP_TERMS]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.fixture(scope="module")
def audited():
    rows = [(i, f"Alpha beta gamma{i % 4} ÉTÉ {'delta ' * (i % 5)}", "en" if i % 3 else "d e:", f"s{i % 4}") for i in range(40)]
    rows += [(50, None, None, None), (51, "", "en", None), (52, "x y", "fr", "only"), (53, LONG, "en", "s1")]
    rows += [(54, "alone alone", "it", "a"), (55, "alone", "it", "b"), (1, rows[1][1], "en", "s1"), (None, "Beta beta", "en", "s0")]
    return rows


def test_audit_equals_brute_force(spark, audited):
    docs = spark.createDataFrame(audited, DOCS).withColumn("place", F.lit("x")).withColumn("terms", F.lit(1))
    found = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert found == brute_audit(audited)
    assert {r[2] for r in found if r[0] == "it"} == {"pair"}
    assert divergence.audit(docs.where("false")).count() == 0


def test_audit_does_not_depend_on_the_split_of_its_vocabulary(spark, audited, monkeypatch):
    docs = spark.createDataFrame(audited, DOCS).repartition(5)
    monkeypatch.setattr(divergence, "n_models", lambda rows: 3)
    for name, value in {"TERMS_AT_ONCE": 5, "COUNTS_AT_ONCE": 3, "PAIRS_AT_ONCE": 2, "TERMS_A_ROW": 2}.items():
        monkeypatch.setattr(divergence, name, value)
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute_audit(audited)


def brute_pii(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1]))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


HARD = [
    "a@b.c_d@e.f x@y@z.com @n.o p.q@r .@.a a..b@c-d.e.f.", "é a@b.co ü 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 9.9.9.9.9",
    "4539 1488 0343 6467 then 4539-1488-0343-6468 and 45391488034364674539 0000000000000000",
    "+1 (743) 555-3824 +49.30-901820, +1 2 +1234567890123456 ++12 345 67 89 +1 )( 23456789",
    "𝒳 6011000990139424 +1 (743) 555-3824𝒳 a@b.c 10.0.0.1", "1.1.1.1.1.1.1.1.1", "12 34", "\n\t", "",
]


@pytest.mark.parametrize("text", HARD)
def test_plain_spans_equal_the_rules(text):
    assert pii.plain_spans(text) == brute_pii(text)


def test_checksums():
    assert pii.luhn("4539148803436467") and not pii.luhn("4539148803436468")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("pay to DE89 3704 0044 0532 0130 00 today", ["iban"]),
        ("pay to DE88 3704 0044 0532 0130 00 today", []),
        ("my social security number is 219-09-9999 ok", ["ssn"]),
        ("order 219-09-9999 shipped", []),
        ("social order 219-09-9999", []),
        ("call me: 743-555-3824", ["local_phone"]),
        ("lot 743-555-3824", []),
        ("Phone +1 743-555-3824", ["phone"]),
        ("credit card 378282246310005.", ["short_card"]),
        ("number 378282246310005.", []),
        ("credit card 378282246310006.", []),
        ("ssn x219-09-9999", []),
    ],
)
def test_context_and_checksums_decide_further_kinds(text, kinds):
    assert [s[0] for s in pii.spans(text)] == kinds


def test_context_changes_the_score():
    score = lambda t: pii.spans(t)[0][3]
    assert score("server 10.0.0.1") > score("at 10.0.0.1") > score("version 10.0.0.1")


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "a@" * 150_000, "1." * 150_000, "+1" * 150_000, "A1" * 150_000, "1 " * 150_000, "+1" + "(" * 300_000, "(" * 300_000])
def test_long_texts_take_linear_time(text):
    started = time.time()
    pii.spans(text)
    assert time.time() - started < 5


def test_find_keeps_rows_and_replaces_a_clashing_column(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a@b.c", "y"), (3, "a@b.c", "y"), (None, LONG, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    found = pii.find(docs)
    assert found.columns == docs.columns
    got = [(r.doc_id, len(r.pii)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(1, 0), (2, 0), (3, 1), (3, 1), (None, 30_000)], key=repr)
    assert pii.find(docs.where("false")).count() == 0


def test_query_digests_are_those_of_the_contract(spark, tmp_path):
    rows = [(i, text, "en", "s", 1) for i, text in enumerate(HARD + [None])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    for r in catalog.op12_pii(spark, str(tmp_path)).collect():
        base = brute_pii(rows[r.doc_id][1])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)
        counts = collections.Counter(k for k, _, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))


def brute_search(docs, items, k=20):
    told = [(i, collections.Counter(words(t, LETTERS_DIGITS))) for i, t in docs]
    told = [(i, c, sum(c.values())) for i, c in told]
    n_docs, n_terms = sum(n > 0 for _, _, n in told), sum(n for _, _, n in told)
    df = collections.Counter(t for _, c, _ in told for t in c)
    out = []
    for item, text in items:
        wanted, found = collections.Counter(words(text, LETTERS_DIGITS)), []
        for i, c, n in told:
            if i is None:
                continue
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 100
            score = 0
            for t, repeats in wanted.items():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += repeats * w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def library():
    docs = [(i, f"the Cat{i % 7} sat on mat{i % 11} {'é1 ' * (i % 4)}") for i in range(120)]
    docs += [(200, None), (201, ""), (202, "..."), (5, docs[5][1]), (None, "the cat1 cat2"), (203, LONG)]
    items = [(1, "THE cat1 cat1 é1"), (2, "mat3, mat4!"), (3, None), (4, ""), (5, "nowhere"), (6, "the"), (7, LONG), (2, "zzz")]
    return docs, items


def test_search_equals_brute_force(spark, library):
    docs, items = library
    wide = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(5)
    listed = spark.createDataFrame(items + [(None, "the")], "item_id long, text string").withColumn("rank", F.lit(1))
    found = sorted(tuple(r) for r in lexical.search(wide, listed).collect())
    want = brute_search(docs, [i for i in items if i != (2, "zzz")])
    assert found == want
    assert lexical.search(wide.where("false"), listed).count() == 0
    assert lexical.search(wide, listed.where("false")).count() == 0


def test_search_in_blocks_and_small_steps_gives_the_same(spark, library, monkeypatch):
    docs, items = library
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:6], "item_id long, text string")
    want = brute_search(docs, items[:6], k=3)
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 12)
    monkeypatch.setattr(lexical, "SCORES_AT_ONCE", 7)
    assert sorted(tuple(r) for r in lexical.search(*tables, k=3).collect()) == want


FEW = [(i, "One two two three four", "en", s) for i, s in enumerate("aab")] + [(4, None, "en", "b"), (5, "one", None, None), (6, "", "fr", "a")]


def test_divergence_passes_texts_to_tasks_in_small_batches_only(spark, monkeypatch):
    setting, seen, written = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, divergence.write_and_reload

    def watched(df, name):
        seen[name] = int(spark.conf.get(setting))
        return written(df, name)

    monkeypatch.setattr(divergence, "write_and_reload", watched)
    monkeypatch.setattr(divergence, "COUNTS_AT_ONCE", 3)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "7000")
    try:
        docs = spark.createDataFrame(FEW, DOCS)
        found = divergence.audit(docs)
        assert spark.conf.get(setting) == "7000"
    finally:
        spark.conf.set(setting, before)
    assert seen["divergence-rows"] == seen["divergence-counts"] == 256
    assert seen["divergence-sides"] == 7000
    assert sorted(tuple(r) for r in found.collect()) == brute_audit(FEW)
