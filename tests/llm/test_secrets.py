"""Planted secrets of every form, and identifiers of the same form."""

import string

import numpy as np

from lapsewise.llm import secrets

MIXED, LETTERS = string.ascii_letters + string.digits, string.ascii_letters


def planted(seed=7, n=40):
    rng = np.random.default_rng(seed)

    def key(size, chars=MIXED):
        return "".join(rng.choice(list(chars), size))

    return {
        "mixed of 24": [key(24) for _ in range(n)], "mixed of 16": [key(16) for _ in range(n)],
        "letters of 24": [key(24, LETTERS) for _ in range(n)], "digits of 24": [key(24, string.digits) for _ in range(n)],
        "pieces of 10": [".".join(key(10) for _ in range(3)) for _ in range(n)],
    }


def ordinary(n=40):
    return [f"docs/guide_{i}/chapter-{i % 7}/the_file_name-v2" for i in range(n)] + [f"release-notes-2024-{i}-final" for i in range(n)]


def test_planted_secrets_are_found_and_identifiers_stay(spark):
    rng = np.random.default_rng(1)
    train = ["secret=" + "".join(rng.choice(list(MIXED), 40)) for _ in range(300)]
    prose = ["the ordinary function name of it is read in a guide of release notes and the final chapter of the docs file"] * 3000
    kinds = {**planted(n=10), "ordinary": ordinary()}
    texts = [(name, f"see {v} in it") for name, values in kinds.items() for v in values]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)] + [(9999, t) for t in train + prose], "doc_id long, text string")
    # A key that stands in the counted texts is one among very many there; here it is left out of them.
    model = secrets.fit(docs.where("doc_id = 9999 or text like '%docs/%' or text like '%release-%'"))
    spans = {r.doc_id: r.spans for r in secrets.scan(docs, model).where("doc_id < 9999").collect()}
    share = {k: np.mean([bool(spans[i]) for i, (name, _) in enumerate(texts) if name == k]) for k in kinds}
    assert min(share["mixed of 24"], share["mixed of 16"], share["letters of 24"], share["pieces of 10"]) >= 0.9, share
    assert share["ordinary"] == 0, share
    whole = next(i for i, (name, _) in enumerate(texts) if name == "pieces of 10")
    assert [s.value for s in spans[whole]] == [texts[whole][1].split()[1]]
