"""Files that hold many notices at once."""

import itertools

from lapsewise.llm import licenses


def test_no_notice_is_lost_to_the_others_of_its_file(spark):
    groups = [list(g) for n in (1, 4, 5, 8) for g in itertools.combinations(sorted(licenses.TEMPLATES), n)]
    rows = [(i, "\n\nplain words between\n\n".join(licenses.TEMPLATES[t] for t in g)) for i, g in enumerate(groups)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [t.template for t in r.templates] for r in licenses.scan(docs, licenses.build_index(docs)).collect()}
    assert [g for i, g in enumerate(groups) if not set(g) <= set(got[i])] == []
    assert got[len(groups) - 1] == sorted(licenses.TEMPLATES)


def test_texts_are_read_once_beside_the_index_and_only_a_to_z_is_lowered(spark):
    rows = [
        (1, None), (2, "  ..  "), (3, "Released UNDER the MIT License"), (4, "MIT licenſe, ÉtÉ 9"),
        (5, "  x MIT--LICENSE\n\nİ K Apache License y  "), (6, "sublicense mit licensed"), (5, "General Public License"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(docs, licenses.build_index(docs))
    got = sorted(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, sorted(r.base_labels), [t.template for t in r.templates])
        for r in found.collect()
    )
    assert got == [
        (1, 0, 0, None, None, [], []), (2, 0, 0, None, None, [], []), (3, 5, 1, 3, 3, ["mit"], ["mit-release"]),
        (4, 4, 0, None, None, [], []), (5, 3, 1, 0, 0, ["gpl"], []), (5, 8, 2, 1, 5, ["apache", "mit"], []),
        (6, 3, 0, None, None, [], []),
    ]
    # Splitting into words happened before the written figures: the plan reads no text.
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()
