from conftest import rows

from lapsewise.operators import profiling


def test_missing_values_counts_each_column_most_first(make_log):
    log = make_log({"artist": None, "gender": None}, {"artist": "x", "song": "s", "length": 1.0}, {})
    counts = [(r.column_name, r.n_missing) for r in profiling.missing_values(log).collect()]
    assert counts[0] == ("artist", 2) and dict(counts)["gender"] == 1 and dict(counts)["page"] == 0
    assert [n for _, n in counts] == sorted((n for _, n in counts), reverse=True)


def test_duplicates(make_log):
    log = make_log({"ts": 1}, {"ts": 1}, {"ts": 2})
    assert rows(profiling.duplicate_rows(log), "ts", "n_rows") == [(1, 2)]
    assert rows(profiling.duplicate_rows(log, ["userId"]), "userId", "n_rows") == [("u1", 3)]


def test_anonymous_rows(make_log):
    gone = {c: None for c in ("firstName", "lastName", "gender", "userAgent", "location", "registration")}
    log = make_log({"userId": "", "auth": "Guest", **gone}, {"userId": "a", "gender": None}, {"userId": None})
    assert rows(profiling.null_attribute_users(log)) == [("",)]
    assert rows(profiling.auth_by_anonymity(log), "anonymous", "auth", "n_logs") == [
        (False, "Logged In", 1), (True, "Guest", 1)
    ]


def test_media_pages_and_totals(make_log):
    log = make_log(
        {"page": "NextSong", "artist": "a", "song": "s", "length": 1.0},
        {"page": "NextSong", "artist": "a", "song": None, "length": 1.0, "sessionId": 2},
        {"page": "Help", "userId": "u2"},
    )
    assert rows(profiling.pages_without_media(log)) == [("Help",), ("NextSong",)]
    assert rows(profiling.pages_with_media(log)) == [("NextSong",)]
    assert rows(profiling.activity_totals(log)) == [(2, 2, 3, 1.5)]
    assert rows(profiling.table_shape(log)) == [(3, 17)]


def test_schema_and_ranges(make_log):
    log = make_log({"status": 200}, {"status": 404, "song": "x"})
    shape = {r.column_name: r for r in profiling.schema_table(log).collect()}
    assert (shape["status"].data_type, shape["status"].n_filled, shape["song"].n_filled) == ("int", 2, 1)
    assert rows(profiling.range_summary(log, ["status", "song"])) == [
        ("song", 1, "x", "x"), ("status", 2, "200", "404")
    ]


def test_sample_and_preview(make_log):
    log = make_log(*[{"ts": i} for i in range(30)])
    assert [r.ts for r in profiling.preview(log, ["ts"], 3).collect()] == [0, 1, 2]
    drawn = profiling.sample_column(log, "userAgent", 5, 1, ["userId", "sessionId", "ts", "page"])
    assert drawn.count() == 5
    again = profiling.sample_column(log.repartition(7), "userAgent", 5, 1, ["userId", "sessionId", "ts", "page"])
    assert drawn.collect() == again.collect()
