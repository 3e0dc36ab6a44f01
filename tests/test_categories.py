"""Categories found in the log: every device, browser and page has a column or is in the rest."""

import pytest

from lapsewise.operators import categories as C
from lapsewise.plans import features
from lapsewise.schema import FEATURES
from lapsewise.sources import read_json_log, unreadable_lines
from lapsewise.storage import new_path

LINUX = "Mozilla/5.0 (Linux; Android 10) Chrome/1 Edg/18.0"


@pytest.fixture
def log(make_log):
    return make_log(
        {"page": "Home"}, {"page": "Shuffle Play", "userAgent": LINUX, "ts": 2_000_000},
        {"page": "Shuffle Play", "userId": "u2", "userAgent": LINUX, "sessionId": 4}, {"userId": "u2", "page": "Fly-Over", "sessionId": 4},
        {"userId": "u2", "userAgent": "x (Safari; y) level/1", "sessionId": 4, "ts": 9_000_000},
    )


def test_unlisted_values_get_columns(log):
    table = features.feature_table(log)
    new = [c for c in table.columns if c not in ("userId", "churn", *FEATURES)]
    assert new == ["Linux", "device_Safari", "Edg", "browser_level", "page_shuffle_play_hourly", "page_fly_over_hourly"]
    found = {r.userId: r for r in table.collect()}
    assert found["u1"].Linux == 0.5 and found["u2"].Linux == pytest.approx(1 / 3) and found["u2"].device_Safari == pytest.approx(1 / 3)
    assert found["u1"].Edg == 0.5 and found["u2"].page_shuffle_play_hourly > 0 and found["u1"].page_fly_over_hourly == 0
    pivot = {r.userId: r for r in features.page_pivot(log).collect()}
    assert pivot["u1"].page_shuffle_play == 1 and pivot["u2"].page_fly_over == 1 and pivot["u1"].page_home == 1
    assert {r.userId: r.Edg for r in features.browser_usage(log).collect()}["u1"] == 0.5


def test_what_has_no_column_is_in_the_rest(log):
    found = features.find_categories(log, most=1)
    assert found["device"].rest == "device_rest" and found["page"].rest == "page_rest"
    table = features.feature_table(log, categories=found)
    row = {r.userId: r for r in table.collect()}["u2"]
    shares = [row[c] for category in ("device", "browser") for c in found[category].names]
    assert sum(shares) == pytest.approx(2.0) and row.device_rest > 0 and row.page_rest_hourly > 0


def test_a_log_of_listed_values_has_the_listed_columns(make_log):
    assert features.feature_table(make_log({"page": "Home"})).columns == ["userId", "churn", *FEATURES]


def test_categories_are_kept_with_the_table(spark, log):
    path = new_path(spark, "features")
    features.create_features(log, path)
    kept = features.load_categories(spark, path)
    assert kept == features.find_categories(log)
    later = features.feature_table(log.where("userId = 'u1'"), categories=kept)
    assert later.columns == features.load_features(spark, path).columns


def test_values_that_share_a_name_share_a_column():
    category = C.Category({"a b": "x", "a  b": "x"}, "rest")
    assert category.names == ["x", "rest"] and len(category.counts(C.F.lit("a b"))) == 2


def test_unreadable_lines_are_accounted_for(spark, tmp_path):
    lines = ['{"userId": "u1", "page": "Home", "ts": 1}', '{"userId": "u2", "pa', "not json", '{"userId": "u3"}']
    (tmp_path / "log.json").write_text("\n".join(lines))
    path = str(tmp_path / "log.json")
    assert sorted(r.userId for r in read_json_log(spark, path).collect()) == ["u1", "u3"]
    bad = unreadable_lines(spark, path)
    assert bad.count() == 2 and sorted(r.line for r in bad.collect()) == sorted(lines[1:3])
    with pytest.raises(Exception):
        read_json_log(spark, path, unreadable="fail").collect()
    with pytest.raises(ValueError):
        read_json_log(spark, path, unreadable="guess")
