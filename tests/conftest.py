import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapsewise.schema import EVENT_SCHEMA  # noqa: E402
from lapsewise.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_log(spark):
    """Log rows from dicts; anything left out takes an ordinary value."""
    defaults = {
        "userId": "u1", "sessionId": 1, "ts": 1_000_000, "registration": 0, "page": "Home",
        "auth": "Logged In", "method": "GET", "status": 200, "level": "free", "gender": "M",
        "firstName": "A", "lastName": "B", "location": "Town, CA",
        "userAgent": "Mozilla/5.0 (Windows NT 6.1) Safari/537.36",
        "artist": None, "song": None, "length": None,
    }

    def make(*rows):
        full = [{**defaults, **row} for row in rows]
        return spark.createDataFrame([tuple(r[n] for n in EVENT_SCHEMA.names) for r in full], EVENT_SCHEMA)

    return make


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def by_user(df):
    return {r.userId: r for r in df.collect()}
