import datetime as dt

import pytest

from marquee.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session("local[4]", 4, **{"spark.checkpoint.dir": f"file://{scratch}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


TITLES = [
    (27205, "Inception", "en", "2010-07-16", 120.5, 8.4, 35000, [28, 878, 12], 1),
    (155, "The Dark Knight", "en", "2008-07-18", 95.2, 9.0, 31000, [28, 80, 18], 2),
    (872585, "Oppenheimer", "en", "2023-07-21", 88.7, 8.1, 12000, [18, 36], 3),
]
TITLE_SCHEMA = (
    "id bigint, title string, original_language string, release_date string, popularity double, "
    "vote_average double, vote_count int, genre_ids array<int>, _position int"
)


@pytest.fixture
def titles(spark):
    return spark.createDataFrame(TITLES, TITLE_SCHEMA)
