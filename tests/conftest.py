import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples; columns may be picked."""

    def pick(df, *columns):
        out = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in out), key=repr)

    return pick
