import pytest

from tallyward.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "tests")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
