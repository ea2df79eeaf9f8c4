import pytest

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def get(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return get
