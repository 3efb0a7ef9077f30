import pytest

from wattmill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__checkpoint__dir=f"{scratch}/checkpoints", spark__sql__warehouse__dir=f"{scratch}/warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
