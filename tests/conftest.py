import pytest

from postloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(8, 8, **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()
