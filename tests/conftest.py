import pytest

from registria.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests", 4,
        **{"spark.checkpoint.dir": str(folder / "checkpoint"), "spark.sql.warehouse.dir": str(folder / "warehouse")},
    )
    yield session
    session.stop()
