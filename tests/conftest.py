import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tidemark-tests",
        **{
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def testdata():
    return "/root/testdata/sf0.001"
