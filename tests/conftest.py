import os

import pytest

from stratum.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ["TZ"] = "UTC"
    folders = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(8, "stratum-tests", **folders)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
