import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sensormart.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(4, **{"spark.checkpoint.dir": scratch})
    yield session
    session.stop()


@pytest.fixture()
def session_zone(spark):
    """Set the session time zone, and put it back afterwards."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
