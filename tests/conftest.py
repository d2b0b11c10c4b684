from __future__ import annotations

import pytest

from streamloader.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, memory="4g", app="streamloader-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    from streamloader import Tables

    return Tables(spark, str(tmp_path / "tables"), buckets=2)
