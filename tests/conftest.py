import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rosterlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture
def many_slices(spark):
    """Keep small shuffles in several partitions, as a large input would have them."""
    names = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def company(spark):
    from .fixtures import company_tables

    return company_tables(spark)
