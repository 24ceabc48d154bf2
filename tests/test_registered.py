"""All registered queries give the rows of their SQL."""

import pytest

from checks.compare import compare, connect
from checks.registry import all_checks

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(all_checks()))
def test_registered(spark, database, name):
    assert compare(spark, database, FOLDER, all_checks()[name]) is None
