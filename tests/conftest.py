import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from spendgroups.session import local_session  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALLEST


@pytest.fixture(scope="session")
def customers(spark):
    """Builds a customer table from ``(age, income, score)`` rows."""
    from spendgroups.sources.customers import customers_from_rows

    def build(*rows):
        return customers_from_rows(spark, [(i, "Male", *row) for i, row in enumerate(rows)])

    return build
