import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tillsight.session import local_session

    session = local_session("tests", cores=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    from tillsight.plans.tables import tables

    return tables(spark, SF)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def sales_of(spark):
    """Raw sale lines from (invoice, code, text, quantity, date, price, customer, country) tuples."""
    import datetime as dt
    from decimal import Decimal

    from tillsight.sources.schemas import RETAIL_RAW

    def build(*rows):
        return spark.createDataFrame(
            [(i, s, d, q, dt.datetime.fromisoformat(w) if w else None, None if p is None else Decimal(str(p)), c, n)
             for i, s, d, q, w, p, c, n in rows], RETAIL_RAW)

    return build
