import os
import sys
from datetime import datetime, timezone
from decimal import Decimal

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from compare import local_session  # noqa: E402

from fraudlens.schema import TRANSACTION_SCHEMA  # noqa: E402
from fraudlens.session import prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session("4"))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


DEFAULTS = {
    "domain": "gaming", "test_id": "t", "actor_id": "A1", "amount": 10, "currency": "USD",
    "ip_address": "10.0.0.1", "pattern": "regular_grinder", "is_fraud": False, "sequence_position": 0,
}


@pytest.fixture(scope="session")
def make_tx(spark):
    """Transactions from dicts; unnamed columns take a default or null."""

    def make(rows):
        filled = []
        for i, row in enumerate(rows):
            full = {"transaction_id": f"TXN{i + 1:03d}", **DEFAULTS, **row}
            full["amount"] = Decimal(str(full["amount"]))
            if isinstance(full["timestamp"], str):
                full["timestamp"] = at(full["timestamp"])
            filled.append(tuple(full.get(c) for c in TRANSACTION_SCHEMA.fieldNames()))
        return spark.createDataFrame(filled, TRANSACTION_SCHEMA)

    return make
