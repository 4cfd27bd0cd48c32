import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.session import checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="shelfwise-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


TXN_SCHEMA = ("transaction_id long, customer_id long, sku_id long, timestamp timestamp_ntz, "
              "quantity int, discount_applied decimal(4,2), total_amount decimal(18,2)")


@pytest.fixture
def make_txns(spark):
    from decimal import Decimal

    def make(rows):
        out = []
        for r in rows:
            tid, cid, sku, when, qty, disc, amt = r
            out.append((tid, cid, sku, ts(when), qty, Decimal(str(disc)), Decimal(str(amt))))
        return spark.createDataFrame(out, TXN_SCHEMA)
    return make
