import os

import pytest

import __spark_entry__ as entry_point
from check_oracles import compare, duck
from tapeloom.registry.queries import REGISTERED

SMALL = "/root/testdata/sf0.001"
ROWS_ONLY = {"recent_files", "newest_file_per_exchange", "file_heads"}
CHECKED = [
    "envelope_build_parse",
    "binary_envelope_base64",
    "route_channels",
    "trade_rows_from_pages",
    "resume_filter",
    "instruments_last_write_wins",
    "trades_enriched",
    "ticker_enriched",
    "json_scalars",
    "payload_expand",
    "market_pick",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's test tables")


def test_every_query_has_an_oracle_but_the_file_listings():
    assert set(REGISTERED) - set(entry_point.oracle_sql()) == ROWS_ONLY
    assert set(REGISTERED) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_has_rows_and_the_stored_schema(spark):
    from tapeloom import schemas

    flagship = entry_point.entry(spark)
    assert flagship.columns == schemas.DERIVATIVES_TRADES.names
    assert flagship.count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_oracle(spark, name):
    assert compare(spark, duck(SMALL), SMALL, name) is None
