import datetime as dt
import json
import os
import sys

import pytest
import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapeloom.session import build_session  # noqa: E402
from tapeloom.sources.raw_capture import raw_file_path  # noqa: E402

DAY = dt.date(2026, 6, 29)
NAME = "BTC-25DEC26-95000-C"


def message(channel, data):
    return json.dumps({"params": {"data": data, "channel": f"{channel}.{NAME}"}, "method": "subscription"})


CONTROL = json.dumps(
    {
        "result": [
            {
                "strike": 95000.0, "is_active": True, "kind": "option", "option_type": "call", "instrument_name": NAME,
                "settlement_period": "week", "creation_timestamp": 1771200000000, "expiration_timestamp": 1798185600000,
                "base_currency": "BTC", "counter_currency": "USD",
            }
        ],
        "id": 41,
    }
)
TICKER = message(
    "incremental_ticker",
    {"mark_price": 0.0177, "instrument_name": NAME, "type": "change", "timestamp": 1782700000123, "stats": {"volume": 31.5}},
)
TRADES = message(
    "trades",
    [{"trade_id": "T-88", "instrument_name": NAME, "price": 0.0182, "trade_seq": 57, "tick_direction": 1, "amount": 2.5,
      "direction": "sell", "timestamp": 1782700001456}],
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tapeloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def envelope(channel, payload, mts=1782700002000, **changes):
    row = {
        "received_at": "2026-06-29T02:26:42.000Z",
        "received_mts": mts,
        "exchange": "deribit",
        "symbol": "BTC",
        "channel": channel,
        "connection_id": "conn-1",
        "payload_text": payload,
    }
    row.update(changes)
    return {key: value for key, value in row.items() if value is not None}


def compress(lines):
    return zstandard.ZstdCompressor(level=1).compress("".join(line + "\n" for line in lines).encode())


def write_raw(root, channel, events, day=DAY, append=False):
    path = raw_file_path(str(root), channel, day, "deribit", "BTC")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [event if isinstance(event, str) else json.dumps(event) for event in events]
    with open(path, "ab" if append else "wb") as file:
        file.write(compress(lines))
    return path


def events_frame(spark, rows):
    """Envelope rows (channel, payload) in order, as `read_raw_events` gives them."""
    data = [
        ("2026-06-29T02:26:42.000Z", 1782700002000 + i, "deribit", "BTC", c, "conn", p, None, i, DAY)
        for i, (c, p) in enumerate(rows)
    ]
    schema = (
        "received_at string, received_mts bigint, exchange string, symbol string, channel string,"
        " connection_id string, payload_text string, payload_base64 string, line_no bigint, date date"
    )
    return spark.createDataFrame(data, schema)


def collect(df):
    return [row.asDict(recursive=True) for row in df.collect()]
