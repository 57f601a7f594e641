"""DuckDB SQL with the expected result of each registered query, written from the base tables."""

from __future__ import annotations

from tapeloom import schemas
from tapeloom.sources.feeds import feed_rows

# Building blocks -------------------------------------------------------------------------------

MS = "(epoch_us(ts) // 1000)"
SHIP_MS = "(epoch_us(l_shipdate) // 1000)"


def instant(mts: str) -> str:
    return f"strftime(make_timestamp(({mts}) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"


def double_text(expression: str) -> str:
    """Exponent form of a double as stored: no plus sign, no leading zeros."""
    text = f"cast(cast({expression} AS double) AS varchar)"
    return f"regexp_replace(regexp_replace({text}, 'e-0*', 'e-'), 'e\\+', 'e')"


def scaled(column: str, exponent: str) -> str:
    return double_text(f"(cast({column} AS varchar) || '{exponent}')")


def plain_milli(column: str) -> str:
    """A two-decimal double times 1e-3 as plain text."""
    exact = f"cast(cast({column} AS decimal(18,2)) * 0.001 AS varchar)"
    return f"CASE WHEN {column} = 0 THEN '0.0' ELSE regexp_replace({exact}, '0+$', '') END"


def decimal_text(expression: str) -> str:
    return f"regexp_replace(cast(cast({expression} AS decimal(38,18)) AS varchar), '\\.?0+$', '')"


FRAMES = """
frames AS (
  SELECT e.*, f.exchange, f.symbol, f.feed,
    CASE
      WHEN f.exchange = 'deribit' THEN CASE event_type WHEN 'view' THEN 'incremental_ticker'
        WHEN 'click' THEN 'trades' WHEN 'purchase' THEN 'instrument_creation' ELSE 'control' END
      WHEN f.exchange = 'hyperliquid' THEN CASE event_type WHEN 'view' THEN 'trades'
        WHEN 'click' THEN 'book' ELSE 'control' END
      ELSE f.feed END AS stored
  FROM events e CROSS JOIN (VALUES
    ('deribit', 'BTC', 'instrument_lifecycle'),
    ('hyperliquid', 'spot_btc', 'spot_market_data'),
    ('bitfinex', 'tBTCUSD', 'trades')) f(exchange, symbol, feed)
)"""

SPOT_TEXT = """CASE event_type
  WHEN 'view' THEN '{"channel":"trades","data":[]}'
  WHEN 'click' THEN '{"channel":"l2Book","data":{}}'
  WHEN 'purchase' THEN '{"event":"connected"}'
  WHEN 'signup' THEN '{"event":"disconnected"}'
  ELSE '{"channel":"other"}' END"""

FRAME_TEXT = """CASE event_type
  WHEN 'view' THEN '{"jsonrpc":"2.0","method":"subscription","params":{"channel":"incremental_ticker.P-' || user_id || '","data":' || props || '}}'
  WHEN 'click' THEN '{"jsonrpc":"2.0","method":"subscription","params":{"channel":"trades.P-' || user_id || '.100ms","data":[]}}'
  WHEN 'purchase' THEN '{"jsonrpc":"2.0","method":"subscription","params":{"channel":"instrument.creation.future.BTC","data":{}}}'
  WHEN 'signup' THEN '{"jsonrpc":"2.0","method":"heartbeat","params":' || CASE WHEN user_id % 2 = 0 THEN '{"type":"test_request"}' ELSE '{"type":5}' END || '}'
  ELSE 'frame ' || event_id END"""

TRADES = f"""
trades AS (
  SELECT 't' || event_type AS sym, event_id AS id, {MS} AS mts,
    CASE WHEN user_id % 2 = 0 THEN -cast(value AS decimal(18,2)) ELSE cast(value AS decimal(18,2)) END AS amount,
    cast(value AS decimal(18,2)) AS price,
    cast(ts AS date) AS day
  FROM events
)"""

KIND = "CASE p_size % 3 WHEN 0 THEN 'option' WHEN 1 THEN 'future' ELSE 'spot' END"
CURRENCY = "CASE WHEN p_size % 4 = 0 THEN 'ETH' ELSE 'BTC' END"
PART_DAY = "CASE WHEN p_size < 25 THEN '2026-06-29' ELSE '2026-06-30' END"
EVENT_DAY = "CASE WHEN event_type IN ('view', 'click') THEN '2026-06-29' ELSE '2026-06-30' END"
LINE_DAY = "CASE WHEN l_linestatus = 'F' THEN '2026-06-29' ELSE '2026-06-30' END"

# All instrument rows with their rank in the load order; one row per write.
WRITES = f"""
writes AS (
  SELECT {PART_DAY} AS day, 0 AS source_rank, p_partkey AS load_order, 0 AS pos,
    'P-' || p_partkey AS instrument_name, {KIND} AS kind, {CURRENCY} AS base_currency,
    CASE WHEN p_size % 2 = 0 THEN 'put' ELSE 'call' END AS option_type, p_type AS settlement_period,
    cast(p_retailprice AS varchar) AS strike, '1e-6' AS contract_size, '0.00001' AS tick_size,
    1785484800000 + p_partkey AS expiration_timestamp,
    CASE p_size % 5 WHEN 0 THEN false WHEN 1 THEN true END AS is_active
  FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')
  UNION ALL
  SELECT {PART_DAY}, 0, p_partkey, 2, 'P-' || p_partkey, 'option', NULL, NULL, NULL,
    cast(p_size AS varchar), NULL, NULL, NULL, NULL
  FROM part WHERE p_brand = 'Brand#4'
  UNION ALL
  SELECT {EVENT_DAY}, 1, event_id, 0, 'P-' || user_id,
    CASE event_type WHEN 'view' THEN 'option' WHEN 'click' THEN 'future' WHEN 'purchase' THEN NULL
      WHEN 'signup' THEN 'spot' ELSE 'option' END,
    CASE event_type WHEN 'view' THEN 'BTC' WHEN 'click' THEN 'ETH' WHEN 'purchase' THEN '7' END,
    NULL, NULL, cast(value AS varchar), NULL, NULL, NULL, NULL
  FROM events
)"""


def terms(per_day: bool = False) -> str:
    keys = "day, instrument_name" if per_day else "instrument_name"
    return f"""{WRITES},
terms AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
    ORDER BY source_rank DESC, load_order DESC, pos DESC) AS rn FROM writes) WHERE rn = 1
)"""


# Trade rows of the messages, one per good element.
TRADE_ROWS = f"""
listed AS (
  SELECT *, CASE l_linenumber WHEN 5 THEN 'trades' ELSE 'trades.P-' || l_partkey || '.100ms' END AS sub
  FROM lineitem
),
trade_rows AS (
  SELECT l_orderkey AS line_no, {SHIP_MS} + l_linenumber AS received_mts, {LINE_DAY} AS day, sub,
    'P-' || l_partkey AS instrument_name, {SHIP_MS} AS trade_timestamp,
    l_orderkey || '-' || l_linenumber AS trade_id, l_suppkey AS trade_seq,
    CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS direction,
    cast(l_linenumber AS bigint) AS tick_direction, cast(l_extendedprice AS varchar) AS price,
    cast(l_quantity AS varchar) AS amount, {scaled("l_extendedprice", "e-12")} AS index_price,
    cast(l_discount AS varchar) AS iv, l_linestatus AS liquidation
  FROM listed WHERE l_linenumber IN (1, 2, 3, 5)
  UNION ALL
  SELECT l_orderkey, {SHIP_MS} + l_linenumber, {LINE_DAY}, sub, 'X-' || l_partkey, NULL, NULL, l_orderkey, NULL,
    NULL, cast(l_tax AS varchar), NULL, NULL, NULL, NULL
  FROM listed WHERE l_linenumber IN (3, 4)
)"""

TRADE_COLUMNS = f"""
  'deribit' AS exchange, 'BTC' AS symbol, {instant("r.received_mts")} AS received_at, r.received_mts,
  'deribit-BTC-instruments' AS connection_id, r.sub AS subscription_channel, r.instrument_name,
  r.trade_timestamp, r.trade_id, r.trade_seq, r.direction, r.tick_direction, r.price, r.amount,
  cast(NULL AS varchar) AS contracts, cast(NULL AS varchar) AS mark_price, r.index_price, r.iv,
  r.liquidation, cast(NULL AS varchar) AS block_trade_id, cast(NULL AS varchar) AS combo_id,
  cast(NULL AS varchar) AS combo_trade_id, cast(NULL AS bigint) AS block_rfq_id"""

TERM_COLUMNS = "t.kind, t.expiration_timestamp, t.strike, t.option_type, t.settlement_period"

_FULL = "event_type IN ('view', 'purchase')"


def full(expression: str) -> str:
    """A value only full ticker messages hold."""
    return f"CASE WHEN {_FULL} THEN {expression} END"


TICKER_ROWS = f"""
ticker_rows AS (
  SELECT event_id, {MS} AS received_mts, {EVENT_DAY} AS day,
    CASE event_type WHEN 'view' THEN 'incremental_ticker.P-' || user_id
      WHEN 'click' THEN 'incremental_ticker.Q-' || user_id ELSE 'incremental_ticker' END AS sub,
    CASE WHEN event_type = 'click' THEN 'Q-' ELSE 'P-' END || user_id AS instrument_name,
    {full(MS)} AS ticker_timestamp,
    CASE WHEN event_type = 'click' THEN 'change' ELSE 'snapshot' END AS ticker_type,
    {full("'open'")} AS state,
    {full("cast(value AS varchar)")} AS best_bid_price,
    {full(scaled("value", "e18"))} AS best_bid_amount,
    {full(plain_milli("value"))} AS best_ask_price,
    {full("'7.5E-20'")} AS index_price,
    CASE WHEN event_type = 'click' THEN cast(value AS varchar) ELSE {scaled("value", "e-9")} END AS mark_price,
    {full("'true'")} AS last_price,
    {full("'SYN.1.0E-7'")} AS underlying_index,
    {full("cast(user_id AS varchar)")} AS open_interest,
    {full("cast(value AS varchar)")} AS stats_volume,
    {full("'-0.0'")} AS delta,
    {full(scaled("value", "e-9"))} AS gamma,
    {full("'60000.0'")} AS rho
  FROM events WHERE event_type IN ('view', 'click', 'purchase')
)"""
_TICKER_SET = {
    "ticker_timestamp", "ticker_type", "state", "best_bid_price", "best_bid_amount", "best_ask_price",
    "index_price", "mark_price", "last_price", "underlying_index", "open_interest", "stats_volume",
    "delta", "gamma", "rho",
}


def ticker_columns() -> str:
    columns = [
        "'deribit' AS exchange",
        "'BTC' AS symbol",
        f"{instant('r.received_mts')} AS received_at",
        "r.received_mts",
        "'deribit-BTC-instruments' AS connection_id",
        "r.sub AS subscription_channel",
        "r.instrument_name",
        TERM_COLUMNS,
    ]
    for name in schemas.INCREMENTAL_TICKER.names[12:]:
        columns.append(f"r.{name}" if name in _TICKER_SET else f"cast(NULL AS varchar) AS {name}")
    return ",\n  ".join(columns)


TICKER_ENRICHED = f"""WITH {terms()},{TICKER_ROWS}
SELECT {ticker_columns()}
FROM ticker_rows r LEFT JOIN terms t USING (instrument_name)"""

DISCOVERED = f"""
  SELECT p_partkey AS line_no, 0 AS pos, 'P-' || p_partkey AS instrument_name FROM part
  WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3') AND {KIND} IN ('option', 'future')
    AND ({CURRENCY} = 'BTC' OR p_size % 8 = 0) AND p_size % 5 <> 0"""

CREATED = "SELECT event_id AS line_no, 'P-' || user_id AS instrument_name FROM events WHERE event_type IN ('view', 'purchase')"
# A currency that is not a text counts as missing, so purchase messages pass.

RANGE = f"mts BETWEEN epoch_ms(TIMESTAMP '2024-01-10 00:00:00') AND epoch_ms(TIMESTAMP '2024-01-20 10:30:00')"

STORED_TRADES = f"""
  'bitfinex' AS exchange, {{symbol}} AS symbol, id, mts, {instant("mts")} AS timestamp,
  CASE WHEN amount >= 0 THEN 'buy' ELSE 'sell' END AS side, {decimal_text("amount")} AS amount,
  {decimal_text("abs(amount)")} AS amount_abs, {decimal_text("price")} AS price"""

LAST_DAYS = f"""{TRADES},
last_days AS (
  SELECT sym AS symbol, day, mts AS last_trade_mts, id AS last_trade_id FROM trades
  QUALIFY row_number() OVER (PARTITION BY sym, day ORDER BY mts DESC, id DESC) = 1
),
completed AS (
  SELECT * FROM (SELECT *, max(day) OVER (PARTITION BY symbol) AS newest FROM last_days) WHERE day < newest
)"""


def catalogue_values() -> str:
    rows = feed_rows([*schemas.VENUES, "bitfinex"])
    return ", ".join(f"('{v}', '{e}', '{s}', '{c}', '{i}')" for v, e, s, c, i, _ in rows)


# Messages of the derivatives venue: their channel, day and order.
CAPTURED = """captured AS (
  SELECT 'control' AS channel, CASE WHEN p_size < 25 THEN DATE '2026-06-29' ELSE DATE '2026-06-30' END AS day, p_partkey AS line_no FROM part
  UNION ALL SELECT unnest(['instrument_creation', 'incremental_ticker']),
    CASE WHEN event_type IN ('view', 'click') THEN DATE '2026-06-29' ELSE DATE '2026-06-30' END, event_id FROM events
  UNION ALL SELECT 'trades', CASE WHEN l_linestatus = 'F' THEN DATE '2026-06-29' ELSE DATE '2026-06-30' END, l_orderkey FROM lineitem)"""

ORACLES: dict[str, str] = {
    "envelope_build_parse": f"""
SELECT {instant(MS)} AS received_at, {MS} AS received_mts, 'bitfinex' AS exchange, 't' || user_id AS symbol,
  event_type AS channel, 'conn-' || event_id AS connection_id, props AS payload_text
FROM events WHERE event_type <> 'error'""",
    "binary_envelope_base64": """
SELECT source AS symbol, lang AS channel, cast(doc_id AS varchar) AS connection_id,
  cast(NULL AS varchar) AS payload_text, to_base64(encode(text)) AS payload_base64
FROM documents""",
    "route_channels": f"""WITH {FRAMES}
SELECT exchange, symbol, stored AS channel, count(*) AS messages FROM frames GROUP BY ALL""",
    "captured_channel_counts": f"""WITH {FRAMES}
SELECT exchange, stored AS channel, cast(cast(ts AS date) AS varchar) AS day, count(*) AS messages, min({MS}) AS first_mts
FROM frames GROUP BY ALL""",
    "text_events_per_channel": f"""WITH {FRAMES}
SELECT CASE WHEN event_id % 5 = 0 AND exchange = 'deribit' THEN 'control' ELSE stored END AS channel, count(*) AS events
FROM frames WHERE event_id % 5 <> 0 GROUP BY ALL""",
    "first_messages_per_feed": f"""WITH {FRAMES}
SELECT exchange, symbol, feed AS channel, event_id,
  CASE exchange WHEN 'bitfinex' THEN props WHEN 'hyperliquid' THEN {SPOT_TEXT} ELSE {FRAME_TEXT} END AS text
FROM (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, feed ORDER BY ts, event_id) AS rn FROM frames) WHERE rn <= 100""",
    "numbered_messages_per_feed": f"""WITH {FRAMES}
SELECT event_id, exchange, symbol, feed AS channel,
  row_number() OVER (PARTITION BY exchange, symbol, feed ORDER BY event_id) AS row_number
FROM frames""",
    "connection_lifecycle": """
SELECT 'hyperliquid-spot-btc' AS connection_id,
  CASE event_type WHEN 'purchase' THEN 'connected' ELSE 'disconnected' END AS event, count(*) AS times
FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY ALL""",
    "feed_coverage": f"""
SELECT v.venue, v.exchange, v.symbol, v.channel, v.connection_id, coalesce(n.messages, 0) AS messages
FROM (VALUES {catalogue_values()}) v(venue, exchange, symbol, channel, connection_id)
LEFT JOIN (SELECT f.*, (SELECT count(*) FROM events) AS messages FROM (VALUES
    ('deribit', 'BTC', 'instrument_lifecycle'), ('hyperliquid', 'spot_btc', 'spot_market_data'),
    ('bitfinex', 'tBTCUSD', 'trades')) f(exchange, symbol, channel)) n USING (exchange, symbol, channel)""",
    "exact_decimals": """
WITH digits AS (SELECT *, lpad(cast(l_orderkey AS varchar), 12, '7') AS d FROM lineitem),
exact AS (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7
    WHEN 0 THEN '-' || d || l_partkey || '.' || rtrim(d || d || l_linenumber, '0')
    WHEN 1 THEN d || d || '7654321.5'
    WHEN 2 THEN '0.' || repeat('0', 20) || rtrim(d, '0')
    WHEN 3 THEN '-' || d[1:9] || '.' || d[10:12] || '25'
    WHEN 4 THEN d || repeat('0', 20) END AS exact
  FROM digits
)
SELECT *, ltrim(exact, '-') AS size, CASE WHEN exact LIKE '-%' THEN 'sell' WHEN exact IS NOT NULL THEN 'buy' END AS side FROM exact""",
    "trade_rows_from_pages": f"WITH {TRADES} SELECT {STORED_TRADES.format(symbol='sym')} FROM trades",
    "trades_time_range": f"""WITH {TRADES}
SELECT id, mts, CASE WHEN amount >= 0 THEN 'buy' ELSE 'sell' END AS side FROM trades WHERE {RANGE}""",
    "parsed_instants": f"""
SELECT event_id, m AS mts, {instant("m")} AS instant, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant_seconds,
  strftime(ts, '%Y-%m-%d') AS day
FROM (SELECT *, CASE event_type WHEN 'click' THEN epoch_us(ts) // 1000000 * 1000 ELSE {MS} END AS m FROM events)""",
    "first_n_trades": f"""WITH {TRADES}
SELECT id, mts, {decimal_text("amount")} AS amount FROM trades ORDER BY mts, id LIMIT 500""",
    "first_n_trades_by_rank": f"""WITH {TRADES}
SELECT id, mts, {decimal_text("amount")} AS amount FROM trades ORDER BY mts, id LIMIT 5000""",
    "first_n_trades_bounded": f"""WITH {TRADES}
SELECT id, mts, {decimal_text("amount")} AS amount FROM trades ORDER BY mts, id LIMIT 2000""",
    "recent_page": f"""WITH {TRADES}, newest AS (SELECT * FROM trades ORDER BY mts DESC, id DESC LIMIT 1000)
SELECT id, mts, {decimal_text("price")} AS price FROM newest ORDER BY mts, id LIMIT 300""",
    "daily_trade_counts": f"""WITH {TRADES}
SELECT sym AS symbol, cast(day AS varchar) AS date, count(*) AS trades FROM trades GROUP BY ALL""",
    "last_trade_per_completed_day": f"""WITH {LAST_DAYS}
SELECT symbol, cast(day AS varchar) AS date, last_trade_mts, last_trade_id FROM completed""",
    "resume_filter": f"""WITH {LAST_DAYS},
points AS (
  SELECT symbol, max(last_trade_mts) AS last_mts, count(*) AS days FROM completed GROUP BY 1
),
resumed AS (
  SELECT symbol, greatest(CASE WHEN symbol = 'tview' THEN 1706600000000 END, last_mts + 1) AS start_mts,
    last_mts + 1 AS cursor, greatest(0, 20 - days) AS remaining FROM points
)
SELECT t.sym AS symbol, t.id, t.mts, r.start_mts, r.cursor, r.remaining
FROM trades t JOIN resumed r ON r.symbol = t.sym WHERE t.mts >= r.start_mts""",
    "page_high_water_mark": f"WITH {TRADES} SELECT sym AS symbol, max(mts) AS max_mts FROM trades GROUP BY 1",
    "daily_parquet_roundtrip": f"""WITH {TRADES}
SELECT {STORED_TRADES.format(symbol="'tBTCUSD'")}, strftime(day, 'tbtcusd_%y-%m-%d.parquet') AS file_name FROM trades""",
    "compacted_history": f"""WITH {TRADES}
SELECT {STORED_TRADES.format(symbol="'tBTCUSD'")} FROM trades""",
    "stored_day_extents": f"""WITH {TRADES}
SELECT cast(day AS date) AS date, count(*) AS rows, min(mts) AS first, max(mts) AS last FROM trades GROUP BY 1""",
    "resumed_history": f"""WITH {TRADES}
SELECT id, mts, CASE WHEN amount >= 0 THEN 'buy' ELSE 'sell' END AS side, {decimal_text("price")} AS price FROM trades""",
    "quarantine_page_rows": """
WITH verdicts(event_type, row_index, problem) AS (VALUES
  ('view', 0, 'good'), ('view', 1, 'not an array'), ('view', 2, 'fewer than 4 fields'),
  ('click', 0, 'ID is not an integer'), ('click', 1, 'good'), ('click', 2, 'MTS is not an integer'),
  ('purchase', 0, 'AMOUNT is not a decimal'), ('purchase', 1, 'PRICE is not a decimal'),
  ('signup', 0, 'rate limited page'), ('error', 0, 'not an array'))
SELECT 't' || event_type AS symbol, row_index, problem, count(*) AS rows FROM events JOIN verdicts USING (event_type) GROUP BY ALL""",
    "instruments_last_write_wins": f"""WITH {terms()}
SELECT 'deribit' AS exchange, 'BTC' AS symbol, instrument_name, kind, cast(NULL AS varchar) AS state, base_currency,
  cast(NULL AS varchar) AS quote_currency, cast(NULL AS varchar) AS settlement_currency,
  cast(NULL AS varchar) AS counter_currency, cast(NULL AS varchar) AS instrument_type,
  cast(NULL AS varchar) AS future_type, settlement_period, option_type, cast(NULL AS varchar) AS price_index,
  strike, contract_size, tick_size, expiration_timestamp, cast(NULL AS bigint) AS creation_timestamp,
  cast(NULL AS bigint) AS instrument_id, is_active
FROM terms""",
    "discovery_filter": DISCOVERED,
    "creation_filter": CREATED,
    "heartbeat_filter": "SELECT event_id FROM events WHERE event_type = 'signup' AND user_id % 2 = 0",
    "new_instruments_anti": f"SELECT instrument_name FROM ({CREATED}) EXCEPT SELECT instrument_name FROM ({DISCOVERED})",
    "new_instrument_count": f"""
SELECT count(*) AS instruments FROM (SELECT instrument_name FROM ({CREATED}) EXCEPT SELECT instrument_name FROM ({DISCOVERED}))""",
    "explode_trade_messages": f"WITH {TRADE_ROWS} SELECT r.line_no, {TRADE_COLUMNS} FROM trade_rows r",
    "trades_enriched": f"""WITH {terms()},{TRADE_ROWS}
SELECT {TRADE_COLUMNS}, {TERM_COLUMNS} FROM trade_rows r LEFT JOIN terms t USING (instrument_name)""",
    "trades_enriched_salted": f"""WITH {terms()},{TRADE_ROWS}
SELECT r.line_no, r.instrument_name, r.price, t.kind, t.strike, t.option_type
FROM trade_rows r LEFT JOIN terms t USING (instrument_name)""",
    "ticker_enriched": TICKER_ENRICHED,
    "normalize_counts": f"""WITH {terms(per_day=True)},{TRADE_ROWS},{TICKER_ROWS}
SELECT 'instruments' AS dataset, day, count(*) AS rows, count(strike) AS with_terms FROM terms GROUP BY ALL
UNION ALL SELECT 'incremental_ticker', r.day, count(*), count(t.kind)
FROM ticker_rows r LEFT JOIN terms t USING (day, instrument_name) GROUP BY ALL
UNION ALL SELECT 'trades', r.day, count(*), count(t.kind)
FROM trade_rows r LEFT JOIN terms t USING (day, instrument_name) GROUP BY ALL""",
    "normalized_trades": f"""WITH {terms(per_day=True)},{TRADE_ROWS}
SELECT r.day, r.instrument_name, r.price, r.trade_id, t.kind, t.strike, t.option_type
FROM trade_rows r LEFT JOIN terms t USING (day, instrument_name)""",
    "capture_files_normalized": f"""WITH {terms(per_day=True)},{TRADE_ROWS}
SELECT r.day, r.instrument_name, r.price, r.trade_id, t.kind, t.strike, t.option_type
FROM trade_rows r LEFT JOIN terms t USING (day, instrument_name) WHERE r.day = '2026-06-30'""",
    "capture_files_counts": f"""WITH {terms(per_day=True)},{TRADE_ROWS}
SELECT 'instruments' AS dataset, '2026-06-30' AS day, count(*) AS rows FROM terms WHERE day = '2026-06-30'
UNION ALL SELECT 'incremental_ticker', '2026-06-30', 0
UNION ALL SELECT 'trades', '2026-06-30', count(*) FROM trade_rows WHERE day = '2026-06-30'""",
    "capture_file_listing": f"""WITH {CAPTURED}
SELECT DISTINCT 'deribit' AS exchange, 'btc' AS symbol, channel, concat('btc_', channel, '_', strftime(day, '%y-%m-%d'), '.jsonl.gz') AS file,
  true AS has_bytes, true AS has_time FROM captured""",
    "capture_file_heads": f"""WITH {CAPTURED}
SELECT channel, received_mts, true AS has_payload FROM (
  SELECT channel, epoch_ms(cast(day AS timestamp)) + line_no % 86400000 AS received_mts,
    row_number() OVER (PARTITION BY channel, day ORDER BY line_no % 86400000) AS place FROM captured) WHERE place <= 3""",
    "required_columns_hold": f"""WITH {TRADE_ROWS}
SELECT count_if(received_mts IS NULL) AS exchange, count_if(received_mts IS NULL) AS symbol,
  count_if(received_mts IS NULL) AS received_at, count_if(received_mts IS NULL) AS received_mts,
  count_if(received_mts IS NULL) AS connection_id, count_if(sub IS NULL) AS subscription_channel,
  count_if(instrument_name IS NULL) AS instrument_name FROM trade_rows""",
    "quarantine_payloads": """
SELECT kind, problem, count(*) AS rows FROM (
  SELECT event_type AS kind, CASE WHEN event_type = 'error' THEN 'invalid JSON' ELSE 'good' END AS problem FROM events
  UNION ALL
  SELECT 'control', CASE WHEN p_brand = 'Brand#1' THEN 'error response' ELSE 'good' END FROM part) GROUP BY ALL""",
    "error_responses": """SELECT p_partkey AS line_no, '{"code":10}' AS error FROM part WHERE p_brand = 'Brand#1'""",
    "json_scalars": f"""
SELECT event_id, CASE WHEN event_id >= 100 THEN event_id - 100 END AS response_id, as_text,
  CASE WHEN event_type = 'signup' AND user_id % 2 = 1 THEN event_id END AS as_integer,
  CASE WHEN event_type = 'signup' AND user_id % 2 = 0 THEN true END AS as_boolean, as_text AS nested_text
FROM (SELECT *, CASE event_type WHEN 'view' THEN cast(value AS varchar)
  WHEN 'click' THEN json_extract_string(props, '$.k')
  WHEN 'purchase' THEN {scaled("value", "e-9")}
  WHEN 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE cast(event_id AS varchar) END
  ELSE CASE WHEN user_id % 2 = 1 THEN {scaled("value", "e18")} END END AS as_text FROM events)""",
    "message_parts": """
SELECT event_id AS line_no, CASE event_type WHEN 'view' THEN 'incremental_ticker.P-' || user_id
    WHEN 'click' THEN 'incremental_ticker.Q-' || user_id WHEN 'signup' THEN 'incremental_ticker.' || user_id END AS message_channel,
  event_type <> 'error' AS has_data, CASE WHEN event_type <> 'error' THEN '2.0' END AS version
FROM events""",
    "symbol_partition_names": """
SELECT name, lower(regexp_replace(name, '[^A-Za-z0-9_-]', '_', 'g')) AS partition_name FROM (
  SELECT url AS name FROM pages UNION ALL SELECT c_name FROM customer UNION ALL SELECT text FROM documents)""",
    "channel_names": """
SELECT 'P-' || p_partkey AS instrument_name, unnest(['incremental_ticker.P-' || p_partkey, 'trades.P-' || p_partkey || '.agg2',
  'instrument.creation.' || lower(p_type) || '.BTC', 'instrument.state.' || lower(p_type) || '.BTC']) AS channel FROM part""",
    "subscribed_channels": f"""
SELECT instrument_name, unnest(['incremental_ticker.' || instrument_name, 'trades.' || instrument_name || '.100ms']) AS channel
FROM (SELECT DISTINCT instrument_name FROM ({DISCOVERED}))""",
    "market_pick": """
WITH ranked AS (
  SELECT c_nationkey AS nation, c_custkey AS position,
    CASE WHEN c_acctbal > 9000 THEN 0 WHEN c_acctbal < 0 THEN 1 WHEN c_acctbal < 5000 THEN 2 END AS match_rank FROM customer)
SELECT nation, position, match_rank FROM ranked WHERE match_rank IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY nation ORDER BY match_rank, position) = 1""",
    "stored_file_names": f"""
SELECT o_orderkey, s || strftime(o_orderdate, '_%y-%m-%d.parquet') AS daily,
  s || strftime(o_orderdate, '_trades_%y-%m-%d.jsonl.zst') AS stream,
  strftime(o_orderdate, 'btc_trades_%y-%m-%d.parquet') AS normalized, {decimal_text("cast(o_totalprice AS decimal(18,2))")} AS total
FROM (SELECT *, lower(regexp_replace(o_orderpriority, '[^A-Za-z0-9_-]', '_', 'g')) AS s FROM orders)""",
    "payload_expand": """
SELECT event_id AS id, 'props' AS origin, 'object' AS kind, cast(json_extract(props, '$.k') AS bigint) AS k, cast(NULL AS varchar) AS raw_text FROM events
UNION ALL SELECT doc_id, 'text', 'text', NULL, text FROM documents
UNION ALL SELECT doc_id, 'none', NULL, NULL, NULL FROM labels""",
    "exchange_filter": f"""
SELECT event_id, 'spot_market_data' AS channel, {SPOT_TEXT} AS text FROM events""",
    "stream_route_land": f"""WITH {FRAMES}
SELECT exchange, symbol, stored AS channel, count(*) AS messages FROM frames GROUP BY ALL""",
    "stream_lines_land": f"""WITH {FRAMES}
SELECT exchange, symbol, stored AS channel, count(*) AS messages FROM frames GROUP BY ALL""",
    "landed_by_channel": f"""WITH {FRAMES}
SELECT exchange, symbol, stored AS channel, count(*) AS messages,
  CASE WHEN stored IN ('trades', 'control', 'incremental_ticker') THEN stored ELSE 'rest' END AS place FROM frames GROUP BY ALL""",
    "landed_batch_stream_batch": f"""WITH {FRAMES}
SELECT exchange, symbol, stored AS channel, 3 * count(*) AS messages FROM frames GROUP BY ALL""",
    "history_batch_then_stream": f"WITH {TRADES} SELECT {STORED_TRADES.format(symbol=repr('tBTCUSD'))} FROM trades",
    "stream_terms_between_batches": f"""WITH {terms()},{TICKER_ROWS}
SELECT r.instrument_name, count(*) AS rows, count(CASE WHEN r.day = '2026-06-30' THEN t.kind END) AS with_terms
FROM ticker_rows r LEFT JOIN terms t USING (instrument_name) GROUP BY 1""",
    "stream_first_seen": f"""
SELECT instrument_name, unnest(['incremental_ticker.' || instrument_name, 'trades.' || instrument_name || '.100ms']) AS channel
FROM (SELECT DISTINCT instrument_name FROM ({CREATED}))""",
    "stream_normalize": TICKER_ENRICHED,
    "stream_late_terms": TICKER_ENRICHED,
    "stream_history": f"WITH {TRADES} SELECT {STORED_TRADES.format(symbol=repr('tBTCUSD'))} FROM trades",
}
