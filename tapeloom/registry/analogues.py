"""Market messages derived row by row from the test tables, for the registered queries.

Roles: instrument = `part` (P-<p_partkey>), instrument update and ticker message = `events`,
trade message = `lineitem`, trade page = `events`, other frames = `documents`. Every message is
made from one row, so deriving them needs no shuffle and no group is ever gathered.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeloom.sources.raw_capture import stored_bytes

# A task gets this many stored bytes of a table: some 100,000 rows, whose messages take seconds to parse.
TASK_BYTES = 2 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, spread over tasks of a few stored bytes each.

    Parsing is the costly step: a file with one row group would be parsed by one task, and a split of
    usual size holds millions of rows. The rows are small, so a shuffle of them costs little.
    """
    return spread(spark.read.parquet(_path(sf_dir, name)), sf_dir, name)


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame, sf_dir: str, name: str) -> DataFrame:
    spark = df.sparkSession
    size = stored_bytes(spark, _path(sf_dir, name))
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    return df.repartition(tasks) if size > 64 * 1024 else df


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_millis(table(spark, sf_dir, "events"))


def with_millis(events: DataFrame) -> DataFrame:
    """Events with `ts` as an instant and `mts` in epoch milliseconds."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("mts", F.unix_millis("ts"))


def json_object(**members: str) -> str:
    """SQL text of a JSON object whose members are SQL expressions giving JSON text."""
    parts = [f"""'"{name}":', {value}""" for name, value in members.items()]
    return "concat('{', " + ", ',', ".join(parts) + ", '}')"


def number(expression: str, suffix: str = "") -> str:
    """SQL text of a JSON number, with an optional exponent."""
    return f"concat(cast({expression} as string), '{suffix}')"


def text(expression: str) -> str:
    """SQL text of a JSON string (for contents without characters to escape)."""
    return f"concat('\"', {expression}, '\"')"


def subscription(channel: str, data: str) -> str:
    params = json_object(channel=text(channel), data=data)
    return json_object(jsonrpc="'\"2.0\"'", method="'\"subscription\"'", params=params)


def as_events(df: DataFrame, payload: str, channel: str, order: str, mts: str, day: str) -> DataFrame:
    """Envelope rows with the given payload, stored channel, order and receipt."""
    return df.select(
        F.date_format(F.timestamp_millis(F.expr(mts)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("received_at"),
        F.expr(mts).alias("received_mts"),
        F.lit("deribit").alias("exchange"),
        F.lit("BTC").alias("symbol"),
        F.expr(channel).alias("channel"),
        F.lit("deribit-BTC-instruments").alias("connection_id"),
        F.expr(payload).alias("payload_text"),
        F.expr(order).alias("line_no"),
        F.expr(day).alias("date"),
    )


DAYS = (dt.date(2026, 6, 29), dt.date(2026, 6, 30))


def two_days(condition: str) -> str:
    """The receipt day of a message, one of two."""
    return f"if({condition}, DATE'{DAYS[0]}', DATE'{DAYS[1]}')"


# Ticker messages -------------------------------------------------------------------------------

_TICKER_FULL = json_object(
    timestamp=number("mts"),
    type="'\"snapshot\"'",
    state="'\"open\"'",
    instrument_name=text("concat('P-', user_id)"),
    best_bid_price=number("value"),
    best_bid_amount=number("value", "e18"),
    best_ask_price=number("value", "e-3"),
    mark_price=number("value", "e-9"),
    open_interest=number("user_id"),
    underlying_index="'\"SYN.1.0E-7\"'",
    index_price="'\"7.5E-20\"'",
    last_price="'true'",
    bid_iv="'null'",
    stats=json_object(volume=number("value"), high="'null'", low="'[1]'", volume_usd="'{\"a\":1}'"),
    greeks=json_object(delta="'-0.0'", gamma=number("value", "e-9"), rho="'60000.0'"),
    ignored="'{\"deep\":[1,2,3]}'",
)
_TICKER_SPARSE = json_object(
    timestamp="'\"17\"'",
    type="'\"change\"'",
    instrument_name=text("concat('Q-', user_id)"),
    mark_price=text("cast(value as string)"),
    stats="'null'",
    greeks="'7'",
)
TICKER_PAYLOAD = f"""
CASE event_type
  WHEN 'view' THEN {subscription("concat('incremental_ticker.P-', user_id)", _TICKER_FULL)}
  WHEN 'click' THEN {subscription("concat('incremental_ticker.Q-', user_id)", _TICKER_SPARSE)}
  WHEN 'purchase' THEN {json_object(jsonrpc="'\"2.0\"'", data=_TICKER_FULL)}
  WHEN 'signup' THEN {subscription("concat('incremental_ticker.', user_id)", json_object(instrument_name=number("user_id")))}
  ELSE {json_object(params=json_object(data="'null'"), data=_TICKER_FULL)}
END"""


def ticker_events(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """view: full row; click: sparse row without terms; purchase: top-level data, no channel;
    signup: name is a number; error: explicit null data. The last two give no ticker row."""
    events = events_table(spark, sf_dir) if source is None else source
    day = two_days("event_type IN ('view', 'click')")
    return as_events(events, TICKER_PAYLOAD, "'incremental_ticker'", "event_id", "mts", day)


# Trade messages --------------------------------------------------------------------------------

_TRADE = json_object(
    timestamp=number("unix_millis(cast(l_shipdate as timestamp))"),
    iv=number("l_discount"),
    price=number("l_extendedprice"),
    amount=number("l_quantity"),
    direction="if(l_returnflag = 'R', '\"sell\"', '\"buy\"')",
    index_price=number("l_extendedprice", "e-12"),
    instrument_name=text("concat('P-', l_partkey)"),
    trade_seq=number("l_suppkey"),
    tick_direction=number("l_linenumber"),
    contracts="'null'",
    trade_id=text("concat(l_orderkey, '-', l_linenumber)"),
    liquidation=text("l_linestatus"),
    block_rfq_id="'5.0'",
)
_UNLISTED_TRADE = json_object(
    instrument_name=text("concat('X-', l_partkey)"), trade_seq=number("l_orderkey"), price=number("l_tax")
)
_TRADES_CHANNEL = "concat('trades.P-', l_partkey, '.100ms')"
TRADE_PAYLOAD = f"""
CASE l_linenumber
  WHEN 1 THEN {subscription(_TRADES_CHANNEL, _TRADE)}
  WHEN 2 THEN {subscription(_TRADES_CHANNEL, f"concat('[', {_TRADE}, ']')")}
  WHEN 3 THEN {subscription(_TRADES_CHANNEL, f"concat('[', {_TRADE}, ', \"junk\", 5, null, [1], ', {_UNLISTED_TRADE}, ']')")}
  WHEN 4 THEN {subscription(_TRADES_CHANNEL, f"concat('[', {_UNLISTED_TRADE}, ',{{\"instrument_name\":5}},{{\"price\":1}}]')")}
  WHEN 5 THEN {json_object(jsonrpc="'\"2.0\"'", data=f"concat('[', {_TRADE}, ']')")}
  WHEN 6 THEN {json_object(params=json_object(channel=number("l_partkey"), data="'null'"), data=_TRADE)}
  ELSE {subscription(_TRADES_CHANNEL, "'\"[]\"'")}
END"""


def trade_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By line number: 1 lone object, 2 array, 3 mixed array with an unlisted instrument, 4 bad
    elements, 5 top-level data without a channel, 6 explicit null data, 7 data is a text."""
    lineitem = table(spark, sf_dir, "lineitem")
    day = two_days("l_linestatus = 'F'")
    mts = "unix_millis(cast(l_shipdate as timestamp)) + l_linenumber"
    return as_events(lineitem, TRADE_PAYLOAD, "'trades'", "l_orderkey", mts, day)


# Instrument messages ---------------------------------------------------------------------------

_KIND = "element_at(array('option', 'future', 'spot'), cast(p_size % 3 + 1 as int))"
_CURRENCY = "if(p_size % 4 = 0, 'ETH', 'BTC')"
_LISTED = json_object(
    instrument_name=text("concat('P-', p_partkey)"),
    kind=text(_KIND),
    base_currency=text(_CURRENCY),
    product_group="if(p_size % 8 = 0, '\"BTC\"', 'null')",
    strike=number("p_retailprice"),
    option_type="if(p_size % 2 = 0, '\"put\"', '\"call\"')",
    settlement_period=text("p_type"),
    expiration_timestamp=number("1785484800000 + p_partkey"),
    instrument_id=number("p_partkey", ".0"),
    is_active="element_at(array('false', 'true', 'null', '\"false\"', '1'), cast(p_size % 5 + 1 as int))",
    tick_size="'0.00001'",
    contract_size="'1e-6'",
)
_RELISTED = json_object(
    instrument_name=text("concat('P-', p_partkey)"), kind="'\"option\"'", strike=number("p_size")
)
CONTROL_PAYLOAD = f"""
CASE p_brand
  WHEN 'Brand#1' THEN {json_object(jsonrpc="'\"2.0\"'", id=number("p_partkey"), error="'{\"code\":10}'")}
  WHEN 'Brand#2' THEN {json_object(jsonrpc="'\"2.0\"'", id="'-1'", result="'[\"ack\", 5]'")}
  WHEN 'Brand#3' THEN {json_object(jsonrpc="'\"2.0\"'", id=text("p_partkey"), result=_LISTED)}
  WHEN 'Brand#4' THEN {json_object(jsonrpc="'\"2.0\"'", id=number("p_partkey"), result=f"concat('[', {_LISTED}, ', \"ack\",', {_RELISTED}, ']')")}
  ELSE {json_object(jsonrpc="'\"2.0\"'", id=number("p_partkey"), result=f"concat('[', {_LISTED}, ', null, {{\"kind\":\"option\"}}]')")}
END"""


def control_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand 1: error; 2: acknowledgements; 3: result is no array; 4: listed twice; else listed."""
    part = table(spark, sf_dir, "part")
    return as_events(
        part, CONTROL_PAYLOAD, "'control'", "p_partkey", "1782771428192 + p_partkey", two_days("p_size < 25")
    )


def _creation(channel: str, **members: str) -> str:
    data = json_object(instrument_name=text("concat('P-', user_id)"), **members)
    return subscription(channel, data)


_STRIKE = number("value")
CREATION_PAYLOAD = f"""
CASE event_type
  WHEN 'view' THEN {_creation("'instrument.creation.option.BTC'", kind="'\"option\"'", base_currency="'\"BTC\"'", strike=_STRIKE)}
  WHEN 'click' THEN {_creation("'instrument.creation.future.ETH'", kind="'\"future\"'", base_currency="'\"ETH\"'", strike=_STRIKE)}
  WHEN 'purchase' THEN {_creation("'instrument.creation.option.BTC'", base_currency="'7'", strike=_STRIKE)}
  WHEN 'signup' THEN {_creation("'instrument.creation.spot.BTC'", kind="'\"spot\"'", strike=_STRIKE)}
  ELSE {_creation("'instrument.state.option.BTC'", kind="'\"option\"'", strike=_STRIKE)}
END"""


def creation_events(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    events = events_table(spark, sf_dir) if source is None else source
    day = two_days("event_type IN ('view', 'click')")
    return as_events(events, CREATION_PAYLOAD, "'instrument_creation'", "event_id", "mts", day)


def capture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of the derivatives venue, received on their day in the order of their `line_no`."""
    parts = [make(spark, sf_dir) for make in (control_events, creation_events, ticker_events, trade_events)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    instant = F.unix_millis(F.col("date").cast("timestamp")) + F.pmod("line_no", F.lit(86_400_000))
    received = F.date_format(F.timestamp_millis(instant), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return rows.withColumns({"received_mts": instant, "received_at": received, "payload_base64": F.lit(None).cast("string")})


# Other frames ----------------------------------------------------------------------------------

FRAME_TEXT = f"""
CASE event_type
  WHEN 'view' THEN {subscription("concat('incremental_ticker.P-', user_id)", "props")}
  WHEN 'click' THEN {subscription("concat('trades.P-', user_id, '.100ms')", "'[]'")}
  WHEN 'purchase' THEN {subscription("'instrument.creation.future.BTC'", "'{}'")}
  WHEN 'signup' THEN {json_object(jsonrpc="'\"2.0\"'", method="'\"heartbeat\"'", params="if(user_id % 2 = 0, '{\"type\":\"test_request\"}', '{\"type\":5}')")}
  ELSE concat('frame ', event_id)
END"""
SPOT_TEXT = """
CASE event_type
  WHEN 'view' THEN '{"channel":"trades","data":[]}'
  WHEN 'click' THEN '{"channel":"l2Book","data":{}}'
  WHEN 'purchase' THEN '{"event":"connected"}'
  WHEN 'signup' THEN '{"event":"disconnected"}'
  ELSE '{"channel":"other"}'
END"""


def received_messages(events: DataFrame) -> DataFrame:
    """Frames of three venues, one per event and venue, as a recorder receives them."""
    frames = [
        ("'deribit'", "'BTC'", "'instrument_lifecycle'", "'deribit-BTC-instruments'", FRAME_TEXT),
        ("'hyperliquid'", "'spot_btc'", "'spot_market_data'", "'hyperliquid-spot-btc'", SPOT_TEXT),
        ("'bitfinex'", "'tBTCUSD'", "'trades'", "'bitfinex-tBTCUSD-trades'", "props"),
    ]
    structs = ", ".join(
        f"struct({e} AS exchange, {s} AS symbol, {c} AS channel, {i} AS connection_id, {t} AS text)"
        for e, s, c, i, t in frames
    )
    return events.select("ts", "event_id", F.expr(f"inline(array({structs}))"))


# Trade pages -----------------------------------------------------------------------------------

_SIGNED = "concat(if(user_id % 2 = 0, '-', ''), cast(value as string))"
_ROW_NUMBERS = f"concat('[', event_id, ',', mts, ',', {_SIGNED}, ',', value, ',\"extra\",7]')"
_ROW_TEXTS = f"""concat('["', event_id, '","', mts, '","', {_SIGNED}, '","', value, '"]')"""
PAGE = f"""
CASE event_type
  WHEN 'view' THEN concat('[', {_ROW_NUMBERS}, ']')
  WHEN 'click' THEN concat('[', {_ROW_TEXTS}, ',', {_ROW_NUMBERS}, ']')
  WHEN 'purchase' THEN concat('[', {_ROW_TEXTS}, ', ', {_ROW_TEXTS}, ', ', {_ROW_NUMBERS}, ']')
  ELSE concat('[', {_ROW_NUMBERS}, ']')
END"""
BAD_PAGE = f"""
CASE event_type
  WHEN 'view' THEN concat('[', {_ROW_NUMBERS}, ',5,[1,2,3]]')
  WHEN 'click' THEN concat('[[5.5,', mts, ',1,1],', {_ROW_TEXTS}, ',[', event_id, ',true,1,1]]')
  WHEN 'purchase' THEN concat('[[', event_id, ',', mts, ',\"x\",1],[', event_id, ',', mts, ',1,null]]')
  WHEN 'signup' THEN '{{"error":"ERR_RATE_LIMIT"}}'
  ELSE concat('page ', event_id)
END"""


def trade_pages(spark: SparkSession, sf_dir: str, page: str = PAGE) -> DataFrame:
    """One page per event; click and purchase pages repeat their trade, as overlapping pages do."""
    events = events_table(spark, sf_dir)
    return events.select(F.expr(page).alias("page"), F.concat(F.lit("t"), "event_type").alias("symbol"))
