"""Fixed schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, versions and layouts that stored data depends on.
HISTORY_EXCHANGE = "bitfinex"
HISTORY_DEFAULT_SYMBOL = "tBTCUSD"
DERIVATIVES_EXCHANGE = "deribit"
DERIVATIVES_SYMBOL = "BTC"
DERIVATIVES_CONNECTION = "deribit-BTC-instruments"
DERIVATIVES_KINDS = ("future", "option")
TRADES_INTERVALS = ("raw", "100ms", "agg2")
DEFAULT_TRADES_INTERVAL = "100ms"
RATE_LIMIT_ERROR = "ERR_RATE_LIMIT"
CHECKPOINT_VERSION = 1
MAX_PAGE_TRADES = 10_000
NORMALIZE_CHANNELS = ("control", "instrument_creation", "incremental_ticker", "trades")
VENUES = ("bitfinex", "extended", "hibachi", "deribit", "hyperliquid")
DEFAULT_VENUES = ("bitfinex", "hibachi", "deribit", "hyperliquid")
PARQUET_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3"}


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.LongType(), "b": T.BooleanType()}
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, kinds[kind[0]], nullable=not kind.endswith("!")))
    return T.StructType(fields)


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable]


# Capture envelope, one JSON object per line. s = text, i = 64-bit integer, b = boolean, ! = required.
ENVELOPE = _struct(
    "received_at:s! received_mts:i! exchange:s! symbol:s! channel:s! connection_id:s!"
    " payload_text:s payload_base64:s"
)

# Trade history, one row per trade.
TRADES = _struct(
    "exchange:s! symbol:s! id:i! mts:i! timestamp:s! side:s! amount:s! amount_abs:s! price:s!"
)

# Contract terms, one row per instrument.
INSTRUMENTS = _struct(
    "exchange:s! symbol:s! instrument_name:s! kind:s state:s base_currency:s quote_currency:s"
    " settlement_currency:s counter_currency:s instrument_type:s future_type:s"
    " settlement_period:s option_type:s price_index:s strike:s contract_size:s tick_size:s"
    " expiration_timestamp:i creation_timestamp:i instrument_id:i is_active:b"
)

# Ticker rows, enriched with five contract terms.
INCREMENTAL_TICKER = _struct(
    "exchange:s! symbol:s! received_at:s! received_mts:i! connection_id:s!"
    " subscription_channel:s! instrument_name:s! kind:s expiration_timestamp:i strike:s"
    " option_type:s settlement_period:s ticker_timestamp:i ticker_type:s state:s"
    " best_bid_price:s best_bid_amount:s best_ask_price:s best_ask_amount:s index_price:s"
    " mark_price:s last_price:s underlying_price:s underlying_index:s open_interest:s"
    " settlement_price:s estimated_delivery_price:s min_price:s max_price:s bid_iv:s ask_iv:s"
    " mark_iv:s funding_8h:s current_funding:s stats_volume:s stats_volume_usd:s"
    " stats_volume_notional:s stats_high:s stats_low:s stats_price_change:s delta:s gamma:s"
    " theta:s vega:s rho:s"
)

# Derivatives trade rows, enriched with five contract terms.
DERIVATIVES_TRADES = _struct(
    "exchange:s! symbol:s! received_at:s! received_mts:i! connection_id:s!"
    " subscription_channel:s! instrument_name:s! kind:s expiration_timestamp:i strike:s"
    " option_type:s settlement_period:s trade_timestamp:i trade_id:s trade_seq:i direction:s"
    " tick_direction:i price:s amount:s contracts:s mark_price:s index_price:s iv:s"
    " liquidation:s block_trade_id:s combo_id:s combo_trade_id:s block_rfq_id:i"
)

# Completed-day checkpoint, one row per save.
CHECKPOINT = T.StructType(
    [
        T.StructField("version", T.ByteType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("symbol_partition", T.StringType(), False),
        T.StructField("last_completed_date", T.StringType(), False),
        T.StructField("last_trade_mts", T.LongType(), False),
        T.StructField("last_trade_id", T.LongType(), False),
        T.StructField("next_start_mts", T.LongType(), False),
        T.StructField("updated_at", T.StringType(), False),
    ]
)

# The five columns a fact takes from the contract terms.
TERM_COLUMNS = ("kind", "expiration_timestamp", "strike", "option_type", "settlement_period")

# Payload fields behind the ticker columns whose name differs from the field name.
TICKER_RENAMED = {"ticker_timestamp": "timestamp", "ticker_type": "type"}
TRADE_RENAMED = {"trade_timestamp": "timestamp"}
TICKER_STATS = ("volume", "volume_usd", "volume_notional", "high", "low", "price_change")
TICKER_GREEKS = ("delta", "gamma", "theta", "vega", "rho")

DATASETS = {
    "instruments": INSTRUMENTS,
    "incremental_ticker": INCREMENTAL_TICKER,
    "trades": DERIVATIVES_TRADES,
}
