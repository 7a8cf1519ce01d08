"""Mappings of venue messages. Field names and stream names are the venues' own: fixed values."""

from __future__ import annotations

from tickloom.operators.normalize import Field as F
from tickloom.operators.normalize import Mapping_ as M

_TICKER = (
    F("change", "p"), F("change_percent", "P"), F("average", "w"), F("last", "c"), F("last_amount", "Q"), F("open", "o"), F("high", "h"),
    F("low", "l"), F("volume", "v"), F("quote_volume", "q"), F("window_start_ns", "O", "ms"), F("window_end_ns", "C", "ms"),
    F("first_trade_id", "F", "uint", False), F("last_trade_id", "L", "uint", False), F("trades", "n", "uint"),
)
_QUOTE = (F("symbol", "s", "text"), F("update_id", "u", "uint"), F("bid_price", "b"), F("bid_amount", "B"), F("ask_price", "a"), F("ask_amount", "A"))
_DEPTH = (
    F("symbol", "s", "text"), F("event_time_ns", "E", "ms"), F("first_sequence", "U", "uint"), F("last_sequence", "u", "uint"),
    F("bids", "b", "levels"), F("asks", "a", "levels"),
)
_AGGREGATE = (
    F("symbol", "s", "text"), F("native_trade_id", "a", "uint"), F("price", "p"), F("amount", "q"), F("first_trade_id", "f", "uint"),
    F("last_trade_id", "l", "uint"), F("trade_time_ns", "T", "ms"), F("event_time_ns", "E", "ms"), F("side", "m", "maker"),
)
_LIQUIDATION = (
    F("symbol", "o.s", "text"), F("side", "o.S", "side"), F("price", "o.p"), F("average_price", "o.ap"), F("amount", "o.q"),
    F("filled", "o.z"), F("status", "o.X", "text"), F("trade_time_ns", "o.T", "ms"), F("event_time_ns", "E", "ms"),
)
_MARK = (
    F("symbol", "s", "text"), F("mark_price", "p"), F("index_price", "i"), F("settle_price", "P", "decimal", False),
    F("funding_rate", "r", "decimal", False), F("next_funding_ns", "T", "ms"), F("event_time_ns", "E", "ms"),
)

SPOT = {
    "trade": M(
        "trade",
        (F("symbol", "s", "text"), F("native_trade_id", "t", "uint"), F("price", "p"), F("amount", "q"), F("trade_time_ns", "T", "ms"),
         F("event_time_ns", "E", "ms"), F("side", "m", "maker"), F("native_ignore", "M", "flag")),
        ("e", "trade"), fixed={"aggregation": "single_match", "duplicate_status": "unassessed_raw_row"},
    ),
    "depth": M("book_update", _DEPTH, ("e", "depthUpdate"), fixed={"update_kind": "delta"}),
    "ticker": M("ticker", (F("symbol", "s", "text"), F("event_time_ns", "E", "ms"), *_TICKER), ("e", "24hrTicker")),
    "quote": M("quote", _QUOTE, ("u", "[0-9]+")),
}
SPOT_SNAPSHOT = M(
    "book_update", (F("last_sequence", "lastUpdateId", "uint"), F("bids", "bids", "levels"), F("asks", "asks", "levels")), fixed={"update_kind": "snapshot"}
)
USDM = {
    "trade": M("trade", (*_AGGREGATE, F("normal_amount", "nq", "decimal", False)), ("e", "aggTrade"), fixed={"aggregation": "taker_order"}),
    "depth": M("book_update", (*_DEPTH, F("previous_sequence", "pu", "uint"), F("trade_time_ns", "T", "ms")), ("e", "depthUpdate"), fixed={"update_kind": "delta"}),
    "ticker": M("ticker", (F("symbol", "s", "text"), F("event_time_ns", "E", "ms"), *_TICKER), ("e", "24hrTicker")),
    "mark": M("derivative_ticker", _MARK, ("e", "markPriceUpdate")),
    "liquidation": M("liquidation", _LIQUIDATION, ("e", "forceOrder"), fixed={"completeness": "largest_in_window"}),
    "quote": M("quote", (*_QUOTE, F("event_time_ns", "E", "ms")), ("e", "bookTicker")),
}
COINM = {
    "trade": M("trade", (*_AGGREGATE, F("pair", "ps", "text", False)), ("e", "aggTrade"), fixed={"aggregation": "taker_order", "amount_unit": "contracts"}),
    "depth": M("book_update", (*_DEPTH, F("previous_sequence", "pu", "uint"), F("pair", "ps", "text", False)), ("e", "depthUpdate"), fixed={"update_kind": "delta"}),
    "ticker": M("ticker", (F("symbol", "s", "text"), F("pair", "ps", "text", False), F("event_time_ns", "E", "ms"), *_TICKER), ("e", "24hrTicker")),
    "mark": M("derivative_ticker", _MARK, ("e", "markPriceUpdate")),
    "liquidation": M("liquidation", _LIQUIDATION, ("e", "forceOrder"), fixed={"completeness": "largest_in_window", "amount_unit": "contracts"}),
    "quote": M("quote", (*_QUOTE, F("event_time_ns", "E", "ms")), ("e", "bookTicker")),
}
_BYBIT_BOOK = (
    F("symbol", "data.s", "text"), F("bids", "data.b", "levels"), F("asks", "data.a", "levels"), F("last_sequence", "data.u", "uint"),
    F("cross_sequence", "data.seq", "uint"), F("update_kind", "type", "text"), F("event_time_ns", "ts", "ms"), F("engine_time_ns", "cts", "ms", False),
)
BYBIT = {
    "trade": M(
        "trade",
        (F("symbol", "s", "text"), F("side", "S", "side"), F("amount", "v"), F("price", "p"), F("native_trade_id", "i", "text"), F("trade_time_ns", "T", "ms"),
         F("block_trade", "BT", "flag"), F("sequence", "seq", "uint", False)),
        ("topic", r"publicTrade\..*"), "data", header=(F("event_time_ns", "ts", "ms"),),
    ),
    "book": M("book_update", _BYBIT_BOOK, ("topic", r"orderbook\.[0-9]+\.(?!.*-[CP](-[A-Z]+)?$).*")),
    "full_book": M("book_update", _BYBIT_BOOK, ("topic", r"orderbook\.full\..*")),
    "option_book": M("book_update", _BYBIT_BOOK, ("topic", r"orderbook\.[0-9]+\..*-[CP](-[A-Z]+)?")),
    "rpi_book": M(
        "book_update", tuple(F(f.name, f.path, "rpi") if f.kind == "levels" else f for f in _BYBIT_BOOK), ("topic", r"orderbook\.rpi\..*")
    ),
    "option_trade": M(
        "trade",
        (F("symbol", "s", "text"), F("side", "S", "side"), F("amount", "v"), F("price", "p"), F("native_trade_id", "i", "text"), F("trade_time_ns", "T", "ms"),
         F("block_trade", "BT", "flag"), F("sequence", "seq", "uint", False), F("mark_price", "mP"), F("index_price", "iP"), F("mark_iv", "mIv"), F("iv", "iv")),
        ("topic", r"publicTrade\..*"), "data", header=(F("event_time_ns", "ts", "ms"),),
    ),
    "liquidation": M(
        "liquidation",
        (F("symbol", "s", "text"), F("side", "S", "side"), F("amount", "v"), F("price", "p"), F("trade_time_ns", "T", "ms")),
        ("topic", r"allLiquidation\..*"), "data", fixed={"completeness": "complete"}, header=(F("event_time_ns", "ts", "ms"),),
    ),
    "ticker": M(
        "derivative_ticker",
        (F("symbol", "data.symbol", "text"), F("mark_price", "data.markPrice", "decimal", False), F("index_price", "data.indexPrice", "decimal", False),
         F("last", "data.lastPrice", "decimal", False), F("open_interest", "data.openInterest", "decimal", False),
         F("funding_rate", "data.fundingRate", "decimal", False), F("update_kind", "type", "text"), F("event_time_ns", "ts", "ms")),
        ("topic", r"tickers\.[A-Z]+[0-9]*"),
    ),
    "option": M(
        "option_summary",
        (F("symbol", "data.symbol", "text"), F("bid_price", "data.bidPrice"), F("ask_price", "data.askPrice"), F("bid_iv", "data.bidIv"), F("ask_iv", "data.askIv"),
         F("mark_price", "data.markPrice"), F("mark_iv", "data.markPriceIv"), F("open_interest", "data.openInterest"), F("delta", "data.delta"), F("gamma", "data.gamma"),
         F("vega", "data.vega"), F("theta", "data.theta"), F("event_time_ns", "ts", "ms")),
        ("topic", r"tickers\..*-[CP].*"),
    ),
}
BYBIT_SNAPSHOT = M(
    "book_update",
    (F("symbol", "result.s", "text"), F("bids", "result.b", "levels"), F("asks", "result.a", "levels"), F("last_sequence", "result.u", "uint"),
     F("cross_sequence", "result.seq", "uint"), F("event_time_ns", "result.ts", "ms")),
    ("retCode", "0"), fixed={"update_kind": "snapshot"},
)
_OKX_INSTRUMENT = (
    F("symbol", "instId", "text"), F("kind", "instType", "text"), F("native_state", "state", "text"), F("state", "state", "okx_state"),
    F("tick_size", "tickSz", "decimal", False), F("lot_size", "lotSz", "decimal", False), F("contract_size", "ctVal", "decimal", False),
    F("listed_ns", "listTime", "ms", False), F("expiry_ns", "expTime", "ms", False),
)
OKX = {
    "trade": M(
        "trade",
        (F("symbol", "instId", "text"), F("native_trade_id", "tradeId", "text"), F("price", "px"), F("amount", "sz"), F("side", "side", "side"),
         F("trade_time_ns", "ts", "ms"), F("count", "count", "uint", False)),
        ("arg.channel", r"trades(-all)?"), "data",
    ),
    "book": M(
        "book_update",
        (F("bids", "bids", "texted"), F("asks", "asks", "texted"), F("event_time_ns", "ts", "ms"), F("previous_sequence", "prevSeqId", "int"),
         F("last_sequence", "seqId", "uint"), F("checksum", "checksum", "int", False)),
        ("arg.channel", r"books|books5|books50-l2-tbt|books-l2-tbt"), "data", header=(F("symbol", "arg.instId", "text"), F("update_kind", "action", "text", False)),
    ),
    "liquidation": M(
        "liquidation",
        (F("symbol", "instId", "text"), F("family", "instFamily", "text", False), F("details", "details", "text")),
        ("arg.channel", r"liquidation-orders"), "data", fixed={"completeness": "partial_nonchronological"},
    ),
    "ticker": M(
        "ticker",
        (F("symbol", "instId", "text"), F("last", "last"), F("bid_price", "bidPx"), F("ask_price", "askPx"), F("open", "open24h"), F("high", "high24h"),
         F("low", "low24h"), F("event_time_ns", "ts", "ms")),
        ("arg.channel", r"tickers"), "data",
    ),
    "option": M(
        "option_summary",
        (F("symbol", "instId", "text"), F("delta", "delta"), F("gamma", "gamma"), F("vega", "vega"), F("theta", "theta"), F("mark_iv", "markVol"), F("event_time_ns", "ts", "ms")),
        ("arg.channel", r"opt-summary"), "data",
    ),
    "rpi_book": M(
        "book_update",
        (F("bids", "bids", "texted"), F("asks", "asks", "texted"), F("event_time_ns", "ts", "ms"), F("previous_sequence", "prevSeqId", "int"),
         F("last_sequence", "seqId", "uint")),
        ("arg.channel", r"books-rpi-tbt"), "data", header=(F("symbol", "arg.instId", "text"), F("update_kind", "action", "text", False)),
    ),
    "quote": M(
        "quote",
        (F("bid_price", "bids", "best"), F("bid_amount", "bids", "best"), F("ask_price", "asks", "best"), F("ask_amount", "asks", "best"),
         F("event_time_ns", "ts", "ms"), F("last_sequence", "seqId", "uint", False)),
        ("arg.channel", r"bbo-tbt"), "data", header=(F("symbol", "arg.instId", "text"),),
    ),
    "mark": M("derivative_ticker", (F("symbol", "instId", "text"), F("mark_price", "markPx"), F("event_time_ns", "ts", "ms")), ("arg.channel", r"mark-price"), "data"),
    "index": M("derivative_ticker", (F("symbol", "instId", "text"), F("index_price", "idxPx"), F("event_time_ns", "ts", "ms")), ("arg.channel", r"index-tickers"), "data"),
    "open_interest": M(
        "derivative_ticker",
        (F("symbol", "instId", "text"), F("open_interest", "oi"), F("open_interest_base", "oiCcy", "decimal", False), F("event_time_ns", "ts", "ms")),
        ("arg.channel", r"open-interest"), "data",
    ),
    "funding": M(
        "derivative_ticker",
        (F("symbol", "instId", "text"), F("funding_rate", "fundingRate"), F("funding_time_ns", "fundingTime", "ms"), F("next_funding_ns", "nextFundingTime", "ms", False),
         F("event_time_ns", "ts", "ms")),
        ("arg.channel", r"funding-rate"), "data",
    ),
    "lifecycle": M("instrument_event", _OKX_INSTRUMENT, ("arg.channel", r"instruments"), "data"),
}
OKX_LIQUIDATION_DETAIL = M(
    "liquidation", (F("side", "side", "side"), F("price", "bkPx"), F("amount", "sz"), F("loss", "bkLoss", "decimal", False), F("trade_time_ns", "ts", "ms")), items="."
)
DERIBIT = {
    "book": M(
        "book_update",
        (F("symbol", "params.data.instrument_name", "text"), F("update_kind", "params.data.type", "text"), F("event_time_ns", "params.data.timestamp", "ms"),
         F("last_sequence", "params.data.change_id", "uint"), F("previous_sequence", "params.data.prev_change_id", "uint", False),
         F("bids", "params.data.bids", "tagged"), F("asks", "params.data.asks", "tagged")),
        ("params.channel", r"book\..*"),
    ),
    "trade": M(
        "trade",
        (F("symbol", "instrument_name", "text"), F("native_trade_id", "trade_id", "text"), F("sequence", "trade_seq", "uint"), F("side", "direction", "side"),
         F("price", "price"), F("amount", "amount"), F("mark_price", "mark_price"), F("index_price", "index_price"), F("trade_time_ns", "timestamp", "ms"),
         F("liquidation", "liquidation", "text", False)),
        ("params.channel", r"trades\..*"), "params.data",
    ),
    "quote": M(
        "quote",
        (F("symbol", "params.data.instrument_name", "text"), F("bid_price", "params.data.best_bid_price"), F("bid_amount", "params.data.best_bid_amount"),
         F("ask_price", "params.data.best_ask_price"), F("ask_amount", "params.data.best_ask_amount"), F("event_time_ns", "params.data.timestamp", "ms")),
        ("params.channel", r"quote\..*"),
    ),
    "ticker": M(
        "derivative_ticker",
        (F("symbol", "params.data.instrument_name", "text"), F("mark_price", "params.data.mark_price"), F("index_price", "params.data.index_price"),
         F("open_interest", "params.data.open_interest"), F("funding_rate", "params.data.funding_8h", "decimal", False), F("event_time_ns", "params.data.timestamp", "ms")),
        ("params.channel", r"ticker\.(?!.*-[CP]\.).*"),
    ),
    "option": M(
        "option_summary",
        (F("symbol", "params.data.instrument_name", "text"), F("mark_price", "params.data.mark_price"), F("mark_iv", "params.data.mark_iv"), F("bid_iv", "params.data.bid_iv"),
         F("ask_iv", "params.data.ask_iv"), F("underlying_price", "params.data.underlying_price"), F("interest_rate", "params.data.interest_rate", "decimal", False),
         F("open_interest", "params.data.open_interest"), F("delta", "params.data.greeks.delta"), F("gamma", "params.data.greeks.gamma"), F("vega", "params.data.greeks.vega"),
         F("theta", "params.data.greeks.theta"), F("rho", "params.data.greeks.rho"), F("event_time_ns", "params.data.timestamp", "ms")),
        ("params.channel", r"ticker\..*-[CP]\..*"),
    ),
    "funding": M(
        "derivative_ticker",
        (F("channel", "params.channel", "text"), F("funding_rate", "params.data.interest"), F("funding_rate_8h", "params.data.interest_8h", "decimal", False),
         F("index_price", "params.data.index_price", "decimal", False), F("event_time_ns", "params.data.timestamp", "ms")),
        ("params.channel", r"perpetual\..*"),
    ),
    "index": M(
        "derivative_ticker", (F("symbol", "params.data.index_name", "text"), F("index_price", "params.data.price"), F("event_time_ns", "params.data.timestamp", "ms")),
        ("params.channel", r"deribit_price_index\..*"),
    ),
    "lifecycle": M(
        "instrument_event",
        (F("symbol", "params.data.instrument_name", "text"), F("native_state", "params.data.state", "text"), F("state", "params.data.state", "deribit_state"),
         F("event_time_ns", "params.data.timestamp", "ms")),
        ("params.channel", r"instrument\.state\..*"),
    ),
}
HYPERLIQUID = {
    "trade": M(
        "trade",
        (F("symbol", "coin", "text"), F("side", "side", "side"), F("price", "px"), F("amount", "sz"), F("native_trade_id", "tid", "uint"),
         F("trade_time_ns", "time", "ms"), F("hash", "hash", "text")),
        ("channel", "trades"), "data",
    ),
    "context": M(
        "derivative_ticker",
        (F("symbol", "data.coin", "text"), F("funding_rate", "data.ctx.funding"), F("open_interest", "data.ctx.openInterest"), F("index_price", "data.ctx.oraclePx"),
         F("mark_price", "data.ctx.markPx"), F("mid_price", "data.ctx.midPx", "decimal", False)),
        ("channel", "activeAssetCtx"),
    ),
    "quote": M(
        "quote",
        (F("symbol", "data.coin", "text"), F("event_time_ns", "data.time", "ms"), F("bid_price", "data.bbo", "named_best", False), F("bid_amount", "data.bbo", "named_best", False),
         F("ask_price", "data.bbo", "named_best", False), F("ask_amount", "data.bbo", "named_best", False)),
        ("channel", "bbo"),
    ),
    "book": M(
        "book_update",
        (F("symbol", "data.coin", "text"), F("event_time_ns", "data.time", "ms"), F("bids", "data.levels", "named"), F("asks", "data.levels", "named")),
        ("channel", "l2Book"), fixed={"update_kind": "snapshot"},
    ),
}
FUNDING_HISTORY = M(
    "derivative_ticker", (F("symbol", "coin", "text"), F("funding_rate", "fundingRate"), F("premium", "premium"), F("event_time_ns", "time", "ms")), items="."
)
SYMBOLS = M(
    "instrument_event",
    (F("symbol", "symbol", "text"), F("state", "status", "text"), F("base_asset", "baseAsset", "text"), F("quote_asset", "quoteAsset", "text"), F("filters", "filters", "text")),
    items="symbols",
)
OKX_INSTRUMENTS = M("instrument_event", _OKX_INSTRUMENT, ("code", "0"), "data")
DERIBIT_INSTRUMENTS = M(
    "instrument_event",
    (F("symbol", "instrument_name", "text"), F("kind", "kind", "text"), F("base_asset", "base_currency", "text"), F("quote_asset", "quote_currency", "text"),
     F("settlement_asset", "settlement_currency", "text"), F("state", "state", "deribit_state"), F("contract_size", "contract_size"), F("listed_ns", "creation_timestamp", "ms"),
     F("expiry_ns", "expiration_timestamp", "ms"), F("option_kind", "option_type", "text", False), F("strike", "strike", "decimal", False)),
    ("jsonrpc", r"2\.0"), "result",
)
_BYBIT_PAGE = (F("return_code", "retCode", "zero"), F("observed_ns", "time", "ms"), F("next_cursor", "result.nextPageCursor", "text", False))
_BYBIT_LISTED = (
    F("symbol", "symbol", "symbol"), F("native_state", "status", "text"), F("base_asset", "baseCoin", "text"), F("quote_asset", "quoteCoin", "text"),
    F("settlement_asset", "settleCoin", "text", False), F("contract_type", "contractType", "text", False), F("listed_ns", "launchTime", "ms", False),
    F("expiry_ns", "deliveryTime", "ms", False), F("delivery_fee_rate", "deliveryFeeRate", "decimal", False), F("price_scale", "priceScale", "uint", False),
    F("tick_size", "priceFilter.tickSize", "decimal", False), F("least_price", "priceFilter.minPrice", "decimal", False),
    F("most_price", "priceFilter.maxPrice", "decimal", False), F("least_amount", "lotSizeFilter.minOrderQty", "decimal", False),
    F("most_amount", "lotSizeFilter.maxOrderQty", "decimal", False), F("most_market_amount", "lotSizeFilter.maxMktOrderQty", "decimal", False),
    F("lot_size", "lotSizeFilter.qtyStep", "decimal", False), F("least_notional", "lotSizeFilter.minNotionalValue", "decimal", False),
    F("funding_interval_minutes", "fundingInterval", "uint", False), F("upper_funding_rate", "upperFundingRate", "decimal", False),
    F("lower_funding_rate", "lowerFundingRate", "decimal", False), F("unified_margin", "unifiedMarginTrade", "flag", False),
    F("pre_listing", "isPreListing", "flag", False), F("pre_listing_info", "preListingInfo", "text", False), F("risk_parameters", "riskParameters", "text", False),
)
BYBIT_INSTRUMENTS = {
    kind: M("instrument_event", _BYBIT_LISTED, ("result.category", kind), "result.list", {"category": kind}, _BYBIT_PAGE) for kind in ("spot", "linear", "inverse")
}
BYBIT_OPTION_INSTRUMENTS = M(
    "instrument_event",
    (F("symbol", "symbol", "text"), F("native_state", "status", "text"), F("base_asset", "baseCoin", "text"), F("quote_asset", "quoteCoin", "text"),
     F("settlement_asset", "settleCoin", "text"), F("option_kind", "optionsType", "option_kind"), F("listed_ns", "launchTime", "ms"), F("expiry_ns", "deliveryTime", "ms"),
     F("delivery_fee_rate", "deliveryFeeRate"), F("tick_size", "priceFilter.tickSize"), F("least_price", "priceFilter.minPrice"), F("most_price", "priceFilter.maxPrice"),
     F("least_amount", "lotSizeFilter.minOrderQty"), F("most_amount", "lotSizeFilter.maxOrderQty"), F("lot_size", "lotSizeFilter.qtyStep"),
     F("unified_margin", "unifiedMarginTrade", "flag")),
    ("result.category", "option"), "result.list", {"category": "option"}, _BYBIT_PAGE,
)
HYPERLIQUID_UNIVERSE = M(
    "instrument_event",
    (F("symbol", "name", "text"), F("size_decimals", "szDecimals", "uint"), F("most_leverage", "maxLeverage", "uint"), F("delisted", "isDelisted", "flag", False)),
    items="universe",
)
