"""Queries of the further venue roles and of the row contracts of each family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import scalars as X
from tickloom.operators import filters, metadata, venues
from tickloom.operators import normalize as N
from tickloom.plans import messages as G
from tickloom.plans import views as V
from tickloom.plans.registry import query

C, L = F.col, F.lit
UID = "instrument_uid AS symbol"
AT = "received_time_ns // 1000000 * 1000000 AS event_time_ns"
P, A = "CAST(price AS VARCHAR)", "CAST(amount AS VARCHAR)"
BOOK_SQL = "SELECT event_id, instrument_uid AS symbol, last_sequence, levels FROM book_events"
DAY_MS = 86_400_000


def _rows(raw, mapping, *names, keep=()):
    """Accepted rows of a mapping with the named columns, decimals as text."""
    return filters.decimals_as_text(N.split(N.apply(raw, mapping, keep=keep))[0].select(*keep, *names))


def _levels():
    return (F.size("bids") + F.size("asks")).cast("long").alias("levels")


def _book(raw, mapping):
    rows = N.split(N.apply(raw, mapping, keep=["event_id"]))[0]
    return rows.select("event_id", "symbol", "last_sequence", _levels())


# ---- futures of the first venue -----------------------------------------------------------------------------


def _day_ticker(spark, d, **more):
    p, q = C("p"), C("q")
    return G.from_trades(
        spark, d, e=L("24hrTicker"), E=C("ms"), s=C("instrument_uid"), p=p, P=p, w=p, c=p, Q=q, o=p, h=p, l=p, v=q, q=q, O=C("ms") - DAY_MS, C=C("ms"), F=L(1), L=L(2),
        n=C("native_trade_id"), **more,
    )


TICKER_SQL = f"SELECT {UID}, {AT}, native_trade_id AS trades, {P} AS last, {A} AS volume FROM trades"
QUOTE_SQL = f"SELECT {UID}, native_trade_id AS update_id, {P} AS bid_price, {A} AS bid_amount, CAST(price + 1 AS VARCHAR) AS ask_price, {AT} FROM trades"


@query(TICKER_SQL, ["trades"])
def n3_usdm_tickers(spark, d):
    return _rows(_day_ticker(spark, d), venues.USDM["ticker"], "symbol", "event_time_ns", "trades", "last", "volume")


def _book_ticker(spark, d, **more):
    ask = (C("p").cast("decimal(18,2)") + 1).cast("string")
    return G.from_trades(spark, d, e=L("bookTicker"), u=C("native_trade_id"), E=C("ms"), T=C("ms"), s=C("instrument_uid"), b=C("p"), B=C("q"), a=ask, A=C("q"), **more)


@query(QUOTE_SQL, ["trades"])
def n3_usdm_quotes(spark, d):
    return _rows(_book_ticker(spark, d), venues.USDM["quote"], "symbol", "update_id", "bid_price", "bid_amount", "ask_price", "event_time_ns")


@query(TICKER_SQL, ["trades"])
def n4_coinm_tickers(spark, d):
    return _rows(_day_ticker(spark, d, ps=L("BTCUSD")), venues.COINM["ticker"], "symbol", "event_time_ns", "trades", "last", "volume")


@query(QUOTE_SQL, ["trades"])
def n4_coinm_quotes(spark, d):
    return _rows(_book_ticker(spark, d, ps=L("BTCUSD")), venues.COINM["quote"], "symbol", "update_id", "bid_price", "bid_amount", "ask_price", "event_time_ns")


@query(f"SELECT {UID}, {P} AS mark_price, {P} AS index_price, CASE WHEN native_trade_id % 2 = 0 THEN {A} END AS funding_rate, {AT} FROM trades", ["trades"])
def n4_coinm_marks(spark, d):
    rate = F.when(C("native_trade_id") % 2 == 0, C("q")).otherwise("")  # delivery contracts have an empty rate
    raw = G.from_trades(spark, d, e=L("markPriceUpdate"), E=C("ms"), s=C("instrument_uid"), p=C("p"), i=C("p"), P=C("p"), r=rate, T=C("ms"))
    return _rows(raw, venues.COINM["mark"], "symbol", "mark_price", "index_price", "funding_rate", "event_time_ns")


@query(
    f"""SELECT {UID}, {P} AS price, {A} AS filled, CASE WHEN buyer_is_maker THEN 'sell' ELSE 'buy' END AS side, 'largest_in_window' AS completeness, 'contracts' AS amount_unit FROM trades""",
    ["trades"],
)
def n4_coinm_liquidations(spark, d):
    names = {"s": C("instrument_uid"), "ps": L("BTCUSD"), "S": F.upper("direction"), "q": C("q"), "p": C("p"), "ap": C("p"), "X": L("FILLED"), "l": C("q"), "z": C("q"), "T": C("ms")}
    raw = G.from_trades(spark, d, e=L("forceOrder"), E=C("ms"), o=F.struct(*(c.alias(k) for k, c in names.items())))
    return _rows(raw, venues.COINM["liquidation"], "symbol", "price", "filled", "side", "completeness", "amount_unit")


@query(f"SELECT event_id, {UID}, last_sequence, first_sequence - 1 AS previous_sequence, levels FROM book_events", ["book_events"])
def n4_coinm_depth(spark, d):
    def build():
        return {"e": L("depthUpdate"), "E": C("ms"), "T": C("ms"), "s": C("instrument_uid"), "ps": L("BTCUSD"), "U": C("first_sequence"), "u": C("last_sequence"),
                "pu": C("first_sequence") - 1, "b": C("bids"), "a": C("asks")}

    rows = N.split(N.apply(G.from_books(spark, d, build), venues.COINM["depth"], keep=["event_id"]))[0]
    return rows.select("event_id", "symbol", "last_sequence", "previous_sequence", _levels())


# ---- second venue -------------------------------------------------------------------------------------------


@query(f"SELECT {UID}, CASE WHEN native_trade_id % 2 = 0 THEN {P} END AS mark_price, {A} AS open_interest, NULL::VARCHAR AS funding_rate, 'delta' AS update_kind FROM trades", ["trades"])
def n6_bybit_tickers(spark, d):
    """A delta names only what changed."""
    mark = F.when(C("native_trade_id") % 2 == 0, C("p"))
    data = F.struct(C("instrument_uid").alias("symbol"), mark.alias("markPrice"), C("q").alias("openInterest"), L("").alias("fundingRate"))
    raw = G.from_trades(spark, d, topic=L("tickers.BTCUSDT"), type=L("delta"), ts=C("ms"), data=data)
    return _rows(raw, venues.BYBIT["ticker"], "symbol", "mark_price", "open_interest", "funding_rate", "update_kind")


def _venue_book(topic: str, bids="bids", asks="asks"):
    def build():
        data = F.struct(C("instrument_uid").alias("s"), F.expr(bids).alias("b"), F.expr(asks).alias("a"), C("last_sequence").alias("u"), C("last_sequence").alias("seq"))
        return {"topic": L(topic), "ts": C("ms"), "type": L("delta"), "data": data, "cts": C("ms")}

    return build


@query(BOOK_SQL, ["book_events"])
def n6_bybit_full_books(spark, d):
    return _book(G.from_books(spark, d, _venue_book("orderbook.full.BTCUSDT")), venues.BYBIT["full_book"])


@query(
    "SELECT event_id, side, CAST(sum(price) AS VARCHAR) AS prices, CAST(sum(amount) AS VARCHAR) AS rpi_amounts, count(*) AS levels FROM book_levels GROUP BY ALL",
    ["book_levels"],
)
def n6_bybit_rpi_books(spark, d):
    """Retail price improvement stays apart from the plain amount; here both are the same number."""
    more = "transform({0}, x -> concat(x, slice(x, 2, 1)))"
    raw = G.from_books(spark, d, _venue_book("orderbook.rpi.BTCUSDT", more.format("bids"), more.format("asks")))
    rows = N.split(N.apply(raw, venues.BYBIT["rpi_book"], keep=["event_id"]))[0].select("event_id", F.inline(F.concat("bids", "asks")))
    total = lambda c: F.sum(c).cast("decimal(38,18)").cast("string")
    return rows.groupBy("event_id", "side").agg(total("price").alias("prices"), total("rpi_amount").alias("rpi_amounts"), F.count("*").alias("levels"))


@query(BOOK_SQL, ["book_events"])
def n7_bybit_option_books(spark, d):
    return _book(G.from_books(spark, d, _venue_book("orderbook.100.BTC-27JUN25-50000-C")), venues.BYBIT["option_book"])


@query(
    f"SELECT {UID}, native_trade_id::VARCHAR AS native_trade_id, {P} AS price, {A} AS amount, CASE WHEN buyer_is_maker THEN 'sell' ELSE 'buy' END AS side, {P} AS index_price, '0.500000000000000000' AS iv FROM trades",
    ["trades"],
)
def n7_bybit_option_trades(spark, d):
    names = {
        "T": C("ms"), "s": C("instrument_uid"), "S": F.initcap("direction"), "v": C("q"), "p": C("p"), "i": C("native_trade_id").cast("string"), "BT": L(False), "mP": C("p"),
        "iP": C("p"), "mIv": L("0.5"), "iv": L("0.5"),
    }
    raw = G.from_trades(spark, d, topic=L("publicTrade.BTC"), type=L("snapshot"), ts=C("ms"), data=F.array(F.struct(*(c.alias(k) for k, c in names.items()))))
    return _rows(raw, venues.BYBIT["option_trade"], "symbol", "native_trade_id", "price", "amount", "side", "index_price", "iv")


# ---- third venue --------------------------------------------------------------------------------------------


def _observed(spark, d, channel: str, **fields):
    item = F.struct(L("SWAP").alias("instType"), C("instrument_uid").alias("instId"), *(c.alias(k) for k, c in fields.items()), C("ms").cast("string").alias("ts"))
    return G.from_trades(spark, d, arg=F.struct(L(channel).alias("channel"), C("instrument_uid").alias("instId")), data=F.array(item))


@query(f"SELECT {UID}, {P} AS last, {P} AS bid_price, CAST(price + 1 AS VARCHAR) AS ask_price, {AT} FROM trades", ["trades"])
def n8_okx_tickers(spark, d):
    p, ask = C("p"), (C("p").cast("decimal(18,2)") + 1).cast("string")
    raw = _observed(spark, d, "tickers", last=p, lastSz=C("q"), askPx=ask, askSz=C("q"), bidPx=p, bidSz=C("q"), open24h=p, high24h=p, low24h=p)
    return _rows(raw, venues.OKX["ticker"], "symbol", "last", "bid_price", "ask_price", "event_time_ns")


@query(f"SELECT {UID}, {P} AS mark_price, {AT} FROM trades", ["trades"])
def n8_okx_marks(spark, d):
    return _rows(_observed(spark, d, "mark-price", markPx=C("p")), venues.OKX["mark"], "symbol", "mark_price", "event_time_ns")


@query(f"SELECT {UID}, {P} AS index_price, {AT} FROM trades", ["trades"])
def n8_okx_index(spark, d):
    return _rows(_observed(spark, d, "index-tickers", idxPx=C("p")), venues.OKX["index"], "symbol", "index_price", "event_time_ns")


@query(f"SELECT {UID}, {A} AS open_interest, CASE WHEN NOT buyer_is_maker THEN {P} END AS open_interest_base, {AT} FROM trades", ["trades"])
def n8_okx_open_interest(spark, d):
    raw = _observed(spark, d, "open-interest", oi=C("q"), oiCcy=F.when(C("maker"), "").otherwise(C("p")))
    return _rows(raw, venues.OKX["open_interest"], "symbol", "open_interest", "open_interest_base", "event_time_ns")


@query(f"SELECT {UID}, {A} AS funding_rate, received_time_ns // 1000000 * 1000000 + 28800000000000 AS funding_time_ns, {AT} FROM trades", ["trades"])
def n8_okx_funding(spark, d):
    raw = _observed(spark, d, "funding-rate", fundingRate=C("q"), fundingTime=(C("ms") + 28_800_000).cast("string"), nextFundingTime=L(""))
    return _rows(raw, venues.OKX["funding"], "symbol", "funding_rate", "funding_time_ns", "event_time_ns")


@query(f"SELECT {UID}, '-0.500000000000000000' AS delta, {A} AS mark_iv, {AT} FROM trades", ["trades"])
def n8_okx_options(spark, d):
    raw = _observed(spark, d, "opt-summary", delta=L("-0.5"), gamma=L("0.1"), vega=L("0.1"), theta=L("-0.1"), markVol=C("q"))
    return _rows(raw, venues.OKX["option"], "symbol", "delta", "mark_iv", "event_time_ns")


@query(f"SELECT {UID}, {P} AS bid_price, {A} AS bid_amount, CAST(price + 1 AS VARCHAR) AS ask_price, {AT} FROM trades", ["trades"])
def n8_okx_quotes(spark, d):
    level = lambda price: F.array(F.array(price, C("q"), L("0"), L("1")))
    raw = _observed(spark, d, "bbo-tbt", bids=level(C("p")), asks=level((C("p").cast("decimal(18,2)") + 1).cast("string")), seqId=C("native_trade_id"))
    return _rows(raw, venues.OKX["quote"], "symbol", "bid_price", "bid_amount", "ask_price", "event_time_ns")


@query(BOOK_SQL, ["book_events"])
def n8_okx_rpi_books(spark, d):
    def build():
        item = F.struct(C("asks"), C("bids"), C("ms").cast("string").alias("ts"), (C("first_sequence") - 1).alias("prevSeqId"), C("last_sequence").alias("seqId"))
        return {"arg": F.struct(L("books-rpi-tbt").alias("channel"), C("instrument_uid").alias("instId")), "action": L("update"), "data": F.array(item)}

    return _book(G.from_books(spark, d, build), venues.OKX["rpi_book"])


STATES_SQL = "['live', 'suspend', 'expired', 'other'][native_trade_id % 4 + 1]"
STATE_SQL = "['continuous_trading', 'suspended', 'expired'][native_trade_id % 4 + 1]"


@query(f"SELECT {UID}, {STATES_SQL} AS native_state, {STATE_SQL} AS state, {P} AS tick_size FROM trades WHERE native_trade_id % 4 < 3", ["trades"])
def n8_okx_lifecycle(spark, d):
    """A state that isn't known is refused."""
    state = F.element_at(F.array(*map(L, ("live", "suspend", "expired", "other"))), (C("native_trade_id") % 4 + 1).cast("int"))
    raw = _observed(spark, d, "instruments", state=state, tickSz=C("p"), lotSz=C("q"), ctVal=L(""))
    return _rows(raw, venues.OKX["lifecycle"], "symbol", "native_state", "state", "tick_size")


# ---- fourth venue -------------------------------------------------------------------------------------------


def _notified(spark, d, channel, **fields):
    data = F.struct(*(c.alias(k) for k, c in fields.items()), C("ms").alias("timestamp"))
    return G.from_trades(spark, d, jsonrpc=L("2.0"), method=L("subscription"), params=F.struct(channel.alias("channel"), data.alias("data")))


def _number(name):
    return C(name).cast("decimal(18,2)")


@query(f"SELECT {UID}, {P} AS bid_price, {A} AS bid_amount, CAST(price + 1 AS VARCHAR) AS ask_price, {AT} FROM trades", ["trades"])
def n9_deribit_quotes(spark, d):
    raw = _notified(
        spark, d, F.concat(L("quote."), "instrument_uid"), instrument_name=C("instrument_uid"), best_bid_price=_number("p"), best_bid_amount=_number("q"),
        best_ask_price=_number("p") + 1, best_ask_amount=_number("q"),
    )
    return _rows(raw, venues.DERIBIT["quote"], "symbol", "bid_price", "bid_amount", "ask_price", "event_time_ns")


@query(
    f"SELECT 'BTC-27JUN25-50000-P' AS symbol, {P} AS mark_price, {P} AS underlying_price, {A} AS open_interest, '-0.500000000000000000' AS delta, {AT} FROM trades WHERE NOT buyer_is_maker",
    ["trades"],
)
def n9_deribit_options(spark, d):
    """Tickers of an option and of a perpetual contract come in one channel family; the latter are refused."""
    greeks = F.struct(L(-0.5).alias("delta"), L(0.1).alias("gamma"), L(0.1).alias("vega"), L(-0.1).alias("theta"), L(0.1).alias("rho"))
    name = F.when(C("maker"), "BTC-PERPETUAL").otherwise("BTC-27JUN25-50000-P")
    raw = _notified(
        spark, d, F.concat(L("ticker."), name, L(".raw")), instrument_name=name, mark_price=_number("p"), mark_iv=_number("q"), bid_iv=_number("q"), ask_iv=_number("q"),
        underlying_price=_number("p"), interest_rate=L(0), open_interest=_number("q"), greeks=greeks,
    )
    return _rows(raw, venues.DERIBIT["option"], "symbol", "mark_price", "underlying_price", "open_interest", "delta", "event_time_ns")


@query(f"SELECT 'perpetual.' || instrument_uid || '.raw' AS channel, {A} AS funding_rate, NULL::VARCHAR AS funding_rate_8h, {P} AS index_price, {AT} FROM trades", ["trades"])
def n9_deribit_funding(spark, d):
    raw = _notified(spark, d, F.concat(L("perpetual."), "instrument_uid", L(".raw")), interest=_number("q"), index_price=_number("p"))
    return _rows(raw, venues.DERIBIT["funding"], "channel", "funding_rate", "funding_rate_8h", "index_price", "event_time_ns")


@query(f"SELECT 'btc_usd' AS symbol, {P} AS index_price, {AT} FROM trades", ["trades"])
def n9_deribit_index(spark, d):
    raw = _notified(spark, d, L("deribit_price_index.btc_usd"), index_name=L("btc_usd"), price=_number("p"))
    return _rows(raw, venues.DERIBIT["index"], "symbol", "index_price", "event_time_ns")


@query(f"SELECT {UID}, ['open', 'locked', 'archivized'][native_trade_id % 3 + 1] AS native_state, ['continuous_trading', 'suspended', 'delisted'][native_trade_id % 3 + 1] AS state, {AT} FROM trades", ["trades"])
def n9_deribit_lifecycle(spark, d):
    state = F.element_at(F.array(*map(L, ("open", "locked", "archivized"))), (C("native_trade_id") % 3 + 1).cast("int"))
    raw = _notified(spark, d, L("instrument.state.any.any"), state=state, instrument_name=C("instrument_uid"))
    return _rows(raw, venues.DERIBIT["lifecycle"], "symbol", "native_state", "state", "event_time_ns")


# ---- fifth venue --------------------------------------------------------------------------------------------


@query("SELECT event_id, instrument_uid AS symbol, levels, levels AS orders FROM book_events", ["book_events"])
def n10_hyperliquid_books(spark, d):
    def build():
        named = lambda side: F.transform(side, lambda x: F.struct(x[0].alias("px"), x[1].alias("sz"), L(1).alias("n")))
        data = F.struct(C("instrument_uid").alias("coin"), C("ms").alias("time"), F.array(named("bids"), named("asks")).alias("levels"))
        return {"channel": L("l2Book"), "data": data}

    rows = N.split(N.apply(G.from_books(spark, d, build), venues.HYPERLIQUID["book"], keep=["event_id"]))[0]
    both = F.concat("bids", "asks")
    return rows.select("event_id", "symbol", _levels(), F.aggregate(both, L(0).cast("long"), lambda n, x: n + x["orders"]).alias("orders"))


@query(f"SELECT {UID}, CASE WHEN NOT buyer_is_maker THEN {P} END AS bid_price, CASE WHEN NOT buyer_is_maker THEN {A} END AS bid_amount, {P} AS ask_price, {AT} FROM trades", ["trades"])
def n10_hyperliquid_quotes(spark, d):
    """A side without orders is null."""
    side = F.struct(C("p").alias("px"), C("q").alias("sz"), L(1).alias("n"))
    data = F.struct(C("instrument_uid").alias("coin"), C("ms").alias("time"), F.array(F.when(~C("maker"), side), side).alias("bbo"))
    raw = G.from_trades(spark, d, channel=L("bbo"), data=data)
    return _rows(raw, venues.HYPERLIQUID["quote"], "symbol", "bid_price", "bid_amount", "ask_price", "event_time_ns")


# ---- metadata -----------------------------------------------------------------------------------------------


def _pages(spark, d, items: str, item, **header):
    """Metadata answers of fifty instruments each."""
    part = V.load(spark, d, "part").groupBy(F.expr("p_partkey div 50").alias("page"))
    return part.agg(F.to_json(F.struct(*(c.alias(k) for k, c in header.items()), F.collect_list(item).alias(items))).alias("payload"))


@query("SELECT p_partkey::VARCHAR AS symbol, CASE WHEN p_size > 25 THEN 'continuous_trading' ELSE 'pre_listing' END AS state, p_size || '.000000000000000000' AS tick_size, NULL::VARCHAR AS contract_size FROM part")
def n11_okx_metadata(spark, d):
    state = F.when(C("p_size") > 25, "live").otherwise("preopen")
    item = F.struct(L("SPOT").alias("instType"), C("p_partkey").cast("string").alias("instId"), state.alias("state"), C("p_size").cast("string").alias("tickSz"), L("").alias("ctVal"))
    return _rows(_pages(spark, d, "data", item, code=L("0"), msg=L("")), venues.OKX_INSTRUMENTS, "symbol", "state", "tick_size", "contract_size")


@query("SELECT p_partkey::VARCHAR AS symbol, CASE WHEN p_size > 25 THEN 'put' END AS option_kind, p_size || '.000000000000000000' AS contract_size, 1700000000000000000 AS listed_ns FROM part")
def n11_deribit_metadata(spark, d):
    names = {
        "instrument_name": C("p_partkey").cast("string"), "kind": L("option"), "base_currency": L("BTC"), "quote_currency": L("USD"), "settlement_currency": L("BTC"),
        "state": L("open"), "contract_size": C("p_size"), "creation_timestamp": L(1_700_000_000_000), "expiration_timestamp": L(1_800_000_000_000),
        "option_type": F.when(C("p_size") > 25, "put"), "strike": C("p_size"),
    }
    item = F.struct(*(c.alias(k) for k, c in names.items()))
    return _rows(_pages(spark, d, "result", item, jsonrpc=L("2.0")), venues.DERIBIT_INSTRUMENTS, "symbol", "option_kind", "contract_size", "listed_ns")


@query("SELECT p_partkey::VARCHAR AS symbol, p_size::BIGINT AS size_decimals, CASE WHEN p_size > 25 THEN true END AS delisted FROM part")
def n11_hyperliquid_metadata(spark, d):
    item = F.struct(C("p_partkey").cast("string").alias("name"), C("p_size").alias("szDecimals"), L(20).alias("maxLeverage"), F.when(C("p_size") > 25, True).alias("isDelisted"))
    return _rows(_pages(spark, d, "universe", item), venues.HYPERLIQUID_UNIVERSE, "symbol", "size_decimals", "delisted")


def _listed(spark, d, category: str, items, pages: str = "p_partkey div 50"):
    """(page, payload): the second venue's instrument pages, items by id."""
    part = V.load(spark, d, "part")
    page = F.expr(pages)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", items.alias("item")))), lambda x: x["item"])
    result = F.struct(L(category).alias("category"), F.max(page).cast("string").alias("nextPageCursor"), listed.alias("list"))
    return part.groupBy(page.alias("page")).agg(F.to_json(F.struct(L(0).alias("retCode"), L("OK").alias("retMsg"), result.alias("result"), L(1_700_000_000_000).alias("time"))).alias("payload"))


@query(
    """WITH p AS (SELECT *, p_partkey // 50 AS page FROM part), bad AS (SELECT DISTINCT page FROM p WHERE p_partkey % 170 = 3)
    SELECT 'P' || p_partkey AS symbol, CASE WHEN p_size > 25 THEN 'Trading' ELSE 'PreLaunch' END AS native_state, p_size || '.000000000000000000' AS tick_size,
    CASE WHEN p_size > 10 THEN (p_size * 2) || '.000000000000000000' END AS lot_size, 1700000000000000000 AS observed_ns, p_size * 1000000 AS listed_ns, page::VARCHAR AS next_cursor
    FROM p WHERE page NOT IN (SELECT page FROM bad)"""
)
def n11_bybit_metadata(spark, d):
    """Linear contracts; pages with an instrument that has no quote asset are refused whole."""
    size = C("p_size").cast("string")
    item = F.struct(
        F.concat(L("P"), "p_partkey").alias("symbol"), F.when(C("p_size") > 25, "Trading").otherwise("PreLaunch").alias("status"), L("BTC").alias("baseCoin"),
        F.when(C("p_partkey") % 170 != 3, "USDT").otherwise("").alias("quoteCoin"), size.alias("launchTime"), F.struct(size.alias("tickSize")).alias("priceFilter"),
        F.struct(F.when(C("p_size") > 10, (C("p_size") * 2).cast("string")).otherwise("").alias("qtyStep")).alias("lotSizeFilter"), L(480).alias("fundingInterval"),
    )
    rows, _ = metadata.whole_pages(N.apply(_listed(spark, d, "linear", item), venues.BYBIT_INSTRUMENTS["linear"], keep=["page"]), ["page"])
    return filters.decimals_as_text(rows).select("symbol", "native_state", "tick_size", "lot_size", "observed_ns", "listed_ns", "next_cursor")


def _options(spark, d):
    """Options with seven kinds of faults by id, twenty to a page."""
    k, size = C("p_partkey"), C("p_size").cast("string")
    named = F.when(k % 400 == 21, k - 1).otherwise(k)
    day = F.when(k % 400 == 62, "30FEB24").otherwise("29FEB24")
    symbol = F.concat(L("C"), named.cast("string"), L("-"), day, L("-"), (named % 50 + 1).cast("string"), F.when(named % 2 == 0, "-C").otherwise("-P"), F.when(named % 3 == 0, "-USDT").otherwise(""))
    item = F.struct(
        symbol.alias("symbol"), F.when(k % 400 == 103, "").otherwise("Trading").alias("status"), F.concat(L("C"), F.when(k % 400 == 144, L("X")).otherwise(named.cast("string"))).alias("baseCoin"),
        F.when(k % 1200 == 585, "USDC").otherwise("USDT").alias("quoteCoin"), L("USDT").alias("settleCoin"), F.when((named % 2 == 0) != (k % 400 == 226), "Call").otherwise("Put").alias("optionsType"),
        L("1700000000000").alias("launchTime"), F.when(k % 400 == 267, "1709251200000").otherwise("1709251199999").alias("deliveryTime"), L("0.00015").alias("deliveryFeeRate"),
        F.struct(*(size.alias(n) for n in ("minPrice", "maxPrice", "tickSize"))).alias("priceFilter"), F.struct(*(size.alias(n) for n in ("minOrderQty", "maxOrderQty", "qtyStep"))).alias("lotSizeFilter"),
        L(True).alias("unifiedMarginTrade"),
    )
    mapped = N.apply(_listed(spark, d, "option", item, "p_partkey div 20"), venues.BYBIT_OPTION_INSTRUMENTS, keep=["page"])
    return metadata.whole_pages(mapped, ["page"], metadata.option_faults(mapped))


_OPTION_FAULT = """SELECT p_partkey // 20 AS page, p_partkey, CASE p_partkey % 400 WHEN 21 THEN 'repeated_symbol' WHEN 62 THEN 'symbol' WHEN 103 THEN 'invalid_field' WHEN 144 THEN 'base'
    WHEN 226 THEN 'kind' WHEN 267 THEN 'expiry' ELSE CASE WHEN p_partkey % 1200 = 585 THEN 'quote' END END AS fault FROM part"""


@query(f"WITH f AS ({_OPTION_FAULT}) SELECT page::BIGINT AS page, any_value(fault) AS fault, (min(CASE WHEN fault IS NOT NULL THEN p_partkey END) - min(p_partkey))::BIGINT AS at FROM f GROUP BY page HAVING count(fault) > 0")
def n11_bybit_option_faults(spark, d):
    return _options(spark, d)[1].withColumn("page", C("page").cast("long"))


@query(
    f"""WITH f AS ({_OPTION_FAULT}) SELECT 'C' || p_partkey || '-29FEB24-' || (p_partkey % 50 + 1) || CASE WHEN p_partkey % 2 = 0 THEN '-C' ELSE '-P' END || CASE WHEN p_partkey % 3 = 0 THEN '-USDT' ELSE '' END AS symbol,
    CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_kind, (p_partkey % 50 + 1)::VARCHAR AS strike, 1709251199999000000 AS expiry_ns FROM part
    WHERE p_partkey // 20 NOT IN (SELECT page FROM f WHERE fault IS NOT NULL)"""
)
def n11_bybit_option_metadata(spark, d):
    rows = _options(spark, d)[0]
    return rows.select("symbol", "option_kind", metadata.option_identity(C("symbol"))["strike"].alias("strike"), "expiry_ns")


# ---- row contracts ------------------------------------------------------------------------------------------


def _broken(rows, family: str):
    return filters.with_violations(rows, family).select("native_trade_id", F.array_join("violations", ",").alias("broken"))


def _pick(values, by=None):
    by = C("native_trade_id") if by is None else by
    return F.element_at(F.array(*map(L, values)), (by % len(values) + 1).cast("int"))


def _contract_sql(*rules):
    """Names of the broken ones of (name, SQL condition), in order."""
    return "SELECT native_trade_id, concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in rules) + ") AS broken FROM trades"


_K = "native_trade_id"


@query(
    _contract_sql(
        ("schema", f"{_K} % 31 <> 1"), ("source", f"{_K} % 31 <> 2"), ("channel", f"{_K} % 31 <> 3"), ("instrument", f"{_K} % 31 NOT IN (4, 5)"), ("ordinal", f"{_K} % 31 <> 6"), ("receive_time", "true"),
        ("mapper", f"{_K} % 31 <> 7"), ("epoch", f"{_K} % 31 <> 8"), ("immutable", f"{_K} % 31 NOT IN (9, 10)"), ("exchange_time", f"{_K} % 31 <> 11"), ("source_time", f"{_K} % 31 <> 12"),
        ("flags", f"{_K} % 31 NOT IN (13, 14)"),
    ),
    ["trades"],
)
def f8_common_contract(spark, d):
    """The columns that all families share, each broken in one way or two: too long, empty, NUL, no digest, no resolution, flags."""
    k = C("native_trade_id") % 31
    bad = lambda n, wrong, right: F.when(k == n, wrong).otherwise(right)
    long, good = F.repeat(L("é"), 65), F.sha2("instrument_uid", 256)
    flags = F.when(k == 13, F.array(*map(L, sorted(X.QUALITY_FLAGS, reverse=True)[:2]))).when(k == 14, F.array(L("odd"))).when(k == 15, F.array().cast("array<string>")).otherwise(F.array(*map(L, sorted(X.QUALITY_FLAGS)[:2])))
    rows = V.trades(spark, d).withColumns(
        {
            "schema_name": bad(1, long, L("trade")), "source_id": bad(2, long, C("source_id")), "channel_id": bad(3, long, C("channel_id")),
            "instrument_uid": F.when(k == 4, F.repeat(L("é"), 129)).when(k == 5, L("a\0b")).when(k == 16, F.repeat(L("é"), 128)).otherwise(C("instrument_uid")), "arrival_ordinal": bad(6, L(0), k + 1),
            "mapper_version": bad(7, L(""), L("v1")), "epoch_kind": bad(8, L("odd"), _pick(filters.EPOCH_KINDS)), "segment_sha256": bad(9, F.repeat(L("0"), 64), good), "payload_sha256": bad(10, F.upper(good), good),
            "exchange_resolution": bad(11, L("absent"), L("millisecond")), "source_resolution": bad(12, L("absent"), L("second")), "quality_flags": flags,
        }
    )
    broken = filters.violations(filters.metadata_rules(["segment_sha256", "payload_sha256"]))
    return rows.select("native_trade_id", F.array_join(broken, ",").alias("broken"))


@query(_contract_sql(("bid", "price > 0 AND amount >= 0"), ("ask", "price + native_trade_id % 3 - 1 > 0 AND amount >= 0"), ("not_crossed", "native_trade_id % 3 = 2")), ["trades"])
def f8_quote_contract(spark, d):
    ask = (C("price") + C("native_trade_id") % 3 - 1).cast("decimal(38,18)")
    rows = V.trades(spark, d).withColumns({"bid_price": C("price"), "bid_amount": C("amount"), "ask_price": ask, "ask_amount": C("amount")})
    return _broken(rows, "quote")


@query(
    _contract_sql(
        ("window", "native_trade_id % 5 > 0"), ("duration", "native_trade_id % 5 > 0"), ("trade_ids", "native_trade_id % 7 <= 3"), ("range", "native_trade_id % 2 = 0 AND price >= 0"),
    ),
    ["trades"],
)
def f8_ticker_contract(spark, d):
    k = C("native_trade_id")
    start = C("received_time_ns") - F.when(k % 5 > 0, L(filters.DAY_NS)).otherwise(1)
    high = F.when(k % 2 == 0, C("price")).otherwise(-F.abs("price") - 1)
    rows = V.trades(spark, d).withColumns(
        {"window_start_ns": start, "window_end_ns": C("received_time_ns"), "window_ns": L(filters.DAY_NS), "first_trade_id": k % 7, "last_trade_id": L(3), "low": C("price"), "last": C("price"), "high": high}
    )
    return _broken(rows, "ticker")


@query(_contract_sql(("role", "native_trade_id % 4 > 0"), ("open_interest", "native_trade_id % 3 > 0"), ("mark", "native_trade_id % 2 = 1 OR price > 0"), ("age", "true")), ["trades"])
def f8_derivative_contract(spark, d):
    k = C("native_trade_id")
    units = F.when(k % 3 == 0, F.array(L("oi"), L("oi"))).otherwise(F.array(L("oi"), L("base")))
    rows = V.trades(spark, d).withColumns(
        {"source_role": F.when(k % 4 > 0, "mark").otherwise(""), "open_interest_units": units, "mark_price": F.when(k % 2 == 0, C("price")), "age_ns": C("received_time_ns") - C("exchange_time_ns")}
    )
    return _broken(rows, "derivative_ticker")


@query(
    _contract_sql(
        ("side", "native_trade_id % 3 < 2"), ("side_meaning", "native_trade_id % 4 < 3"), ("price", "price > 0"), ("price_kind", "native_trade_id % 6 < 5"),
        ("window", "CASE native_trade_id % 2 WHEN 0 THEN true ELSE native_trade_id % 5 > 0 END"),
    ),
    ["trades"],
)
def f8_liquidation_contract(spark, d):
    """Even ids are complete feeds, odd ones the largest of a window per symbol, which must have a length."""
    k = C("native_trade_id")
    even = k % 2 == 0
    span = F.when(even | (k % 5 == 0), 0).otherwise(1_000_000_000)
    rows = V.trades(spark, d).withColumns(
        {
            "side": _pick(("buy", "sell", "long")), "side_meaning": _pick((*filters.SIDE_MEANINGS, "odd")), "price_kind": _pick((*filters.PRICE_KINDS, "odd")),
            "completeness": F.when(even, "complete").otherwise("largest_in_window"), "selection": F.when(even, "all_observed").otherwise("largest_per_symbol"),
            "window_start_ns": C("received_time_ns"), "window_end_ns": C("received_time_ns") + span, "window_ns": span, "per_symbol": ~even,
        }
    )
    return _broken(rows, "liquidation")


@query(
    _contract_sql(("identity", "native_trade_id % 5 > 0"), ("kind", "native_trade_id % 3 < 2"), ("strike", "price > 0"), ("expiry", "true"), ("volatility_unit", "native_trade_id % 4 <> 2")),
    ["trades"],
)
def f8_option_contract(spark, d):
    k = C("native_trade_id")
    rows = V.trades(spark, d).withColumns(
        {
            "underlying": F.when(k % 5 > 0, "BTC"), "index": L("btc_usd"), "option_kind": _pick(("call", "put", "other")), "strike": C("price"), "expiry_ns": C("received_time_ns"),
            "mark_iv": F.when(k % 2 == 0, C("amount")), "iv_unit": _pick(("implied_volatility", "rate", "percent", "percent")),
        }
    )
    return _broken(rows, "option_summary")


@query(_contract_sql(("generation", "native_trade_id % 7 > 0"), ("resolution", "native_trade_id % 5 < 4"), ("change", "native_trade_id % 3 > 0"), ("states", "native_trade_id % 4 < 3")), ["trades"])
def f8_instrument_contract(spark, d):
    k = C("native_trade_id")
    after = _pick(("listed", "suspended", "delisted", "odd"))
    before = F.when(k % 3 == 0, after).when(k % 3 == 1, "auction")
    rows = V.trades(spark, d).withColumns(
        {"generation": F.when(k % 7 > 0, k), "resolution": _pick((*filters.RESOLUTIONS, "odd")), "state_before": before, "state_after": after, "changed_terms": F.array().cast("array<string>")}
    )
    return _broken(rows, "instrument_event")


@query(
    _contract_sql(
        ("dimension", "native_trade_id % 3 < 2"), ("scope", "native_trade_id % 7 < 6"), ("status", "native_trade_id % 4 < 3"), ("window", "native_trade_id % 5 > 1"),
        ("change", "native_trade_id % 2 = 0"),
    ),
    ["trades"],
)
def f8_health_contract(spark, d):
    """Ids that are 0 mod 5 lack one bound of their window, those that are 1 mod 5 have it reversed."""
    k = C("native_trade_id")
    now = _pick(("up", "down", "stale", "odd"))
    rows = V.trades(spark, d).withColumns(
        {
            "dimension": _pick(("dns", "clock", "odd")), "scope": _pick((*filters.HEALTH_SCOPES, "odd")), "status": now, "previous_status": F.when(k % 2 == 1, now),
            "window_start_ns": C("received_time_ns") + F.when(k % 5 == 1, 1).otherwise(0), "window_end_ns": F.when(k % 5 > 0, C("received_time_ns")),
        }
    )
    return _broken(rows, "source_health")


@query(
    """SELECT opportunity_id, concat_ws(',', CASE WHEN opportunity_id % 3 = 0 THEN 'sources' END, CASE WHEN opportunity_id % 70 > 64 THEN 'channels' END,
    CASE WHEN opportunity_id % 12000 NOT BETWEEN 1 AND 10000 THEN 'limit' END, CASE WHEN opportunity_id % 4 = 0 THEN 'range' END, CASE WHEN opportunity_id % 4 = 3 THEN 'span' END) AS faults FROM opportunities""",
    ["opportunities"],
)
def f2_spec_validation(spark, d):
    """Logged query specs checked in bulk: id lists sorted and unique and within their caps, limit, time range."""
    k = C("opportunity_id")
    sources = F.when(k % 3 == 0, F.array(L("b"), L("a"))).otherwise(F.array(L("a"), L("b")))
    channels = F.transform(F.sequence(L(1), F.greatest(k % 70, L(1))), lambda x: F.lpad(x.cast("string"), 3, "0"))
    span = F.element_at(F.array(L(0), L(1), L(filters.MOST_NS), L(filters.MOST_NS + 1)), (k % 4 + 1).cast("int"))
    faults = filters.spec_faults(L(1).cast("long"), L(1) + span, k % 12_000, sources, channels, F.array().cast("array<string>"))
    return V.opportunities(spark, d).select("opportunity_id", F.array_join(faults, ",").alias("faults"))
