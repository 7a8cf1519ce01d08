"""Queries of the venue jobs: messages made from the views, mapped back; the views are what they must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import normalize as N
from tickloom.operators import venues, windows
from tickloom.plans import messages as G
from tickloom.plans import views as V
from tickloom.plans.registry import query

C, L = F.col, F.lit
P2 = "CAST(CAST(price AS DECIMAL(38,18)) AS VARCHAR) AS price, CAST(CAST(amount AS DECIMAL(38,18)) AS VARCHAR) AS amount"
TIME = "received_time_ns // 1000000 * 1000000 AS trade_time_ns"
SIDE = "CASE WHEN buyer_is_maker THEN 'sell' ELSE 'buy' END AS side"
TRADE_SQL = f"SELECT instrument_uid AS symbol, native_trade_id::VARCHAR AS id, {P2}, {TIME}, {SIDE} FROM trades"
BROKEN = "native_trade_id % 13 BETWEEN 1 AND 5"


def _trades(df):
    t = lambda c: C(c).cast("string").alias(c)
    return df.select("symbol", C("native_trade_id").cast("string").alias("id"), t("price"), t("amount"), "trade_time_ns", "side")


def _accepted(raw, mapping):
    return N.split(N.apply(raw, mapping))[0]


@query(f"{TRADE_SQL} WHERE NOT ({BROKEN})", ["trades"])
def n1_spot_trades(spark, d):
    return _trades(_accepted(V.raw_json(spark, d), venues.SPOT["trade"]))


@query("SELECT event_id, side, level_ordinal, CAST(price AS VARCHAR) AS price, CAST(amount AS VARCHAR) AS amount, first_sequence, last_sequence FROM (SELECT event_id, side, price, amount, row_number() OVER (PARTITION BY event_id, side ORDER BY level_ordinal) - 1 AS level_ordinal FROM book_levels) JOIN book_events USING (event_id)", ["book_levels", "book_events"])
def n1_spot_depth(spark, d):
    raw = G.from_books(spark, d, lambda: {"e": L("depthUpdate"), "E": C("ms"), "s": C("instrument_uid"), "U": C("first_sequence"), "u": C("last_sequence"), "b": C("bids"), "a": C("asks")})
    rows = N.split(N.apply(raw, venues.SPOT["depth"], keep=["event_id"]))[0]
    levels = rows.select("event_id", "first_sequence", "last_sequence", F.inline(F.concat("bids", "asks")))
    return levels.select("event_id", "side", "level_ordinal", C("price").cast("string").alias("price"), C("amount").cast("string").alias("amount"), "first_sequence", "last_sequence")


@query("SELECT native_trade_id AS update_id, CAST(price AS VARCHAR) AS bid_price, CAST(price + 1 AS VARCHAR) AS ask_price FROM trades", ["trades"])
def n1_spot_quotes(spark, d):
    raw = G.from_trades(spark, d, u=C("native_trade_id"), s=C("instrument_uid"), b=C("p"), B=C("q"), a=(C("p").cast("decimal(18,2)") + 1).cast("string"), A=C("q"))
    return _accepted(raw, venues.SPOT["quote"]).select("update_id", C("bid_price").cast("string").alias("bid_price"), C("ask_price").cast("string").alias("ask_price"))


@query("SELECT instrument_uid AS symbol, native_trade_id AS trades, CAST(price AS VARCHAR) AS last, 86400000000000 AS window_ns FROM trades", ["trades"])
def n1_spot_tickers(spark, d):
    p = C("p")
    raw = G.from_trades(
        spark, d, e=L("24hrTicker"), E=C("ms"), s=C("instrument_uid"), p=p, P=p, w=p, x=p, c=p, Q=C("q"), b=p, B=p, a=p, A=p, o=p, h=p, l=p, v=C("q"), q=C("q"),
        O=C("ms") - 86_400_000, C=C("ms"), F=L(1), L=L(2), n=C("native_trade_id"),
    )
    rows = _accepted(raw, venues.SPOT["ticker"])
    return rows.select("symbol", "trades", C("last").cast("string").alias("last"), (C("window_end_ns") - C("window_start_ns")).alias("window_ns"))


@query("SELECT event_id, last_sequence, levels FROM book_events", ["book_events"])
def n2_spot_snapshots(spark, d):
    raw = G.from_books(spark, d, lambda: {"lastUpdateId": C("last_sequence"), "bids": C("bids"), "asks": C("asks")})
    rows = N.split(N.apply(raw, venues.SPOT_SNAPSHOT, keep=["event_id"]))[0]
    return rows.select("event_id", "last_sequence", (F.size("bids") + F.size("asks")).cast("long").alias("levels"))


def _aggregate(spark, d, **more):
    return G.from_trades(spark, d, e=L("aggTrade"), E=C("ms"), s=C("instrument_uid"), a=C("native_trade_id"), p=C("p"), q=C("q"), f=L(1), l=L(2), T=C("ms"), m=C("maker"), **more)


@query(TRADE_SQL, ["trades"])
def n3_usdm_trades(spark, d):
    return _trades(_accepted(_aggregate(spark, d, nq=C("q")), venues.USDM["trade"]))


@query("SELECT instrument_uid AS symbol, CAST(price AS VARCHAR) AS mark_price, NULL::VARCHAR AS funding_rate, received_time_ns // 1000000 * 1000000 AS event_time_ns FROM trades", ["trades"])
def n3_usdm_marks(spark, d):
    raw = G.from_trades(spark, d, e=L("markPriceUpdate"), E=C("ms"), s=C("instrument_uid"), p=C("p"), i=C("p"), P=C("p"), r=L(""), T=C("ms"))
    return _accepted(raw, venues.USDM["mark"]).select("symbol", C("mark_price").cast("string").alias("mark_price"), C("funding_rate").cast("string").alias("funding_rate"), "event_time_ns")


@query(f"SELECT instrument_uid AS symbol, {P2}, {TIME}, {SIDE} FROM trades", ["trades"])
def n3_usdm_liquidations(spark, d):
    o = F.struct(
        C("instrument_uid").alias("s"), F.upper("direction").alias("S"), L("LIMIT").alias("o"), L("IOC").alias("f"), C("q").alias("q"), C("p").alias("p"), C("p").alias("ap"),
        L("FILLED").alias("X"), C("q").alias("l"), C("q").alias("z"), C("ms").alias("T"),
    )
    rows = _accepted(G.from_trades(spark, d, e=L("forceOrder"), E=C("ms"), o=o), venues.USDM["liquidation"])
    return rows.select("symbol", C("price").cast("string").alias("price"), C("amount").cast("string").alias("amount"), "trade_time_ns", "side")


@query("SELECT event_id, first_sequence, last_sequence, first_sequence - 1 AS previous_sequence FROM book_events", ["book_events"])
def n3_usdm_depth(spark, d):
    raw = G.from_books(spark, d, lambda: {"e": L("depthUpdate"), "E": C("ms"), "T": C("ms"), "s": C("instrument_uid"), "U": C("first_sequence"), "u": C("last_sequence"), "pu": C("first_sequence") - 1, "b": C("bids"), "a": C("asks")})
    return N.split(N.apply(raw, venues.USDM["depth"], keep=["event_id"]))[0].select("event_id", "first_sequence", "last_sequence", "previous_sequence")


@query(TRADE_SQL, ["trades"])
def n4_coinm_trades(spark, d):
    return _trades(_accepted(_aggregate(spark, d, ps=L("BTCUSD")), venues.COINM["trade"]))


@query("SELECT native_trade_id, CASE native_trade_id % 3 WHEN 1 THEN 'usdm' WHEN 2 THEN 'coinm' ELSE 'rejected' END AS market FROM trades", ["trades"])
def n5_merged_stream(spark, d):
    rows = _aggregate(spark, d, st=C("native_trade_id") % 3).withColumn("payload", F.concat(L("["), "payload", L("]")))
    return N.merged_stream_route(rows).select("native_trade_id", "market")


@query(TRADE_SQL, ["trades"])
def n6_bybit_trades(spark, d):
    item = F.struct(
        C("ms").alias("T"), C("instrument_uid").alias("s"), F.initcap("direction").alias("S"), C("q").alias("v"), C("p").alias("p"), C("native_trade_id").cast("string").alias("i"),
        L(False).alias("BT"), C("native_trade_id").alias("seq"),
    )
    raw = G.from_trades(spark, d, topic=F.concat(L("publicTrade."), "instrument_uid"), type=L("snapshot"), ts=C("ms"), data=F.array(item))
    return _trades(_accepted(raw, venues.BYBIT["trade"]))


@query("SELECT event_id, last_sequence, levels FROM book_events", ["book_events"])
def n6_bybit_books(spark, d):
    data = lambda: F.struct(C("instrument_uid").alias("s"), C("bids").alias("b"), C("asks").alias("a"), C("last_sequence").alias("u"), C("last_sequence").alias("seq"))
    raw = G.from_books(spark, d, lambda: {"topic": L("orderbook.50.X"), "ts": C("ms"), "type": L("delta"), "data": data(), "cts": C("ms")})
    rows = N.split(N.apply(raw, venues.BYBIT["book"], keep=["event_id"]))[0]
    return rows.select("event_id", "last_sequence", (F.size("bids") + F.size("asks")).cast("long").alias("levels"))


@query(f"SELECT instrument_uid AS symbol, {P2}, {TIME}, {SIDE} FROM trades", ["trades"])
def n6_bybit_liquidations(spark, d):
    item = F.struct(C("ms").alias("T"), C("instrument_uid").alias("s"), F.initcap("direction").alias("S"), C("q").alias("v"), C("p").alias("p"))
    rows = _accepted(G.from_trades(spark, d, topic=L("allLiquidation.X"), type=L("snapshot"), ts=C("ms"), data=F.array(item)), venues.BYBIT["liquidation"])
    return rows.select("symbol", C("price").cast("string").alias("price"), C("amount").cast("string").alias("amount"), "trade_time_ns", "side")


@query("SELECT instrument_uid AS symbol, CAST(price AS VARCHAR) AS mark_price, CAST(amount AS VARCHAR) AS open_interest, '0.500000000000000000' AS delta FROM trades", ["trades"])
def n7_bybit_options(spark, d):
    p, g = C("p"), L("0.5")
    data = F.struct(
        C("instrument_uid").alias("symbol"), p.alias("bidPrice"), p.alias("askPrice"), g.alias("bidIv"), g.alias("askIv"), p.alias("markPrice"), g.alias("markPriceIv"),
        C("q").alias("openInterest"), g.alias("delta"), g.alias("gamma"), g.alias("vega"), g.alias("theta"),
    )
    rows = _accepted(G.from_trades(spark, d, topic=L("tickers.BTC-1JAN25-50000-C"), type=L("snapshot"), ts=C("ms"), data=data), venues.BYBIT["option"])
    return rows.select("symbol", C("mark_price").cast("string").alias("mark_price"), C("open_interest").cast("string").alias("open_interest"), C("delta").cast("string").alias("delta"))


@query(TRADE_SQL, ["trades"])
def n8_okx_trades(spark, d):
    item = F.struct(C("instrument_uid").alias("instId"), C("native_trade_id").cast("string").alias("tradeId"), C("p").alias("px"), C("q").alias("sz"), C("direction").alias("side"), C("ms").cast("string").alias("ts"), L("1").alias("count"))
    raw = G.from_trades(spark, d, arg=F.struct(L("trades").alias("channel"), C("instrument_uid").alias("instId")), data=F.array(item))
    return _trades(_accepted(raw, venues.OKX["trade"]))


@query("SELECT event_id, instrument_uid AS symbol, last_sequence, first_sequence - 1 AS previous_sequence, levels FROM book_events", ["book_events"])
def n8_okx_books(spark, d):
    def build():
        item = F.struct(C("asks"), C("bids"), C("ms").cast("string").alias("ts"), L(-5).alias("checksum"), (C("first_sequence") - 1).alias("prevSeqId"), C("last_sequence").alias("seqId"))
        return {"arg": F.struct(L("books").alias("channel"), C("instrument_uid").alias("instId")), "action": L("update"), "data": F.array(item)}

    rows = N.split(N.apply(G.from_books(spark, d, build), venues.OKX["book"], keep=["event_id"]))[0]
    return rows.select("event_id", "symbol", "last_sequence", "previous_sequence", (F.size("bids") + F.size("asks")).cast("long").alias("levels"))


@query(f"SELECT instrument_uid AS symbol, {P2}, {TIME}, {SIDE} FROM trades", ["trades"])
def n8_okx_liquidations(spark, d):
    detail = F.struct(C("direction").alias("side"), L("long").alias("posSide"), C("p").alias("bkPx"), C("q").alias("sz"), L("0").alias("bkLoss"), L("USD").alias("ccy"), C("ms").cast("string").alias("ts"))
    item = F.struct(L("SWAP").alias("instType"), L("BTC-USD").alias("instFamily"), C("instrument_uid").alias("instId"), L("BTC-USD").alias("uly"), F.array(detail).alias("details"))
    raw = G.from_trades(spark, d, arg=F.struct(L("liquidation-orders").alias("channel")), data=F.array(item))
    rows = N.split(N.apply(_accepted(raw, venues.OKX["liquidation"]).drop("message_ordinal"), venues.OKX_LIQUIDATION_DETAIL, "details", keep=["symbol"]))[0]
    return rows.select("symbol", C("price").cast("string").alias("price"), C("amount").cast("string").alias("amount"), "trade_time_ns", "side")


@query(TRADE_SQL, ["trades"])
def n9_deribit_trades(spark, d):
    price, amount = C("p").cast("decimal(18,2)"), C("q").cast("decimal(18,2)")
    item = F.struct(
        C("native_trade_id").alias("trade_seq"), C("native_trade_id").cast("string").alias("trade_id"), C("instrument_uid").alias("instrument_name"), C("direction"), price.alias("price"),
        amount.alias("amount"), price.alias("mark_price"), price.alias("index_price"), C("ms").alias("timestamp"),
    )
    raw = G.from_trades(spark, d, params=F.struct(L("trades.X.raw").alias("channel"), F.array(item).alias("data")))
    return _trades(_accepted(raw, venues.DERIBIT["trade"]))


@query("SELECT event_id, last_sequence, first_sequence - 1 AS previous_sequence, levels FROM book_events", ["book_events"])
def n9_deribit_books(spark, d):
    def build():
        tag = lambda side: F.transform(side, lambda x: F.concat(F.array(L("new")), x))
        data = F.struct(L("change").alias("type"), C("ms").alias("timestamp"), C("instrument_uid").alias("instrument_name"), C("last_sequence").alias("change_id"), (C("first_sequence") - 1).alias("prev_change_id"), tag("bids").alias("bids"), tag("asks").alias("asks"))
        return {"params": F.struct(L("book.X.raw").alias("channel"), data.alias("data"))}

    rows = N.split(N.apply(G.from_books(spark, d, build), venues.DERIBIT["book"], keep=["event_id"]))[0]
    return rows.select("event_id", "last_sequence", "previous_sequence", (F.size("bids") + F.size("asks")).cast("long").alias("levels"))


@query("SELECT instrument_uid AS symbol, CAST(price AS VARCHAR) AS mark_price, CAST(amount AS VARCHAR) AS open_interest FROM trades", ["trades"])
def n9_deribit_tickers(spark, d):
    number = lambda c: C(c).cast("decimal(18,2)")
    data = F.struct(C("instrument_uid").alias("instrument_name"), number("p").alias("mark_price"), number("p").alias("index_price"), number("q").alias("open_interest"), C("ms").alias("timestamp"))
    rows = _accepted(G.from_trades(spark, d, params=F.struct(L("ticker.X.raw").alias("channel"), data.alias("data"))), venues.DERIBIT["ticker"])
    return rows.select("symbol", C("mark_price").cast("string").alias("mark_price"), C("open_interest").cast("string").alias("open_interest"))


@query(f"{TRADE_SQL} UNION ALL {TRADE_SQL}", ["trades"])
def n10_hyperliquid_trades(spark, d):
    side = F.when(C("maker"), "A").otherwise("B")
    item = F.struct(C("instrument_uid").alias("coin"), side.alias("side"), C("p").alias("px"), C("q").alias("sz"), L("0x1").alias("hash"), C("ms").alias("time"), C("native_trade_id").alias("tid"))
    return _trades(_accepted(G.from_trades(spark, d, channel=L("trades"), data=F.array(item, item)), venues.HYPERLIQUID["trade"]))


@query("SELECT instrument_uid AS symbol, CAST(price AS VARCHAR) AS mark_price, NULL::VARCHAR AS mid_price FROM trades", ["trades"])
def n10_hyperliquid_contexts(spark, d):
    ctx = F.struct(L("0.01").alias("funding"), C("q").alias("openInterest"), C("p").alias("oraclePx"), C("p").alias("markPx"), L(None).cast("string").alias("midPx"))
    rows = _accepted(G.from_trades(spark, d, channel=L("activeAssetCtx"), data=F.struct(C("instrument_uid").alias("coin"), ctx.alias("ctx"))), venues.HYPERLIQUID["context"])
    return rows.select("symbol", C("mark_price").cast("string").alias("mark_price"), C("mid_price").cast("string").alias("mid_price"))


@query("SELECT instrument_uid AS symbol, CAST(amount AS VARCHAR) AS funding_rate, received_time_ns // 1000000 * 1000000 AS event_time_ns FROM trades", ["trades"])
def n10_funding_history(spark, d):
    raw = G.from_trades(spark, d, coin=C("instrument_uid"), fundingRate=C("q"), premium=C("q"), time=C("ms")).withColumn("payload", F.concat(L("["), "payload", L("]")))
    return _accepted(raw, venues.FUNDING_HISTORY).select("symbol", C("funding_rate").cast("string").alias("funding_rate"), "event_time_ns")


@query("SELECT p_partkey::VARCHAR AS symbol, CASE WHEN p_size > 25 THEN 'TRADING' ELSE 'BREAK' END AS state, p_size::VARCHAR AS tick_size FROM part")
def n11_exchange_metadata(spark, d):
    part = V.load(spark, d, "part")
    rule = F.struct(L("PRICE_FILTER").alias("filterType"), C("p_size").cast("string").alias("tickSize"))
    symbol = F.struct(C("p_partkey").cast("string").alias("symbol"), F.when(C("p_size") > 25, "TRADING").otherwise("BREAK").alias("status"), C("p_brand").alias("baseAsset"), L("USD").alias("quoteAsset"), F.array(rule).alias("filters"))
    pages = part.groupBy(F.expr("p_partkey div 50").alias("page")).agg(F.to_json(F.struct(F.collect_list(symbol).alias("symbols"))).alias("payload"))
    rows = _accepted(pages, venues.SYMBOLS)
    rules = F.map_from_entries(F.transform(F.from_json("filters", "array<struct<filterType:string,tickSize:string>>"), lambda f: F.struct(f["filterType"], f["tickSize"])))
    return rows.select("symbol", "state", rules["PRICE_FILTER"].alias("tick_size"))


@query("SELECT native_trade_id, CASE native_trade_id % 13 WHEN 1 THEN 'schema_unknown' WHEN 2 THEN 'schema_type_or_meaning_change' END AS code FROM raw_json", ["raw_json"])
def n12_fingerprint_routing(spark, d):
    raw = V.raw_json(spark, d)
    shapes = N.fingerprint_route(raw.where("native_trade_id % 13 IN (0, 2, 6)"), spark.createDataFrame([], "fingerprint string, class string"))
    kind = F.when(C("native_trade_id") % 13 == 0, "exact").when(C("native_trade_id") % 13 == 2, "type_change").otherwise("additive")
    rules = shapes.select("fingerprint", kind.alias("class")).distinct()
    return N.fingerprint_route(raw, rules).select("native_trade_id", "code")


@query(
    """SELECT native_trade_id, 'price' AS bad_field, CASE native_trade_id % 13 WHEN 1 THEN 'missing' WHEN 2 THEN 'null' WHEN 3 THEN 'empty' ELSE 'value' END AS bad_state,
    sha256('10:quarantine|' || strlen(source_id) || ':' || source_id || '|' || strlen(native_trade_id::VARCHAR) || ':' || native_trade_id) AS quarantine_id FROM raw_json WHERE native_trade_id % 13 BETWEEN 1 AND 5""",
    ["raw_json"],
)
def n13_quarantine(spark, d):
    raw = N.split(N.apply(V.raw_json(spark, d).withColumnRenamed("native_trade_id", "record_id"), venues.SPOT["trade"], keep=["source_id", "record_id"]))[1]
    return raw.select(C("record_id").alias("native_trade_id"), "bad_field", "bad_state", N.quarantine_id("source_id", "record_id").alias("quarantine_id"))


@query("SELECT native_trade_id AS record_id, 'lost' AS fault FROM trades WHERE native_trade_id % 100 = 7 AND NOT (native_trade_id % 13 BETWEEN 1 AND 5)", ["trades"])
def n14_accounting(spark, d):
    raw = V.raw_json(spark, d).withColumnRenamed("native_trade_id", "record_id")
    rows, bad = N.split(N.apply(raw, venues.SPOT["trade"], keep=["record_id"]))
    return N.accounting(raw, rows.where("record_id % 100 <> 7"), bad, ["record_id"])


@query("SELECT source_id, epoch_id, arrival_ordinal FROM arrivals_gapped GROUP BY ALL HAVING count(*) > 1", ["arrivals_gapped"])
def n15_order_check(spark, d):
    rows = V.arrivals_gapped(spark, d).withColumn("position", C("arrival_ordinal"))
    return windows.order_faults(rows, ["source_id", "epoch_id"], "position", ["arrival_ordinal"]).select("source_id", "epoch_id", "arrival_ordinal")


@query("SELECT native_trade_id, CASE native_trade_id % 4 WHEN 0 THEN 'continue' WHEN 1 THEN 'transition' ELSE CASE WHEN buyer_is_maker THEN 'fail_closed' ELSE 'quarantine' END END AS action FROM trades", ["trades"])
def n16_drift_action(spark, d):
    kind = F.element_at(F.array(*map(L, ("exact", "additive", "semantic", "type_change"))), (C("native_trade_id") % 4 + 1).cast("int"))
    return V.trades(spark, d).select("native_trade_id", N.drift_action(kind, C("buyer_is_maker")).alias("action"))


@query(f"SELECT native_trade_id, {SIDE} FROM trades", ["trades"])
def n17_aggressor_side(spark, d):
    from tickloom.functions.scalars import aggressor_side

    return V.trades(spark, d).select("native_trade_id", aggressor_side(C("buyer_is_maker")).alias("side"))
