"""Registered queries over forms with broken ones among them, contracts, packs, rescans and streams' batch versions, each beside its DuckDB SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions import contracts
from barloom.functions.packs import Packs
from barloom.plans import sql
from barloom.plans.registry import Registry
from barloom.sources import file_tables, ownership_forms, tables
from barloom.streaming import bar_watch, reactions

R = Registry()

# --- forms -------------------------------------------------------------------------------------------------------------------------------------

_BROKEN = "CASE WHEN o_orderkey % 11 = 0 THEN 'tag' WHEN o_orderkey % 13 = 0 THEN 'and' WHEN o_orderkey % 17 = 0 THEN 'none' END"


def _forms(spark, d):  # noqa: ANN001, ANN202
    """A form for each order; some lack an end tag, have a bare ampersand, or are empty."""
    def transaction(tag: str, nth: str) -> str:
        return f"""concat('<{tag}><securityTitle><value>Share ', {nth}, '</value></securityTitle><transactionDate><value>', CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE concat(to_date(o_orderdate), '-05:00') END, '</value></transactionDate><transactionCoding>',
 CASE WHEN {nth} = 1 THEN '<transactionCode><value>S</value></transactionCode>' ELSE '<transactionCode>P</transactionCode>' END, '</transactionCoding><transactionAmounts><transactionShares><value>', {nth} + 2, '</value></transactionShares><transactionPricePerShare><value>', CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE cast(o_custkey AS string) END,
 '</value></transactionPricePerShare></transactionAmounts><ownershipNature><directOrIndirectOwnership><value>', CASE WHEN o_custkey % 2 = 0 THEN 'D' ELSE 'I' END, '</value></directOrIndirectOwnership></ownershipNature></{tag}>')"""

    xml = f"""concat('<?xml version="1.0"?><ownershipDocument><issuer><issuerCik>', o_custkey * 3, '</issuerCik><issuerTradingSymbol>tk', o_custkey % 90, '</issuerTradingSymbol>', CASE WHEN kind <=> 'tag' THEN '' ELSE '</issuer>' END,
 '<reportingOwner><reportingOwnerId><rptOwnerCik>', o_orderkey % 100, '</rptOwnerCik><rptOwnerName>A ', CASE WHEN kind <=> 'and' THEN '&' ELSE '&amp;' END, ' B ', o_custkey % 7, '</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>', o_orderkey % 2, '</isDirector><isOfficer>', CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END,
 '</isOfficer><officerTitle>Title ', o_orderkey % 4, '</officerTitle></reportingOwnerRelationship></reportingOwner><nonDerivativeTable>', array_join(transform(sequence(0, cast(o_orderkey % 3 AS int)), n -> {transaction('nonDerivativeTransaction', 'n')}), ''), '</nonDerivativeTable><derivativeTable>',
 CASE WHEN o_orderkey % 4 = 1 THEN {transaction('derivativeTransaction', '0')} ELSE '' END, '</derivativeTable></ownershipDocument>')"""
    o = tables.dealt(spark, d, "orders", "o_orderkey", 1 << 20).withColumn("kind", F.expr(_BROKEN))
    return o.select("o_orderkey", F.expr(f"CASE WHEN kind <=> 'none' THEN '' ELSE {xml} END").alias("xml"))


@R.query(f"""WITH o AS (SELECT *, {_BROKEN} AS kind FROM orders), t AS (SELECT *, false AS d, unnest(range(0, (o_orderkey % 3 + 1)::BIGINT)) AS nth FROM o WHERE kind IS NULL UNION ALL SELECT *, true, 0 FROM o WHERE kind IS NULL AND o_orderkey % 4 = 1)
SELECT o_orderkey AS id, 'TK' || o_custkey % 90 AS ticker, (o_custkey * 3)::VARCHAR AS issuer_cik, 'A & B ' || o_custkey % 7 AS owner, (o_orderkey % 100)::VARCHAR AS owner_cik, o_orderkey % 2 = 1 AS is_director, o_orderkey % 3 = 0 AS is_officer, false AS is_ten_percent_owner,
 'Title ' || o_orderkey % 4 AS officer_title, d AS is_derivative, nth::INT AS nth, 'Share ' || nth AS security, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS date, CASE WHEN nth = 1 THEN 'S' ELSE 'P' END AS code, '' AS acquired, (nth + 2)::DOUBLE AS shares,
 CASE WHEN o_orderkey % 7 > 0 THEN o_custkey::DOUBLE END AS price, CASE WHEN o_orderkey % 7 > 0 THEN ((nth + 2) * o_custkey)::DOUBLE END AS value_usd, NULL::DOUBLE AS after, CASE WHEN o_custkey % 2 = 0 THEN 'D' ELSE 'I' END AS direct_or_indirect FROM t""", "shares price value_usd after")
def insider_transactions(spark, d):  # noqa: ANN001, ANN201
    return ownership_forms.insider_transactions(_forms(spark, d), "o_orderkey", "xml")


@R.query(f"SELECT o_orderkey AS id, CASE {_BROKEN} WHEN 'none' THEN 'empty' ELSE 'not well-formed' END AS reject FROM orders WHERE ({_BROKEN}) IS NOT NULL")
def rejected_forms(spark, d):  # noqa: ANN001, ANN201
    return ownership_forms.rejected_forms(_forms(spark, d), "o_orderkey", "xml").drop("length")


# --- contracts ---------------------------------------------------------------------------------------------------------------------------------

_SIGNALS = {
    "type": "object", "required": ["date", "stocks"],
    "properties": {"date": {"type": "string", "minLength": 10}, "stocks": {"type": "array", "maxItems": 3, "items": {"type": "object", "required": ["score"], "properties": {"ticker": {"type": "integer"}, "score": {"type": "number", "minimum": 5, "maximum": 45}, "side": {"enum": ["R", "A"]}}}}},
}
_PARAMS = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 20}, "note": {"type": ["string", "null"]}, "value": {"type": "number", "exclusiveMaximum": 90}}, "additionalProperties": False}
_LINE = "'{' || CASE WHEN l_suppkey % 6 > 0 THEN '\"score\":' || l_quantity::INT || ',' ELSE '' END || '\"ticker\":' || CASE WHEN l_suppkey % 9 = 0 THEN '\"T\"' ELSE l_suppkey::VARCHAR END || ',\"side\":\"' || l_returnflag || '\"}'"
_FIELDS = "CASE WHEN l_suppkey % 9 = 0 THEN [p || '.ticker: is not of type integer'] ELSE [] END || CASE WHEN l_suppkey % 6 > 0 AND q < 5 THEN [p || '.score: is less than 5'] ELSE [] END || CASE WHEN l_suppkey % 6 > 0 AND q > 45 THEN [p || '.score: is greater than 45'] ELSE [] END || CASE WHEN l_returnflag NOT IN ('R', 'A') THEN [p || '.side: is not one of \"R\", \"A\"'] ELSE [] END"


@R.query(f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_quantity::INT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {_LINE}) - 1 AS pos, '$.stocks[' || pos || ']' AS p FROM lineitem),
w AS (SELECT l_orderkey, pos, CASE WHEN l_suppkey % 6 = 0 THEN [p || ': lacks score'] ELSE [] END || {_FIELDS} AS w FROM l),
g AS (SELECT l_orderkey, count(*) AS n, flatten(list(w ORDER BY pos)) AS w FROM w GROUP BY l_orderkey)
SELECT l_orderkey AS id, CASE WHEN l_orderkey % 19 = 0 THEN '$: is not a document' ELSE array_to_string(CASE WHEN l_orderkey % 8 = 0 THEN ['$: lacks date'] WHEN l_orderkey % 10 = 0 THEN ['$.date: is shorter than 10'] ELSE [] END || CASE WHEN n > 3 THEN ['$.stocks: has ' || n || ' items, more than 3'] ELSE [] END || w, ';') END AS warnings FROM g""")
def signal_contract(spark, d):  # noqa: ANN001, ANN201
    """A document for each order, with an entry for each of its lines, under a contract with nested arrays."""
    line = _LINE.replace("::INT", "").replace("l_quantity", "cast(l_quantity AS int)").replace("l_suppkey::VARCHAR", "cast(l_suppkey AS string)")
    g = tables.read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.expr(line).alias("x")))).alias("lines"))
    date = "CASE WHEN l_orderkey % 8 = 0 THEN '' WHEN l_orderkey % 10 = 0 THEN '\"date\":\"soon\",' ELSE '\"date\":\"2024-01-02\",' END"
    g = g.select(F.col("l_orderkey").alias("id"), F.expr(f"CASE WHEN l_orderkey % 19 = 0 THEN '{{\"date\":' ELSE '{{' || {date} || '\"stocks\":[' || array_join(transform(lines, l -> l.x), ',') || ']}}' END").alias("doc"))
    return contracts.validated(g, "doc", _SIGNALS).select("id", F.array_join("warnings", ";").alias("warnings"))


@R.query("""WITH e AS (SELECT event_id AS id, (props->>'k')::INT AS k, value, event_id % 7 AS m FROM events)
SELECT id, array_to_string(CASE WHEN m = 0 THEN ['$: lacks k'] WHEN m = 1 THEN ['$.k: is not of type integer'] WHEN k < 20 THEN ['$.k: is less than 20'] ELSE [] END || CASE WHEN m = 2 THEN ['$.note: is not of type string or null'] ELSE [] END
 || CASE WHEN floor(value) >= 90 THEN ['$.value: is not below 90'] ELSE [] END || CASE WHEN m = 3 THEN ['$: has more'] ELSE [] END, ';') AS warnings FROM e""")
def parameter_contract(spark, d):  # noqa: ANN001, ANN201
    """A document for each event under a flat contract that allows no other fields."""
    e = tables.read(spark, d, "events").select(F.col("event_id").alias("id"), F.get_json_object("props", "$.k").alias("k"), F.floor("value").cast("string").alias("v"), (F.col("event_id") % 7).alias("m"))
    doc = F.expr("""concat('{', CASE WHEN m = 0 THEN '' WHEN m = 1 THEN concat('"k":"', k, '",') ELSE concat('"k":', k, ',') END, CASE WHEN m = 2 THEN '"note":5,' WHEN m = 4 THEN '"note":null,' ELSE '"note":"x",' END, CASE WHEN m = 3 THEN '"more":1,' ELSE '' END, '"value":', v, '}')""")
    return contracts.validated(e.select("id", doc.alias("doc")), "doc", _PARAMS).select("id", F.array_join("warnings", ";").alias("warnings"))


# --- packs -------------------------------------------------------------------------------------------------------------------------------------

PACKS = Packs()


@PACKS.per_key("rising_streak", ["close"], {"streak": "bigint"})
def _streak(t: pa.Table) -> pa.Table:
    """Sessions in a row with a higher close than the session before: a loop over a ticker's history, as a stand-in for arbitrary Python."""
    out, n, before = [], 0, None
    for x in t.column("close").to_pylist():
        n = n + 1 if before is not None and x > before else 0
        out.append(n)
        before = x
    return pa.table({"streak": pa.array(out, pa.int64())})


@PACKS.table("a_streak_rank", ["streak"], {"streak_share": "double", "long_streak": "boolean"})
def _share(df):  # noqa: ANN001, ANN202
    """Reads what another pack gives: the share of a date's tickers with at most this streak."""
    g = df.groupBy("date", "streak").agg(F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy("date")
    g = g.withColumn("streak_share", F.sum("_n").over(by.orderBy("streak")) / F.sum("_n").over(by)).drop("_n")
    return df.join(g, ["date", "streak"]).withColumn("long_streak", F.col("streak") >= 4)


@R.query(f"""WITH {sql._BARS}, u AS (SELECT ticker, date, close, coalesce(close > lag(close) OVER ({sql._BY}), false) AS up FROM bars), b AS (SELECT *, sum((NOT up)::INT) OVER ({sql._BY}) AS run FROM u),
s AS (SELECT ticker, date, close, count(*) OVER (PARTITION BY ticker, run ORDER BY date) - 1 AS streak FROM b)
SELECT ticker, date, close, streak::BIGINT AS streak, count(*) OVER (PARTITION BY date ORDER BY streak)::DOUBLE / count(*) OVER (PARTITION BY date) AS streak_share, streak >= 4 AS long_streak FROM s""", "close streak_share")
def packed_features(spark, d):  # noqa: ANN001, ANN201
    return PACKS.apply(tables.bars(spark, d).select("ticker", "date", "close"), ["streak_share", "streak", "long_streak"])


# --- rescans -----------------------------------------------------------------------------------------------------------------------------------

_STORED = "CASE WHEN ticker % 10 = 3 AND day(date) % 3 > 0 THEN 'canonical' WHEN ticker % 4 = 0 THEN 'canonical' ELSE 'other' END"
_FRESH = "CASE WHEN ticker % 5 = 0 THEN 'other' ELSE 'canonical' END"


@R.query(f"""WITH {sql._BARS}, s AS (SELECT ticker, date, close, {_STORED} AS source FROM bars), f AS (SELECT ticker, date, CASE WHEN ticker % 3 = 0 THEN close * 2 ELSE close END AS close, {_FRESH} AS source FROM bars UNION ALL SELECT ticker + 5000, date, close, 'canonical' FROM bars WHERE ticker = 7),
n AS (SELECT DISTINCT ticker FROM bars WHERE ticker % 50 = 3), days AS (SELECT DISTINCT date FROM bars WHERE date <= DATE '1998-06-01' ORDER BY date DESC LIMIT 300),
c AS (SELECT date, (SELECT count(DISTINCT s.ticker) FROM s JOIN n USING (ticker) WHERE s.date = days.date AND s.source = 'canonical') >= (SELECT count(*) FROM n) AS canonical FROM days),
j AS (SELECT f.ticker, f.date, f.close, f.source, s.ticker IS NULL AS new, s.close AS old, (f.source = 'canonical')::INT AS rf, (s.source = 'canonical')::INT AS rs FROM f JOIN c ON c.date = f.date AND NOT canonical LEFT JOIN s ON s.ticker = f.ticker AND s.date = f.date)
SELECT ticker, date, close, source FROM j WHERE new OR rf > rs OR (rf = rs AND close <> old)""", "close")
def repaired_sessions(spark, d):  # noqa: ANN001, ANN201
    """What a rescan of the last 300 sessions writes: rows of sessions in which some names lack a canonical close."""
    b = tables.bars(spark, d).select("ticker", "date", "close")
    stored = b.withColumn("source", F.expr(_STORED))
    fresh = b.select("ticker", "date", F.expr("CASE WHEN ticker % 3 = 0 THEN close * 2 ELSE close END").alias("close"), F.expr(_FRESH).alias("source")).unionByName(b.where("ticker = 7").select((F.col("ticker") + 5000).alias("ticker"), "date", "close", F.lit("canonical").alias("source")))
    plan = file_tables.sessions_to_rescan(stored, b, b.where("ticker % 50 = 3"), "1998-06-01", "canonical", 300)
    return file_tables.repaired(stored, fresh, plan, {"canonical": 1})


# --- streams as tables -------------------------------------------------------------------------------------------------------------------------


@R.query(f"""WITH {sql._BARS}, l AS (SELECT ticker, date, close, lag(date) OVER w AS last_date, lag(close) OVER w AS last_close, lead(date) OVER w AS nxt FROM bars WHERE date <= DATE '1998-07-31' WINDOW w AS (PARTITION BY ticker ORDER BY date))
SELECT ticker::BIGINT AS ticker, date, 'splice' AS event, last_date, last_close, close FROM l WHERE (close >= 1.8 * last_close OR close * 1.8 <= last_close) AND date - last_date <= 60
UNION ALL SELECT ticker::BIGINT, date + 10, 'stale', date, close, NULL FROM l WHERE coalesce(nxt > date + 10, date + 10 <= DATE '1998-07-31')""", "last_close close")
def bar_events(spark, d):  # noqa: ANN001, ANN201
    return bar_watch.events(tables.bars(spark, d), "1998-07-31")


@R.query("""WITH a AS (SELECT event_id AS article_id, user_id % 500 AS ticker, ts::TIMESTAMP AS published_at FROM events WHERE event_type = 'click'), b AS (SELECT user_id % 500 AS ticker, (ts::DATE + 1)::TIMESTAMP AS bar_at, max(value) AS close FROM events WHERE event_type <> 'click' GROUP BY ALL)
SELECT article_id, a.ticker, published_at, bar_at, close FROM a LEFT JOIN b ON b.ticker = a.ticker AND bar_at > published_at AND bar_at <= published_at + INTERVAL 3 DAYS""", "close")
def article_reactions(spark, d):  # noqa: ANN001, ANN201
    """Clicks stand for articles, the days' other events for bars that are known at their day's end."""
    e = tables.read(spark, d, "events").withColumn("ticker", F.col("user_id") % 500)
    a = e.where("event_type = 'click'").select(F.col("event_id").alias("article_id"), "ticker", F.col("ts").alias("published_at"))
    b = e.where("event_type <> 'click'").groupBy("ticker", F.date_add(F.to_date("ts"), 1).cast("timestamp").alias("bar_at")).agg(F.max("value").alias("close"))
    return reactions.reactions(a, b)
