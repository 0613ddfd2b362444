"""Registered queries over nested documents, shapes of series and contracts, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import windows
from barloom.operators import articles, documents, gates, payloads, tracking
from barloom.plans import filings, records, sql
from barloom.plans.registry import Registry
from barloom.plans.upkeep import _MACRO
from barloom.sources import tables

R = Registry()
_BARS = sql._BARS
_WIDE = f"""{_MACRO}, wide AS (SELECT date, {', '.join(f"max(value) FILTER (series_id = '{n}') AS {n}" for n in ('VIX', 'VIX3M', 'TNX', 'IRX', 'GLD'))} FROM macro GROUP BY date)"""


def _payloads(spark, d):  # noqa: ANN001, ANN202
    k = F.get_json_object("props", "$.k").cast("int")
    eps = F.when(k % 3 > 0, F.struct(F.when(k % 2 == 0, F.col("value")).alias("surprise_pct"), (k % 40).cast("double").alias("days_since_earnings"), F.when(k % 5 > 0, k / 100).alias("revision_4w")))
    surprises = F.when(k % 4 > 0, F.array(F.struct(F.lit("2024-06-30").alias("date"), (F.col("value") * 2).alias("surprise_pct")), F.struct(F.lit("2024-03-31").alias("date"), F.lit(0.0).alias("surprise_pct")))).otherwise(F.array().cast("array<struct<date:string,surprise_pct:double>>"))
    options = F.when(k % 2 > 0, F.struct(F.col("value").alias("put_call_ratio"), F.when(k % 7 > 0, k.cast("double")).alias("iv_rank")))
    doc = F.struct(eps.alias("eps_revision"), F.struct(surprises.alias("earnings_surprises")).alias("analyst_consensus"), options.alias("options_flow"))
    return tables.read(spark, d, "events").select(F.col("event_id").alias("ticker"), F.to_json(doc).alias("payload"))


_ALT = """k AS (SELECT event_id AS ticker, value, (props->>'k')::INT AS k FROM events),
alt AS (SELECT ticker, coalesce(CASE WHEN k % 3 > 0 AND k % 2 = 0 THEN value END, CASE WHEN k % 4 > 0 THEN value * 2 ELSE 0 END) / 100.0::DOUBLE AS surprise_pct, CASE WHEN k % 3 > 0 THEN k % 40 ELSE 0 END::DOUBLE AS days_since_earnings,
 CASE WHEN k % 3 > 0 AND k % 5 > 0 THEN k / 100.0::DOUBLE ELSE 0 END AS eps_revision_4w, 0::INT AS revision_streak, CASE WHEN k % 2 > 0 THEN value END AS put_call_ratio, CASE WHEN k % 2 > 0 AND k % 7 > 0 THEN k::DOUBLE END AS iv_rank, NULL::DOUBLE AS atm_iv FROM k)"""


@R.query(f"WITH {_ALT} SELECT * FROM alt", "surprise_pct days_since_earnings eps_revision_4w put_call_ratio iv_rank atm_iv")
def alternative_payloads(spark, d):  # noqa: ANN001, ANN201
    return documents.alternative_features(_payloads(spark, d))


@R.query(f"WITH {_ALT} SELECT ticker, put_call_ratio, iv_rank, atm_iv FROM alt WHERE coalesce(put_call_ratio, iv_rank, atm_iv) IS NOT NULL", "put_call_ratio iv_rank atm_iv")
def options_mirror(spark, d):  # noqa: ANN001, ANN201
    return documents.options_mirror(documents.alternative_features(_payloads(spark, d)), ["put_call_ratio", "iv_rank", "atm_iv"])


@R.query("""SELECT s_suppkey AS ticker, round(s_acctbal / 19997 * 100, 2) AS short_pct_float, CASE WHEN s_suppkey % 4 > 0 THEN round(s_acctbal / 701, 2) END AS short_ratio, (s_suppkey * 1000)::BIGINT AS shares_short FROM supplier""", "short_pct_float short_ratio")
def short_interest(spark, d):  # noqa: ANN001, ANN201
    s = tables.read(spark, d, "supplier")
    return documents.short_interest(s.select(F.col("s_suppkey").alias("ticker"), (F.col("s_acctbal") / 19997).alias("fraction"), F.when(F.col("s_suppkey") % 4 > 0, F.col("s_acctbal") / 701).alias("days"), (F.col("s_suppkey") * 1000).alias("shares")))


@R.query(f"WITH {_MACRO} SELECT series_id AS ticker, date, value AS open, value AS high, value AS low, value AS close, value AS adj_close, 0::BIGINT AS volume, NULL::DOUBLE AS vwap, 'macro' AS source FROM macro", "open high low close adj_close vwap")
def macro_bars(spark, d):  # noqa: ANN001, ANN201
    return documents.as_bars(tables.macro(spark, d), "macro")


@R.query(f"""WITH {_WIDE} SELECT date, VIX / 20 AS vix_level, TNX / 10 AS yield_10y, (TNX - IRX) / 10 AS yield_curve_slope, GLD / nullif(lag(GLD, 5) OVER (ORDER BY date), 0) - 1 AS gold_mom_5d, (VIX3M - VIX) / greatest(VIX, 1.0) AS vix_term_slope_rel FROM wide WHERE VIX IS NOT NULL""", "vix_level yield_10y yield_curve_slope gold_mom_5d vix_term_slope_rel")
def backfill_macro(spark, d):  # noqa: ANN001, ANN201
    return documents.backfill_macro(documents.wide(tables.macro(spark, d), ["VIX", "VIX3M", "TNX", "IRX", "GLD"]))


@R.query(f"""WITH {_BARS}, {_MACRO}, c AS (SELECT DISTINCT date FROM bars), g AS (SELECT date, value FROM macro WHERE series_id = 'GLD' AND day(date) % 3 = 0)
SELECT c.date, g.value AS gld, g.date AS gld_date FROM c ASOF LEFT JOIN g ON c.date >= g.date""", "gld")
def value_on_or_before(spark, d):  # noqa: ANN001, ANN201
    gold = tables.macro(spark, d).where((F.col("series_id") == "GLD") & (F.dayofmonth("date") % 3 == 0))
    return windows.as_of(tables.bars(spark, d).select("date").distinct(), gold.select("date", "value"), "value", "gld")


@R.query(f"WITH {_BARS} SELECT ticker, date, close FROM bars WHERE ticker IN (SELECT DISTINCT ticker FROM bars ORDER BY ticker LIMIT 5)", "close")
def first_tickers(spark, d):  # noqa: ANN001, ANN201
    return documents.first_tickers(tables.bars(spark, d), 5).select("ticker", "date", "close")


@R.query(f"""WITH {_BARS}, a AS (SELECT ticker, max(date) AS l, count(*) AS n, count(*) FILTER (close > open) AS up, count(*) FILTER (volume > 20) AS traded FROM bars GROUP BY ALL), g AS (SELECT *, ((SELECT max(l) FROM a) - l)::INT AS age FROM a),
o AS (SELECT max(age) FILTER (ticker = 0)::DOUBLE AS anchor_age, avg((age <= 5)::INT) AS fresh, sum(up)::DOUBLE / sum(n)::DOUBLE AS rising, sum(traded)::DOUBLE / sum(n)::DOUBLE AS traded FROM g)
SELECT 'anchor_age' AS gate, anchor_age AS value, coalesce(anchor_age <= 5, false) AS passed FROM o UNION ALL SELECT 'fresh', fresh, fresh >= 1 FROM o UNION ALL SELECT 'rising', rising, rising >= 0.3 FROM o UNION ALL SELECT 'traded', traded, traded >= 0.9 FROM o""", "value")
def contract_gates(spark, d):  # noqa: ANN001, ANN201
    return documents.contract_gates(tables.bars(spark, d), F.col("ticker") == 0, 5, {"rising": (F.col("close") > F.col("open"), 0.3), "traded": (F.col("volume") > 20, 0.9)})


@R.query("""WITH x AS (SELECT event_id, event_id % 13 = 0 AS broken, (props->>'k')::INT AS k FROM events)
SELECT event_id, CASE WHEN broken THEN 'not a document' ELSE concat_ws(',', CASE WHEN NOT k >= 10 THEN 'k_low' END, CASE WHEN NOT k % 2 = 0 THEN 'k_odd' END) END AS warnings FROM x""")
def contract_warnings(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select("event_id", F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("props")).alias("doc"))
    got = documents.contract_warnings(e, "event_id", "doc", "k int", {"k_low": F.col("p.k") >= 10, "k_odd": F.col("p.k") % 2 == 0})
    return got.select("event_id", F.array_join("warnings", ",").alias("warnings"))


@R.query(f"""WITH {_BARS}, l AS (SELECT *, lag(close) OVER w AS c, lag(date) OVER w AS p FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)),
g AS (SELECT ticker, count(*) FILTER (abs(close / c - 1) > 0.5) AS large_moves, count(*) FILTER (date - p > 5) AS gaps FROM l GROUP BY ticker)
SELECT ticker, concat_ws(',', CASE WHEN large_moves > 210 THEN 'large_moves' END, CASE WHEN gaps > 130 THEN 'gaps' END) AS gates, large_moves > 210 OR gaps > 130 AS quarantine FROM g""")
def quarantined_series(spark, d):  # noqa: ANN001, ANN201
    return documents.quarantined(gates.series_gate(tables.bars(spark, d)), {"large_moves": 210, "gaps": 130})


@R.query("""WITH t AS (SELECT doc_id, concat_ws(chr(10) || chr(10), CASE WHEN trim(source) <> '' THEN 'Source: ' || source END, CASE WHEN trim(text) <> '' THEN 'Thesis: ' || text END) AS body FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(body, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM t), s AS (SELECT doc_id, w, unnest(range(0, len(w), 100)) AS s FROM w WHERE len(w) > 0)
SELECT doc_id, (s // 100)::INT AS chunk, md5(array_to_string(w[s + 1:s + 120], ' ')) AS body_md5 FROM s""")
def thesis_chunks(spark, d):  # noqa: ANN001, ANN201
    docs = tables.read(spark, d, "documents")
    body = docs.select("doc_id", documents.thesis_text(docs, {"Source": "source", "Thesis": "text"}).alias("body"))
    return articles.word_chunks(body, "doc_id", "body", 120, 20).select("doc_id", "chunk", F.md5("body").alias("body_md5"))


@R.query(f"""WITH {_BARS}, r AS (SELECT ticker, date, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS ret FROM bars WHERE date IN (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 60)) SELECT * FROM r""", "ret")
def trailing_returns(spark, d):  # noqa: ANN001, ANN201
    return tracking.daily_returns(documents.trailing(tables.bars(spark, d), 60))


@R.query("""SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN '^' || c_mktsegment WHEN 1 THEN c_mktsegment || '-B' WHEN 2 THEN c_mktsegment || '-BC' ELSE c_mktsegment END AS raw, CASE c_custkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_mktsegment || '.B' WHEN 2 THEN c_mktsegment || '-BC' ELSE c_mktsegment END AS symbol FROM customer""")
def vendor_symbols(spark, d):  # noqa: ANN001, ANN201
    c = tables.read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.expr("CASE c_custkey % 4 WHEN 0 THEN '^' || c_mktsegment WHEN 1 THEN c_mktsegment || '-B' WHEN 2 THEN c_mktsegment || '-BC' ELSE c_mktsegment END").alias("raw"))
    return c.select("id", "raw", payloads.vendor_symbol("raw").alias("symbol"))


@R.query(f"WITH {_BARS} SELECT ticker::VARCHAR AS ticker, date, close, NULL::DOUBLE AS adj_close, volume FROM bars", "close adj_close volume")
def canonical_columns(spark, d):  # noqa: ANN001, ANN201
    return payloads.canonical(tables.bars(spark, d), [("ticker", "string"), ("date", "date"), ("close", "double"), ("adj_close", "double"), ("volume", "double")])


@R.query("""SELECT p_brand AS ticker, count(*) AS lots, sum(l_quantity) AS shares FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_partkey % 3 > 0 GROUP BY ALL""", "shares")
def mapped_holdings(spark, d):  # noqa: ANN001, ANN201
    h = tables.read(spark, d, "lineitem").select(F.col("l_partkey").alias("cusip"), F.col("l_quantity").alias("shares"))
    dim = tables.read(spark, d, "part").select(F.col("p_partkey").alias("cusip"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).alias("ticker"))
    return documents.mapped(h, dim, "cusip").groupBy("ticker").agg(F.count(F.lit(1)).alias("lots"), F.sum("shares").alias("shares"))


@R.query(f"""WITH {_BARS}, n AS (SELECT ticker, max(date) AS last_date FROM bars WHERE ticker % 9 > 0 GROUP BY ALL)
SELECT s_suppkey AS ticker, last_date, (DATE '2000-01-01' - last_date)::INT AS age FROM supplier LEFT JOIN n ON ticker = s_suppkey WHERE last_date IS NULL OR (DATE '2000-01-01' - last_date)::INT > 400""")
def stale_tickers(spark, d):  # noqa: ANN001, ANN201
    expected = tables.read(spark, d, "supplier").select(F.col("s_suppkey").alias("ticker"))
    return documents.stale(expected, tables.bars(spark, d).where("ticker % 9 > 0"), "2000-01-01", 400)


@R.query(f"""WITH {_BARS}, {_MACRO} SELECT ticker::VARCHAR AS ticker, date, close, volume, vwap, NULL::VARCHAR AS source FROM bars UNION ALL SELECT series_id, date, value, 0, NULL, 'macro' FROM macro""", "close volume vwap")
def price_source(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).withColumn("ticker", F.col("ticker").cast("string"))
    m = documents.as_bars(tables.macro(spark, d), "macro").withColumn("volume", F.col("volume").cast("double"))
    return documents.price_source(b, m).select("ticker", "date", "close", "volume", "vwap", "source")


@R.query(f"""WITH {records._SCORES}, {filings.EVENTS} SELECT id, 'score' AS kind, 'sentiment' AS name, score AS value FROM scores UNION ALL SELECT id, 'event', category, 1 FROM flags""", "value")
def article_annotations(spark, d):  # noqa: ANN001, ANN201
    return documents.annotations(records._scores(spark, d), filings.events(spark, d).select("id", "category"))
