"""Registered queries over reports, ranks and verdicts, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import articles, merge, reports
from barloom.plans import catalog_inputs, series, sql
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()
_BARS, _BY = sql._BARS, sql._BY


@R.query(f"""WITH {_BARS}, n AS (SELECT *, CASE ticker % 20 WHEN 0 THEN 'SPY' WHEN 1 THEN 'XLK' WHEN 2 THEN 'GLD' ELSE 'S' || ticker END AS name FROM bars), s AS (SELECT * EXCLUDE (ticker), name || CASE WHEN name = 'SPY' AND ticker > 0 AND ticker <> 20 THEN ticker::VARCHAR ELSE '' END AS tk FROM n),
k AS (SELECT tk, date FROM s WHERE tk NOT IN ('GLD') AND NOT starts_with(tk, 'XL') QUALIFY count(*) OVER (PARTITION BY tk) >= 265 AND row_number() OVER (PARTITION BY tk ORDER BY date DESC) <= 400) SELECT tk AS ticker, count(*) AS rows, min(date) AS first_date FROM k GROUP BY ALL""")
def admitted_stocks(spark, d):  # noqa: ANN001, ANN201
    k = F.col("ticker")
    name = F.when(k % 20 == 0, F.when((k > 0) & (k != 20), F.concat(F.lit("SPY"), k)).otherwise("SPY")).when(k % 20 == 1, "XLK").when(k % 20 == 2, "GLD").otherwise(F.concat(F.lit("S"), k))
    b = reports.admitted_stocks(tables.bars(spark, d).withColumn("ticker", name), 265, 400)
    return b.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"))


@R.query(f"""WITH {series._MACRO}, s AS (SELECT series_id, date, CASE WHEN day(date) % 3 > 0 THEN value END AS value FROM macro), l AS (SELECT series_id, arg_max(value, date) AS v FROM s WHERE value IS NOT NULL GROUP BY ALL),
o AS (SELECT max(v) FILTER (series_id = 'TNX') AS treasury_10yr, max(v) FILTER (series_id = 'IRX') AS treasury_2yr, max(v) FILTER (series_id = 'VIX') AS vix FROM l), p AS (SELECT value, row_number() OVER (ORDER BY date DESC) AS k FROM s WHERE series_id = 'GLD' AND value IS NOT NULL)
SELECT *, round((treasury_10yr - treasury_2yr) * 100, 1) AS yield_curve_slope, ((SELECT value FROM p WHERE k = 1) / nullif((SELECT value FROM p WHERE k = 13), 0) - 1) * 100 AS cpi_yoy FROM o""", "treasury_10yr treasury_2yr vix yield_curve_slope cpi_yoy")
def macro_levels(spark, d):  # noqa: ANN001, ANN201
    m = tables.macro(spark, d).withColumn("value", F.when(F.dayofmonth("date") % 3 > 0, F.col("value")))
    return reports.macro_levels(m, {"TNX": "treasury_10yr", "IRX": "treasury_2yr", "VIX": "vix"}, "TNX", "IRX", "GLD")


@R.query("""WITH r AS (SELECT user_id AS ticker, ts, event_id, value AS actual, CASE WHEN event_id % 9 = 0 THEN 0 WHEN event_id % 7 > 0 THEN value + event_id % 5 - 2 END AS estimated, CASE WHEN event_id % 4 = 0 THEN event_id % 13 END::DOUBLE AS pct FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts DESC) AS k FROM r) SELECT ticker, k::INT AS nth, actual, coalesce(pct, (actual - estimated) / abs(nullif(estimated, 0)) * 100) AS surprise_pct FROM k WHERE k <= 4""", "actual surprise_pct")
def latest_surprises(spark, d):  # noqa: ANN001, ANN201
    i = F.col("event_id")
    est = F.when(i % 9 == 0, 0.0).when(i % 7 > 0, F.col("value") + i % 5 - 2)
    exact = F.coalesce(F.when(i % 4 == 0, (i % 13).cast("double")), (F.col("value") - est) / F.abs(F.nullif(est, F.lit(0.0))) * 100)
    r = tables.read(spark, d, "events").select(F.col("user_id").alias("ticker"), F.col("ts").alias("date"), F.col("value").alias("actual"), est.alias("estimated"), exact.alias("surprise_pct"))
    s = reports.latest_surprises(r)
    return s.select("ticker", F.posexplode("surprises").alias("nth", "s")).select("ticker", (F.col("nth") + 1).alias("nth"), "s.actual", "s.surprise_pct")


@R.query(f"""WITH {_BARS}, k AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 252), r AS (SELECT *, close / nullif(lag(close) OVER ({_BY}), 0) - 1 AS r FROM k),
v AS (SELECT ticker, CASE WHEN count(r) OVER w = 20 THEN stddev_samp(r) OVER w * sqrt(252) END AS v FROM r WINDOW w AS ({_BY} ROWS 19 PRECEDING)), iv AS (SELECT s_suppkey AS ticker, 8 + s_suppkey % 40 AS iv FROM supplier)
SELECT ticker, CASE WHEN count(*) >= 30 AND count(v) >= 10 THEN round(avg((v < iv)::INT) * 100, 1) END AS iv_rank FROM v JOIN iv USING (ticker) GROUP BY ALL""", "iv_rank")
def volatility_rank(spark, d):  # noqa: ANN001, ANN201
    iv = tables.read(spark, d, "supplier").select(F.col("s_suppkey").alias("ticker"), (8 + F.col("s_suppkey") % 40).cast("double").alias("atm_iv"))
    return reports.volatility_rank(tables.bars(spark, d), iv)


_COS = "coalesce(list_cosine_similarity(a.m, b.m), 0)"


@R.query(f"""WITH e AS (SELECT label AS ticker, DATE '2024-01-01' + (vec_id % 5)::INT AS filed_date, CASE vec_id % 3 WHEN 0 THEN 'Risk Factors' WHEN 1 THEN 'Business' ELSE 'Other' END AS section, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
g AS (SELECT ticker, filed_date, CASE WHEN grouping(section) = 1 THEN '' ELSE section END AS section, pos, avg(x) AS m, count(*) AS n FROM e GROUP BY GROUPING SETS ((ticker, filed_date, pos), (ticker, filed_date, section, pos))),
c AS (SELECT ticker, filed_date, section, list(m ORDER BY pos) AS m, max(n) AS n FROM g GROUP BY ALL), d AS (SELECT ticker, filed_date, row_number() OVER (PARTITION BY ticker ORDER BY filed_date DESC) AS k FROM (SELECT DISTINCT ticker, filed_date FROM c)),
b AS (SELECT a.ticker, a.section, a.filed_date AS d1, b.filed_date AS d2, a.n AS n1, b.n AS n2, {_COS} AS s FROM (SELECT * FROM c JOIN d USING (ticker, filed_date) WHERE k = 1) a JOIN (SELECT * FROM c JOIN d USING (ticker, filed_date) WHERE k = 2) b USING (ticker, section)),
w AS (SELECT ticker, max(d2) FILTER (section = '') AS prev_date, max(d1) FILTER (section = '') AS curr_date, max(s) FILTER (section = '') AS s, max(s) FILTER (section = 'Risk Factors') AS rf, max(n2) FILTER (section = '') AS n_prev_chunks, max(n1) FILTER (section = '') AS n_curr_chunks, count(*) FILTER (section <> '') AS sections FROM b GROUP BY ALL)
SELECT ticker, prev_date, curr_date, round(s, 3) AS similarity, round(rf, 3) AS risk_similarity, n_prev_chunks, n_curr_chunks, sections, round(1 - s, 4) < 0.05 AS lazy_flag, coalesce(round(rf, 4) < 0.9, false) AS risk_factor_change_flag FROM w""", "similarity risk_similarity")
def filing_changes(spark, d):  # noqa: ANN001, ANN201
    section = F.when(F.col("vec_id") % 3 == 0, "Risk Factors").when(F.col("vec_id") % 3 == 1, "Business").otherwise("Other")
    e = tables.read(spark, d, "embeddings").select(F.col("label").alias("ticker"), F.expr("date_add(date'2024-01-01', cast(vec_id % 5 AS int))").alias("filed_date"), section.alias("section"), "embedding")
    c = articles.centroids(e, ["ticker", "filed_date", "section"], [["ticker", "filed_date", "section"], ["ticker", "filed_date"]])
    f = reports.filing_changes(c.withColumn("doc_type", F.lit("10-K")))
    return f.select("ticker", "prev_date", "curr_date", F.round("overall_similarity", 3).alias("similarity"), F.round(F.col("section_similarities")["Risk Factors"], 3).alias("risk_similarity"), "n_prev_chunks", "n_curr_chunks", F.size("section_similarities").cast("long").alias("sections"), "lazy_flag", "risk_factor_change_flag")


@R.query("""WITH m AS (SELECT user_id AS ticker, max(ts) AS mark FROM events GROUP BY ALL), t AS (SELECT c_custkey AS ticker FROM customer WHERE c_custkey IN (SELECT ticker FROM m)), j AS (SELECT ticker, epoch(TIMESTAMP '2024-02-05' - mark) / 3600 AS age FROM t JOIN m USING (ticker)), due AS (SELECT * FROM j WHERE age >= 150)
SELECT ticker, least(2000, greatest(150, floor((SELECT max(age) FROM due) * 1.1)::INT + 1))::INT AS hours FROM due""")
def lookback_hours(spark, d):  # noqa: ANN001, ANN201
    marks = tables.read(spark, d, "events").groupBy(F.col("user_id").alias("ticker")).agg(F.max("ts").cast("timestamp").alias("mark"))
    asked = tables.read(spark, d, "customer").select(F.col("c_custkey").alias("ticker")).join(marks.select("ticker"), "ticker", "left_semi")
    return reports.lookback(asked, marks, "2024-02-05", 150, 2000)


_SPLICE = f"""hist AS (SELECT ticker, date, close FROM bars WHERE ticker % 4 < 3 OR day(date) % 2 = 0), inc AS (SELECT ticker, date, close * CASE WHEN ticker % 7 = 0 AND day(date) % 3 = 0 THEN 3.0 ELSE 1.0 END AS close FROM bars WHERE year(date) = 1996),
ac AS (SELECT ticker, ex_date, split_from / split_to AS factor FROM splits), al AS (SELECT coalesce(h.ticker, i.ticker) AS ticker, coalesce(h.date, i.date) AS date, h.close AS h, i.close AS c FROM hist h FULL JOIN inc i ON h.ticker = i.ticker AND h.date = i.date),
pv AS (SELECT *, last_value(h IGNORE NULLS) OVER ({_BY} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM al), rr AS (SELECT *, c / CASE WHEN p > 0 THEN p END AS r FROM pv WHERE c IS NOT NULL),
wy AS (SELECT rr.ticker, rr.date, arg_min(factor, ex_date) AS f FROM rr JOIN ac USING (ticker) WHERE ex_date > date AND abs(r * factor - 1) <= 0.02 GROUP BY ALL),
vd AS (SELECT rr.*, f, CASE WHEN r IS NULL OR c <= 0 OR r > 1 / 1.5 AND r < 1.5 THEN 'ok' WHEN f IS NOT NULL THEN 'restated' WHEN h > 0 AND NOT (c / h > 1 / 1.5 AND c / h < 1.5) THEN 'refused' ELSE 'unexplained' END AS verdict FROM rr LEFT JOIN wy USING (ticker, date))"""


@R.query(f"WITH {_BARS}, {sql._SPLITS}, {_SPLICE} SELECT ticker, date, CASE verdict WHEN 'restated' THEN c * f ELSE c END AS close, verdict FROM vd", "close")
def splice_verdicts(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).select("ticker", "date", "close")
    inc = b.where("year(date) = 1996").withColumn("close", F.col("close") * F.when((F.col("ticker") % 7 == 0) & (F.dayofmonth("date") % 3 == 0), 3.0).otherwise(1.0))
    s = catalog_inputs.splits(spark, d).select("ticker", "ex_date", (F.col("split_from") / F.col("split_to")).alias("factor"))
    return reports.splice_verdicts(b.where("ticker % 4 < 3 or day(date) % 2 = 0"), inc, s)


@R.query(f"""WITH {_BARS}, {sql._SPLITS}, o AS (SELECT ticker, date, close * CASE WHEN ticker % 5 = 0 AND date > DATE '1996-06-01' THEN 1.2 WHEN ticker % 3 = 0 THEN 2.0 ELSE 1.0 END AS close FROM bars WHERE ticker % 11 > 0),
j AS (SELECT bars.ticker, bars.date, bars.close AS x, o.close AS y FROM bars JOIN o ON o.ticker = bars.ticker AND o.date = bars.date WHERE bars.date >= DATE '1995-01-01'),
e AS (SELECT ticker, date, abs((x / first_value(x) OVER w) / nullif(y / first_value(y) OVER w, 0) - 1) AS dev FROM j WINDOW w AS ({_BY})), e2 AS (SELECT ticker, date, round(dev, 9) AS dev FROM e), g AS (SELECT ticker, max(dev) AS m FROM e2 GROUP BY ALL),
a AS (SELECT s_suppkey AS ticker FROM supplier WHERE s_suppkey IN (SELECT ticker FROM bars)) SELECT a.ticker, CASE WHEN m IS NULL THEN 'no_overlap' WHEN m <= 0.01 THEN 'within_tol' ELSE 'out_of_tol' END AS verdict, m AS max_deviation FROM a LEFT JOIN g USING (ticker)""", "max_deviation")
def scoped_reconciliation(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).select("ticker", "date", "close")
    k = F.when((F.col("ticker") % 5 == 0) & (F.col("date") > F.lit("1996-06-01").cast("date")), 1.2).when(F.col("ticker") % 3 == 0, 2.0).otherwise(1.0)
    r = reports.scoped_reconciliation(b, b.where("ticker % 11 > 0").withColumn("close", F.col("close") * k), catalog_inputs.splits(spark, d), "1995-01-01")
    return r.select("ticker", "verdict", "max_deviation")


@R.query("""WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE year(l_shipdate) <= 1992), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE year(l_shipdate) >= 1998), j AS (SELECT a.k AS x, b.k AS y FROM a FULL JOIN b ON a.k = b.k)
SELECT count(*) FILTER (y IS NULL) AS missing, count(*) FILTER (x IS NULL) AS extra, CASE WHEN count(*) FILTER (y IS NULL) > 5 OR count(*) FILTER (x IS NULL) > 5 THEN 'drift' ELSE 'ok' END AS status FROM j""")
def drift_status(spark, d):  # noqa: ANN001, ANN201
    li = tables.read(spark, d, "lineitem").select(F.col("l_partkey").alias("ticker"), F.year("l_shipdate").alias("y"))
    return reports.drift_status(li.where("y <= 1992"), li.where("y >= 1998"), 5)


_ROUTE = f"floor_ AS (SELECT min(date) AS f FROM (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 5)), ok AS (SELECT ticker FROM bars GROUP BY ticker HAVING max(date) >= (SELECT f FROM floor_)), asked AS (SELECT c_custkey AS ticker FROM customer WHERE c_custkey <= 3000)"


def _routed(spark, d):  # noqa: ANN001, ANN202
    return reports.fresh_or_gap(tables.bars(spark, d), tables.read(spark, d, "customer").where("c_custkey <= 3000").select(F.col("c_custkey").alias("ticker")), 5)


@R.query(f"WITH {_BARS}, {_ROUTE} SELECT ticker, count(*) AS rows FROM bars WHERE ticker IN (SELECT ticker FROM ok) AND ticker IN (SELECT ticker FROM asked) GROUP BY ALL")
def cached_series(spark, d):  # noqa: ANN001, ANN201
    return _routed(spark, d)[0].groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))


@R.query(f"WITH {_BARS}, {_ROUTE} SELECT ticker FROM asked WHERE ticker NOT IN (SELECT ticker FROM ok)")
def gap_tickers(spark, d):  # noqa: ANN001, ANN201
    return _routed(spark, d)[1]


@R.query("SELECT o_orderpriority AS kind, string_agg(DISTINCT o_orderdate::DATE::VARCHAR, ',' ORDER BY o_orderdate::DATE::VARCHAR) AS dates FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-01-10' AND DATE '1996-02-09' GROUP BY ALL")
def release_dates(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "orders").select(F.col("o_orderpriority").alias("kind"), F.to_date("o_orderdate").alias("date"))
    return reports.release_dates(e, "1996-01-10", 30).withColumn("dates", F.array_join(F.col("dates").cast("array<string>"), ","))


@R.query(f"""WITH {sql._CLOSES}, g AS (SELECT ticker, date, count(*) FILTER (close > 0) AS n, min(close) FILTER (close > 0) AS lo, max(close) FILTER (close > 0) AS hi FROM closes GROUP BY ALL), s AS (SELECT ticker, CASE WHEN n = 0 THEN 'no_data' WHEN n = 1 THEN 'provisional' WHEN (hi - lo) / lo * 1e4 <= 2000 THEN 'agreed' ELSE 'quarantine' END AS status FROM g)
SELECT status, count(*) AS n, md5(coalesce(string_agg(DISTINCT ticker::VARCHAR, ',' ORDER BY ticker::VARCHAR) FILTER (status IN ('quarantine', 'no_data')), '')) AS tickers_md5 FROM s GROUP BY ALL""")
def quarantine_tally(spark, d):  # noqa: ANN001, ANN201
    from barloom.operators import gates

    s = gates.source_agreement(tables.closes(spark, d), 2000.0).select(F.col("ticker").cast("string").alias("ticker"), "status")
    q = reports.quarantine(s, ["quarantine", "no_data"])
    return q.select("status", "n", F.md5(F.array_join("tickers", ",")).alias("tickers_md5"))


@R.query(f"WITH {_BARS} SELECT count(DISTINCT ticker) AS loaded, 2000000::BIGINT AS recorded, 2000000 - count(DISTINCT ticker) AS shortfall FROM bars")
def load_shortfall(spark, d):  # noqa: ANN001, ANN201
    return reports.reconciled_load(tables.bars(spark, d), 2_000_000)


@R.query(f"WITH {_BARS}, {series._FRAME} SELECT date, coalesce(GLD / nullif(lag(GLD, 5) OVER (ORDER BY date), 0) - 1, 0) AS oil_mom_5d, coalesce(TNX, 0) AS hy_oas_credit_spread_pct FROM frame", "oil_mom_5d hy_oas_credit_spread_pct")
def energy_and_credit(spark, d):  # noqa: ANN001, ANN201
    f = series._frame(spark, d)
    return reports.energy_and_credit(f.select("date", F.col("GLD").alias("USO"), F.col("TNX").alias("HYOAS")))


@R.query("""WITH a AS (SELECT DISTINCT o_custkey AS ticker, o_orderpriority AS kind FROM orders WHERE year(o_orderdate) <= 1996), b AS (SELECT o_custkey AS ticker, o_orderpriority AS kind, min(o_orderkey) AS id FROM orders GROUP BY ALL)
SELECT ticker, kind, NULL::BIGINT AS id FROM a UNION ALL SELECT ticker, kind, id FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.ticker = b.ticker AND a.kind = b.kind)""")
def absent_inserts(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("y"))
    base = o.where("y <= 1996").select("ticker", "kind").distinct().withColumn("id", F.lit(None).cast("bigint"))
    return merge.insert_absent(base, o.groupBy("ticker", "kind").agg(F.min("id").alias("id")), ["ticker", "kind"])
