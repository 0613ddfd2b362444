"""Registered queries over universes, restated series and stored states, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import actions, reconcile, stores, universe
from barloom.plans import catalog_inputs, sql
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()
_BARS = sql._BARS
_SPLITS = """splits AS (SELECT s_suppkey AS ticker, DATE '1994-01-01' + (s_suppkey % 50 * 10 + k * 400)::INT AS ex_date, 1.0::DOUBLE AS split_from, (k + s_suppkey % 3)::DOUBLE AS split_to FROM supplier, (SELECT unnest([1, 2]) AS k) WHERE s_suppkey % 7 = 0)"""
#: A second version of the bars: every fifth ticker is halved before 1998, every eleventh is 3 % higher on a third of the dates, every fourth is missing.
_OTHER = """other AS (SELECT ticker, date, close * CASE WHEN ticker % 5 = 0 AND date < DATE '1998-01-01' THEN 0.5 WHEN ticker % 11 = 0 AND day(date) % 3 = 0 THEN 1.03 ELSE 1 END AS close FROM bars WHERE ticker % 4 <> 3)"""
_EVENTS = """events2 AS (SELECT ticker, ex_date, split_from / split_to AS factor FROM splits UNION ALL SELECT s_suppkey, DATE '1997-12-20', 0.5 FROM supplier WHERE s_suppkey % 10 = 0)"""


def _other(spark, d):  # noqa: ANN001, ANN202
    f = F.when((F.col("ticker") % 5 == 0) & (F.col("date") < F.lit("1998-01-01").cast("date")), 0.5).when((F.col("ticker") % 11 == 0) & (F.dayofmonth("date") % 3 == 0), 1.03).otherwise(1.0)
    return tables.bars(spark, d).where("ticker % 4 <> 3").select("ticker", "date", (F.col("close") * f).alias("close"))


def _events(spark, d):  # noqa: ANN001, ANN202
    s = catalog_inputs.splits(spark, d).select("ticker", "ex_date", (F.col("split_from") / F.col("split_to")).alias("factor"))
    extra = tables.read(spark, d, "supplier").where("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("ticker"), F.lit("1997-12-20").cast("date").alias("ex_date"), F.lit(0.5).alias("factor"))
    return s.union(extra)


def _tickers(spark, d, where):  # noqa: ANN001, ANN202
    return tables.read(spark, d, "supplier").select(F.col("s_suppkey").alias("ticker")).where(where)


@R.query(f"""WITH {_BARS}, {_OTHER}, x AS (SELECT ticker, date, b.close AS a, o.close AS b FROM bars b JOIN other o USING (ticker, date) WHERE b.close > 0 AND o.close > 0),
f AS (SELECT ticker, arg_min(a, date) AS fa, arg_min(b, date) AS fb FROM x GROUP BY ALL), w AS (SELECT ticker, count(*) AS common, max(abs((a / fa) / (b / fb) - 1)) AS deviation FROM x JOIN f USING (ticker) GROUP BY ALL)
SELECT ticker, coalesce(common, 0) AS common, deviation, CASE WHEN common IS NULL THEN 'no_overlap' WHEN deviation <= 0.035 THEN 'within_tol' ELSE 'out_of_tol' END AS status FROM (SELECT DISTINCT ticker FROM bars) LEFT JOIN w USING (ticker)""", "deviation")
def series_reconciliation(spark, d):  # noqa: ANN001, ANN201
    return reconcile.rebased_deviation(tables.bars(spark, d), _other(spark, d), 0.035)


_DISC = f"""{_BARS}, {_OTHER}, {_SPLITS}, {_EVENTS},
x AS (SELECT ticker, date, b.close AS prior, o.close AS now, o.close / b.close AS ratio, abs(o.close / b.close - 1) AS change FROM bars b JOIN other o USING (ticker, date) WHERE b.close > 0 AND o.close > 0),
y AS (SELECT * FROM x WHERE change > 0.01), n AS (SELECT ticker, date, min(ex_date) AS explained_by FROM y JOIN events2 USING (ticker) WHERE ex_date BETWEEN date - 3 AND date + 60 AND (abs(ratio / factor - 1) <= 0.005 OR abs(ratio * factor - 1) <= 0.005) GROUP BY ALL),
disc AS (SELECT y.*, explained_by, CASE WHEN change <= 0.05 THEN 'warning' WHEN explained_by IS NOT NULL THEN 'explained' ELSE 'error' END AS level FROM y LEFT JOIN n USING (ticker, date))"""


@R.query(f"WITH {_DISC} SELECT * FROM disc", "prior now ratio change")
def discrepancies(spark, d):  # noqa: ANN001, ANN201
    return reconcile.discrepancies(tables.bars(spark, d), _other(spark, d), _events(spark, d))


@R.query(f"""WITH {_DISC}, m AS (SELECT ticker, avg(ratio) AS mean_ratio, count(*) AS dates, max(ratio) AS hi, min(ratio) AS lo FROM disc WHERE level = 'error' GROUP BY ALL)
SELECT ticker, dates, mean_ratio, dates >= 2 AND greatest(hi - mean_ratio, mean_ratio - lo) <= 0.02 * mean_ratio AS uniform FROM m""", "mean_ratio")
def uniform_restatements(spark, d):  # noqa: ANN001, ANN201
    return reconcile.uniform_groups(reconcile.discrepancies(tables.bars(spark, d), _other(spark, d), _events(spark, d)).where("level = 'error'"))


@R.query(f"""WITH {_BARS}, {_OTHER}, r AS (SELECT ticker, arg_max(close, date) AS ref FROM bars GROUP BY ALL), x AS (SELECT ticker, ref, o.close AS c FROM other o JOIN r USING (ticker))
SELECT ticker, CASE WHEN c > 0 AND ref > 0 AND abs(ref / c - 2) <= 0.5 THEN 'old' WHEN c > 0 AND ref > 0 AND abs(ref / c - 1) <= 0.25 THEN 'new' ELSE 'unknown' END AS scale, count(*) AS n FROM x GROUP BY ALL""")
def archive_scale(spark, d):  # noqa: ANN001, ANN201
    ref = tables.bars(spark, d).groupBy("ticker").agg(F.max_by("close", "date").alias("ref"))
    scale = reconcile.archive_scale(F.col("close"), F.col("ref"), F.lit(2.0), 0.25)
    return _other(spark, d).join(ref, "ticker").groupBy("ticker", scale.alias("scale")).agg(F.count(F.lit(1)).alias("n"))


@R.query(f"WITH {_BARS}, {_SPLITS}, l AS (SELECT ticker, max(ex_date) AS e FROM splits GROUP BY ALL) SELECT ticker, date FROM bars JOIN l USING (ticker) WHERE date < e")
def touched_dates(spark, d):  # noqa: ANN001, ANN201
    return reconcile.touched_dates(tables.bars(spark, d), catalog_inputs.splits(spark, d))


@R.query(f"""WITH {_BARS}, {_SPLITS}, n AS (SELECT b.ticker, b.date, arg_min(ex_date, row(abs(ex_date - date), ex_date)) AS nearest FROM bars b JOIN splits USING (ticker) WHERE abs(ex_date - date) <= 30 GROUP BY ALL)
SELECT ticker, date, nearest FROM bars LEFT JOIN n USING (ticker, date)""")
def nearest_action(spark, d):  # noqa: ANN001, ANN201
    return reconcile.nearest_event(tables.bars(spark, d).select("ticker", "date"), catalog_inputs.splits(spark, d), 30)


@R.query(f"""WITH e AS ({sql._SQL['split_evidence']}), a AS (SELECT *, ticker % 14 = 0 AS done FROM e),
s AS (SELECT *, CASE WHEN done THEN 'already_applied' WHEN evidence = 'direct' THEN 'apply' WHEN evidence = 'inverse' THEN 'apply_inverse' ELSE 'refused' END AS status FROM a)
SELECT ticker, ex_date, factor, moves, evidence, status, CASE status WHEN 'apply' THEN factor WHEN 'apply_inverse' THEN 1 / factor END AS use FROM s""", "factor use")
def splits_to_apply(spark, d):  # noqa: ANN001, ANN201
    s = catalog_inputs.splits(spark, d)
    return reconcile.to_apply(actions.orientation(s, tables.bars(spark, d)), s.where("ticker % 14 = 0"))


@R.query(f"""WITH {_BARS}, r AS (SELECT s_suppkey AS o, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey + 100000 ELSE s_suppkey + 1 END AS n FROM supplier WHERE s_suppkey % 9 = 0),
k AS (SELECT o, n, n IN (SELECT ticker FROM bars) AS taken FROM r), j AS (SELECT coalesce(n, ticker) AS ticker, date, close, taken FROM bars LEFT JOIN k ON ticker = o)
SELECT ticker, count(*) AS n, min(date) AS first_date, sum(close) AS total FROM j WHERE NOT coalesce(taken, false) GROUP BY ALL""", "total")
def renamed_history(spark, d):  # noqa: ANN001, ANN201
    r = _tickers(spark, d, "s_suppkey % 9 = 0").select(F.col("ticker").alias("old_ticker"), F.when(F.col("ticker") % 2 == 0, F.col("ticker") + 100000).otherwise(F.col("ticker") + 1).alias("new_ticker"))
    return universe.renamed_history(tables.bars(spark, d), r).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.sum("close").alias("total"))


@R.query("""WITH u AS (SELECT c_custkey AS ticker, 'held' AS o FROM customer WHERE c_acctbal > 5000 UNION SELECT s_suppkey, 'index' FROM supplier UNION SELECT p_partkey, 'watch' FROM part WHERE p_size < 5)
SELECT ticker, string_agg(o, ',' ORDER BY o) AS origins FROM u GROUP BY ALL""")
def assembled_universe(spark, d):  # noqa: ANN001, ANN201
    t = lambda n, k, w="true": tables.read(spark, d, n).where(w).select(F.col(k).alias("ticker"))
    return universe.assembled({"held": t("customer", "c_custkey", "c_acctbal > 5000"), "index": t("supplier", "s_suppkey"), "watch": t("part", "p_partkey", "p_size < 5")})


@R.query("SELECT DISTINCT c_custkey AS ticker FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) AND c_custkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def former_members(spark, d):  # noqa: ANN001, ANN201
    t = lambda n, k, w="true": tables.read(spark, d, n).where(w).select(F.col(k).alias("ticker"))
    return universe.former(t("customer", "c_custkey"), t("supplier", "s_suppkey"), t("part", "p_partkey", "p_size < 25"))


@R.query("""WITH i AS (SELECT s_suppkey AS ticker, 'C' || s_nationkey AS c FROM supplier), h AS (SELECT c_custkey AS ticker, 'C' || c_nationkey AS c FROM customer WHERE c_custkey % 3 = 0)
SELECT ticker, coalesce(h.c, i.c) AS currency, h.c IS NOT NULL AS held FROM i FULL JOIN h USING (ticker)""")
def priced_universe(spark, d):  # noqa: ANN001, ANN201
    t = lambda n, k, c: tables.read(spark, d, n).select(F.col(k).alias("ticker"), F.concat(F.lit("C"), c).alias("currency"))
    return universe.priced(t("supplier", "s_suppkey", "s_nationkey"), t("customer", "c_custkey", "c_nationkey").where("ticker % 3 = 0"))


_CHG = """raw AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, 'T' || o_custkey % 400 AS added, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'R' || o_custkey % 300 END AS removed FROM orders),
lg AS (SELECT try_cast(date AS DATE) AS date, added AS ticker, 'ADDED' AS action FROM raw UNION ALL SELECT try_cast(date AS DATE), removed, 'REMOVED' FROM raw), chg AS (SELECT * FROM lg WHERE date IS NOT NULL AND regexp_full_match(ticker, '[A-Z0-9.-]+'))"""


def _changes(spark, d):  # noqa: ANN001, ANN202
    o = tables.read(spark, d, "orders")
    return universe.change_events(o.select(F.when(F.col("o_orderkey") % 13 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.concat(F.lit("T"), F.col("o_custkey") % 400).alias("added"), F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.concat(F.lit("R"), F.col("o_custkey") % 300)).alias("removed")))


@R.query(f"WITH {_CHG} SELECT * FROM chg")
def change_events(spark, d):  # noqa: ANN001, ANN201
    return _changes(spark, d)


@R.query(f"WITH {_CHG}, g AS (SELECT date, sum((action = 'ADDED')::INT)::BIGINT AS added, sum((action = 'REMOVED')::INT)::BIGINT AS removed FROM chg GROUP BY ALL) SELECT * FROM g WHERE added > 0 AND removed > 0")
def swap_dates(spark, d):  # noqa: ANN001, ANN201
    return universe.swaps(_changes(spark, d))


@R.query(f"""WITH {_CHG}, a AS (SELECT DISTINCT ticker, action FROM chg WHERE year(date) <= 1996), b AS (SELECT DISTINCT ticker, action FROM chg WHERE year(date) >= 1999)
SELECT *, 'first' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def change_divergence(spark, d):  # noqa: ANN001, ANN201
    c = _changes(spark, d)
    return universe.set_divergence(c.where("year(date) <= 1996"), c.where("year(date) >= 1999"))


@R.query(f"""WITH {_CHG}, h AS (SELECT sha256(to_json([date::VARCHAR, ticker::VARCHAR, action])) AS h FROM chg), p AS (SELECT floor(('0x' || h[1:4])::INT * 64 / 65536.0) AS p, sha256(string_agg(h, ',' ORDER BY h)) AS s, count(*) AS n FROM h GROUP BY ALL)
SELECT sha256(string_agg(s, ',' ORDER BY p)) AS content_hash, sum(n)::BIGINT AS rows FROM p""")
def change_hash(spark, d):  # noqa: ANN001, ANN201
    return stores.content_hash(_changes(spark, d), ["date", "ticker", "action"])


@R.query("""SELECT s_suppkey AS ticker, CASE WHEN s_suppkey % 5 = 0 THEN 'not_member' WHEN s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01') THEN 'healed' ELSE 'still_absent' END AS state FROM supplier""")
def allowlist_state(spark, d):  # noqa: ANN001, ANN201
    today = tables.bars(spark, d).where("date >= date'2001-06-01'")
    return universe.allowlist_state(_tickers(spark, d, "true"), today, _tickers(spark, d, "s_suppkey % 5 <> 0"))


@R.query(f"WITH {_BARS}, c AS (SELECT min(date) AS f FROM (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 5)), l AS (SELECT ticker, max(date) AS last_date FROM bars GROUP BY ALL) SELECT ticker, last_date, CASE WHEN last_date >= f THEN 'cached' ELSE 'gap' END AS route FROM l, c")
def series_routing(spark, d):  # noqa: ANN001, ANN201
    return universe.routed(tables.bars(spark, d), 5)


@R.query(f"WITH {_BARS}, p AS (SELECT ticker, max(date) AS planned_last FROM bars WHERE ticker % 3 > 0 OR date < DATE '2000-01-01' GROUP BY ALL), s AS (SELECT ticker, max(date) AS stored_last FROM bars GROUP BY ALL) SELECT * FROM p JOIN s USING (ticker) WHERE planned_last < stored_last")
def regression_check(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    return universe.regressions(b.where("ticker % 3 > 0 or date < date'2000-01-01'"), b)


@R.query(f"""WITH {_BARS}, live AS (SELECT ticker, date, close FROM bars WHERE ticker % 6 > 0 OR date > DATE '2001-01-01'), sh AS (SELECT ticker FROM live GROUP BY ALL HAVING count(*) < 265),
f AS (SELECT ticker, date, close FROM bars SEMI JOIN sh USING (ticker) ANTI JOIN live USING (ticker, date)), u AS (SELECT *, 'live' AS origin FROM live UNION ALL SELECT *, 'stitched' FROM f) SELECT ticker, origin, count(*) AS n, sum(close) AS total FROM u GROUP BY ALL""", "total")
def warm_up(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).select("ticker", "date", "close")
    return universe.warmed_up(b.where("ticker % 6 > 0 or date > date'2001-01-01'"), b, 265).groupBy("ticker", "origin").agg(F.count(F.lit(1)).alias("n"), F.sum("close").alias("total"))


@R.query("""WITH l AS (SELECT o_custkey AS ticker, max(o_orderdate::DATE) AS last_date, count(*) AS rows FROM orders GROUP BY ALL) SELECT * FROM l WHERE ticker % 3 <> 0 AND ticker % 5 <> 0 AND DATE '2001-08-01' - last_date > 14""")
def pruned_tickers(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("date"))
    c = tables.read(spark, d, "customer").select(F.col("c_custkey").alias("ticker"))
    return universe.pruned(o, c.where("ticker % 3 = 0"), c.where("ticker % 5 = 0"), F.lit("2001-08-01").cast("date"))


@R.query("""WITH n AS (SELECT user_id AS key, event_type AS kind, max(ts::DATE) AS date FROM events WHERE user_id % 4 > 0 GROUP BY ALL), x AS (SELECT k.key, t.kind FROM (SELECT DISTINCT user_id AS key FROM events) k, (SELECT DISTINCT event_type AS kind FROM events) t),
g AS (SELECT kind, count(*) AS expected, sum(coalesce((DATE '2024-01-29' - date <= 2), false)::INT)::BIGINT AS fresh, sum(coalesce((DATE '2024-01-29' - date > 2), false)::INT)::BIGINT AS stale, sum((date IS NULL)::INT)::BIGINT AS missing FROM x LEFT JOIN n USING (key, kind) GROUP BY ALL)
SELECT *, CASE WHEN fresh / expected >= 0.6 THEN 'fresh' WHEN missing < expected THEN 'stale' ELSE 'missing' END AS verdict FROM g""")
def corpus_coverage(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("kind"), F.to_date("ts").alias("date"))
    kinds = F.broadcast(e.select("kind").distinct())  # a handful of kinds: the closed set of event types
    return universe.coverage(e.select("key").distinct().crossJoin(kinds), e.where("key % 4 > 0"), "2024-01-29", 2, 0.6)


@R.query("SELECT sum((c_custkey NOT IN (SELECT p_partkey FROM part))::INT)::BIGINT AS outside, 0::BIGINT AS malformed, bool_and(c_custkey IN (SELECT p_partkey FROM part)) AS passes FROM customer")
def nesting_gate(spark, d):  # noqa: ANN001, ANN201
    t = lambda n, k: tables.read(spark, d, n).select(F.col(k).alias("ticker"))
    return universe.nested(t("customer", "c_custkey"), t("part", "p_partkey"))


@R.query("""WITH n AS (SELECT event_type AS source, count(DISTINCT user_id) AS loaded FROM events WHERE event_type <> 'view' AND (event_type <> 'click' OR user_id < 40) GROUP BY ALL), m AS (SELECT event_type AS source, count(DISTINCT user_id) AS recorded FROM events GROUP BY ALL)
SELECT source, recorded, coalesce(loaded, 0) AS loaded, CASE WHEN coalesce(loaded, 0) = 0 THEN 'empty' WHEN loaded < recorded THEN 'short' ELSE 'complete' END AS status FROM m LEFT JOIN n USING (source)""")
def load_reconciliation(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("ticker"))
    return universe.reconciled(e.where("source <> 'view' and (source <> 'click' or ticker < 40)"), e.groupBy("source").agg(F.countDistinct("ticker").alias("recorded")))


@R.query("""WITH c AS (SELECT user_id % 500 AS ticker, ts::DATE AS date, event_type AS source, arg_max(value, event_id) AS close FROM events GROUP BY ALL), g AS (SELECT date, count(*) AS rows, sum((source <> 'click' OR close IS NULL)::INT)::BIGINT AS low_quality FROM c GROUP BY ALL) SELECT * FROM g WHERE low_quality > 0""")
def low_quality_sessions(spark, d):  # noqa: ANN001, ANN201
    return universe.low_quality_sessions(tables.closes(spark, d), "click")


@R.query("SELECT source, count(*) AS rows, avg((quality IS NOT NULL AND toxic IS NOT NULL)::INT) * 100 AS complete_pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL", "complete_pct")
def context_completeness(spark, d):  # noqa: ANN001, ANN201
    return universe.completeness(tables.read(spark, d, "documents").join(tables.read(spark, d, "labels"), "doc_id", "left"), ["quality", "toxic"], "source")


@R.query("""WITH s AS (SELECT o_orderdate::DATE AS date, count(*) AS signals FROM orders WHERE o_orderdate::DATE <= DATE '2001-06-01' - 30 GROUP BY ALL) SELECT * FROM s WHERE date NOT IN (SELECT o_orderdate::DATE FROM orders WHERE o_orderstatus = 'F')""")
def outcome_gaps(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), "o_orderstatus")
    return universe.uncovered_dates(o, o.where("o_orderstatus = 'F'"), "2001-06-01", 30)


@R.query("""WITH x AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN quality END AS quality, CASE WHEN doc_id % 3 = 0 THEN toxic END AS toxic FROM labels) SELECT doc_id, coalesce(x.quality, l.quality) AS quality, coalesce(x.toxic, l.toxic) AS toxic FROM x LEFT JOIN (SELECT * FROM labels WHERE doc_id % 5 > 0) l USING (doc_id)""")
def context_repair(spark, d):  # noqa: ANN001, ANN201
    t = tables.read(spark, d, "labels")
    x = t.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("quality")).alias("quality"), F.when(F.col("doc_id") % 3 == 0, F.col("toxic")).alias("toxic"))
    return universe.repaired(x, t.where("doc_id % 5 > 0"), ["doc_id"], ["quality", "toxic"])
