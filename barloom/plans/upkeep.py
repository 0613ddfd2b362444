"""Registered queries over due dates, seeds, pending rows, gates and snapshots, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import gates, merge, payloads, returns, tracking
from barloom.plans import catalog_inputs, records, sql, states
from barloom.plans.registry import Registry
from barloom.sources import snapshots, tables

R = Registry()
_BARS = sql._BARS
_CAL = f"{_BARS}, cal AS (SELECT date, row_number() OVER (ORDER BY date) AS session, count(*) OVER () AS last FROM (SELECT DISTINCT date FROM bars))"
_MACRO = "macro AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'VIX' WHEN '2-HIGH' THEN 'VIX3M' WHEN '3-MEDIUM' THEN 'TNX' WHEN '4-NOT SPECIFIED' THEN 'IRX' WHEN '5-LOW' THEN 'GLD' END AS series_id, o_orderdate::DATE AS date, avg(o_totalprice) / 10000 AS value FROM orders GROUP BY ALL)"
_CHECKED = f"""{_BARS}, checked AS (SELECT ticker, date, list_filter([CASE WHEN high > low * 1.5 THEN 'wide_range' END, CASE WHEN volume > 140 THEN 'large_volume' END, CASE WHEN close > 1.9 * open THEN 'large_move' END], lambda x: x IS NOT NULL) AS anomalies FROM bars)"""
_CLOSES = "closes AS (SELECT user_id % 500 AS ticker, ts::DATE AS date, event_type AS source, arg_max(value, event_id) AS close, max(event_id) AS run FROM events GROUP BY ALL)"
_SCORE = {"strong_buy": 5.0, "buy": 4.0, "hold": 3.0, "sell": 2.0}


def _checked(spark, d):  # noqa: ANN001, ANN202
    rules = gates.flags(wide_range=F.col("high") > F.col("low") * 1.5, large_volume=F.col("volume") > 140, large_move=F.col("close") > 1.9 * F.col("open"))
    return tables.bars(spark, d).select("ticker", "date", rules.alias("anomalies"))


def _dates(spark, d):  # noqa: ANN001, ANN202
    return tables.bars(spark, d).select("date").distinct()


@R.query(f"""WITH {_CAL}, s AS (SELECT date, day(date) % 4 <> 0 AS a, day(date) % 3 = 0 AS b FROM cal WHERE day(date) % 5 <> 0)
SELECT date, session + 21 < last AS long_closed FROM cal LEFT JOIN s USING (date) WHERE session + 5 < last AND NOT (coalesce(a, false) AND (coalesce(b, false) OR NOT session + 21 < last))""")
def due_dates(spark, d):  # noqa: ANN001, ANN201
    day = F.dayofmonth("date")
    stored = _dates(spark, d).where(day % 5 != 0).select("date", (day % 4 != 0).alias("has_short"), (day % 3 == 0).alias("has_long"))
    return tracking.due_dates(tables.bars(spark, d), stored)


@R.query(f"""WITH {_CAL}, h AS (SELECT unnest([5, 21])::INT AS horizon), g AS (SELECT horizon, max(date) AS newest_graded, max(session) AS s0 FROM cal, h WHERE date < DATE '1998-06-01' - horizon GROUP BY ALL),
c AS (SELECT horizon, max(date) AS newest_closed, max(session) AS s1 FROM cal, h WHERE session + horizon < last GROUP BY ALL)
SELECT horizon, newest_closed, newest_graded, greatest(coalesce(s1 - s0, 0), 0)::BIGINT AS lag FROM g LEFT JOIN c USING (horizon)""")
def grading_lag(spark, d):  # noqa: ANN001, ANN201
    each = _dates(spark, d).withColumn("horizon", F.explode(F.array(F.lit(5), F.lit(21))))
    return tracking.grading_lag(tables.bars(spark, d), each.where(F.expr("date < date_sub(date'1998-06-01', horizon)")))


@R.query(f"""WITH {_CAL}, p AS (SELECT ticker, date, close, session FROM bars JOIN cal USING (date)), h AS (SELECT unnest([5, 10, 21])::INT AS horizon),
r AS (SELECT a.ticker, a.date, horizon, a.close AS entry, b.close / a.close - 1 AS ret FROM p a, h, p b WHERE a.ticker = b.ticker AND b.session = a.session + horizon)
SELECT ticker, date, horizon, entry, floor(entry * (1 + ret) * 100.0::DOUBLE + 0.5) / 100.0::DOUBLE AS exit FROM r""", "entry exit")
def exit_prices(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    forward = returns.forward_returns(b, tables.benchmark(spark, d), (5, 10, 21))
    return tracking.exit_prices(b.select("ticker", "date", F.col("close").alias("entry")), forward)


@R.query("""WITH o AS (SELECT o_custkey AS ticker, o_orderdate::DATE AS date, o_orderkey % 2 AS shape, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'BUY' ELSE 'HOLD' END AS signal, o_totalprice AS score FROM orders),
e AS (SELECT ticker, date, shape, arg_max(signal, row(score, signal)) AS signal, max(score) AS score FROM o GROUP BY ALL),
m AS (SELECT ticker, date, min(row(shape, score)) AS m, arg_min(score, row(shape, score)) AS score FROM e WHERE signal = 'BUY' GROUP BY ALL)
SELECT m.ticker, date, score, c_mktsegment AS sector FROM m LEFT JOIN customer ON c_custkey = m.ticker""", "score")
def signal_seeds(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("date"), (F.col("o_orderkey") % 2).alias("shape"), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "BUY").otherwise("HOLD").alias("signal"), F.col("o_totalprice").alias("score"))
    e = o.groupBy("ticker", "date", "shape").agg(F.max(F.struct("score", "signal")).alias("m")).select("ticker", "date", "shape", "m.signal", "m.score")
    # a document is one ticker's on one date, so that none grows with the data
    docs = e.groupBy("date", "ticker").agg(F.collect_list(F.when(F.col("shape") == 0, F.struct("ticker", "signal", "score"))).alias("universe"), F.map_from_entries(F.collect_list(F.when(F.col("shape") == 1, F.struct("ticker", F.struct("signal", "score"))))).alias("by_ticker")).drop("ticker")
    sectors = tables.read(spark, d, "customer").select(F.col("c_custkey").alias("ticker"), F.col("c_mktsegment").alias("sector"))
    return tracking.seed_signals(docs, sectors)


@R.query("""WITH e AS (SELECT user_id AS ticker, ts::DATE AS date, event_type AS version, event_id, value FROM events),
s AS (SELECT DISTINCT ticker, date, CASE WHEN version <> 'click' THEN version END AS version FROM e WHERE event_id % 3 = 0),
a AS (SELECT ticker, date, NULL::VARCHAR AS version, arg_min(value, event_id) AS value FROM e WHERE version = 'click' GROUP BY ALL), b AS (SELECT ticker, date, version, arg_min(value, event_id) AS value FROM e WHERE version <> 'click' GROUP BY ALL)
SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.ticker = a.ticker AND s.date = a.date AND s.version IS NULL)
UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.ticker = b.ticker AND s.date = b.date AND s.version = b.version)""", "value")
def new_predictions(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select(F.col("user_id").alias("ticker"), F.to_date("ts").alias("date"), F.col("event_type").alias("version"), "event_id", "value")
    click = F.col("version") == "click"
    stored = e.where("event_id % 3 = 0").select("ticker", "date", F.when(~click, F.col("version")).alias("version")).distinct()
    return tracking.new_predictions(e.where(click), e.where(~click), stored, "event_id")


@R.query(f"""WITH {_BARS}, p AS (SELECT ticker, date, CASE WHEN day(date) % 3 = 0 THEN NULL ELSE close END AS outcome FROM bars), f AS (SELECT ticker, date, vwap FROM bars WHERE ticker % 4 <> 1)
SELECT ticker, date, coalesce(outcome, vwap) AS outcome, outcome IS NULL AND vwap IS NOT NULL AS resolved FROM p LEFT JOIN f USING (ticker, date)""", "outcome")
def resolved_outcomes(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    pending = b.select("ticker", "date", F.when(F.dayofmonth("date") % 3 != 0, F.col("close")).alias("outcome"))
    return tracking.resolve_pending(pending, b.where("ticker % 4 <> 1").select("ticker", "date", F.col("vwap").alias("outcome")), ["ticker", "date"], "outcome")


@R.query(f"""WITH {_CHECKED}, total AS (SELECT count(*) AS n, count(*) FILTER (len(anomalies) > 0) AS anomalous FROM checked),
x AS (SELECT ticker, date, ticker || ' ' || strftime(date, '%Y-%m-%d') || ' ' || array_to_string(anomalies, '+') AS line FROM checked WHERE len(anomalies) > 0 ORDER BY ticker, date LIMIT 20)
SELECT n, n - anomalous AS clean, anomalous, coalesce((SELECT string_agg(line, ';' ORDER BY ticker, date) FROM x), '') AS details, anomalous > n * 0.05::DOUBLE AS failed FROM total""")
def validation_summary(spark, d):  # noqa: ANN001, ANN201
    return tracking.validation_summary(_checked(spark, d))


@R.query(f"""WITH {_CHECKED} SELECT kind, count(*) AS n, CASE WHEN kind IN ('large_move', 'wide_range') THEN 'block' ELSE 'warn' END AS action FROM (SELECT unnest(anomalies) AS kind FROM checked) GROUP BY kind""")
def anomaly_policy(spark, d):  # noqa: ANN001, ANN201
    return tracking.anomaly_policy(_checked(spark, d), ["large_move", "wide_range"])


@R.query(f"""WITH {_CLOSES}, g AS (SELECT ticker, date, count(close) FILTER (close > 0) AS k, min(close) FILTER (close > 0) AS lo, max(close) FILTER (close > 0) AS hi FROM closes GROUP BY ALL),
s AS (SELECT ticker, (hi - lo) / lo * 1e4::DOUBLE AS bps, CASE WHEN k = 0 THEN 'no_data' WHEN k = 1 THEN 'provisional' WHEN (hi - lo) / lo * 1e4::DOUBLE <= 7.5 THEN 'agreed' ELSE 'quarantine' END AS status FROM g)
SELECT status, count(*) AS n, count(DISTINCT ticker) AS tickers, max(bps) AS widest FROM s GROUP BY status""", "widest")
def status_tally(spark, d):  # noqa: ANN001, ANN201
    return tracking.status_tally(gates.source_agreement(tables.closes(spark, d)))


@R.query("""SELECT n_regionkey AS area, count(*) AS names, avg((s_acctbal > 0)::INT) AS sector_coverage, avg((n_name IS NOT NULL)::INT) AS country_coverage
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 > 0) ON s_nationkey = n_nationkey GROUP BY ALL""", "sector_coverage country_coverage")
def classification(spark, d):  # noqa: ANN001, ANN201
    members = tables.read(spark, d, "supplier").select(F.col("s_suppkey").alias("ticker"), F.when(F.col("s_acctbal") > 0, "x").alias("sector"), F.col("s_nationkey").alias("n_nationkey"))
    places = tables.read(spark, d, "nation").where("n_nationkey % 6 > 0").select("n_nationkey", F.col("n_name").alias("country"), F.col("n_regionkey").alias("area"))
    return tracking.classification(members, places, "n_nationkey")


@R.query("""WITH e AS (SELECT user_id AS ticker, event_type AS t, event_id, value AS target, CASE event_id % 4 WHEN 0 THEN 'buy' WHEN 1 THEN 'hold' WHEN 2 THEN 'other' END AS rating FROM events),
a AS (SELECT ticker, arg_max(target, event_id) AS target, max_by(row(rating), event_id)[1] AS rating FROM e WHERE t = 'click' AND ticker % 5 > 0 GROUP BY ALL),
b AS (SELECT * FROM (SELECT ticker, arg_max(target, event_id) AS target2, max_by(row(rating), event_id)[1] AS rating2 FROM e WHERE t = 'view' GROUP BY ALL) WHERE rating2 IS NOT NULL),
j AS (SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(rating, rating2) AS rating, CASE WHEN a.ticker IS NULL THEN target2 ELSE target END AS target FROM a FULL JOIN b ON a.ticker = b.ticker)
SELECT ticker, rating, CASE rating WHEN 'buy' THEN 4.0 WHEN 'hold' THEN 3.0 END::DOUBLE AS rating_score, target FROM j WHERE rating IS NOT NULL OR target IS NOT NULL""", "rating_score target")
def consensus(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").withColumn("rating", F.expr("CASE event_id % 4 WHEN 0 THEN 'buy' WHEN 1 THEN 'hold' WHEN 2 THEN 'other' END"))
    newest = lambda kind: e.where(F.col("event_type") == kind).groupBy(F.col("user_id").alias("ticker")).agg(F.max_by(F.struct(F.col("value").alias("target"), "rating"), "event_id").alias("m")).select("ticker", "m.*")
    return tracking.consensus(newest("click").where("ticker % 5 > 0"), newest("view"), _SCORE)


@R.query("""SELECT p_partkey AS ticker, coalesce(CASE p_type WHEN 'ECONOMY' THEN 'XA' WHEN 'PROMO' THEN 'XB' END, CASE WHEN right(p_brand, 1) IN ('1', '2', '3', '4') THEN 'S' || right(p_brand, 1) END) AS etf FROM part WHERE etf IS NOT NULL""")
def sub_sector_etf(spark, d):  # noqa: ANN001, ANN201
    part = tables.read(spark, d, "part").select(F.col("p_partkey").alias("ticker"), F.col("p_type").alias("sub_industry"), F.col("p_brand").alias("sector"))
    etf = part.select("sector").distinct().where(F.expr("right(sector, 1)").isin("1", "2", "3", "4")).withColumn("etf", F.concat(F.lit("S"), F.expr("right(sector, 1)")))
    return tracking.etf_of(part, {"ECONOMY": "XA", "PROMO": "XB"}, etf)


@R.query(f"""WITH {_CLOSES} SELECT date, count(*) AS rows, bool_and(coalesce(source = 'click' AND close IS NOT NULL, false)) AS skip FROM (SELECT * REPLACE (CASE WHEN day(date) % 4 = 0 THEN 'click' ELSE source END AS source) FROM closes) GROUP BY date ORDER BY date DESC LIMIT 15""")
def rescan_window(spark, d):  # noqa: ANN001, ANN201
    c = tables.closes(spark, d).withColumn("source", F.when(F.dayofmonth("date") % 4 == 0, "click").otherwise(F.col("source")))
    return tracking.rescan(c, "click", 15)


@R.query(f"""WITH {_BARS}, here AS (SELECT DISTINCT ticker FROM bars WHERE date = DATE '1997-06-10') SELECT ticker, max(date) AS last_date FROM bars WHERE ticker NOT IN (SELECT ticker FROM here) GROUP BY ticker""")
def absent_today(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    return tracking.absent(b, b.where(F.col("date") == F.lit("1997-06-10").cast("date")))


@R.query(f"""WITH {_BARS} SELECT ticker, date, close, close / nullif(vwap, 0) - 1 AS over_vwap, high / nullif(low, 0) AS range FROM bars""", "close over_vwap range")
def widened_table(spark, d):  # noqa: ANN001, ANN201
    t = tables.bars(spark, d)
    added = {"over_vwap": F.col("close") / F.nullif("vwap", F.lit(0.0)) - 1, "range": F.col("high") / F.nullif("low", F.lit(0.0))}
    return tracking.widened(t, added, [*t.columns, "over_vwap", "range"]).select("ticker", "date", "close", "over_vwap", "range")


@R.query(f"""WITH {_MACRO} SELECT series_id, date, value FROM macro UNION ALL SELECT 'TERM', a.date, a.value / b.value FROM macro a JOIN macro b USING (date) WHERE a.series_id = 'VIX3M' AND b.series_id = 'VIX' AND b.value <> 0""", "value")
def macro_history(spark, d):  # noqa: ANN001, ANN201
    return tracking.ratio_series(tables.macro(spark, d), "VIX3M", "VIX", "TERM")


@R.query(f"""WITH {_MACRO}, n AS (SELECT series_id, date, value * 2 AS value FROM macro WHERE date >= DATE '1998-01-01')
SELECT series_id, date, value FROM n UNION ALL SELECT series_id, date, value FROM macro m WHERE date < DATE '1998-03-01' AND NOT EXISTS (SELECT 1 FROM n WHERE n.series_id = m.series_id AND n.date = m.date)""", "value")
def macro_upsert(spark, d):  # noqa: ANN001, ANN201
    m = tables.macro(spark, d).select("series_id", "date", "value")
    new = m.where(F.col("date") >= F.lit("1998-01-01").cast("date")).withColumn("value", F.col("value") * 2)
    return merge.upsert(m.where(F.col("date") < F.lit("1998-03-01").cast("date")), new, ["series_id", "date"]).select("series_id", "date", "value")


@R.query(f"""WITH {_BARS} SELECT ticker, date, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS ret FROM bars WHERE ticker IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AND ticker % 2 = 1""", "ret")
def supplemental_returns(spark, d):  # noqa: ANN001, ANN201
    held = tables.read(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("ticker"))
    covered = tables.read(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("ticker"))
    return tracking.daily_returns(tracking.supplemental(tables.bars(spark, d), held, covered))


@R.query(f"""WITH {_BARS} SELECT ticker, date, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS ret FROM bars""", "ret")
def daily_returns(spark, d):  # noqa: ANN001, ANN201
    return tracking.daily_returns(tables.bars(spark, d))


@R.query(r"""WITH g AS (SELECT doc_id % 300 AS fingerprint, arg_min(coalesce(lang, ''), doc_id) AS title, arg_max(coalesce(text, ''), row(length(coalesce(text, '')), -doc_id)) AS excerpt FROM documents GROUP BY ALL),
b AS (SELECT fingerprint, regexp_replace(concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(excerpt, '')), '^\s+|\s+$', '', 'g') AS body FROM g) SELECT fingerprint, md5(body) AS body_md5, length(body) AS chars FROM b""")
def chunk_bodies(spark, d):  # noqa: ANN001, ANN201
    v = tables.read(spark, d, "documents").select((F.col("doc_id") % 300).alias("fingerprint"), F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("title"), F.col("text").alias("excerpt"))
    return tracking.chunk_body(v).select("fingerprint", F.md5("body").alias("body_md5"), F.length("body").cast("long").alias("chars"))


@R.query(f"""WITH {states._SPLITS} SELECT ticker, ex_date, CASE WHEN split_from <> 0 AND split_to <> 0 THEN split_from / split_to END AS factor, NOT coalesce(split_from <> 0 AND split_to <> 0, false) AS incomplete
FROM (SELECT * REPLACE (CASE WHEN ticker % 3 = 0 THEN 0 ELSE split_to END AS split_to) FROM splits)""", "factor")
def expected_factors(spark, d):  # noqa: ANN001, ANN201
    s = catalog_inputs.splits(spark, d)
    return tracking.expected_factor(s.withColumn("split_to", F.when(F.col("ticker") % 3 == 0, 0.0).otherwise(F.col("split_to"))))


@R.query(f"""WITH {records._SCORES}, {records._ART}, x AS (SELECT id, unnest(tickers) AS ticker, date FROM arts), j AS (SELECT * FROM x JOIN scores USING (id))
SELECT ticker, max(date) AS date, arg_max(id, row(date, id)) AS id, arg_max(score, row(date, id)) AS score FROM j GROUP BY ticker""", "score")
def latest_sentiment(spark, d):  # noqa: ANN001, ANN201
    scored = records._news(spark, d).select("id", "date", F.explode("tickers").alias("ticker")).join(records._scores(spark, d), "id")
    return payloads.newest(scored.select("ticker", "date", "id", "score"), ["ticker"], ["date", "id"]).select("ticker", "date", "id", "score")


@R.query(f"""WITH {_BARS} SELECT ticker, date, close, volume FROM bars WHERE date BETWEEN DATE '1995-03-10' AND DATE '1995-07-20'""", "close volume")
def snapshot_range(spark, d):  # noqa: ANN001, ANN201
    path = snapshots.scratch(spark, "snapshot")
    snapshots.write_groups(tables.bars(spark, d), path, {"prices": ["close", "volume"]})
    return snapshots.read_range(spark, path, "prices", "1995-03-10", "1995-07-20")


@R.query(f"""WITH {_BARS}, m AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS spy FROM orders GROUP BY ALL) SELECT DISTINCT date, spy FROM bars JOIN m USING (date) WHERE date = (SELECT max(date) FROM bars JOIN m USING (date))""", "spy")
def snapshot_latest_macro(spark, d):  # noqa: ANN001, ANN201
    path = snapshots.scratch(spark, "snapshot")
    snapshots.write_groups(tables.bars(spark, d).join(tables.benchmark(spark, d), "date"), path, {"macro": ["spy"]})
    day = snapshots.latest_date(spark, path, "macro").first()[0]
    return snapshots.read_date(spark, path, "macro", day.isoformat()) if day else spark.read.parquet(f"{path}/macro").drop("month")


@R.query(f"""WITH {_BARS} SELECT ticker, date, close FROM bars WHERE date > DATE '1996-02-01' AND date <= DATE '1996-03-15'""", "close")
def price_delta(spark, d):  # noqa: ANN001, ANN201
    return snapshots.delta(tables.bars(spark, d), "1996-02-01", "1996-03-15").select("ticker", "date", "close")
