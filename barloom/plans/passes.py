"""Registered queries over whole passes: a day's append with all features, series judged with today's row, digests, labelled histories and the registry of columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import daily, macro, news, technicals
from barloom.plans import records, series, sql, stores
from barloom.plans.registry import Registry
from barloom.sources import readers, snapshots, tables

R = Registry()
_DAY, _BY = stores._DAY, sql._BY
_LIMITS = {"large_moves": 192, "gaps": 80}
_FACTORS = ["momentum_20d", "price_vs_ma50", "realized_vol_20d"]
_SCORED = ["momentum_20d", "rsi_14", "beta_60d", "atr_14_pct"]
_STORED = sql._BARS.replace("bars AS (", "stored AS (")
_OVER = " OR ".join(f"{k} > {n}" for k, n in _LIMITS.items())
_GATES = "concat_ws(',', " + ", ".join(f"CASE WHEN {k} > {n} THEN '{k}' END" for k, n in _LIMITS.items()) + ")"


def _judged_sql(table: str, condition: str = "true") -> str:
    """large_moves and gaps of each ticker over the rows of a table."""
    return f"""SELECT ticker, count(*) FILTER (abs(close / nullif(c, 0) - 1) > 0.5 AND {condition}) AS large_moves, count(*) FILTER (date - p > 5 AND {condition}) AS gaps
 FROM (SELECT *, lag(close) OVER ({_BY}) AS c, lag(date) OVER ({_BY}) AS p FROM {table}) GROUP BY ticker"""


_APPEND = f"""{_STORED}, {sql._MARKET}, {stores._BOTH.replace('FROM bars', 'FROM stored').replace('< 265', f'< {daily.REACH}')},
b3 AS (SELECT * FROM b2 WHERE ticker IN (SELECT ticker FROM vd WHERE verdict = 'accepted')), sg AS ({_judged_sql('b3')}), bad AS (SELECT ticker, {_GATES} AS series_gates FROM sg WHERE {_OVER}),
bars AS (SELECT * FROM b3 WHERE ticker NOT IN (SELECT ticker FROM bad))"""


def _inner(text: str) -> str:
    """A statement's text without its table of bars, to stand inside of one that has them."""
    return text.replace(sql._BARS + ",", "", 1).replace(f" {sql._MARKET},", "", 1)


_PRICE = f"SELECT * FROM (WITH {_inner(sql._PRICE)} SELECT ticker, date, {', '.join(sql.PRICE_FEATURES)} FROM price)"
_MACRO = f"""WITH {series._FRAME.replace('FROM bars', "FROM (SELECT date FROM stored WHERE date < DATE '" + _DAY + "' UNION SELECT DATE '" + _DAY + "' AS date)")}
SELECT date, VIX / 20 AS vix_level, TNX / 10 AS yield_10y, (TNX - IRX) / 10 AS yield_curve_slope, coalesce((VIX - VIX3M) / 20, 0) AS vix_term_slope,
 coalesce({series._change('GLD', 5, 'ORDER BY date')}, 0) AS gold_mom_5d, (VIX3M - VIX) / greatest(VIX, 1) AS vix_term_ratio FROM frame"""
_ON_DAY = f"WHERE date = DATE '{_DAY}'"
_Z = f"""lg AS (SELECT ticker, unnest([{', '.join(f"'{c}'" for c in _SCORED)}]) AS k, unnest([{', '.join(_SCORED)}]) AS x FROM today), md AS (SELECT k, median(x) AS med, count(x) AS n FROM lg GROUP BY k),
ms AS (SELECT k, med, n, median(abs(x - med)) * 1.4826 AS mad FROM lg JOIN md USING (k) GROUP BY ALL), wi AS (SELECT lg.*, n, mad, CASE WHEN x IS NOT NULL THEN least(greatest(x, med - 3 * mad), med + 3 * mad) END AS w FROM lg JOIN ms USING (k)),
zz AS (SELECT ticker, k, CASE WHEN n >= 2 AND mad > 0 AND stddev_pop(w) OVER (PARTITION BY k) > 0 THEN (w - avg(w) OVER (PARTITION BY k)) / stddev_pop(w) OVER (PARTITION BY k) END AS z FROM wi),
zw AS (SELECT ticker, {', '.join(f"max(z) FILTER (k = '{c}') AS z_{c}" for c in _SCORED)} FROM zz GROUP BY ticker)"""
_ALL = [*sql.PRICE_FEATURES, *sql.OSCILLATORS, *daily.MARKET, *daily.MACRO, "factor_momentum_ratio", *[f"z_{c}" for c in _SCORED]]
_EVERY = f"""WITH {_APPEND}, f1 AS ({_PRICE}), f2 AS (SELECT * FROM ({_inner(sql._OSC)})), f3 AS (SELECT * FROM ({_inner(sql._MKT)})), f4 AS (SELECT * FROM ({_MACRO}) {_ON_DAY}),
f5 AS (SELECT ticker, date, factor_momentum_ratio FROM ({_inner(sql._SQL['factor_momentum_ratio'])}) {_ON_DAY}),
today AS (SELECT f1.*, f2.* EXCLUDE (ticker, date), f3.* EXCLUDE (ticker, date) FROM f1 JOIN f2 USING (ticker, date) JOIN f3 USING (ticker, date) {_ON_DAY}), {_Z},
al AS (SELECT today.*, f4.* EXCLUDE (date), factor_momentum_ratio, zw.* EXCLUDE (ticker) FROM today LEFT JOIN f4 USING (date) LEFT JOIN f5 USING (ticker, date) LEFT JOIN zw USING (ticker))
SELECT ticker, date, {', '.join(_ALL)}, ({' + '.join(f'({c} IS NULL)::INT' for c in _ALL)})::INT AS unknown FROM al"""


def _bars(spark, d):  # noqa: ANN001, ANN202
    b = tables.bars(spark, d)
    new = technicals.latest(b).withColumns({"date": F.lit(_DAY).cast("date"), "close": F.when(F.col("ticker") % 7 == 3, -F.col("close")).otherwise(F.col("close"))})
    return b, new


def _append(spark, d):  # noqa: ANN001, ANN202
    b, new = _bars(spark, d)
    return daily.append_all(b, new, _DAY, tables.benchmark(spark, d), tables.macro(spark, d), series._NAMES, _LIMITS, _FACTORS, _SCORED, window=60, skip=5, min_names=5)


@R.query(_EVERY, " ".join(_ALL))
def append_all_features(spark, d):  # noqa: ANN001, ANN201
    """Every pass of a day's append, all columns."""
    return _append(spark, d)[0]


@R.query(f"WITH {_APPEND} SELECT vd.ticker, date, blocking, splice, CASE WHEN series_gates IS NOT NULL THEN 'quarantined' ELSE verdict END AS verdict, series_gates FROM vd LEFT JOIN bad USING (ticker)")
def append_all_verdicts(spark, d):  # noqa: ANN001, ANN201
    return daily.judged_all(*_bars(spark, d), _DAY, _LIMITS)[1]


@R.query(f"""WITH {sql._BARS}, tod AS (SELECT ticker, DATE '1997-12-31' AS date, open, high, low, CASE WHEN ticker % 2 = 0 THEN close * 3 ELSE close END AS close, volume, vwap FROM bars WHERE ticker % 5 > 0 QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1),
h AS (SELECT *, false AS new FROM bars WHERE ticker IN (SELECT ticker FROM tod) AND (ticker, date) NOT IN (SELECT (ticker, date) FROM tod) AND date < DATE '1998-01-01' UNION ALL SELECT *, true FROM tod),
n AS ({_judged_sql('h')}), o AS ({_judged_sql('h', 'NOT new')})
SELECT n.ticker, concat_ws(',', CASE WHEN n.large_moves > 171 AND o.large_moves <= 171 THEN 'large_moves' END, CASE WHEN n.gaps > 73 AND o.gaps <= 73 THEN 'gaps' END) AS fresh_gates, concat_ws(',', CASE WHEN n.large_moves > 171 THEN 'large_moves' END, CASE WHEN n.gaps > 73 THEN 'gaps' END) AS gates,
 n.large_moves > 171 OR n.gaps > 73 AS quarantine FROM n JOIN o USING (ticker)""")
def series_with_today(spark, d):  # noqa: ANN001, ANN201
    """Each second ticker's row of the day has a tripled close."""
    b = tables.bars(spark, d)
    today = technicals.latest(b.where("ticker % 5 > 0")).withColumns({"date": F.lit("1997-12-31").cast("date"), "close": F.when(F.col("ticker") % 2 == 0, F.col("close") * 3).otherwise(F.col("close"))})
    return daily.series_with_today(b.where("date < '1998-01-01'"), today, {"large_moves": 171, "gaps": 73})


def _articles(spark, d):  # noqa: ANN001, ANN202
    return records._news(spark, d).join(records._scores(spark, d), "id").withColumnRenamed("date", "published_at")


_ENTRIES = f"""{records._SCORES}, ar AS (SELECT doc_id AS id, source, DATE '2024-01-01' + (doc_id % 30)::INT AS published_at FROM documents),
en AS (SELECT id, p AS pos, CASE p WHEN 0 THEN id % 50 ELSE id % 7 END AS ticker, score, published_at, source FROM ar JOIN scores USING (id), (SELECT unnest([0, 1])::INT AS p) WHERE lower(coalesce(source, '')) <> 'src0'),
pf AS (SELECT row_number() OVER (ORDER BY abs(coalesce(score, 0)) DESC, published_at DESC, id, pos)::INT AS rank, * REPLACE (round(coalesce(score, 0), 6) AS score) FROM en QUALIFY rank <= 30)"""


@R.query(f"WITH {_ENTRIES} SELECT * FROM pf", "score")
def portfolio_entries(spark, d):  # noqa: ANN001, ANN201
    return news.portfolio_entries(_articles(spark, d), "SRC0")


_RAW = """e AS (SELECT event_type AS topic, event_id AS seq, 'Story ' || user_id || ' ' || (value::INT % 9) AS title, 'http://x/' || (event_id % 3000) || CASE WHEN event_id % 2 = 0 THEN '/' ELSE '' END AS url, CASE WHEN event_id % 11 > 0 THEN ts END AS published_at FROM events),
f AS (SELECT *, lower(rtrim(trim(url), '/')) AS u, lower(trim(title)) AS t FROM e WHERE published_at IS NULL OR published_at >= TIMESTAMP '2024-01-05')"""
_ROUNDS = f"""{_RAW}, r AS (SELECT 0 AS n, topic, seq, u, t, 0 AS state FROM f UNION ALL
 SELECT n + 1, topic, seq, u, t, CASE WHEN f THEN 1 WHEN bool_or(f) OVER (PARTITION BY topic, u) OR bool_or(f) OVER (PARTITION BY topic, t) THEN 2 ELSE 0 END
 FROM (SELECT *, seq = min(seq) OVER (PARTITION BY topic, u) AND seq = min(seq) OVER (PARTITION BY topic, t) AS f FROM r WHERE state = 0)),
ts AS (SELECT topic, seq, title, url, published_at, row_number() OVER (PARTITION BY topic ORDER BY published_at DESC NULLS LAST, seq)::INT AS rank FROM f SEMI JOIN (SELECT topic, seq FROM r WHERE state = 1) USING (topic, seq) QUALIFY rank <= 50)"""


def _stories(spark, d):  # noqa: ANN001, ANN202
    e = tables.read(spark, d, "events")
    title = F.concat(F.lit("Story "), "user_id", F.lit(" "), F.bround("value").cast("int") % 9)
    e = e.select(F.col("event_type").alias("topic"), F.col("event_id").alias("seq"), title.alias("title"), F.concat(F.lit("http://x/"), F.col("event_id") % 3000, F.when(F.col("event_id") % 2 == 0, "/").otherwise("")).alias("url"), F.when(F.col("event_id") % 11 > 0, F.col("ts")).alias("published_at"))
    return news.topic_stories(e, "2024-01-05", 50)


@R.query(f"WITH RECURSIVE {_ROUNDS} SELECT topic, seq, title, url, rank FROM ts")
def topic_stories(spark, d):  # noqa: ANN001, ANN201
    return _stories(spark, d).drop("published_at")


@R.query(f"""WITH RECURSIVE {_ENTRIES}, {_ROUNDS}, s AS (SELECT 'portfolio' AS section, rank, id, ticker::VARCHAR AS ticker FROM pf UNION ALL SELECT topic, rank, seq, NULL FROM ts WHERE topic IN ('view', 'purchase'))
SELECT pos::INT AS pos, n.section, count(rank)::INT AS n, coalesce(string_agg(id || ':' || coalesce(ticker, ''), ',' ORDER BY rank), '') AS entries FROM (SELECT unnest([0, 1, 2, 3]) AS pos, unnest(['portfolio', 'view', 'purchase', 'nothing']) AS section) n LEFT JOIN s USING (section) GROUP BY ALL""")
def digest_document(spark, d):  # noqa: ANN001, ANN201
    """The digest's sections; one named topic has no stories."""
    feed = _stories(spark, d).select("topic", "rank", F.col("seq").alias("id"), F.col("published_at").cast("date").alias("published_at"), F.lit("feed").alias("source"))
    doc = news.digest_document(news.portfolio_entries(_articles(spark, d), "src0"), feed, ["view", "purchase", "nothing"])
    return doc.withColumn("entries", F.array_join(F.transform("entries", lambda e: F.concat(e["id"].cast("string"), F.lit(":"), F.coalesce(e["ticker"], F.lit("")))), ","))


_MONTHS = """mo AS (SELECT o_orderpriority AS series_id, date_trunc('month', o_orderdate)::DATE AS date, avg(o_totalprice) AS value FROM orders GROUP BY ALL)"""


@R.query(f"""WITH {_MONTHS}, y AS (SELECT 'YOY' AS series_id, date, round((value / nullif(lag(value, 12) OVER (ORDER BY date), 0) - 1) * 100, 2) AS value FROM mo WHERE series_id = '3-MEDIUM'),
al AS (SELECT * FROM mo UNION ALL SELECT * FROM y WHERE value IS NOT NULL) SELECT date, series_id, CASE series_id WHEN 'YOY' THEN 'Change of 3-MEDIUM' ELSE 'Mean of ' || series_id END AS label, value, CASE series_id WHEN 'YOY' THEN 'pct' ELSE 'index' END AS units, 'M' AS frequency
FROM al WHERE series_id <> '5-LOW'""", "value")
def labelled_history(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders")
    months = o.groupBy(F.col("o_orderpriority").alias("series_id"), F.trunc(F.to_date("o_orderdate"), "month").alias("date")).agg(F.avg("o_totalprice").alias("value"))
    about = o.select(F.col("o_orderpriority").alias("series_id")).distinct().where("series_id <> '5-LOW'").select("series_id", F.concat(F.lit("Mean of "), "series_id").alias("label"), F.lit("index").alias("units"), F.lit("M").alias("frequency"))
    about = about.union(spark.range(1).select(F.lit("YOY"), F.lit("Change of 3-MEDIUM"), F.lit("pct"), F.lit("M")))
    return macro.labelled_history(months, about, {"YOY": "3-MEDIUM"})


_GROUPS = {"trade": ["l_quantity", "l_extendedprice", "l_shipdate", "user_id"], "text": ["text", "lang", "event_type"]}
_COLUMNS = {"lineitem": _GROUPS["trade"][:3], "events": ["user_id", "event_type"], "documents": ["text", "lang"]}


@R.query(" UNION ALL ".join(f"""SELECT '{g}' AS "group", '{c}' AS "column", CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof(any_value({c}))) END AS type, '{t}' AS "table", count({c}) AS filled, count(*) AS rows FROM {t}""" for t, cols in _COLUMNS.items() for c in cols for g in _GROUPS if c in _GROUPS[g]))
def column_registry(spark, d):  # noqa: ANN001, ANN201
    """The registry exported as JSON and read back."""
    path = snapshots.scratch(spark, "registry")
    made = readers.filled_registry(spark, _GROUPS, {t: tables.read(spark, d, t) for t in _COLUMNS})
    made.write.json(path)
    return spark.read.schema(made.schema).json(path)
