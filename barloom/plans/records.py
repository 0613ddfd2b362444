"""Registered queries over news, filings and analyst records, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import membership, news
from barloom.plans import filings
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()
_TRUST = {"src0": 0.9, "src1": 0.8, "src2": 0.7}
_W = "CASE source WHEN 'src0' THEN 0.9 WHEN 'src1' THEN 0.8 WHEN 'src2' THEN 0.7 ELSE 0.5 END::DOUBLE"
_SCORES = filings.SCORES
_ART = f"arts AS (SELECT doc_id AS id, list_distinct([doc_id % 50, doc_id % 7]) AS tickers, DATE '2024-01-01' + (doc_id % 30)::INT AS date, source, {_W} AS w FROM documents)"


def _trust():  # noqa: ANN202
    return F.coalesce(*[F.when(F.col("source") == s, F.lit(v)) for s, v in _TRUST.items()], F.lit(0.5))


def _news(spark, d):  # noqa: ANN001, ANN202
    return tables.read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.array(F.col("doc_id") % 50, F.col("doc_id") % 7).alias("tickers"), F.expr("date_add(date'2024-01-01', cast(doc_id % 30 as int))").alias("date"), "source", "text")


def _scores(spark, d):  # noqa: ANN001, ANN202
    return filings.scores(spark, d)


@R.query(f"""WITH {_SCORES}, {_ART},
{filings.EVENTS},
e2 AS (SELECT id, category, description, 0.25 + 0.5 * (id % 2) AS severity FROM flags),
ef AS (SELECT id, count(*) AS n, max(severity) AS m, sum(severity) AS s, list(category) AS c FROM e2 GROUP BY id),
x AS (SELECT a.id, unnest(tickers) AS ticker, date, source, w FROM arts a), j AS (SELECT x.*, words, positive, negative, uncertainty, score, n, m, s, c FROM x LEFT JOIN scores USING (id) LEFT JOIN ef USING (id)),
src AS (SELECT ticker, date, source, count(*) AS k FROM j GROUP BY ALL), js AS (SELECT ticker, date, '{{' || string_agg('"' || source || '":' || k, ',' ORDER BY source) || '}}' AS by_source FROM src GROUP BY ALL),
cats AS (SELECT ticker, date, string_agg(DISTINCT cat, ',' ORDER BY cat) AS categories FROM (SELECT ticker, date, unnest(c) AS cat FROM j) GROUP BY ALL),
tops AS (SELECT ticker, date, string_agg(description, '; ' ORDER BY k) AS top_events FROM (SELECT ticker, date, description, row_number() OVER (PARTITION BY ticker, date ORDER BY severity DESC, e2.id, category) AS k FROM x JOIN e2 ON e2.id = x.id) WHERE k <= 3 GROUP BY ALL),
g AS (SELECT ticker, date, count(*) AS articles, sum(w) AS trusted_weight, avg(score) AS sentiment_mean, max(score) AS sentiment_max, min(score) AS sentiment_min, sum(w * score) / nullif(sum(w), 0) AS sentiment_trusted,
 sum(positive)::BIGINT AS positive, sum(negative)::BIGINT AS negative, sum(uncertainty)::BIGINT AS uncertainty, sum(words)::BIGINT AS words, coalesce(sum(n), 0)::BIGINT AS events, coalesce(max(m), 0)::DOUBLE AS severity_max, coalesce(sum(s) / sum(n), 0)::DOUBLE AS severity_mean FROM j GROUP BY ALL)
SELECT g.*, by_source, coalesce(categories, '') AS categories, coalesce(top_events, '') AS top_events FROM g JOIN js USING (ticker, date) LEFT JOIN cats USING (ticker, date) LEFT JOIN tops USING (ticker, date)""", "trusted_weight sentiment_mean sentiment_max sentiment_min sentiment_trusted severity_max severity_mean")
def news_daily(spark, d):  # noqa: ANN001, ANN201
    e = filings.events(spark, d).withColumn("severity", 0.25 + 0.5 * (F.col("id") % 2))
    return news.daily_aggregate(_news(spark, d), _scores(spark, d), e, _trust())


@R.query(f"""WITH {_SCORES}, v AS (SELECT doc_id % 300 AS fingerprint, doc_id AS id, source, {_W} AS w, CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE md5(coalesce(text, '')) END AS body, [coalesce(lang, ''), 't' || doc_id % 3] AS tags, CASE WHEN doc_id % 5 > 1 THEN 'kind' || doc_id % 5 END AS event, (doc_id % 7) / 10.0 AS severity FROM documents),
j AS (SELECT v.*, score FROM v JOIN scores USING (id)),
tg AS (SELECT fingerprint, string_agg(DISTINCT t, ',' ORDER BY t) AS tags FROM (SELECT fingerprint, unnest(tags) AS t FROM v) GROUP BY ALL),
g AS (SELECT fingerprint, arg_max(source, row(w, source)) AS primary_source, arg_max(body, row(w, source, body)) FILTER (trim(body) <> '') AS body, avg(score) AS score_mean, count(*) AS variants, arg_max(event, row(severity, event)) FILTER (event IS NOT NULL) AS top_event FROM j GROUP BY ALL)
SELECT * FROM g JOIN tg USING (fingerprint)""", "score_mean")
def article_records(spark, d):  # noqa: ANN001, ANN201
    v = tables.read(spark, d, "documents").select((F.col("doc_id") % 300).alias("fingerprint"), F.col("doc_id").alias("id"), "source", F.when(F.col("doc_id") % 4 == 0, " ").otherwise(F.md5(F.coalesce("text", F.lit("")))).alias("body"), F.array(F.coalesce("lang", F.lit("")), F.concat(F.lit("t"), F.col("doc_id") % 3)).alias("tags"), F.when(F.col("doc_id") % 5 > 1, F.concat(F.lit("kind"), F.col("doc_id") % 5)).alias("event"), (F.col("doc_id") % 7 / 10).alias("severity"))
    return news.article_records(v.join(_scores(spark, d), "id"), _trust())


@R.query(f"""WITH {_SCORES}, a AS (SELECT doc_id AS id, source, DATE '2024-01-01' + (doc_id % 30)::INT AS published_at FROM documents),
top AS (SELECT id, score, published_at FROM a JOIN scores USING (id) WHERE source IS DISTINCT FROM 'src0' ORDER BY abs(score) DESC, published_at DESC, id LIMIT 30)
SELECT id, score, published_at, p AS pos, CASE p WHEN 0 THEN id % 50 ELSE id % 7 END AS ticker FROM top, (SELECT unnest([0, 1])::INT AS p)""", "score")
def news_digest(spark, d):  # noqa: ANN001, ANN201
    a = _news(spark, d).join(_scores(spark, d), "id").withColumnRenamed("date", "published_at")
    return news.digest(a, "src0")


@R.query("""WITH e AS (SELECT event_type AS topic, event_id AS seq, 'Story ' || user_id || ' ' || (value::INT % 9) AS title, 'http://x/' || (event_id % 3000) || CASE WHEN event_id % 2 = 0 THEN '/' ELSE '' END AS url, CASE WHEN event_id % 11 > 0 THEN ts END AS published_at FROM events),
f AS (SELECT * FROM e WHERE published_at IS NULL OR published_at >= TIMESTAMP '2024-01-05'), u AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY topic, lower(rtrim(trim(url), '/')) ORDER BY seq) = 1),
t AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY topic, lower(trim(title)) ORDER BY seq) = 1)
SELECT topic, seq, title, url, row_number() OVER (PARTITION BY topic ORDER BY published_at DESC NULLS LAST, seq)::INT AS rank FROM t QUALIFY rank <= 50""")
def topic_feed(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events")
    e = e.select(F.col("event_type").alias("topic"), F.col("event_id").alias("seq"), F.concat(F.lit("Story "), "user_id", F.lit(" "), F.bround("value").cast("int") % 9).alias("title"), F.concat(F.lit("http://x/"), F.col("event_id") % 3000, F.when(F.col("event_id") % 2 == 0, "/").otherwise("")).alias("url"), F.when(F.col("event_id") % 11 > 0, F.col("ts")).alias("published_at"))
    return news.topic_feed(e, "2024-01-05", 50).drop("published_at")


@R.query("""WITH h AS (SELECT year(l_shipdate) AS y, l_partkey % 100 AS ticker, count(DISTINCT l_suppkey) AS holders, sum(l_quantity) AS shares FROM lineitem GROUP BY ALL),
p AS (SELECT *, lag(shares) OVER (PARTITION BY ticker ORDER BY y) AS prior FROM h)
SELECT ticker, y::VARCHAR AS quarter, ticker || ': ' || holders || ' holders with ' || shares::BIGINT || ' shares in ' || y || ', ' || CASE WHEN prior IS NULL THEN 'new' WHEN shares > prior THEN 'up' WHEN shares < prior THEN 'down' ELSE 'unchanged' END AS body FROM p""")
def ownership_text(spark, d):  # noqa: ANN001, ANN201
    li = tables.read(spark, d, "lineitem")
    h = li.groupBy(F.year("l_shipdate").cast("string").alias("quarter"), (F.col("l_partkey") % 100).alias("ticker")).agg(F.countDistinct("l_suppkey").alias("holders"), F.sum("l_quantity").alias("shares"))
    w = membership.Window.partitionBy("ticker").orderBy("quarter")
    return news.ownership_text(h.withColumn("prior_shares", F.lag("shares").over(w)))


@R.query("""WITH s AS (SELECT DISTINCT lang, source, n_chars FROM documents WHERE doc_id % 3 = 0),
f AS (SELECT * FROM documents d WHERE length(text) >= 50 AND NOT EXISTS (SELECT 1 FROM s WHERE s.lang = d.lang AND s.source = d.source AND s.n_chars = d.n_chars))
SELECT doc_id, lang, source FROM f QUALIFY row_number() OVER (PARTITION BY lang, source, n_chars ORDER BY doc_id) = 1""")
def new_documents(spark, d):  # noqa: ANN001, ANN201
    docs = tables.read(spark, d, "documents")
    return news.new_documents(docs, docs.where("doc_id % 3 = 0"), ["lang", "source", "n_chars"], 50).select("doc_id", "lang", "source")


@R.query("""WITH s AS (SELECT user_id AS ticker, event_type AS source, ts::DATE AS date, arg_max(struct_pack(t := value, r := CASE WHEN value > 40 THEN 'Buy' ELSE 'Hold' END), row(ts, event_id)) AS p FROM events GROUP BY ALL),
w AS (SELECT ticker, date, coalesce(max(p.t) FILTER (source = 'click'), max(p.t) FILTER (source = 'view'), max(p.t) FILTER (source = 'signup')) AS target,
 coalesce(max(p.r) FILTER (source = 'click'), max(p.r) FILTER (source = 'view'), max(p.r) FILTER (source = 'signup')) AS rating FROM s WHERE date BETWEEN DATE '2024-01-30' - 36 AND DATE '2024-01-30' GROUP BY ALL),
a AS (SELECT *, (DATE '2024-01-30' - date)::INT AS age FROM w),
g AS (SELECT ticker, max(target) FILTER (age = 0) AS target, arg_max(target, date) FILTER (age BETWEEN 7 AND 13 AND target IS NOT NULL) AS target_7d, arg_max(target, date) FILTER (age BETWEEN 30 AND 36 AND target IS NOT NULL) AS target_30d,
 max(rating) FILTER (age = 0) AS rating, arg_max(rating, date) FILTER (age BETWEEN 30 AND 36 AND rating IS NOT NULL) AS rating_30d, count(*) AS days FROM a GROUP BY ALL)
SELECT *, target - target_7d AS delta_7d, target - target_30d AS delta_30d, (target - target_30d) / nullif(target_30d, 0) * 100 AS pct_30d, coalesce(rating <> rating_30d, false) AS rating_changed FROM g""", "target target_7d target_30d delta_7d delta_30d pct_30d")
def analyst_revisions(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select(F.col("user_id").alias("ticker"), F.col("event_type").alias("source"), F.to_date("ts").alias("date"), F.struct("ts", "event_id").alias("fetched_at"), F.col("value").alias("mean_target"), F.when(F.col("value") > 40, "Buy").otherwise("Hold").alias("rating"))
    return news.analyst_revisions(news.daily_snapshots(e), ["click", "view", "signup"], "2024-01-30")


@R.query("""SELECT o_custkey AS ticker, o_orderkey AS filing_id, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC)::INT AS nth FROM orders QUALIFY nth <= 3""")
def latest_filings(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderkey").alias("filing_id"), F.to_date("o_orderdate").alias("filed_date"))
    return news.latest_filings(o, 3).drop("filed_date")
