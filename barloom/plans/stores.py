"""Registered queries over stores, files and their upkeep, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import membership, stores
from barloom.plans import catalog_inputs, records, series, sql
from barloom.plans.registry import Registry
from barloom.sources import readers, snapshots, tables

R = Registry()
_BARS, _BY = sql._BARS, sql._BY
_ROSTERS = "rosters AS (SELECT DISTINCT date_trunc('quarter', l_shipdate)::DATE AS date, l_partkey AS ticker FROM lineitem)"
_CHANGES = f"""{_ROSTERS}, rc AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM rosters)), rn AS (SELECT ticker, n FROM rosters JOIN rc USING (date)),
ch AS (SELECT date, ticker, 'ADDED' AS action FROM rn a JOIN rc USING (n) WHERE n > 1 AND NOT EXISTS (SELECT 1 FROM rn b WHERE b.ticker = a.ticker AND b.n = a.n - 1)
 UNION ALL SELECT rc.date, a.ticker, 'REMOVED' FROM rn a JOIN rc ON rc.n = a.n + 1 WHERE NOT EXISTS (SELECT 1 FROM rn b WHERE b.ticker = a.ticker AND b.n = a.n + 1)),
re AS (SELECT g.date, g.ticker AS old, c.ticker AS new FROM ch g JOIN ch c ON c.date = g.date AND c.ticker = g.ticker + 1 AND c.action = 'ADDED' WHERE g.action = 'REMOVED' AND g.ticker % 10 = 0),
kept AS (SELECT * FROM ch WHERE NOT EXISTS (SELECT 1 FROM re WHERE re.date = ch.date AND (ch.action = 'REMOVED' AND re.old = ch.ticker OR ch.action = 'ADDED' AND re.new = ch.ticker)))"""


def _rosters(spark, d):  # noqa: ANN001, ANN202
    return tables.read(spark, d, "lineitem").select(F.expr("cast(trunc(l_shipdate, 'quarter') as date)").alias("date"), F.col("l_partkey").alias("ticker")).distinct()


def _renamed(spark, d):  # noqa: ANN001, ANN202
    r = tables.read(spark, d, "part").where("p_partkey % 10 = 0").select(F.col("p_partkey").alias("old_ticker"), (F.col("p_partkey") + 1).alias("new_ticker"))
    return stores.renamed_changes(_rosters(spark, d), r)


@R.query(f"WITH {_CHANGES} SELECT date, ticker, action FROM kept")
def roster_changes_without_renames(spark, d):  # noqa: ANN001, ANN201
    return _renamed(spark, d)[0]


@R.query(f"""WITH {_CHANGES}, g AS (SELECT date, coalesce(string_agg(ticker::VARCHAR, ',' ORDER BY ticker) FILTER (action = 'REMOVED'), '') AS l, coalesce(string_agg(ticker::VARCHAR, ',' ORDER BY ticker) FILTER (action = 'ADDED'), '') AS j FROM kept GROUP BY ALL)
SELECT date, md5(l) AS left_md5, md5(j) AS joined_md5 FROM g WHERE l <> '' AND j <> ''""")
def unresolved_swaps(spark, d):  # noqa: ANN001, ANN201
    s = _renamed(spark, d)[1]
    text = lambda c: F.md5(F.array_join(F.col(c).cast("array<string>"), ","))
    return s.select("date", text("left").alias("left_md5"), text("joined").alias("joined_md5"))


@R.query(f"""WITH {_CHANGES}, a AS (SELECT DISTINCT ticker, action FROM ch WHERE date >= DATE '1996-01-01'), b AS (SELECT DISTINCT ticker, action FROM kept WHERE date >= DATE '1996-01-01')
SELECT *, 'observed' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'reference' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def change_divergence_since(spark, d):  # noqa: ANN001, ANN201
    return membership.divergence(membership.roster_changes(_rosters(spark, d)), _renamed(spark, d)[0], "1996-01-01")


@R.query(f"""WITH {_CHANGES}, h AS (SELECT sha256(to_json([date::VARCHAR, ticker::VARCHAR, action])) AS h FROM kept), p AS (SELECT floor(('0x' || h[1:4])::INT * 64 / 65536.0) AS p, sha256(string_agg(h, ',' ORDER BY h)) AS s, count(*) AS n FROM h GROUP BY ALL)
SELECT sha256(string_agg(s, ',' ORDER BY p)) AS content_hash, sum(n)::BIGINT AS rows FROM p""")
def frozen_changes_hash(spark, d):  # noqa: ANN001, ANN201
    return stores.content_hash(_renamed(spark, d)[0], ["date", "ticker", "action"])


_ON_BASIS = f"""lastd AS (SELECT ticker, max(date) AS l FROM bars GROUP BY ALL), sp AS (SELECT splits.ticker, splits.ex_date, split_from / split_to AS f FROM splits JOIN lastd USING (ticker) WHERE ex_date <= l),
dd AS (SELECT d.ticker, d.ex_date, d.cash * coalesce((SELECT product(f) FROM sp WHERE sp.ticker = d.ticker AND sp.ex_date > d.ex_date), 1) AS cash FROM divs d)"""


def _returns_sql(bars: str) -> str:
    return f"""d2 AS (SELECT ticker, ex_date, sum(cash) AS cash FROM dd GROUP BY ALL), pv AS (SELECT d2.ticker, d2.ex_date, d2.cash, max(b.date) AS date FROM d2 JOIN {bars} b ON b.ticker = d2.ticker AND b.date < d2.ex_date GROUP BY ALL),
cf AS (SELECT pv.ticker, pv.date, 1 - sum(cash) / any_value(close) AS f FROM pv JOIN {bars} USING (ticker, date) GROUP BY ALL HAVING sum(cash) < any_value(close)),
tr AS (SELECT ticker, date, close, close * product(coalesce(f, 1.0)) OVER ({_BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS total_return_close FROM {bars} LEFT JOIN cf USING (ticker, date))"""


@R.query(f"WITH {_BARS}, {sql._SPLITS}, {sql._DIVS}, {_ON_BASIS}, {_returns_sql('bars')} SELECT * FROM tr", "close total_return_close")
def total_return_on_basis(spark, d):  # noqa: ANN001, ANN201
    r = stores.total_return_on_basis(tables.bars(spark, d), catalog_inputs.dividends(spark, d), catalog_inputs.splits(spark, d))
    return r.select("ticker", "date", "close", "total_return_close")


_RESTATED = f"rb AS (SELECT ticker, date, close * coalesce((SELECT product(split_from / split_to) FROM splits s WHERE s.ticker = b.ticker AND s.ex_date > b.date), 1) AS close FROM bars b)"


@R.query(f"WITH {_BARS}, {sql._SPLITS}, {sql._DIVS}, {_ON_BASIS}, {_RESTATED}, {_returns_sql('rb')} SELECT * FROM tr", "close total_return_close")
def crsp_basis(spark, d):  # noqa: ANN001, ANN201
    r = stores.crsp_basis(tables.bars(spark, d), catalog_inputs.dividends(spark, d), catalog_inputs.splits(spark, d))
    return r.select("ticker", "date", "close", "total_return_close")


_EVIDENCE = f"""mv AS (SELECT ticker, date, close / lag(close) OVER ({_BY}) AS move FROM bars), sf AS (SELECT *, split_from / split_to AS f FROM splits),
sg AS (SELECT s.ticker, s.ex_date, f, count(move) AS n, coalesce(bool_or(abs(move / f - 1) <= 0.15), false) AS d, coalesce(bool_or(abs(move * f - 1) <= 0.15), false) AND NOT f BETWEEN 1 / 1.45 AND 1.45 AS i FROM sf s LEFT JOIN mv ON mv.ticker = s.ticker AND move IS NOT NULL AND abs(date_diff('day', mv.date, s.ex_date)) <= 4 GROUP BY s.ticker, s.ex_date, f),
st AS (SELECT *, CASE WHEN ticker % 3 = 0 AND year(ex_date) < 1996 THEN 'already_applied' WHEN d AND i THEN 'refused' WHEN d THEN 'applied' WHEN i THEN 'applied_inverse' ELSE 'unconfirmed' END AS status FROM sg)"""


def _applied(spark, d):  # noqa: ANN001, ANN202
    s = catalog_inputs.splits(spark, d)
    return stores.apply_splits(tables.bars(spark, d), s, s.where("ticker % 3 = 0 and year(ex_date) < 1996"))


@R.query(f"WITH {_BARS}, {sql._SPLITS}, {_EVIDENCE} SELECT ticker, ex_date, status FROM st")
def split_status(spark, d):  # noqa: ANN001, ANN201
    return _applied(spark, d)[1]


@R.query(f"WITH {_BARS}, {sql._SPLITS}, {_EVIDENCE}, due AS (SELECT ticker, ex_date, CASE status WHEN 'applied' THEN f ELSE 1 / f END AS f FROM st WHERE status LIKE 'applied%') SELECT ticker, date, close * coalesce((SELECT product(f) FROM due WHERE due.ticker = b.ticker AND due.ex_date > b.date), 1) AS close FROM bars b", "close")
def applied_splits(spark, d):  # noqa: ANN001, ANN201
    return _applied(spark, d)[0].select("ticker", "date", "close")


_SYNC = f"""mk AS (SELECT ticker, ex_date FROM splits WHERE ticker % 2 = 0), due AS (SELECT * FROM splits WHERE NOT EXISTS (SELECT 1 FROM mk WHERE mk.ticker = splits.ticker AND mk.ex_date = splits.ex_date)),
hist AS (SELECT ticker, date, close * coalesce((SELECT product(split_from / split_to) FROM due s WHERE s.ticker = b.ticker AND s.ex_date > b.date), 1) AS close FROM bars b),
fa AS (SELECT ticker, date, close, coalesce((SELECT product(split_from / split_to) FROM splits s WHERE s.ticker = b.ticker AND s.ex_date > b.date), 1) AS f FROM bars b),
ar AS (SELECT fa.ticker, fa.date, fa.close, f, coalesce(abs(fa.close * f / hist.close - 1) <= 0.02, false) AND NOT coalesce(abs(fa.close / hist.close - 1) <= 0.02, false) AS rescaled FROM fa LEFT JOIN hist USING (ticker, date))"""


def _synced(spark, d):  # noqa: ANN001, ANN202
    b, s = tables.bars(spark, d), catalog_inputs.splits(spark, d)
    return stores.sync_stores(b.select("ticker", "date", "close"), b, s, s.where("ticker % 2 = 0").select("ticker", "ex_date", F.lit("history").alias("store")))


@R.query(f"WITH {_BARS}, {sql._SPLITS}, {_SYNC} SELECT ticker, date, CASE WHEN rescaled THEN close * f ELSE close END AS close, rescaled FROM ar", "close")
def synced_archive(spark, d):  # noqa: ANN001, ANN201
    return _synced(spark, d)[1]


@R.query(f"WITH {sql._SPLITS} SELECT ticker, ex_date, store FROM splits, (SELECT unnest(['history', 'archive']) AS store) WHERE NOT (store = 'history' AND ticker % 2 = 0)")
def sync_markers(spark, d):  # noqa: ANN001, ANN201
    return _synced(spark, d)[2]


@R.query(f"""WITH {series._MACRO}, s AS (SELECT series_id, date, CASE WHEN day(date) % 4 = 0 THEN NULL WHEN day(date) % 4 = 1 THEN value + 1 ELSE value END AS value FROM macro), o AS (SELECT * FROM macro WHERE day(date) % 3 > 0),
j AS (SELECT s.series_id, s.date, s.value, o.value AS seen FROM s ASOF LEFT JOIN o ON s.series_id = o.series_id AND s.date >= o.date), r AS (SELECT *, date BETWEEN DATE '1995-01-01' AND DATE '1996-06-30' AND seen IS NOT NULL AND value IS DISTINCT FROM seen AS repaired FROM j)
SELECT series_id, date, CASE WHEN repaired THEN seen ELSE value END AS value, repaired FROM r""", "value")
def series_repair(spark, d):  # noqa: ANN001, ANN201
    m = tables.macro(spark, d)
    k = F.dayofmonth("date") % 4
    return stores.series_repair(m.withColumn("value", F.when(k == 1, F.col("value") + 1).when(k > 1, F.col("value"))), m.where("day(date) % 3 > 0"), "1995-01-01", "1996-06-30")


_DOCS = "d AS (SELECT doc_id, lang AS doc_type, DATE '2024-01-01' + (doc_id % 30)::INT AS day, TIMESTAMP '2024-01-01' + to_hours((doc_id % 720)::INT) AS ts, doc_id % 37 AS ticker FROM documents)"


def _typed(spark, d):  # noqa: ANN001, ANN202
    return tables.read(spark, d, "documents").selectExpr("doc_id", "lang AS doc_type", "date_add(date'2024-01-01', cast(doc_id % 30 AS int)) AS day", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(doc_id % 720 AS int)) AS ts", "doc_id % 37 AS ticker")


@R.query(f"""WITH {_DOCS}, c AS (SELECT doc_id, count(*) AS n FROM (SELECT label * 7 + vec_id % 11 AS doc_id FROM embeddings) GROUP BY ALL)
SELECT day, count(DISTINCT doc_id) FILTER (doc_type = 'en') AS en, count(DISTINCT doc_id) FILTER (doc_type = 'de') AS de, count(DISTINCT doc_id) AS documents, coalesce(sum(n), 0)::BIGINT AS chunks, max(ts)::VARCHAR AS newest FROM d LEFT JOIN c USING (doc_id) GROUP BY ALL""")
def manifest_by_day(spark, d):  # noqa: ANN001, ANN201
    chunks = tables.read(spark, d, "embeddings").select((F.col("label") * 7 + F.col("vec_id") % 11).alias("doc_id"))
    return stores.manifest_by_day(_typed(spark, d), chunks, ["en", "de"]).withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@R.query(f"WITH {_DOCS}, n AS (SELECT ticker, count(DISTINCT doc_id) AS n FROM d GROUP BY ALL) SELECT count(*) AS keys, min(n) AS least, quantile_disc(n, 0.25) AS q1, quantile_disc(n, 0.5) AS q2, quantile_disc(n, 0.75) AS q3, max(n) AS most FROM n")
def documents_per_ticker(spark, d):  # noqa: ANN001, ANN201
    return stores.documents_per_key(_typed(spark, d))


@R.query(f"""WITH {_BARS}, c AS (SELECT DISTINCT date FROM bars WHERE date >= DATE '1997-01-01'), f AS (SELECT ticker, min(date) AS b FROM bars WHERE date >= DATE '1997-01-01' GROUP BY ALL),
m AS (SELECT ticker, date FROM f JOIN c ON c.date > b WHERE NOT EXISTS (SELECT 1 FROM bars x WHERE x.ticker = f.ticker AND x.date = c.date)) SELECT ticker, md5(string_agg(date::VARCHAR, ',' ORDER BY date DESC)) AS missing_md5, count(*) AS n FROM m GROUP BY ALL""")
def missing_dates(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    return stores.missing_dates(b, b, "1997-01-01").select("ticker", F.md5(F.array_join(F.col("missing").cast("array<string>"), ",")).alias("missing_md5"), "n")


@R.query(f"""WITH {records._SCORES}, {records._ART}, s AS (SELECT id, score FROM scores), tk AS (SELECT id, unnest(tickers) AS ticker FROM arts), nt AS (SELECT ticker, count(*) AS n FROM tk GROUP BY ALL),
be AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS k FROM s), wo AS (SELECT id, score, row_number() OVER (ORDER BY score, id) AS k FROM s)
SELECT 'best' AS section, string_agg(id::VARCHAR, ',' ORDER BY k) AS ids FROM be WHERE k <= 5 UNION ALL SELECT 'worst', string_agg(id::VARCHAR, ',' ORDER BY k) FROM wo WHERE k <= 5 UNION ALL SELECT 'tickers', string_agg(ticker || ':' || n, ',' ORDER BY n DESC, ticker) FROM nt""")
def digest_sections(spark, d):  # noqa: ANN001, ANN201
    a = records._news(spark, d).join(records._scores(spark, d), "id").select("id", "score", F.col("date").alias("published_at"), F.explode(F.array_distinct("tickers")).alias("ticker"))
    s = stores.digest_sections(a)
    story = F.from_json("body", "array<struct<id:bigint,score:double>>")
    count = F.from_json("body", "array<struct<ticker:bigint,n:bigint>>")
    ids = F.when(F.col("section") == "tickers", F.array_join(F.transform(count, lambda x: F.concat(x["ticker"].cast("string"), F.lit(":"), x["n"].cast("string"))), ",")).otherwise(F.array_join(F.transform(story, lambda x: x["id"].cast("string")), ","))
    return s.select("section", ids.alias("ids"))


_DAY = "1998-03-11"
_BOTH = f"""near AS (SELECT * FROM bars WHERE date < DATE '{_DAY}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) < 265), inc AS (SELECT ticker, DATE '{_DAY}' AS date, open, high, low, CASE WHEN ticker % 7 = 3 THEN -close ELSE close END AS close, volume, vwap FROM bars QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1),
b2 AS (SELECT * FROM near WHERE ticker IN (SELECT ticker FROM inc) UNION ALL SELECT * FROM inc), g AS (SELECT *, close / lag(close) OVER ({_BY}) AS ratio FROM b2),
v AS (SELECT ticker, date, concat_ws(',', CASE WHEN high < low THEN 'high_below_low' END, CASE WHEN close > high OR close < low THEN 'close_out_of_range' END, CASE WHEN close <= 0 THEN 'nonpositive_close' END, CASE WHEN volume < 0 THEN 'negative_volume' END) AS blocking,
 CASE WHEN ratio IS NULL OR greatest(ratio, 1 / ratio) <= 1.5 THEN 'ok' WHEN abs(greatest(ratio, 1 / ratio) / round_even(greatest(ratio, 1 / ratio), 0) - 1) <= 0.005 AND round_even(greatest(ratio, 1 / ratio), 0) BETWEEN 2 AND 50 THEN 'split_like' ELSE 'refused' END AS splice FROM g WHERE date = DATE '{_DAY}'),
vd AS (SELECT *, CASE WHEN blocking <> '' THEN 'blocked' WHEN splice <> 'ok' THEN splice ELSE 'accepted' END AS verdict FROM v)"""


def _appended(spark, d):  # noqa: ANN001, ANN202
    from barloom.operators import technicals

    b = tables.bars(spark, d)
    new = technicals.latest(b).withColumns({"date": F.lit(_DAY).cast("date"), "close": F.when(F.col("ticker") % 7 == 3, -F.col("close")).otherwise(F.col("close"))})
    return b, new, *stores.daily_append(b, new, _DAY)


@R.query(f"WITH {_BARS}, {_BOTH} SELECT * FROM vd")
def append_verdicts(spark, d):  # noqa: ANN001, ANN201
    return _appended(spark, d)[3]


@R.query(f"WITH {_BARS}, {_BOTH}, p AS (SELECT ticker, date, close / nullif(lag(close, 20) OVER ({_BY}), 0) - 1 AS momentum_20d, CASE WHEN count(close) OVER ({_BY} ROWS 49 PRECEDING) = 50 THEN close / avg(close) OVER ({_BY} ROWS 49 PRECEDING) - 1 END AS price_vs_ma50 FROM b2 WHERE ticker IN (SELECT ticker FROM vd WHERE verdict = 'accepted')) SELECT * FROM p WHERE date = DATE '{_DAY}'", "momentum_20d price_vs_ma50")
def append_features(spark, d):  # noqa: ANN001, ANN201
    return _appended(spark, d)[2].select("ticker", "date", "momentum_20d", "price_vs_ma50")


@R.query(f"WITH {_BARS}, {_BOTH}, ok AS (SELECT inc.* FROM inc JOIN vd USING (ticker) WHERE verdict = 'accepted') SELECT ticker, date, close FROM ok UNION ALL SELECT ticker, date, close FROM bars WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.ticker = bars.ticker AND ok.date = bars.date)", "close")
def appended_store(spark, d):  # noqa: ANN001, ANN201
    b, new, _, verdicts = _appended(spark, d)
    return stores.appended(b, new, verdicts).select("ticker", "date", "close")


@R.query("""WITH h AS (SELECT lpad((l_partkey % 1000)::VARCHAR, 9, '0') AS cusip, l_quantity * 1000 AS shares, CASE WHEN l_linenumber = 6 THEN 'PUT' END AS pc, l_linenumber FROM lineitem) SELECT cusip, shares::DOUBLE AS shares, CASE WHEN l_linenumber % 3 > 0 THEN shares * 2 END::DOUBLE AS market_value FROM h WHERE pc IS NULL AND l_linenumber <> 5""", "shares market_value")
def holdings_file(spark, d):  # noqa: ANN001, ANN201
    """The holdings written as a pipe-separated table, as filers do, and read back."""
    path = snapshots.scratch(spark, "holdings")
    shares = F.format_number(F.col("l_quantity") * 1000, 0)
    value = F.when(F.col("l_linenumber") % 3 > 0, F.format_number(F.col("l_quantity") * 2000, 0)).otherwise("n/a")
    cusip = F.when(F.col("l_linenumber") == 5, F.lit("ABC")).otherwise(F.lpad((F.col("l_partkey") % 1000).cast("string"), 9, "0"))
    tables.read(spark, d, "lineitem").select(cusip.alias("CUSIP"), shares.alias(" Shares"), value.alias("MARKET_VALUE"), F.when(F.col("l_linenumber") == 6, "PUT").otherwise(" ").alias("Put_Call")).write.option("header", True).option("sep", "|").csv(path)
    return readers.holdings_table(spark, path)


@R.query("""WITH e AS (SELECT ts::DATE AS date, user_id::VARCHAR AS ticker, arg_max(value, event_id) AS value, max(event_id) AS seq FROM events GROUP BY ALL), m AS (SELECT max(date) AS date FROM e WHERE date <= DATE '2024-01-20') SELECT date, ticker, value AS pe, seq FROM e SEMI JOIN m USING (date)""", "pe")
def payload_files(spark, d):  # noqa: ANN001, ANN201
    """Payloads of each day written as JSON objects by ticker, in shares of 16, and the newest one on or before a day read back."""
    path = snapshots.scratch(spark, "payloads")
    e = tables.read(spark, d, "events").groupBy(F.to_date("ts").alias("date"), F.col("user_id").cast("string").alias("ticker")).agg(F.max_by("value", "event_id").alias("pe"), F.max("event_id").alias("seq"))
    by = e.groupBy("date", (F.crc32("ticker") % 16).alias("share")).agg(F.map_from_entries(F.collect_list(F.struct("ticker", F.struct("pe", "seq")))).alias("payload"))
    by.select("date", "payload").write.partitionBy("date").json(path)
    return readers.nested_payloads(spark, path, "struct<pe: double, seq: bigint>", "2024-01-20").select("date", "ticker", "value.pe", "value.seq")


@R.query(f"WITH {_BARS} SELECT 'T' || ticker % 20 AS name, ticker, date, CASE WHEN ticker % 3 > 0 THEN close END AS close, volume FROM bars", "close volume")
def price_files(spark, d):  # noqa: ANN001, ANN201
    """Bars written into one folder for each name, some closes as not-a-number, and all of them read at once."""
    path = snapshots.scratch(spark, "prices")
    b = tables.bars(spark, d).select(F.concat(F.lit("T"), F.col("ticker") % 20, F.lit(".parquet")).alias("name"), "ticker", "date", F.when(F.col("ticker") % 3 > 0, F.col("close")).otherwise(float("nan")).alias("close"), "volume")
    b.write.partitionBy("name").parquet(path)
    got = readers.price_history(spark, f"{path}/name=*", "ticker bigint, date date, close double, volume double", "name")
    return got.withColumn("name", F.regexp_extract("name", r"(T\d+)$", 1))


@R.query("""WITH r AS (SELECT o_orderkey AS id, 'S' || o_custkey AS issuer, 'Owner ' || o_custkey % 7 AS owner, o_orderdate::DATE AS date, o_totalprice, o_orderkey % 3 AS k FROM orders),
n AS (SELECT *, 'non_derivative' AS "table", unnest(range(0, (k + 1)::BIGINT)) AS nth FROM r), dv AS (SELECT *, 'derivative' AS "table", 0 AS nth FROM r WHERE k = 1), a AS (SELECT * FROM n UNION ALL SELECT * FROM dv)
SELECT id, issuer, owner, "table", nth::INT AS nth, CASE "table" WHEN 'derivative' THEN 'Option & right' ELSE 'Common <A>' END AS security, date, CASE WHEN nth = 1 THEN 'S' ELSE 'P' END AS code, CASE WHEN nth = 1 THEN 'D' ELSE 'A' END AS acquired, (nth + 1) * 10.0::DOUBLE AS shares, CASE WHEN k > 0 THEN round(o_totalprice, 2) END AS price, 100.0::DOUBLE AS after FROM a""", "shares price after")
def ownership_forms(spark, d):  # noqa: ANN001, ANN201
    """Ownership forms in XML made from the orders, parsed to one row per transaction."""
    def transaction(tag: str, title: str, nth: str) -> str:
        code = f"CASE WHEN {nth} = 1 THEN 'S' ELSE 'P' END"
        side = f"CASE WHEN {nth} = 1 THEN 'D' ELSE 'A' END"
        price = "CASE WHEN o_orderkey % 3 > 0 THEN concat('<transactionPricePerShare><value>', cast(round(o_totalprice, 2) AS decimal(20, 2)), '</value></transactionPricePerShare>') ELSE '<transactionPricePerShare/>' END"
        return f"""concat('<{tag}><securityTitle><value>{title}</value></securityTitle><transactionDate><value>', to_date(o_orderdate), '</value></transactionDate><transactionCoding><transactionCode>', {code}, '</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>', ({nth} + 1) * 10, '</value></transactionShares>', {price},
 '<transactionAcquiredDisposedCode><value>', {side}, '</value></transactionAcquiredDisposedCode></transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>100</value></sharesOwnedFollowingTransaction></postTransactionAmounts></{tag}>')"""

    xml = f"""concat('<?xml version="1.0"?><ownershipDocument><issuer><issuerTradingSymbol>S', o_custkey, '</issuerTradingSymbol></issuer><reportingOwner><rptOwnerName>Owner ', o_custkey % 7, '</rptOwnerName></reportingOwner><nonDerivativeTable>',
 array_join(transform(sequence(0, cast(o_orderkey % 3 AS int)), n -> {transaction('nonDerivativeTransaction', 'Common &lt;A&gt;', 'n')}), ''), '</nonDerivativeTable><derivativeTable>', CASE WHEN o_orderkey % 3 = 1 THEN {transaction('derivativeTransaction', 'Option &amp; right', '0')} ELSE '' END, '</derivativeTable></ownershipDocument>')"""
    forms = tables.dealt(spark, d, "orders", "o_orderkey", 1 << 20).select("o_orderkey", F.expr(xml).alias("xml"))
    return readers.ownership_transactions(forms, "o_orderkey", "xml")


@R.query(f"WITH {_ROSTERS} SELECT date, md5(string_agg(DISTINCT 'P' || ticker, ',' ORDER BY 'P' || ticker)) AS tickers_md5 FROM rosters WHERE date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31' GROUP BY ALL")
def roster_files(spark, d):  # noqa: ANN001, ANN201
    path = snapshots.scratch(spark, "rosters")
    _rosters(spark, d).select(F.concat(F.lit("P"), "ticker").alias("ticker"), "date").write.partitionBy("date").parquet(path)
    return readers.rosters(spark, path, "1994-01-01", "1996-12-31").select("date", F.md5(F.array_join("tickers", ",")).alias("tickers_md5"))


@R.query("""WITH e AS (SELECT ts::DATE AS date, user_id % 20 AS ticker, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL) SELECT ticker, CASE WHEN day(date) = 15 THEN -n ELSE n END AS n, total, date FROM e WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""", "total")
def day_store(spark, d):  # noqa: ANN001, ANN201
    """Daily aggregates written day by day, one day written again, and a range of days read back under the fixed schema."""
    path = snapshots.scratch(spark, "days")
    e = tables.read(spark, d, "events").groupBy(F.to_date("ts").alias("date"), (F.col("user_id") % 20).alias("ticker")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    readers.write_days(e, path)
    readers.write_days(e.where("day(date) = 15").withColumn("n", -F.col("n")), path)
    return readers.read_days(spark, path, "ticker bigint, n bigint, total double, date date", "2024-01-10", "2024-01-20")
