"""Registered queries over macro series, payloads and restatements, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import macro, payloads, returns, technicals, tracking
from barloom.plans import sql
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()
_BARS, _MARKET, _BY = sql._BARS, sql._MARKET, sql._BY
_NAMES = list(tables.SERIES.values())
_MACRO = f"""macro AS (SELECT CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in tables.SERIES.items())} END AS series_id, o_orderdate::DATE AS date, avg(o_totalprice) / 10000 AS value FROM orders GROUP BY ALL)"""
_FRAME = f"""{_MACRO},
wide AS (SELECT date, {', '.join(f"max(value) FILTER (series_id = '{n}') AS {n}" for n in _NAMES)} FROM macro GROUP BY date),
cal AS (SELECT DISTINCT date FROM bars),
every AS (SELECT date, cal.date IS NOT NULL AS inside, {', '.join(_NAMES)} FROM (SELECT date FROM cal UNION SELECT date FROM wide) LEFT JOIN wide USING (date) LEFT JOIN cal USING (date)),
filled AS (SELECT date, inside, {', '.join(f'last_value({n} IGNORE NULLS) OVER (ORDER BY date) AS {n}' for n in _NAMES)} FROM every),
frame AS (SELECT * FROM filled WHERE inside)"""


def _change(x: str, n: int, by: str = _BY) -> str:
    return f"({x} / nullif(lag({x}, {n}) OVER ({by}), 0) - 1)"


def _frame(spark, d):  # noqa: ANN001, ANN202
    return macro.aligned(tables.bars(spark, d), tables.macro(spark, d), _NAMES)


@R.query(f"""WITH {_BARS}, {_FRAME}
SELECT date, VIX / 20 AS vix_level, TNX / 10 AS yield_10y, (TNX - IRX) / 10 AS yield_curve_slope, coalesce((VIX - VIX3M) / 20, 0) AS vix_term_slope,
 coalesce({_change('GLD', 5, 'ORDER BY date')}, 0) AS gold_mom_5d, (VIX3M - VIX) / greatest(VIX, 1) AS vix_term_ratio FROM frame""", "vix_level yield_10y yield_curve_slope vix_term_slope gold_mom_5d vix_term_ratio")
def macro_features(spark, d):  # noqa: ANN001, ANN201
    return macro.macro_features(_frame(spark, d))


def _sectors(spark, d):  # noqa: ANN001, ANN202
    """A tenth of the suppliers has no sector; the second half of them has a finer one of its own."""
    s = tables.read(spark, d, "supplier")
    s = s.select(F.col("s_suppkey").alias("ticker"), F.when(F.col("s_suppkey") % 10 != 0, F.concat(F.lit("N"), F.col("s_nationkey") % 5)).alias("broad"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("M"), F.col("s_nationkey"))).alias("fine"))
    return macro.first_known(s, ["fine", "broad"], "finest")


def _etf(bars, sector_of):  # noqa: ANN001, ANN202
    return bars.join(sector_of, "ticker").groupBy("sector", "date").agg(F.avg("close").alias("etf"))


def _sector(spark, d, column, prefix):  # noqa: ANN001, ANN202
    b = tables.bars(spark, d)
    of = _sectors(spark, d).select("ticker", F.col(column).alias("sector"))
    return macro.sector_relative(b, of, _etf(b, of.where("sector is not null")), tables.benchmark(spark, d), prefix)


def _sector_sql(column: str, prefix: str) -> str:
    cols = ", ".join(f"CASE WHEN sector IS NULL THEN 0.0 ELSE {_change('etf', n)} - {_change('spy', n)} END AS {prefix}_{n}d" for n in (5, 10, 20))
    return f"""{_BARS}, {_MARKET},
s AS (SELECT s_suppkey AS ticker, CASE WHEN s_suppkey % 10 <> 0 THEN 'N' || s_nationkey % 5 END AS broad, CASE WHEN s_suppkey % 2 = 0 THEN 'M' || s_nationkey END AS fine FROM supplier),
sectors AS (SELECT ticker, {column} AS sector FROM s),
etf AS (SELECT sector, date, avg(close) AS etf FROM bars JOIN sectors USING (ticker) WHERE sector IS NOT NULL GROUP BY ALL),
rel AS (SELECT ticker, date, {cols} FROM bars LEFT JOIN sectors USING (ticker) LEFT JOIN etf USING (sector, date) LEFT JOIN market USING (date))"""


@R.query(f"WITH {_sector_sql('broad', 'sector_vs_spy')} SELECT * FROM rel", "sector_vs_spy_5d sector_vs_spy_10d sector_vs_spy_20d")
def sector_relative(spark, d):  # noqa: ANN001, ANN201
    return _sector(spark, d, "broad", "sector_vs_spy")


@R.query(f"WITH {_sector_sql('coalesce(fine, broad)', 'sub_sector_vs_benchmark')} SELECT * FROM rel", "sub_sector_vs_benchmark_5d sub_sector_vs_benchmark_10d sub_sector_vs_benchmark_20d")
def sub_sector_relative(spark, d):  # noqa: ANN001, ANN201
    return _sector(spark, d, "finest", "sub_sector_vs_benchmark")


@R.query(f"""WITH {_sector_sql('broad', 'sector_vs_spy')}, {_FRAME},
f AS (SELECT ticker, date, {_change('close', 5)} AS m5, CASE WHEN count(volume) OVER ({_BY} ROWS 19 PRECEDING) = 20 THEN avg(volume) OVER ({_BY} ROWS 4 PRECEDING) / nullif(avg(volume) OVER ({_BY} ROWS 19 PRECEDING), 0) END AS vt FROM bars),
tr AS (SELECT date, coalesce({_change('spy', 20, 'ORDER BY date')}, 0) AS trend FROM market)
SELECT f.ticker, f.date, m5 * (VIX / 20 - 1) AS mom5d_x_vix, (coalesce(vt, 1) - 1) * (VIX / 20 - 1) AS vol_trend_x_vix, sector_vs_spy_5d * coalesce(trend, 0) AS sector_x_trend
FROM f JOIN rel USING (ticker, date) LEFT JOIN frame USING (date) LEFT JOIN tr USING (date)""", "mom5d_x_vix vol_trend_x_vix sector_x_trend")
def regime_products(spark, d):  # noqa: ANN001, ANN201
    f = technicals.price_features(tables.bars(spark, d)).select("ticker", "date", "momentum_5d", "volume_trend")
    f = f.join(_sector(spark, d, "broad", "sector_vs_spy"), ["ticker", "date"])
    return macro.regime_products(f, _frame(spark, d), tables.benchmark(spark, d))


@R.query(f"""WITH {_BARS}, r AS (SELECT ticker, abs({_change('close', 1)}) AS m FROM bars) SELECT ticker, max(m) AS largest_move, count(m) AS moves FROM r GROUP BY ticker""", "largest_move")
def largest_moves(spark, d):  # noqa: ANN001, ANN201
    return macro.largest_moves(tables.bars(spark, d))


@R.query(f"""WITH {_MACRO}, m AS (SELECT series_id, date_trunc('month', date)::DATE AS month, avg(value) AS value FROM macro GROUP BY ALL)
SELECT *, value / nullif(lag(value, 12) OVER (PARTITION BY series_id ORDER BY month), 0) * 100 - 100 AS yoy_pct FROM m""", "value yoy_pct")
def macro_year_on_year(spark, d):  # noqa: ANN001, ANN201
    m = tables.macro(spark, d).groupBy("series_id", F.trunc("date", "month").alias("month")).agg(F.avg("value").alias("value"))
    return macro.year_on_year(m)


@R.query(f"""WITH {_MACRO}, l AS (SELECT series_id, arg_max(value, date) AS value, max(date) AS date FROM macro GROUP BY ALL),
o AS (SELECT max(date) AS as_of, {', '.join(f"max(value) FILTER (series_id = '{n}') AS {n.lower()}" for n in _NAMES)} FROM l) SELECT *, (tnx - irx) * 100 AS slope_bps FROM o""", "vix vix3m tnx irx gld slope_bps")
def macro_snapshot(spark, d):  # noqa: ANN001, ANN201
    return macro.snapshot(tables.macro(spark, d), _NAMES)


@R.query("""SELECT event_type AS kind, min(ts::DATE) AS next_date, sum(CASE WHEN ts::DATE - DATE '2024-01-10' <= 5 THEN 1 ELSE 0 END)::BIGINT AS within FROM events WHERE ts::DATE >= DATE '2024-01-10' GROUP BY ALL""")
def release_calendar(spark, d):  # noqa: ANN001, ANN201
    return macro.upcoming(tables.read(spark, d, "events").select(F.col("event_type").alias("kind"), F.to_date("ts").alias("date")), "2024-01-10", 5)


@R.query("""WITH m AS (SELECT p_partkey AS ticker, CASE WHEN p_size % 3 > 0 THEN p_retailprice / 20 END AS pe_ttm, CASE WHEN p_size % 5 > 0 THEN p_retailprice / 25 END AS pe_annual, CASE WHEN p_size % 4 > 0 THEN p_size * 3.0 END AS margin FROM part)
SELECT ticker, least(greatest(coalesce(pe_ttm, pe_annual, 0) / 30, -3), 3) AS pe_ratio, least(greatest(coalesce(margin, 0) / 100, 0), 1) AS gross_margin,
 concat_ws(',', CASE WHEN margin IS NULL THEN 'gross_margin' END, CASE WHEN coalesce(pe_ttm, pe_annual) IS NULL THEN 'pe_ratio' END) AS absent FROM m""", "pe_ratio gross_margin")
def fundamentals(spark, d):  # noqa: ANN001, ANN201
    p = tables.read(spark, d, "part")
    known = lambda k, x: F.when(F.col("p_size") % k > 0, x)
    m = p.select(F.col("p_partkey").alias("ticker"), known(3, F.col("p_retailprice") / 20).alias("pe_ttm"), known(5, F.col("p_retailprice") / 25).alias("pe_annual"), known(4, F.col("p_size") * 3.0).alias("margin"))
    return payloads.shaped(m, {"pe_ratio": ["pe_ttm", "pe_annual"], "gross_margin": ["margin"]}, {"pe_ratio": (30.0, -3.0, 3.0), "gross_margin": (100.0, 0.0, 1.0)})


_RV = f"CASE WHEN count(r) OVER ({_BY} ROWS 19 PRECEDING) = 20 THEN stddev_samp(r) OVER ({_BY} ROWS 19 PRECEDING) * sqrt(252) END"


@R.query(f"""WITH {_BARS}, q AS (SELECT *, {_change('close', 1)} AS r FROM bars), v AS (SELECT ticker, date, {_RV} AS rv FROM q), l AS (SELECT ticker, arg_max(rv, date) FILTER (rv IS NOT NULL) AS x, max_by(struct_pack(v := rv), date).v AS realized_vol_20d FROM v GROUP BY ticker),
e AS (SELECT user_id AS ticker, arg_max(CAST(json_extract_string(props, '$.k') AS DOUBLE), row(ts, event_id)) / 100 AS atm_iv, arg_max(value, row(ts, event_id)) AS surprise_pct FROM events GROUP BY ALL)
SELECT ticker, realized_vol_20d, coalesce(surprise_pct, 0) AS surprise_pct, coalesce(atm_iv, 0) AS atm_iv, CASE WHEN atm_iv > 0 AND realized_vol_20d > 0 THEN atm_iv / realized_vol_20d ELSE 1 END AS iv_vs_rv FROM l LEFT JOIN e USING (ticker)""", "realized_vol_20d surprise_pct atm_iv iv_vs_rv")
def alternative_features(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select(F.col("user_id").alias("ticker"), "ts", "event_id", (F.get_json_object("props", "$.k").cast("double") / 100).alias("atm_iv"), F.col("value").alias("surprise_pct"))
    last = payloads.newest(e, ["ticker"], ["ts", "event_id"])
    base = technicals.latest(technicals.price_features(tables.bars(spark, d))).select("ticker", "realized_vol_20d")
    return payloads.implied_over_realized(payloads.with_defaults(base, last, ["ticker"], {"surprise_pct": 0.0, "atm_iv": 0.0}))


@R.query("""WITH a AS (SELECT o_custkey AS ticker, arg_max(o_totalprice, row(o_orderdate, o_orderkey), 5) AS v FROM orders GROUP BY ALL), x AS (SELECT ticker, v[1] AS v0, v[2] AS v1, v[3] AS v2, v[4] AS v3, v[5] AS v4 FROM a)
SELECT ticker, (v0 - v2) / nullif(abs(v2), 0) * 100 AS revision_4w,
 CASE WHEN NOT coalesce(v0 >= v1, false) THEN 0 WHEN NOT coalesce(v1 >= v2, false) THEN 1 WHEN NOT coalesce(v2 >= v3, false) THEN 2 WHEN NOT coalesce(v3 >= v4, false) THEN 3 ELSE 4 END::BIGINT AS streak FROM x""", "revision_4w")
def estimate_revisions(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders")
    newest = F.row_number().over(technicals.Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")))
    w = o.withColumn("n", newest).where("n <= 5").groupBy(F.col("o_custkey").alias("ticker")).agg(*[F.max(F.when(F.col("n") == i + 1, F.col("o_totalprice"))).alias(f"v{i}") for i in range(5)])
    return payloads.revision(w, [f"v{i}" for i in range(5)]).select("ticker", "revision_4w", "streak")


@R.query("""WITH c AS (SELECT o_custkey AS ticker, sum((o_orderstatus = 'F')::INT) AS b, sum((o_orderstatus = 'P')::INT) AS h, sum((o_orderstatus = 'O')::INT) AS s FROM orders GROUP BY ALL)
SELECT ticker, CASE WHEN b + h + s = 0 THEN NULL WHEN b > s AND b >= h THEN 'Buy' WHEN s > b THEN 'Sell' ELSE 'Hold' END AS rating, (b + h + s)::BIGINT AS num_analysts FROM c""")
def analyst_labels(spark, d):  # noqa: ANN001, ANN201
    n = lambda s: F.sum((F.col("o_orderstatus") == s).cast("int"))
    c = tables.read(spark, d, "orders").groupBy(F.col("o_custkey").alias("ticker")).agg(n("F").alias("b"), n("P").alias("h"), n("O").alias("s"))
    return c.select("ticker", payloads.analyst_label(F.col("b"), F.col("h"), F.col("s")).alias("rating"), F.expr("b + h + s").alias("num_analysts"))


@R.query("""WITH c AS (SELECT l_suppkey AS ticker, (l_partkey % 12 * 7)::INT AS days, CASE WHEN l_linenumber % 2 = 0 THEN 'call' ELSE 'put' END AS kind, l_quantity AS oi, l_discount + 0.1 AS iv, l_tax - 0.04 AS m FROM lineitem),
w AS (SELECT * FROM c WHERE days BETWEEN 15 AND 60), e AS (SELECT ticker, arg_min(days, row(abs(days - 30), days)) AS days FROM w GROUP BY ALL),
g AS (SELECT ticker, days, kind, sum(oi) AS oi, arg_min(iv, row(abs(m), iv)) AS iv FROM w SEMI JOIN e USING (ticker, days) GROUP BY ALL),
o AS (SELECT ticker, days, max(oi) FILTER (kind = 'put') / nullif(max(oi) FILTER (kind = 'call'), 0) AS put_call_ratio, avg(iv) AS atm_iv FROM g GROUP BY ALL)
SELECT *, atm_iv * sqrt(days / 365) AS expected_move FROM o""", "put_call_ratio atm_iv expected_move")
def options_signals(spark, d):  # noqa: ANN001, ANN201
    li = tables.read(spark, d, "lineitem")
    return payloads.options_signals(li.select(F.col("l_suppkey").alias("ticker"), (F.col("l_partkey") % 12 * 7).cast("int").alias("days"), F.when(F.col("l_linenumber") % 2 == 0, "call").otherwise("put").alias("kind"), F.col("l_quantity").alias("open_interest"), (F.col("l_discount") + 0.1).alias("iv"), (F.col("l_tax") - 0.04).alias("moneyness")))


@R.query("""WITH f AS (SELECT o_custkey AS ticker, o_orderkey AS id, o_orderdate::DATE AS date, o_totalprice AS value FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-06-30' - 90 AND DATE '1998-06-30'),
n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC, id DESC) AS n FROM f)
SELECT ticker, count(*) AS filings, sum(value) AS value, min(DATE '1998-06-30' - date)::INT AS days_ago, string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (n <= 10) AS newest FROM n GROUP BY ALL""", "value")
def insider_activity(spark, d):  # noqa: ANN001, ANN201
    o = tables.read(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderkey").alias("filing_id"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"))
    return payloads.recent_summary(o, "1998-06-30")


@R.query("""SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'unknown' END AS provenance, count(*) AS n FROM events GROUP BY ALL""")
def provenance(spark, d):  # noqa: ANN001, ANN201
    return tables.read(spark, d, "events").groupBy("user_id", payloads.closed_set("event_type", ["click", "view"]).alias("provenance")).agg(F.count(F.lit(1)).alias("n"))


_ALL_FWD = f"""WITH {_BARS}, {_MARKET}, {sql._CAL}, p AS (SELECT ticker, date, close, session FROM bars JOIN cal USING (date)), mk AS (SELECT session, spy FROM market JOIN cal USING (date)),
f AS (SELECT a.ticker, a.date, h AS horizon, a.close AS c0, b.close AS c1, m0.spy AS m0, m1.spy AS m1 FROM p a CROSS JOIN unnest([1, 3, 5, 10, 15, 21, 30, 60, 90]) u(h) JOIN p b ON b.ticker = a.ticker AND b.session = a.session + h
 LEFT JOIN mk m0 ON m0.session = a.session LEFT JOIN mk m1 ON m1.session = a.session + h)"""


@R.query(f"{_ALL_FWD} SELECT ticker, date, horizon, c1 / c0 - 1 AS ret, ln(c1 / c0) AS log_ret, m1 / m0 - 1 AS spy_ret, ln(m1 / m0) AS log_spy, c1 / c0 - 1 > m1 / m0 - 1 AS beat_spy FROM f", "ret log_ret spy_ret log_spy")
def forward_returns_all_horizons(spark, d):  # noqa: ANN001, ANN201
    return returns.forward_returns(tables.bars(spark, d), tables.benchmark(spark, d), returns.ALL_HORIZONS)


@R.query(f"{_ALL_FWD} SELECT ticker, date, horizon, c0 AS entry, floor(c0 * (1 + (c1 / c0 - 1)) * 100.0::DOUBLE + 0.5) / 100.0::DOUBLE AS exit FROM f WHERE horizon IN (5, 10, 21, 30)", "entry exit")
def exit_prices_all_horizons(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    return tracking.exit_prices(b.select("ticker", "date", F.col("close").alias("entry")), returns.forward_returns(b, tables.benchmark(spark, d), (5, 10, 21, 30)))


@R.query(f"""WITH {_BARS}, s AS (SELECT ticker, min(date) AS b, max(date) AS e, arg_max(close, date) AS l FROM bars GROUP BY ALL),
w AS (SELECT ticker, b, l, unnest([1, 3, 5, 10, 0]) AS y, unnest([e - to_years(1), e - to_years(3), e - to_years(5), e - to_years(10), date_trunc('year', e)]) AS start FROM s),
p AS (SELECT ticker, y, any_value(l) / arg_min(close, date) - 1 AS r FROM w JOIN bars USING (ticker) WHERE b <= start AND date >= start GROUP BY ALL)
SELECT ticker, {', '.join(f"max(r) FILTER (y = {y}) AS return_{f'{y}y' if y else 'ytd'}" for y in (1, 3, 5, 10, 0))} FROM s LEFT JOIN p USING (ticker) GROUP BY ALL""", "return_1y return_3y return_5y return_10y return_ytd")
def period_returns_all(spark, d):  # noqa: ANN001, ANN201
    return returns.period_returns(tables.bars(spark, d), (1, 3, 5, 10), year_to_date=True)
