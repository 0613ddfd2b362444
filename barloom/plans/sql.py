"""DuckDB SQL with the results of the registered queries over the market tables."""

from __future__ import annotations

PRICE_FEATURES = [
    "momentum_5d", "momentum_20d", "return_60d", "return_120d", "mom_12_1_pct", "price_vs_ma50", "price_vs_ma200", "avg_volume_20d_raw", "avg_volume_20d", "rel_volume_ratio",
    "dist_from_52w_high", "dist_from_52w_low", "dist_from_5d_high", "dist_from_20d_high", "overnight_return_5d", "intraday_return_5d", "vol_ratio_10_60", "realized_vol_20d",
    "realized_vol_63d", "bollinger_pct", "price_accel", "vwap_divergence_pct", "volume_trend", "volume_price_div", "cmf_20_ratio", "vol_of_vol_30d", "max_drawdown_60d", "obv_slope_10d",
]
NUDGE = 1.7e-9
OSCILLATORS = ["rsi_14", "rsi_slope_5d", "macd_line_last", "macd_above_zero", "macd_cross", "ema_cross_8_21", "atr_14_pct"]

_BARS = """
t AS (SELECT l_suppkey AS ticker, l_shipdate::DATE AS date, l_extendedprice / l_quantity AS price, l_quantity AS qty, l_extendedprice AS amount, l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
bars AS (SELECT ticker, date, arg_min(price, row(seq, price)) AS open, max(price) AS high, min(price) AS low, arg_max(price, row(seq, price)) AS close, sum(qty) AS volume, sum(amount) / sum(qty) AS vwap
         FROM t GROUP BY ALL)"""
_MARKET = "market AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS spy FROM orders GROUP BY ALL)"
_BY = "PARTITION BY ticker ORDER BY date"


def _full(n: int, agg: str, x: str) -> str:
    w = f"({_BY} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) OVER {w} = {n} THEN {agg}({x}) OVER {w} END"


def _change(x: str, n: int) -> str:
    return f"({x} / nullif(lag({x}, {n}) OVER ({_BY}), 0) - 1)"


_PRICE = f"""{_BARS},
a AS (SELECT *, {_change('close', 5)} AS momentum_5d, {_change('close', 20)} AS momentum_20d, {_change('close', 60)} AS return_60d, {_change('close', 120)} AS return_120d,
 lag(close, 21) OVER ({_BY}) / nullif(lag(close, 252) OVER ({_BY}), 0) - 1 AS mom_12_1_pct,
 close / ({_full(50, 'avg', 'close')}) - 1 AS price_vs_ma50, close / ({_full(200, 'avg', 'close')}) - 1 AS price_vs_ma200,
 {_full(20, 'avg', 'volume')} AS avg_volume_20d_raw, CASE WHEN count(volume) OVER ({_BY}) >= 20 THEN avg(volume) OVER ({_BY}) END AS expanding,
 close / ({_full(252, 'max', 'close')}) - 1 AS dist_from_52w_high, close / ({_full(252, 'min', 'close')}) - 1 AS dist_from_52w_low,
 close / ({_full(5, 'max', 'high')}) - 1 AS dist_from_5d_high, close / ({_full(20, 'max', 'high')}) - 1 AS dist_from_20d_high,
 open / nullif(lag(close) OVER ({_BY}), 0) - 1 AS overnight, close / nullif(open, 0) - 1 AS intraday, ln(close / lag(close) OVER ({_BY})) AS lg, close / nullif(lag(close) OVER ({_BY}), 0) - 1 AS ret,
 close - lag(close) OVER ({_BY}) AS delta, (close - vwap) / nullif(vwap, 0) AS vwap_divergence_pct,
 coalesce(({_full(5, 'avg', 'volume')}) / nullif({_full(20, 'avg', 'volume')}, 0), 1.0) AS volume_trend,
 coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0.0) * volume AS mf, {_full(60, 'max', 'close')} AS peak, {_full(20, 'avg', 'close')} AS mid, {_full(20, 'stddev_samp', 'close')} AS sd FROM bars),
b AS (SELECT *, coalesce(avg_volume_20d_raw / nullif(expanding, 0), CASE WHEN expanding = 0 THEN 1.0 END) AS avg_volume_20d, coalesce(volume / nullif(avg_volume_20d_raw, 0), 1.0) AS rel_volume_ratio,
 {_full(5, 'sum', 'overnight')} AS overnight_return_5d, {_full(5, 'sum', 'intraday')} AS intraday_return_5d,
 coalesce(({_full(10, 'stddev_samp', 'lg')}) / nullif({_full(60, 'stddev_samp', 'lg')}, 0), 1.0) AS vol_ratio_10_60,
 ({_full(20, 'stddev_samp', 'ret')}) * sqrt(252) AS realized_vol_20d, ({_full(63, 'stddev_samp', 'ret')}) * sqrt(252) AS realized_vol_63d,
 coalesce((close - (mid - 2 * sd)) / nullif(4 * sd, 0), 0.5) AS bollinger_pct, momentum_5d - momentum_20d AS price_accel, sign(volume_trend - 1)::DOUBLE * sign(momentum_5d) AS volume_price_div,
 ({_full(20, 'sum', 'mf')}) / nullif({_full(20, 'sum', 'volume')}, 0) AS cmf_20_ratio, sum(coalesce(sign(delta), 0) * volume) OVER ({_BY}) AS obv, close / peak - 1 AS dd FROM a),
price AS (SELECT *, {_full(30, 'stddev_samp', 'realized_vol_20d')} AS vol_of_vol_30d, {_full(60, 'min', 'dd')} AS max_drawdown_60d,
 (({_full(5, 'avg', 'obv')}) - ({_full(20, 'avg', 'obv')})) / nullif(avg_volume_20d_raw, 0) AS obv_slope_10d FROM b)"""


def _ewm(x: str, alpha: float, skip: int) -> str:
    """The decayed running sum; skip: leading nulls of x."""
    i = f"(rn - {1 + skip})"
    return f"CASE WHEN {i} >= 0 THEN power({1 - alpha!r}, {i}) * sum(CASE WHEN {i} = 0 THEN {x} WHEN {i} > 0 THEN {alpha!r} * {x} * power({1 - alpha!r}, -{i}) END) OVER ({_BY}) END"


_OSC = f"""WITH {_BARS},
p AS (SELECT *, row_number() OVER ({_BY}) AS rn, lag(close) OVER ({_BY}) AS pc FROM bars),
q AS (SELECT *, CASE WHEN pc IS NOT NULL THEN greatest(close - pc, 0) END AS up, CASE WHEN pc IS NOT NULL THEN greatest(pc - close, 0) END AS down,
 greatest(high - low, coalesce(abs(high - pc), 0), coalesce(abs(low - pc), 0)) AS tr FROM p),
e AS (SELECT *, {_ewm('up', 1 / 14, 1)} AS gain, {_ewm('down', 1 / 14, 1)} AS loss, {_ewm('close', 2 / 13, 0)} AS e12, {_ewm('close', 2 / 27, 0)} AS e26, {_ewm('close', 2 / 9, 0)} AS e8, {_ewm('close', 2 / 22, 0)} AS e21, {_ewm('tr', 2 / 15, 0)} AS atr FROM q),
m AS (SELECT *, e12 - e26 AS macd, 100 - 100 / (1 + gain / nullif(loss, 0)) AS rsi_14 FROM e),
s AS (SELECT *, macd - {_ewm('macd', 2 / 10, 0)} AS hist FROM m),
x AS (SELECT *, CASE WHEN hist > 0 AND lag(hist) OVER ({_BY}) <= 0 THEN 1.0 WHEN hist < 0 AND lag(hist) OVER ({_BY}) >= 0 THEN -1.0 END AS crs FROM s)
SELECT ticker, date, rsi_14, (rsi_14 - lag(rsi_14, 5) OVER ({_BY})) / 5 AS rsi_slope_5d, macd AS macd_line_last, (macd > 0)::DOUBLE AS macd_above_zero,
 coalesce(crs, lag(crs, 1) OVER ({_BY}), lag(crs, 2) OVER ({_BY}), 0)::DOUBLE AS macd_cross, e8 / nullif(e21, 0) - 1 AS ema_cross_8_21, atr / nullif(close, 0) AS atr_14_pct FROM x"""

_W60 = f"({_BY} ROWS 59 PRECEDING)"
_MKT = f"""WITH {_BARS}, {_MARKET},
j AS (SELECT bars.*, spy FROM bars LEFT JOIN market USING (date)),
r AS (SELECT *, ln(close / lag(close) OVER ({_BY})) AS r, ln(spy / lag(spy) OVER ({_BY})) AS m, {_change('close', 5)} - {_change('spy', 5)} AS return_vs_spy_5d FROM j),
b AS (SELECT *, CASE WHEN count(r + m) OVER {_W60} = 60 THEN covar_samp(r, m) OVER {_W60} / nullif(var_samp(m) OVER {_W60}, 0) END AS beta_60d FROM r),
e AS (SELECT *, r - beta_60d * m AS e FROM b),
v AS (SELECT *, ({_full(60, 'stddev_samp', 'e')}) * sqrt(252) AS idio_vol_60d, {_full(231, 'sum', 'e')} AS s, {_full(20, 'stddev_samp', 'e')} AS v FROM e)
SELECT ticker, date, return_vs_spy_5d, beta_60d, idio_vol_60d, lag(s, 21) OVER ({_BY}) / nullif(v * sqrt(231), 0) AS residual_momentum_ratio FROM v"""

_LONG = f"""WITH {_PRICE},
long AS (SELECT ticker, date, ret, factor, loading FROM (SELECT ticker, date, ret, unnest(['momentum_20d', 'price_vs_ma50', 'realized_vol_20d']) AS factor, unnest([momentum_20d, price_vs_ma50, realized_vol_20d]) AS loading FROM price))"""
_FACTOR = f"""{_LONG},
l AS (SELECT *, lag(loading) OVER (PARTITION BY factor, ticker ORDER BY date) AS l FROM long),
k AS (SELECT *, count(*) OVER (PARTITION BY factor, date) AS n, row_number() OVER (PARTITION BY factor, date ORDER BY l, ticker) AS rn FROM l WHERE l IS NOT NULL AND ret IS NOT NULL),
f AS (SELECT factor, date, avg(ret) FILTER (rn > n - greatest(round_even(n * 0.3, 0), 1)) - avg(ret) FILTER (rn <= greatest(round_even(n * 0.3, 0), 1)) AS factor_return, max(n) AS names FROM k WHERE n >= 5 GROUP BY ALL)"""

_CLOSES = "closes AS (SELECT user_id % 500 AS ticker, ts::DATE AS date, event_type AS source, arg_max(value, event_id) AS close, max(event_id) AS run FROM events GROUP BY ALL)"
_PRIO = "CASE WHEN close IS NULL THEN -1 WHEN source IN ('click', 'purchase') THEN 3 WHEN source IN ('view', 'signup') THEN 1 ELSE 0 END"
_CAL = "cal AS (SELECT date, row_number() OVER (ORDER BY date) AS session FROM (SELECT DISTINCT date FROM bars))"
_SPLITS = "splits AS (SELECT s_suppkey AS ticker, (date '1994-01-01' + (s_suppkey % 50 * 10 + k * 400)::INT) AS ex_date, 1.0::DOUBLE AS split_from, (k + s_suppkey % 3)::DOUBLE AS split_to FROM supplier, unnest([1, 2]) u(k) WHERE s_suppkey % 7 = 0)"
_DIVS = "divs AS (SELECT s_suppkey AS ticker, (date '1993-01-01' + (s_suppkey % 30 + k * 180)::INT) AS ex_date, k * 3.0::DOUBLE AS cash FROM supplier, unnest(range(1, 7)) u(k) WHERE s_suppkey % 5 = 0)"
_FWD = f"""WITH {_BARS}, {_MARKET}, {_CAL},
p AS (SELECT ticker, date, close, session FROM bars JOIN cal USING (date)), mk AS (SELECT session, spy FROM market JOIN cal USING (date)),
fwd AS (SELECT a.ticker, a.date, h AS horizon, b.close / a.close - 1 AS ret, ln(b.close / a.close) AS log_ret, m1.spy / m0.spy - 1 AS spy_ret, ln(m1.spy / m0.spy) AS log_spy, a.close AS c0
 FROM p a CROSS JOIN unnest([1, 3, 5, 10, 21]) u(h) JOIN p b ON b.ticker = a.ticker AND b.session = a.session + h LEFT JOIN mk m0 ON m0.session = a.session LEFT JOIN mk m1 ON m1.session = a.session + h)"""
_ROST = "rosters AS (SELECT DISTINCT date_trunc('quarter', l_shipdate)::DATE AS date, l_partkey AS ticker FROM lineitem)"
_CHG = f"""{_ROST}, rc AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM rosters)),
changes AS (SELECT c.date, x.ticker, CASE WHEN r.ticker IS NULL THEN 'REMOVED' ELSE 'ADDED' END AS action FROM (SELECT DISTINCT ticker FROM rosters) x CROSS JOIN rc c LEFT JOIN rosters r ON r.ticker = x.ticker AND r.date = c.date
 LEFT JOIN (SELECT n + 1 AS n, rosters.ticker FROM rosters JOIN rc USING (date)) b ON b.ticker = x.ticker AND b.n = c.n WHERE c.n > 1 AND (r.ticker IS NULL) <> (b.ticker IS NULL))"""
_HOLD = "h AS (SELECT strftime(l_shipdate, '%Y') AS quarter, l_partkey % 100 AS ticker, l_suppkey AS filer, sum(l_quantity) AS shares, sum(l_extendedprice) AS value FROM lineitem GROUP BY ALL)"
_TITLE = "trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"

_SQL = {
    "bars": f"WITH {_BARS} SELECT * FROM bars",
    "price_features": f"WITH {_PRICE} SELECT ticker, date, {', '.join(PRICE_FEATURES)} FROM price",
    "oscillators": _OSC,
    "market_features": _MKT,
    "latest_technicals": f"WITH {_PRICE} SELECT ticker, date, momentum_20d, price_vs_ma50, max_drawdown_60d FROM price QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1",
    "dispersion": f"WITH {_BARS}, r AS (SELECT date, {_change('close', 1)} AS r FROM bars) SELECT date, stddev_samp(r) AS xsect_dispersion, count(r) AS names FROM r GROUP BY ALL",
    "admitted_universe": f"WITH {_BARS}, k AS (SELECT ticker, date FROM bars QUALIFY count(*) OVER (PARTITION BY ticker) >= 480 AND row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 400) SELECT ticker, count(*) AS rows, min(date) AS first_date FROM k GROUP BY ALL",
    "robust_zscores": f"""{_LONG}, md AS (SELECT factor, date, median(loading) AS med, count(loading) AS n FROM long GROUP BY ALL), lm AS (SELECT long.*, med, n FROM long JOIN md USING (factor, date)),
 ms AS (SELECT factor, date, median(abs(loading - med)) * 1.4826 AS mad FROM lm GROUP BY ALL), w AS (SELECT lm.*, mad, CASE WHEN loading IS NOT NULL THEN least(greatest(loading, med - 3 * mad), med + 3 * mad) END AS w FROM lm JOIN ms USING (factor, date)),
 z AS (SELECT *, avg(w) OVER (PARTITION BY factor, date) AS mu, stddev_pop(w) OVER (PARTITION BY factor, date) AS sd FROM w) SELECT ticker, date, factor, CASE WHEN n >= 2 AND mad > 0 AND sd > 0 THEN (w - mu) / sd END AS z FROM z""",
    "plain_zscores": f"WITH {_PRICE} SELECT ticker, date, CASE WHEN stddev_samp(momentum_20d) OVER (PARTITION BY date) > 1e-9 THEN (momentum_20d - avg(momentum_20d) OVER (PARTITION BY date)) / stddev_samp(momentum_20d) OVER (PARTITION BY date) END AS z FROM price",
    "factor_returns": f"{_FACTOR} SELECT factor, date, factor_return, names FROM f",
    "factor_momentum_ratio": f"""{_FACTOR}, s AS (SELECT *, CASE WHEN count(factor_return) OVER w = 60 THEN sum(factor_return) OVER w END AS s FROM f WINDOW w AS (PARTITION BY factor ORDER BY date ROWS 59 PRECEDING)),
 mo AS (SELECT factor, date, lag(s, 5) OVER (PARTITION BY factor ORDER BY date) AS mom FROM s),
 z AS (SELECT *, CASE WHEN stddev_samp(loading) OVER w > 1e-9 THEN (loading - avg(loading) OVER w) / stddev_samp(loading) OVER w END AS z FROM long WINDOW w AS (PARTITION BY factor, date))
 SELECT ticker, date, avg(z * mom) AS factor_momentum_ratio FROM z JOIN mo USING (factor, date) GROUP BY ALL""",
    "breadth": f"WITH {_PRICE} SELECT date, avg((price_vs_ma50 > 0)::DOUBLE) AS pct_above_50, avg((price_vs_ma200 > 0)::DOUBLE) AS pct_above_200, sum((momentum_5d > 0)::INT)::BIGINT AS advancing, sum((momentum_5d < 0)::INT)::BIGINT AS declining, count(*) AS names FROM price GROUP BY ALL",
    "sector_medians": "SELECT p_brand, median(p_retailprice) FILTER (p_retailprice > 0) AS median_p_retailprice, count(*) FILTER (p_retailprice > 0) AS n_p_retailprice, median(p_size) FILTER (p_size > 0) AS median_p_size, count(*) FILTER (p_size > 0) AS n_p_size FROM part GROUP BY ALL",
    "dead_columns": """WITH l AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'nothing', 'same']) AS "column", unnest([l_quantity, l_discount, l_tax, NULL, 1.0]) AS x FROM lineitem)
 SELECT "column", count(x) AS n, count(x) = 0 AS all_null, coalesce(count(x) >= 20 AND stddev_pop(x) = 0, false) AS zero_variance FROM l GROUP BY ALL""",
    "modal_share": "WITH l AS (SELECT unnest(['l_returnflag', 'l_linestatus', 'l_linenumber']) AS field, unnest([l_returnflag, l_linestatus, l_linenumber::VARCHAR]) AS v FROM lineitem), c AS (SELECT field, v, count(*) AS c FROM l WHERE v IS NOT NULL GROUP BY ALL) SELECT field, sum(c)::BIGINT AS n, max(c) / sum(c) AS modal_share FROM c GROUP BY ALL",
    "source_coverage": "SELECT event_type, count(*) AS n, avg((value > 20)::DOUBLE) AS ok_ratio, avg((value > 20)::DOUBLE) >= 0.8 AS ok FROM events GROUP BY ALL",
    "authority_merge": f"""WITH {_CLOSES}, n AS (SELECT * REPLACE (CASE WHEN source <> 'error' THEN close END AS close), 1 AS is_new FROM closes WHERE source IN ('click', 'view', 'error') QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY run DESC) = 1),
 o AS (SELECT *, 0 AS is_new FROM closes WHERE source IN ('signup', 'purchase') QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY run DESC) = 1), u AS (SELECT *, {_PRIO} AS p FROM (SELECT * FROM n UNION ALL SELECT * FROM o)),
 b AS (SELECT *, max(p) FILTER (is_new = 1) OVER w AS bn, max(p) FILTER (is_new = 0) OVER w AS bo FROM u WINDOW w AS (PARTITION BY ticker, date))
 SELECT ticker, date, source, close, CASE WHEN bo IS NULL THEN 'new' WHEN bn IS NULL THEN 'retained' WHEN bn < bo THEN 'downgrade_blocked' ELSE 'overwritten' END AS status FROM b QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY p DESC, is_new DESC) = 1""",
    "delta_upsert": f"WITH {_BARS} SELECT ticker, date, CASE WHEN ticker % 3 = 0 THEN close * 2 ELSE close END AS close FROM bars",
    "freshness": f"WITH {_BARS}, {_CAL} SELECT ticker, max(date) AS last_date, ((SELECT max(session) FROM cal) - max(session))::INT AS age, (SELECT max(session) FROM cal) - max(session) > 3 AS stale FROM bars JOIN cal USING (date) GROUP BY ticker",
    "missing_sessions": f"WITH {_BARS}, {_CAL} SELECT ticker, count(*) AS have, max(session) - min(session) + 1 - count(*) AS missing FROM bars JOIN cal USING (date) WHERE date >= date '1995-01-01' GROUP BY ticker",
    "ingestion_watermarks": """WITH e AS (SELECT *, ts::DATE AS day FROM events), m AS (SELECT event_type, min(day) AS mark FROM e WHERE event_type <> 'error' AND value < 50 GROUP BY ALL)
 SELECT event_type, count(*) AS outstanding, least(30, coalesce(floor(date_diff('day', max(mark), max(day)) * 1.1::DOUBLE) + 1, 30))::INT AS lookback_days FROM e LEFT JOIN m USING (event_type) WHERE mark IS NULL OR day > mark GROUP BY event_type""",
    "row_gate": f"""WITH {_BARS}, g AS (SELECT *, lag(close) OVER ({_BY}) AS pc, quantile_cont(CASE WHEN volume > 0 THEN volume END, 0.5) OVER ({_BY} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS med FROM bars),
 f AS (SELECT ticker, date, concat_ws(',', CASE WHEN high < low THEN 'high_below_low' END, CASE WHEN close > high OR close < low THEN 'close_out_of_range' END, CASE WHEN close <= 0 THEN 'nonpositive_close' END, CASE WHEN volume < 0 THEN 'negative_volume' END) AS blocking,
 concat_ws(',', CASE WHEN abs(close / pc - 1) > 0.3 THEN 'large_move' END, CASE WHEN volume = 0 THEN 'zero_volume' END, CASE WHEN volume > 3.0 * med THEN 'volume_spike' END) AS warnings FROM g) SELECT *, blocking <> '' AS blocked FROM f""",
    "series_gate": f"""WITH {_BARS}, g AS (SELECT *, coalesce(abs(close / lag(close) OVER ({_BY}) - 1) > 0.5, false) AS big, coalesce(date_diff('day', lag(date) OVER ({_BY}), date) > 5, false) AS gap FROM bars)
 SELECT ticker, count(*) AS bars, sum((high < low)::INT)::BIGINT AS bad_range, sum((close <= 0)::INT)::BIGINT AS nonpositive, sum(big::INT)::BIGINT AS large_moves, coalesce(array_to_string(list_sort(list(strftime(date, '%Y-%m-%d')) FILTER (big))[1:5], ','), '') AS first_moves,
 sum((volume = 0)::INT)::BIGINT AS zero_volume, sum(gap::INT)::BIGINT AS gaps FROM g GROUP BY ticker""",
    "source_agreement": f"""WITH {_CLOSES}, g AS (SELECT ticker, date, count(*) FILTER (close > 0) AS sources, min(close) FILTER (close > 0) AS lo, max(close) FILTER (close > 0) AS hi, avg(close) FILTER (close > 0) AS mean FROM closes GROUP BY ALL),
 s AS (SELECT *, (hi - lo) / lo * 1e4 AS spread_bps FROM g) SELECT ticker, date, sources, spread_bps, CASE WHEN sources = 0 THEN 'no_data' WHEN sources = 1 THEN 'provisional' WHEN spread_bps <= 2000 THEN 'agreed' ELSE 'quarantine' END AS status, CASE WHEN sources = 1 OR spread_bps <= 2000 THEN mean END AS value FROM s""",
    "field_gate": """WITH l AS (SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount']) AS field, unnest([l_quantity, l_discount]) AS x, unnest([2, 0.01]) AS lo, unnest([48, 0.09]) AS hi FROM lineitem)
 SELECT l_orderkey, l_linenumber, field, x, CASE WHEN x < lo THEN 'below' ELSE 'above' END AS violation FROM l WHERE x < lo OR x > hi""",
    "universe_drift": """WITH a AS (SELECT DISTINCT l_partkey AS ticker FROM lineitem WHERE year(l_shipdate) <= 1994), b AS (SELECT DISTINCT l_partkey AS ticker FROM lineitem WHERE year(l_shipdate) >= 1995)
 SELECT ticker, 'missing' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT ticker, 'extra' FROM (FROM b EXCEPT FROM a)""",
    "quote_sanity": f"WITH {_BARS}, p AS (SELECT *, lag(close) OVER ({_BY}) AS p FROM bars) SELECT ticker, date, abs(open / p - 1) > 0.4 AS jumped, close / p < 0.5 OR close / p > 2.0 AS off_scale FROM p",
    "split_restatement": f"""WITH {_BARS}, {_SPLITS}, f AS (SELECT b.ticker, b.date, coalesce(product(split_from / split_to), 1.0) AS f FROM bars b LEFT JOIN splits s ON s.ticker = b.ticker AND s.ex_date > b.date GROUP BY ALL)
 SELECT ticker, date, open * f AS open, close * f AS close, round_even(volume / f, 0) AS volume, f AS split_factor FROM bars JOIN f USING (ticker, date)""",
    "total_return": f"""WITH {_BARS}, {_DIVS}, d AS (SELECT ticker, ex_date, sum(cash) AS cash FROM divs GROUP BY ALL), p AS (SELECT d.ticker, d.ex_date, d.cash, max(b.date) AS date FROM d JOIN bars b ON b.ticker = d.ticker AND b.date < d.ex_date GROUP BY ALL),
 c AS (SELECT p.ticker, p.date, 1 - sum(cash) / any_value(close) AS f FROM p JOIN bars USING (ticker, date) GROUP BY ALL HAVING sum(cash) < any_value(close))
 SELECT ticker, date, close, close * product(coalesce(f, 1.0)) OVER ({_BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS total_return_close FROM bars LEFT JOIN c USING (ticker, date)""",
    "split_evidence": f"""WITH {_BARS}, {_SPLITS}, m AS (SELECT ticker, date, close / lag(close) OVER ({_BY}) AS move FROM bars), s AS (SELECT *, split_from / split_to AS f FROM splits),
 g AS (SELECT s.ticker, s.ex_date, f, count(move) AS n, coalesce(bool_or(abs(move / f - 1) <= 0.15), false) AS d, coalesce(bool_or(abs(move * f - 1) <= 0.15), false) AND NOT f BETWEEN 1 / 1.45 AND 1.45 AS i FROM s LEFT JOIN m ON m.ticker = s.ticker AND move IS NOT NULL AND abs(date_diff('day', m.date, s.ex_date)) <= 4 GROUP BY s.ticker, s.ex_date, f)
 SELECT ticker, ex_date, f AS factor, n AS moves, CASE WHEN n = 0 THEN 'uncovered' WHEN d AND i THEN 'ambiguous' WHEN d THEN 'direct' WHEN i THEN 'inverse' ELSE 'none' END AS evidence FROM g""",
    "residual_jumps": f"""WITH {_BARS}, {_SPLITS}, m AS (SELECT ticker, date, close / lag(close) OVER ({_BY}) AS move FROM bars)
 SELECT m.ticker, m.date, move, min(ex_date) AS explained_by, CASE WHEN min(ex_date) IS NOT NULL THEN 'missed' ELSE 'suspected' END AS kind FROM m LEFT JOIN splits s ON s.ticker = m.ticker AND abs(date_diff('day', m.date, s.ex_date)) <= 4 AND (abs(move / (split_from / split_to) - 1) <= 0.15 OR abs(move * (split_from / split_to) - 1) <= 0.15)
 WHERE abs(move - 1) > 0.18 GROUP BY ALL""",
    "splice_guard": f"WITH {_BARS}, r AS (SELECT ticker, date, close / lag(close) OVER ({_BY}) AS ratio FROM bars), b AS (SELECT *, greatest(ratio, 1 / ratio) AS big FROM r) SELECT ticker, date, ratio, CASE WHEN ratio IS NULL OR big <= 1.5 THEN 'ok' WHEN abs(big / round_even(big, 0) - 1) <= 0.005 AND round_even(big, 0) BETWEEN 2 AND 50 THEN 'split_like' ELSE 'refused' END AS verdict FROM b",
    "action_ids": f"WITH {_SPLITS} SELECT ticker, ex_date, sha256(concat_ws('|', 'split', ticker, ex_date, split_from::INT, split_to::INT, '')) AS action_id FROM splits",
    "forward_returns": f"{_FWD} SELECT ticker, date, horizon, ret, log_ret, spy_ret, log_spy, ret > spy_ret AS beat_spy FROM fwd",
    "outcome_hit_rates": f"""{_FWD}, s AS (SELECT horizon, CASE WHEN bars.close > open THEN 'UP' WHEN bars.close < open THEN 'DOWN' ELSE 'FLAT' END AS label, log_ret - coalesce(log_spy, 0) AS a FROM fwd JOIN bars USING (ticker, date)),
 c AS (SELECT *, CASE label WHEN 'UP' THEN a > 0 WHEN 'DOWN' THEN a < 0 END AS ok FROM s) SELECT horizon, label, count(*) AS n, count(ok) AS graded, avg(ok::DOUBLE) AS hit_rate, avg(a) AS mean_alpha FROM c GROUP BY ALL""",
    "risk_stats": f"""WITH {_BARS}, r AS (SELECT *, close / lag(close) OVER ({_BY}) - 1 AS r, max(close) OVER ({_BY}) AS peak FROM bars), g AS (SELECT ticker, count(r) AS n, avg(r) AS mu, stddev_samp(r) AS sd, sqrt(avg(CASE WHEN r IS NOT NULL THEN power(least(r, 0), 2) END)) AS down, min(close / peak - 1) AS max_drawdown FROM r GROUP BY ALL)
 SELECT ticker, n, sd * sqrt(252) AS volatility, mu / sd * sqrt(252) AS sharpe, mu / nullif(down, 0) * sqrt(252) AS sortino, max_drawdown FROM g WHERE n >= 60""",
    "market_beta": f"""WITH {_BARS}, {_MARKET}, j AS (SELECT ticker, date, close, spy FROM bars JOIN market USING (date)), r AS (SELECT *, close / lag(close) OVER ({_BY}) - 1 AS r, spy / lag(spy) OVER ({_BY}) - 1 AS m FROM j)
 SELECT ticker, count(r) AS n, covar_pop(r, m) / var_pop(m) AS beta, (arg_max(close, date) / arg_min(close, date) - 1) - (arg_max(spy, date) / arg_min(spy, date) - 1) AS excess_return FROM r GROUP BY ALL""",
    "period_returns": f"""WITH {_BARS}, s AS (SELECT ticker, min(date) AS b, max(date) AS e, arg_max(close, date) AS l FROM bars GROUP BY ALL),
 p AS (SELECT s.ticker, y, arg_min(close, date) AS c FROM s CROSS JOIN unnest([1, 3, 5]) u(y) JOIN bars USING (ticker) WHERE date >= e - to_years(y) AND b <= e - to_years(y) GROUP BY ALL)
 SELECT ticker, max(l / c - 1) FILTER (y = 1) AS return_1y, max(l / c - 1) FILTER (y = 3) AS return_3y, max(l / c - 1) FILTER (y = 5) AS return_5y FROM s LEFT JOIN p USING (ticker) GROUP BY ALL""",
    "roster_changes": f"WITH {_CHG} SELECT date, ticker, action FROM changes",
    "point_in_time_membership": f"""WITH {_CHG}, ask AS (SELECT DISTINCT date FROM rosters)
 SELECT a.date, x.ticker FROM ask a CROSS JOIN (SELECT DISTINCT ticker FROM rosters) x LEFT JOIN rosters nw ON nw.ticker = x.ticker AND nw.date = (SELECT max(date) FROM rosters)
 LEFT JOIN LATERAL (SELECT arg_min(action, c.date) AS act FROM changes c WHERE c.ticker = x.ticker AND c.date >= a.date) n ON true WHERE CASE n.act WHEN 'REMOVED' THEN true WHEN 'ADDED' THEN false ELSE nw.ticker IS NOT NULL END""",
    "membership_windows": f"WITH {_ROST} SELECT ticker, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS dates FROM rosters GROUP BY ALL",
    "ownership": f"""WITH {_HOLD}, r AS (SELECT *, row_number() OVER (PARTITION BY quarter, ticker ORDER BY shares DESC, filer) AS rn FROM h)
 SELECT quarter, ticker, count(DISTINCT filer) AS holders, sum(shares) AS shares, sum(value) AS value, CASE WHEN count(DISTINCT filer) >= 5 THEN sum(shares) FILTER (rn <= 5) / nullif(sum(shares), 0) END AS top_share FROM r GROUP BY ALL""",
    "ownership_deltas": f"""WITH {_HOLD}, n AS (SELECT ticker, filer, shares AS now FROM h WHERE quarter = '1996'), b AS (SELECT ticker, filer, shares AS before FROM h WHERE quarter = '1995')
 SELECT ticker, filer, now, before, CASE WHEN before IS NULL THEN 'new' WHEN now IS NULL THEN 'exited' WHEN now > before THEN 'increased' WHEN now < before THEN 'decreased' ELSE 'unchanged' END AS status, coalesce(now, 0) - coalesce(before, 0) AS delta FROM n FULL JOIN b USING (ticker, filer)""",
    "article_dedupe": f"""WITH a AS (SELECT *, split_part(text, chr(10), 1) AS title, 'http://x/' || (doc_id % 40) || '?r=' || doc_id AS url, timestamp '2024-01-01' + to_days((doc_id % 30)::INT) AS ts, CASE source WHEN 'src0' THEN 0.9 WHEN 'src1' THEN 0.8 WHEN 'src2' THEN 0.7 ELSE 0.5 END::DOUBLE AS w FROM documents),
 f AS (SELECT *, sha1({_TITLE} || '|' || sha1(regexp_replace(lower(url), '[?#].*$', ''))) AS fingerprint FROM a),
 tk AS (SELECT fingerprint, string_agg(t::VARCHAR, ',' ORDER BY t) AS tickers FROM (SELECT DISTINCT fingerprint, unnest([doc_id % 50, doc_id % 7]) AS t FROM f) GROUP BY ALL)
 SELECT fingerprint, any_value(tickers) AS tickers, md5(string_agg(coalesce(source, '') || ' ' || url, '; ' ORDER BY source NULLS FIRST, url)) AS records, arg_max(title, row(length(title), title)) AS title, arg_max(url, row(w, url)) AS url, min(ts) AS published_at, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS variants, max(w) AS trust FROM f JOIN tk USING (fingerprint) GROUP BY fingerprint""",
    "article_chunks": r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') AS w FROM documents)
 SELECT doc_id, (s // 269)::INT AS chunk, md5(array_to_string(w[s + 1 : s + 307], ' ')) AS body_md5 FROM w, unnest(range(0, len(w), 269)) u(s) WHERE len(w) > 0""",
    "transcript_sections": "WITH s AS (SELECT *, CASE WHEN sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) >= 2 THEN 'q_and_a' ELSE 'remarks' END AS section FROM conversations) SELECT conv_id, section, count(*) AS turns, sum(length(text))::BIGINT AS chars, min(turn) AS first_turn FROM s GROUP BY ALL",
    "vector_centroids": """WITH e AS (SELECT label, vec_id % 2 AS half, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), g AS (SELECT label, half, grouping(half)::TINYINT AS all_half, pos, avg(x) AS m, count(*) AS n FROM e GROUP BY GROUPING SETS ((label, half, pos), (label, pos)))
 SELECT label, half, all_half, max(n) AS n, max(m) FILTER (pos = 1) AS "first", sum(m) AS total FROM g GROUP BY label, half, all_half""",
    "centroid_drift": """WITH e AS (SELECT label, vec_id % 4 AS part, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), g AS (SELECT label, part, pos, avg(x) AS m FROM e GROUP BY ALL),
 j AS (SELECT a.label, a.part, a.m AS x, b.m AS y, row_number() OVER () AS r FROM g a JOIN (SELECT *, lead(part) OVER (PARTITION BY label, pos ORDER BY part) AS nxt FROM g) b ON a.label = b.label AND a.pos = b.pos AND a.part = b.nxt), c AS (SELECT label, part, sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) AS similarity FROM j GROUP BY ALL)
 SELECT label, part, similarity, 1 - similarity AS change, 1 - similarity < 0.05 AS lazy FROM c""",
    "corpus_manifest": "SELECT source, count(*) AS docs, sum(n_chars)::BIGINT AS total, quantile_disc(n_chars, 0.25) AS q1, quantile_disc(n_chars, 0.5) AS q2, quantile_disc(n_chars, 0.75) AS q3 FROM documents GROUP BY ALL",
}


def oracle_sql(digits: int) -> dict[str, str]:
    """The statements with their doubles rounded as the queries round theirs."""
    return {k: f"SELECT * REPLACE ({', '.join(f'round({c} + {NUDGE!r}::DOUBLE, {digits}) + 0.0 AS {c}' for c in DOUBLES[k])}) FROM ({v})" if DOUBLES.get(k) else v for k, v in _SQL.items()}


#: Result columns of type double.
DOUBLES = {
    "bars": ["open", "high", "low", "close", "volume", "vwap"],
    "price_features": PRICE_FEATURES,
    "oscillators": OSCILLATORS,
    "market_features": ["return_vs_spy_5d", "beta_60d", "idio_vol_60d", "residual_momentum_ratio"],
    "latest_technicals": ["momentum_20d", "price_vs_ma50", "max_drawdown_60d"],
    "dispersion": ["xsect_dispersion"],
    "robust_zscores": ["z"],
    "plain_zscores": ["z"],
    "factor_returns": ["factor_return"],
    "factor_momentum_ratio": ["factor_momentum_ratio"],
    "breadth": ["pct_above_50", "pct_above_200"],
    "sector_medians": ["median_p_retailprice", "median_p_size"],
    "modal_share": ["modal_share"],
    "source_coverage": ["ok_ratio"],
    "authority_merge": ["close"],
    "delta_upsert": ["close"],
    "source_agreement": ["spread_bps", "value"],
    "field_gate": ["x"],
    "split_restatement": ["open", "close", "volume", "split_factor"],
    "total_return": ["close", "total_return_close"],
    "split_evidence": ["factor"],
    "residual_jumps": ["move"],
    "splice_guard": ["ratio"],
    "forward_returns": ["ret", "log_ret", "spy_ret", "log_spy"],
    "outcome_hit_rates": ["hit_rate", "mean_alpha"],
    "risk_stats": ["volatility", "sharpe", "sortino", "max_drawdown"],
    "market_beta": ["beta", "excess_return"],
    "period_returns": ["return_1y", "return_3y", "return_5y"],
    "ownership": ["shares", "value", "top_share"],
    "ownership_deltas": ["now", "before", "delta"],
    "article_dedupe": ["trust"],
    "vector_centroids": ['"first"', "total"],
    "centroid_drift": ["similarity", "change"],
}
