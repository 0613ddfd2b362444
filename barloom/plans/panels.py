"""Registered queries over panels of features, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import cross_section, documents, gates, macro, panels, payloads, reconcile, technicals, tracking
from barloom.plans import series, sql
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()
_BARS, _MARKET, _BY = sql._BARS, sql._MARKET, sql._BY
_OSC = sql._OSC.removeprefix("WITH ")
_OSC_CTES, _OSC_SELECT = _OSC[: _OSC.rindex("SELECT ticker, date, rsi_14")].rstrip(), _OSC[_OSC.rindex("SELECT ticker, date, rsi_14") :]
_OSC_TABLE = f"{_OSC_CTES}, osc AS ({_OSC_SELECT})"
_KEYS = sorted({k for keys, *_ in panels.FUNDAMENTALS.values() for k in keys})
_FIELDS = list(panels.FUNDAMENTALS)


def _metric(n: int) -> tuple[str, str]:
    """A provider key's column over `part`, as (Spark, DuckDB) SQL: missing for some parts, of either sign."""
    x = f"CASE WHEN (p_partkey + {n}) % {2 + n % 4} > 0 THEN (p_partkey * {n + 3} % 997 - 200) / {1 + n % 3} END"
    return f"cast({x} AS double)", f"({x})::DOUBLE"


def _metrics(spark, d, step=None):  # noqa: ANN001, ANN202
    """Parts stand for tickers; with `step` dealt by ticker over partitions of so many bytes, for those who make many rows of one."""
    p = tables.dealt(spark, d, "part", "p_partkey", step) if step else tables.read(spark, d, "part")
    return p.select(F.col("p_partkey").alias("ticker"), *[F.expr(_metric(n)[0]).alias(k) for n, k in enumerate(_KEYS) if k != "capexCagr5Y"])


def _field_sql(f: str) -> str:
    keys, unit, lo, hi = panels.FUNDAMENTALS[f]
    x = f"coalesce({', '.join(f'"{k}"' for k in keys)}, 0)"
    if f == "fcf_yield":
        x = f"CASE WHEN {x} > 0 THEN 1 / {x} ELSE 0 END"
    return f"CASE WHEN {x} > 0 THEN {x} ELSE 0 END AS {f}" if f == "market_cap_raw" else f"least(greatest({x} / {unit}, {lo}), {hi}) AS {f}"


def _absent_sql() -> str:
    gone = [f"""CASE WHEN coalesce({', '.join(f'"{k}"' for k in panels.FUNDAMENTALS[f][0])}) IS NULL THEN '{f}' END""" for f in _FIELDS]
    return f"array_to_string(list_sort(list_filter([{', '.join(gone)}], lambda x: x IS NOT NULL)), ',') AS absent"


_FUND = f"""metrics AS (SELECT p_partkey AS ticker, {', '.join(f'{_metric(n)[1] if k != "capexCagr5Y" else "NULL::DOUBLE"} AS "{k}"' for n, k in enumerate(_KEYS))} FROM part), fund AS (SELECT ticker, {', '.join(map(_field_sql, _FIELDS))}, {_absent_sql()} FROM metrics)"""


@R.query(f"WITH {_FUND} SELECT * FROM fund", " ".join(_FIELDS))
def fundamentals_all(spark, d):  # noqa: ANN001, ANN201
    return panels.fundamentals(_metrics(spark, d)).withColumn("absent", F.array_join("absent", ","))


@R.query(f"WITH {_BARS}, {_FUND} SELECT ticker, date, {', '.join(f'coalesce({f}, 0) AS {f}' for f in _FIELDS)} FROM bars LEFT JOIN fund USING (ticker) WHERE date >= DATE '1998-01-01'", " ".join(_FIELDS))
def fundamental_panel(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).where("date >= date'1998-01-01'").select("ticker", "date")
    return panels.with_fundamentals(b, panels.fundamentals(_metrics(spark, d)).where("ticker % 7 > -1"))


@R.query(f"""WITH {_FUND}, l AS (SELECT ticker, unnest({[f for f, _, _ in panels.FUNDAMENTAL_SPECS]}) AS field, unnest([{', '.join(f for f, _, _ in panels.FUNDAMENTAL_SPECS)}]) * 1.2 AS x, unnest({[lo for _, lo, _ in panels.FUNDAMENTAL_SPECS]}) AS lo, unnest({[hi for _, _, hi in panels.FUNDAMENTAL_SPECS]}) AS hi FROM fund)
SELECT ticker, field, x, CASE WHEN x < lo THEN 'below' ELSE 'above' END AS violation FROM l WHERE x < lo OR x > hi""", "x")
def fundamental_gate(spark, d):  # noqa: ANN001, ANN201
    f = panels.fundamentals(_metrics(spark, d))
    wide = f.select("ticker", *[(F.col(c) * 1.2).alias(c) for c, _, _ in panels.FUNDAMENTAL_SPECS])
    return gates.field_gate(wide, ["ticker"], panels.FUNDAMENTAL_SPECS)


_ALT = """k AS (SELECT user_id AS ticker, arg_max(value, row(ts, event_id)) AS v, arg_max((props->>'k')::INT, row(ts, event_id)) AS k FROM events GROUP BY ALL),
alt AS (SELECT ticker, CASE WHEN k % 3 > 0 THEN v END AS surprise_pct, CASE WHEN k % 2 > 0 THEN k END AS days, k / 50.0 AS rev, k % 4 AS streak, CASE WHEN k % 5 > 0 THEN v / 30 END AS pcr, CASE WHEN k % 7 > 0 THEN k / 100.0 END AS ivr, CASE WHEN k % 6 > 0 THEN k / 80.0 END AS atm,
 k % 10 > 1 AS he, k % 10 > 2 AS hr, k % 10 > 3 AS ho FROM k)"""


@R.query(f"""WITH {sql._PRICE}, {_ALT}, rv AS (SELECT ticker, (max_by(struct_pack(v := realized_vol_20d), date)).v AS rv FROM price GROUP BY ticker)
SELECT p.ticker, p.date, CASE WHEN he THEN coalesce(surprise_pct, 0) ELSE 0 END AS earnings_surprise_pct, CASE WHEN he THEN coalesce(days, 90) / 90.0 ELSE 1 END AS days_since_earnings, CASE WHEN hr THEN coalesce(rev, 0) ELSE 0 END AS eps_revision_4w,
 CASE WHEN hr THEN streak ELSE 0 END::DOUBLE AS revision_streak, CASE WHEN ho THEN coalesce(pcr, 0) ELSE 0 END AS put_call_ratio, CASE WHEN ho THEN coalesce(ivr, 0.5) ELSE 0.5 END AS iv_rank, CASE WHEN ho AND rv > 0 AND atm > 0 THEN atm / rv ELSE 1 END AS iv_vs_rv
FROM price p LEFT JOIN alt USING (ticker) JOIN rv USING (ticker) WHERE p.date >= DATE '1998-01-01' OR true""", "earnings_surprise_pct days_since_earnings eps_revision_4w revision_streak put_call_ratio iv_rank iv_vs_rv")
def alternative_panel(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").select(F.col("user_id").alias("ticker"), "ts", "event_id", F.col("value").alias("v"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    k = payloads.newest(e, ["ticker"], ["ts", "event_id"])
    p = k.selectExpr(
        "ticker", "CASE WHEN k % 3 > 0 THEN v END AS surprise_pct", "CASE WHEN k % 2 > 0 THEN cast(k AS double) END AS days_since_earnings", "k / 50 AS eps_revision_4w", "k % 4 AS revision_streak", "CASE WHEN k % 5 > 0 THEN v / 30 END AS put_call_ratio",
        "CASE WHEN k % 7 > 0 THEN k / 100 END AS iv_rank", "CASE WHEN k % 6 > 0 THEN k / 80 END AS atm_iv", "k % 10 > 1 AS has_earnings", "k % 10 > 2 AS has_revision", "k % 10 > 3 AS has_options",
    )
    return panels.with_alternative(technicals.price_features(tables.bars(spark, d)).select("ticker", "date", "realized_vol_20d"), p)


_ALL_DATES = "every AS (SELECT coalesce(c.date, m.date) AS date, c.date IS NOT NULL AS inside, spy FROM (SELECT DISTINCT date FROM bars) c FULL JOIN market m ON c.date = m.date)"


@R.query(f"""WITH {series._sector_sql('broad', 'sector_vs_spy')}, {series._FRAME.replace('every AS', 'every0 AS').replace('FROM every)', 'FROM every0)')}, {_OSC_TABLE.replace(_BARS + ',', '').replace('s AS (SELECT *, macd', 'sg AS (SELECT *, macd').replace('FROM s)', 'FROM sg)')},
{_ALL_DATES}, mf AS (SELECT date, inside, last_value(spy IGNORE NULLS) OVER (ORDER BY date) AS spy FROM every),
f AS (SELECT ticker, date, {series._change('close', 5)} AS m5, CASE WHEN count(volume) OVER ({_BY} ROWS 19 PRECEDING) = 20 THEN avg(volume) OVER ({_BY} ROWS 4 PRECEDING) / nullif(avg(volume) OVER ({_BY} ROWS 19 PRECEDING), 0) END AS vt FROM bars),
j AS (SELECT f.*, rsi_14, atr_14_pct, sector_vs_spy_5d, VIX / 20 - 1 AS v, coalesce(mf.spy / nullif(lag(mf.spy, 20) OVER (PARTITION BY f.ticker ORDER BY f.date), 0) - 1, 0) AS trend FROM f JOIN osc USING (ticker, date) JOIN rel USING (ticker, date) LEFT JOIN frame USING (date) LEFT JOIN mf ON mf.date = f.date AND mf.inside)
SELECT ticker, date, m5 * v AS mom5d_x_vix, (rsi_14 - 50) / 50 * v AS rsi_x_vix, sector_vs_spy_5d * trend AS sector_x_trend, atr_14_pct * v AS atr_x_vix, (coalesce(vt, 1) - 1) * v AS vol_trend_x_vix FROM j""", "mom5d_x_vix rsi_x_vix sector_x_trend atr_x_vix vol_trend_x_vix")
def regime_products_all(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    f = technicals.oscillators(technicals.price_features(b)).select("ticker", "date", "momentum_5d", "volume_trend", "rsi_14", "atr_14_pct")  # one pass over the bars for both
    f = f.join(series._sector(spark, d, "broad", "sector_vs_spy"), ["ticker", "date"])
    return panels.regime_products(f, macro.macro_features(series._frame(spark, d)).select("date", "vix_level"), tables.benchmark(spark, d))


_MATRIX = ["momentum_5d", "momentum_20d", "price_vs_ma50", "volume_trend"]


@R.query(f"WITH {sql._PRICE} SELECT ticker, date, {', '.join(f'{c}::FLOAT::DOUBLE AS x{n}' for n, c in enumerate(_MATRIX))}, 4::INT AS width FROM price", " ".join(f"x{n}" for n in range(4)))
def feature_matrix(spark, d):  # noqa: ANN001, ANN201
    m = panels.feature_matrix(technicals.price_features(tables.bars(spark, d)), _MATRIX)
    return m.select("ticker", "date", *[F.get("features", F.lit(n)).cast("double").alias(f"x{n}") for n in range(4)], F.size("features").alias("width"))


_SNAP = ["rsi_14", "macd_hist", "ma_50", "ma_200", "pct_to_ma_50", "pct_to_ma_200", "high_52w", "low_52w", "pct_in_52w_range", "pct_from_52wk_high", "mom_20d", "mom_60d"]


@R.query(f"""WITH {_OSC_CTES}, y AS (SELECT *, row_number() OVER ({_BY}) AS k, max(close) OVER ({_BY} ROWS 251 PRECEDING) AS hi, min(close) OVER ({_BY} ROWS 251 PRECEDING) AS lo, avg(close) OVER ({_BY} ROWS 49 PRECEDING) AS m50, avg(close) OVER ({_BY} ROWS 199 PRECEDING) AS m200,
 {series._change('close', 20)} AS c20, {series._change('close', 60)} AS c60 FROM x), l AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)
SELECT ticker, date, rsi_14 AS rsi_14, hist AS macd_hist, CASE WHEN k >= 50 THEN m50 END AS ma_50, CASE WHEN k >= 200 THEN m200 END AS ma_200, CASE WHEN k >= 50 THEN close / m50 - 1 END AS pct_to_ma_50,
 CASE WHEN k >= 200 THEN close / m200 - 1 END AS pct_to_ma_200, hi AS high_52w, lo AS low_52w, CASE WHEN hi > lo THEN (close - lo) / (hi - lo) END AS pct_in_52w_range, close / hi - 1 AS pct_from_52wk_high, c20 AS mom_20d, c60 AS mom_60d FROM l WHERE k >= 30""", " ".join(_SNAP))
def technicals_snapshot(spark, d):  # noqa: ANN001, ANN201
    return panels.technicals_snapshot(technicals.oscillators(tables.bars(spark, d)), rounded=False)


_BASE = ["momentum_20d", "return_60d", "mom_12_1_pct", "realized_vol_63d", "dist_from_52w_high"]


def _loading_panel(spark, d):  # noqa: ANN001, ANN202
    b = tables.bars(spark, d)
    p = technicals.price_features(b).select("ticker", "date", *_BASE).join(technicals.market_features(b, tables.benchmark(spark, d)).select("ticker", "date", "beta_60d", "idio_vol_60d"), ["ticker", "date"])
    return panels.with_fundamentals(p, panels.fundamentals(_metrics(spark, d)))


_ZS = list(panels.LOADINGS.values())
_MKT = sql._MKT.removeprefix("WITH ")
_MKT_TABLE = f"{_MKT[: _MKT.rindex('SELECT ticker, date, return_vs_spy_5d')].replace(sql._BARS + ',', '').replace('b AS (SELECT *, CASE', 'mb AS (SELECT *, CASE').replace('FROM b)', 'FROM mb)').rstrip()}, mkt AS (SELECT ticker, date, beta_60d, idio_vol_60d FROM v)"
_Z = f"""{sql._PRICE}, {_MKT_TABLE}, {_FUND},
long AS (SELECT ticker, date, unnest({list(panels.LOADINGS)}) AS factor, unnest([{', '.join('CASE WHEN coalesce(market_cap_raw, 0) > 0 THEN ln(market_cap_raw) END' if c == 'market_cap_raw' else (f'coalesce({c}, 0)' if c in _FIELDS else c) for c in panels.LOADINGS)}]) AS x FROM price JOIN mkt USING (ticker, date) LEFT JOIN fund USING (ticker)),
md AS (SELECT factor, date, median(x) AS med, count(x) AS n FROM long GROUP BY ALL), lm AS (SELECT long.*, med, n FROM long JOIN md USING (factor, date)), ms AS (SELECT factor, date, median(abs(x - med)) * 1.4826 AS mad FROM lm GROUP BY ALL),
w AS (SELECT lm.*, mad, CASE WHEN x IS NOT NULL THEN least(greatest(x, med - 3 * mad), med + 3 * mad) END AS w FROM lm JOIN ms USING (factor, date)), zz AS (SELECT *, avg(w) OVER k AS mu, stddev_pop(w) OVER k AS sd FROM w WINDOW k AS (PARTITION BY factor, date)),
z AS (SELECT ticker, date, factor, CASE WHEN n >= 2 AND mad > 0 AND sd > 0 THEN (w - mu) / sd END AS z FROM zz),
loadings AS (SELECT ticker, date, {', '.join(f"max(z) FILTER (factor = '{c}') AS {out}" for c, out in panels.LOADINGS.items())} FROM z GROUP BY ALL)"""


@R.query(f"WITH {_Z} SELECT * FROM loadings", " ".join(_ZS))
def factor_loadings(spark, d):  # noqa: ANN001, ANN201
    return panels.factor_loadings(_loading_panel(spark, d))


@R.query(f"WITH {_BARS}, r AS (SELECT date, {sql._change('close', 1)} AS r FROM bars), x AS (SELECT date, stddev_samp(r) AS s FROM r GROUP BY ALL HAVING date_part('day', date) % 2 = 0) SELECT ticker, bars.date, coalesce(s, 0) AS xsect_dispersion FROM bars ASOF LEFT JOIN (SELECT * FROM x WHERE s IS NOT NULL) x ON bars.date >= x.date", "xsect_dispersion")
def panel_dispersion(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    return panels.dispersion_on(b.select("ticker", "date"), technicals.dispersion(b).where("day(date) % 2 = 0").select("date", "xsect_dispersion"))


@R.query(f"""WITH {series._sector_sql('broad', 'sector_vs_spy')}, j AS (SELECT ticker, date, etf FROM bars LEFT JOIN sectors USING (ticker) LEFT JOIN (SELECT * FROM etf WHERE date_part('day', date) % 5 > 0) etf USING (sector, date)),
f AS (SELECT ticker, date, last_value(etf IGNORE NULLS) OVER ({_BY}) AS e FROM j) SELECT ticker, date, lag(e, 21) OVER ({_BY}) / nullif(lag(e, 252) OVER ({_BY}), 0) - 1 AS sector_mom_pct FROM f""", "sector_mom_pct")
def sector_momentum(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    of = series._sectors(spark, d).select("ticker", F.col("broad").alias("sector"))
    return panels.sector_momentum(b, of, series._etf(b, of.where("sector is not null")).where("day(date) % 5 > 0"))


@R.query(f"""WITH {_BARS}, g AS (SELECT *, coalesce(abs(close / lag(close) OVER ({_BY}) - 1) > 0.5, false) AS big, coalesce(date_diff('day', lag(date) OVER ({_BY}), date) > 5, false) AS gap, count(volume) OVER w AS n20, median(volume) OVER w AS m FROM bars WINDOW w AS ({_BY} ROWS 19 PRECEDING)),
s AS (SELECT ticker, count(*) AS bars, sum((high < low)::INT)::BIGINT AS bad_range, sum((close <= 0)::INT)::BIGINT AS nonpositive, sum(big::INT)::BIGINT AS large_moves, coalesce(array_to_string(list_sort(list(strftime(date, '%Y-%m-%d')) FILTER (big))[1:5], ','), '') AS first_moves,
 sum((volume = 0)::INT)::BIGINT AS zero_volume, sum(gap::INT)::BIGINT AS gaps, CASE WHEN count(*) >= 25 THEN count(*) FILTER (n20 >= 10 AND m > 0 AND volume / m > 4) ELSE 0 END AS volume_spikes FROM g GROUP BY ticker)
SELECT *, CASE WHEN bad_range > 0 OR nonpositive > 0 OR large_moves > 0 OR zero_volume > 0 OR gaps > 0 OR volume_spikes > 0 THEN 'anomaly' ELSE 'clean' END AS status FROM s""")
def series_anomalies(spark, d):  # noqa: ANN001, ANN201
    return panels.series_anomalies(tables.bars(spark, d), spike=4.0)


@R.query(f"""WITH {series._sector_sql('broad', 'sector_vs_spy')}, {sql._CAL}, p AS (SELECT ticker, date, close, session, sector FROM bars JOIN cal USING (date) LEFT JOIN sectors USING (ticker)), e AS (SELECT sector, session, etf FROM etf JOIN cal USING (date)),
j AS (SELECT a.ticker, a.date, b.close / nullif(a.close, 0) - 1 AS r, e1.etf / nullif(e0.etf, 0) - 1 AS s FROM p a JOIN p b ON b.ticker = a.ticker AND b.session = a.session + 5 LEFT JOIN e e0 ON e0.sector = a.sector AND e0.session = a.session LEFT JOIN e e1 ON e1.sector = a.sector AND e1.session = a.session + 5)
SELECT ticker, date, s AS sector_ret, r > s AS beat_sector FROM j""", "sector_ret")
def sector_forward_returns(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    of = series._sectors(spark, d).select("ticker", F.col("broad").alias("sector"))
    return panels.sector_returns(b, of, series._etf(b, of.where("sector is not null")))


@R.query(f"WITH {_BARS}, a AS (SELECT DISTINCT o_orderdate::DATE AS eval_date FROM orders), s AS (SELECT DISTINCT date FROM bars WHERE day(date) % 3 > 0) SELECT eval_date, s.date FROM a ASOF JOIN s ON a.eval_date <= s.date WHERE s.date < DATE '1998-06-01'")
def priced_dates(spark, d):  # noqa: ANN001, ANN201
    asked = tables.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("eval_date")).distinct()
    return panels.priced_on(asked, tables.bars(spark, d).where("day(date) % 3 > 0"), "1998-06-01")


@R.query(f"""WITH {_BARS}, f AS (SELECT ticker, date, {sql._change('close', 5)} AS m FROM bars) SELECT ticker, date, CASE WHEN date > DATE '1997-01-01' THEN m ELSE 0 END AS m FROM f""", "m")
def updated_panel(spark, d):  # noqa: ANN001, ANN201
    fresh = tables.bars(spark, d).select("ticker", "date", panels.change("close", 5).alias("m"))
    return panels.updated(fresh.withColumn("m", F.lit(0.0)), fresh, "1997-01-01")


@R.query(f"""WITH {_BARS}, h AS (SELECT * FROM bars WHERE ticker IN (SELECT c_custkey FROM customer) AND ticker NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)) SELECT ticker, date, close / nullif(lag(close, 20) OVER ({_BY}), 0) - 1 AS momentum_20d, CASE WHEN count(volume) OVER ({_BY} ROWS 19 PRECEDING) = 20 THEN avg(volume) OVER ({_BY} ROWS 19 PRECEDING) END AS avg_volume_20d_raw FROM h""", "momentum_20d avg_volume_20d_raw")
def supplemental_features(spark, d):  # noqa: ANN001, ANN201
    held = tables.read(spark, d, "customer").select(F.col("c_custkey").alias("ticker"))
    covered = tables.read(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("ticker"))
    return technicals.price_features(tracking.supplemental(tables.bars(spark, d), held, covered)).select("ticker", "date", "momentum_20d", "avg_volume_20d_raw")


@R.query("""WITH l AS (SELECT unnest(['l_quantity', 'l_tax', 'same']) AS "column", unnest([l_quantity, l_tax, 1.0]) AS x FROM lineitem) SELECT "column", count(x) AS n, count(x) = 0 AS all_null, coalesce(count(x) >= 20 AND stddev_pop(x) = 0, false) AS zero_variance FROM l GROUP BY ALL""")
def dead_columns_but_exempt(spark, d):  # noqa: ANN001, ANN201
    t = tables.read(spark, d, "lineitem").withColumn("nothing", F.lit(None).cast("double")).withColumn("same", F.lit(1.0))
    return cross_section.dead_columns(t, ["l_quantity", "l_tax", "nothing", "same"], exempt=("nothing",))


_TAIL = "60 + 5 + 40"
_SLICE = f"""{sql._PRICE}, tailed AS (SELECT * FROM price WHERE date IN (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT {_TAIL})),
sl AS (SELECT ticker, date, ret, factor, loading FROM (SELECT ticker, date, ret, unnest(['momentum_20d', 'price_vs_ma50', 'realized_vol_20d']) AS factor, unnest([momentum_20d, price_vs_ma50, realized_vol_20d]) AS loading FROM tailed)),
ll AS (SELECT *, lag(loading) OVER (PARTITION BY factor, ticker ORDER BY date) AS l FROM sl), kk AS (SELECT *, count(*) OVER (PARTITION BY factor, date) AS n, row_number() OVER (PARTITION BY factor, date ORDER BY l, ticker) AS rn FROM ll WHERE l IS NOT NULL AND ret IS NOT NULL),
ff AS (SELECT factor, date, avg(ret) FILTER (rn > n - greatest(round_even(n * 0.3, 0), 1)) - avg(ret) FILTER (rn <= greatest(round_even(n * 0.3, 0), 1)) AS r FROM kk WHERE n >= 5 GROUP BY ALL),
sm AS (SELECT *, CASE WHEN count(r) OVER w = 60 THEN sum(r) OVER w END AS s FROM ff WINDOW w AS (PARTITION BY factor ORDER BY date ROWS 59 PRECEDING)), mo AS (SELECT factor, date, lag(s, 5) OVER (PARTITION BY factor ORDER BY date) AS mom FROM sm),
zl AS (SELECT *, CASE WHEN stddev_samp(loading) OVER w > 1e-9 THEN (loading - avg(loading) OVER w) / stddev_samp(loading) OVER w END AS z FROM sl WINDOW w AS (PARTITION BY factor, date))"""


@R.query(f"WITH {_SLICE} SELECT ticker, date, avg(z * mom) AS factor_momentum_ratio FROM zl JOIN mo USING (factor, date) GROUP BY ALL", "factor_momentum_ratio")
def factor_momentum_slice(spark, d):  # noqa: ANN001, ANN201
    """Factor momentum of the newest dates from the last window, skip and 40 sessions of loadings alone."""
    f = technicals.price_features(tables.bars(spark, d)).select("ticker", "date", F.col("_ret").alias("ret"), "momentum_20d", "price_vs_ma50", "realized_vol_20d")
    tail = documents.trailing(f, 60 + 5 + 40)
    long = tail.unpivot(["ticker", "date", "ret"], ["momentum_20d", "price_vs_ma50", "realized_vol_20d"], "factor", "loading")
    return cross_section.factor_momentum_ratio(long, 60, 5, 0.3, 5)


@R.query(f"""WITH {_BARS}, o AS (SELECT ticker, date, close * CASE WHEN ticker % 4 = 0 THEN 1.2 WHEN ticker % 4 = 1 THEN 1.03 ELSE 1.0 END AS close FROM bars),
r AS (SELECT ticker, date, abs(o.close / bars.close - 1) AS change FROM bars JOIN o USING (ticker, date)), names AS (SELECT s_suppkey AS ticker FROM supplier WHERE s_suppkey % 8 = 0)
SELECT ticker, date, CASE WHEN change <= 0.05 THEN 'warning' WHEN ticker IN (FROM names) THEN 'restated' ELSE 'error' END AS level FROM r WHERE change > 0.01""")
def restated_discrepancies(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).select("ticker", "date", "close")
    k = F.col("ticker") % 4
    none = b.limit(0).select("ticker", F.col("date").alias("ex_date"), F.col("close").alias("factor"))
    names = tables.read(spark, d, "supplier").where("s_suppkey % 8 = 0").select(F.col("s_suppkey").alias("ticker"))
    return reconcile.discrepancies(b, b.withColumn("close", F.col("close") * F.when(k == 0, 1.2).when(k == 1, 1.03).otherwise(1.0)), none, restated=names).select("ticker", "date", "level")
