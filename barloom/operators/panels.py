"""Panels per ticker from fundamentals, alternative data and loadings, with their defaults; dated updates and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.bitemporal import all_known_on, known_on
from barloom.functions.windows import change, lag, rows, safe
from barloom.operators import cross_section, gates
from barloom.operators.payloads import clipped, picked

# Fundamental fields, their provider keys in order of preference, divisor and bounds. A yield is the inverse of its
# key; raw market value has no bounds.
FUNDAMENTALS: dict[str, tuple[list[str], float, float | None, float | None]] = {
    "pe_ratio": (["peTTM", "peExclExtraTTM", "peNormalizedAnnual"], 30.0, -3.0, 3.0),
    "pb_ratio": (["pbAnnual", "pbQuarterly"], 5.0, -3.0, 3.0),
    "debt_to_equity": (["totalDebt/totalEquityAnnual", "totalDebt/totalEquityQuarterly"], 2.0, -3.0, 3.0),
    "revenue_growth_yoy": (["revenueGrowthTTMYoy", "revenueGrowthQuarterlyYoy", "revenueGrowth5Y"], 100.0, -1.0, 2.0),
    "fcf_yield": (["pfcfShareTTM", "pfcfShareAnnual"], 1.0, -0.5, 0.5),
    "gross_margin": (["grossMarginTTM", "grossMarginAnnual", "grossMargin5Y"], 100.0, 0.0, 1.0),
    "roe": (["roeTTM", "roeRfy"], 100.0, -1.0, 1.0),
    "current_ratio": (["currentRatioAnnual", "currentRatioQuarterly"], 3.0, 0.0, 3.0),
    "revenue_growth_3y": (["revenueGrowth3Y", "revenueGrowth5Y"], 100.0, -0.5, 1.5),
    "eps_growth_3y": (["epsGrowth3Y", "epsBasicExclExtraItemsAnnual5Y", "epsGrowth5Y"], 100.0, -1.0, 2.0),
    "payout_ratio": (["payoutRatioTTM", "payoutRatioAnnual"], 100.0, 0.0, 2.0),
    "dividend_yield": (["dividendYieldIndicatedAnnual", "currentDividendYieldTTM"], 100.0, 0.0, 0.20),
    "capex_growth_5y": (["capexCagr5Y"], 100.0, -1.0, 2.0),
    "market_cap_raw": (["marketCapitalization"], 1.0, None, None),
}
# Range gate of the fundamental fields (least, most), and the loadings with their names.
FUNDAMENTAL_SPECS = [(f, lo, hi) for f, (_, _, lo, hi) in list(FUNDAMENTALS.items())[:8]]
LOADINGS = {
    "momentum_20d": "momentum_20d_zscore", "return_60d": "return_60d_zscore", "mom_12_1_pct": "mom_12_1_pct_zscore", "beta_60d": "beta_60d_zscore", "idio_vol_60d": "idio_vol_60d_zscore",
    "realized_vol_63d": "realized_vol_63d_zscore", "dist_from_52w_high": "dist_from_52w_high_zscore", "pe_ratio": "pe_ratio_zscore", "roe": "roe_zscore", "market_cap_raw": "size_zscore",
}
# Alternative features and their neutral values.
ALTERNATIVE = {"earnings_surprise_pct": 0.0, "days_since_earnings": 1.0, "eps_revision_4w": 0.0, "revision_streak": 0.0, "put_call_ratio": 0.0, "iv_rank": 0.5, "iv_vs_rv": 1.0}


def fundamentals(metrics: DataFrame) -> DataFrame:
    """ticker, all FUNDAMENTALS fields scaled and bounded, and `absent`: the fields without any of their keys, sorted. A missing key is a null or a missing column."""
    have = set(metrics.columns)
    m = metrics.select("*", *[F.lit(None).cast("double").alias(k) for k in sorted({k for keys, *_ in FUNDAMENTALS.values() for k in keys} - have)])
    cols, gone = [], []
    for field, (keys, unit, lo, hi) in FUNDAMENTALS.items():
        named = [f"`{k}`" for k in keys]
        x = picked(named)
        if field == "fcf_yield":
            x = F.when(x > 0, 1 / x).otherwise(0.0)
        if field == "market_cap_raw":
            cols.append(F.when(x > 0, x).otherwise(0.0).alias(field))
        else:
            cols.append(clipped(x / unit, lo, hi).alias(field))
        gone.append(F.when(F.coalesce(*[F.col(k) for k in named]).isNull(), F.lit(field)))
    return m.select("ticker", *cols, F.array_sort(F.array_compact(F.array(*gone))).alias("absent"))


def with_fundamentals(panel: DataFrame, values: DataFrame) -> DataFrame:
    """A panel by ticker with all fundamental columns, 0 where a ticker or a value is missing."""
    return panel.join(values.select("ticker", *FUNDAMENTALS), "ticker", "left").fillna(0.0, list(FUNDAMENTALS))


def with_alternative(panel: DataFrame, payloads: DataFrame) -> DataFrame:
    """A panel (ticker, date, realized_vol_20d) with the seven alternative features; implied over realised volatility uses the ticker's newest realised one.

    payloads: ticker, surprise_pct, days_since_earnings, eps_revision_4w, revision_streak, put_call_ratio, iv_rank, atm_iv, and has_earnings, has_revision,
    has_options (whether the part is there). The payload is a snapshot without a date, so it holds for all of a ticker's rows."""
    newest = panel.groupBy("ticker").agg(F.max_by("realized_vol_20d", "date").alias("_rv"))
    p = newest.join(payloads, "ticker", "left")
    part = lambda has, x, inside, outside: F.when(F.coalesce(has, F.lit(False)), F.coalesce(x, F.lit(inside))).otherwise(F.lit(outside))
    ratio = F.when((F.col("_rv") > 0) & (F.col("atm_iv") > 0), F.col("atm_iv") / F.col("_rv"))
    p = p.select(
        "ticker", part("has_earnings", F.col("surprise_pct"), 0.0, 0.0).alias("earnings_surprise_pct"), part("has_earnings", F.coalesce("days_since_earnings", F.lit(90.0)) / 90, 1.0, 1.0).alias("days_since_earnings"),
        part("has_revision", F.col("eps_revision_4w"), 0.0, 0.0).alias("eps_revision_4w"), part("has_revision", F.col("revision_streak").cast("double"), 0.0, 0.0).alias("revision_streak"),
        part("has_options", F.col("put_call_ratio"), 0.0, 0.0).alias("put_call_ratio"), part("has_options", F.col("iv_rank"), 0.5, 0.5).alias("iv_rank"), part("has_options", ratio, 1.0, 1.0).alias("iv_vs_rv"),
    )
    return panel.select("ticker", "date").join(p, "ticker")


def with_fundamentals_known(panel: DataFrame, values: DataFrame, broadcast: bool = False) -> DataFrame:
    """A panel (ticker, date) with all fundamental columns as they were known on each row's date, 0 where nothing was.

    values: ticker, period (the quarter's end), known_at (the filing's day), FUNDAMENTALS. With `broadcast` each ticker's newest values of all hold for all of its rows, as
    `with_fundamentals` has it: a look ahead, for comparisons only."""
    if broadcast:
        newest = Window.partitionBy("ticker").orderBy(F.desc("period"), F.desc("known_at"), *[F.desc(c) for c in FUNDAMENTALS])
        return with_fundamentals(panel, values.withColumn("_n", F.row_number().over(newest)).where("_n = 1"))
    return known_on(panel, values, list(FUNDAMENTALS)).drop("period", "known_at").fillna(0.0, list(FUNDAMENTALS))


#: Parts of the alternative data, with the fields of each; each part is known from days of its own.
PARTS = {"earnings": ["surprise_pct", "days_since_earnings"], "revision": ["eps_revision_4w", "revision_streak"], "options": ["put_call_ratio", "iv_rank", "atm_iv"]}


def with_alternative_known(panel: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """A panel (ticker, date, realized_vol_20d) with the seven alternative features as they were known on each row's date.

    parts: of `earnings`, `revision` and `options` those that there are, each ticker, period, known_at and the fields of PARTS. Days since the earnings go on from the day they were known;
    implied volatility is set against the realised one of the row's own date, not of the newest. What was not known yet is neutral."""
    df = panel.select("ticker", "date", "realized_vol_20d")
    given = {f"_{name}_": (parts[name], fields) for name, fields in PARTS.items() if name in parts}
    if given:  # by years: what is carried into a block is a row a ticker and year, and a year's dates are few
        df = all_known_on(df, given, block="year")
    for name, fields in PARTS.items():
        if name not in parts:
            df = df.withColumns({f"_{name}_known_at": F.lit(None).cast("date"), **{f: F.lit(None).cast("double") for f in fields}})
    c = F.col
    neutral = lambda x, value: F.coalesce(x, F.lit(value))
    days = F.when(c("_earnings_known_at").isNotNull(), F.coalesce(c("days_since_earnings") + F.datediff("date", "_earnings_known_at"), F.lit(90.0)) / 90)
    ratio = F.when((c("realized_vol_20d") > 0) & (c("atm_iv") > 0), c("atm_iv") / c("realized_vol_20d"))
    return df.select(
        "ticker", "date", neutral(c("surprise_pct"), 0.0).alias("earnings_surprise_pct"), neutral(days, 1.0).alias("days_since_earnings"), neutral(c("eps_revision_4w"), 0.0).alias("eps_revision_4w"),
        neutral(c("revision_streak").cast("double"), 0.0).alias("revision_streak"), neutral(c("put_call_ratio"), 0.0).alias("put_call_ratio"), neutral(c("iv_rank"), 0.5).alias("iv_rank"), neutral(ratio, 1.0).alias("iv_vs_rv"),
    )


def regime_products(features: DataFrame, vix_level: DataFrame, market: DataFrame) -> DataFrame:
    """The five products of a ticker's features with the market's regime: volatility less its base, and the market's 20-row trend on the ticker's own dates.

    features: ticker, date, momentum_5d, rsi_14, atr_14_pct, volume_trend, sector_vs_spy_5d; vix_level (date, vix_level) is aligned; market (date, spy) is filled
    forward on each ticker's calendar, as it lacks some of its dates. A trend that is not known yet is 0."""
    w = Window.partitionBy("ticker").orderBy("date")
    df = features.join(vix_level, "date", "left").join(as_of_market(features.select("date").distinct(), market), "date", "left")
    trend = F.coalesce(safe(F.col("spy"), F.lag("spy", 20).over(w)) - 1, F.lit(0.0))
    v = F.col("vix_level") - 1
    return df.withColumn("_t", trend).select(
        "ticker", "date", (F.col("momentum_5d") * v).alias("mom5d_x_vix"), ((F.col("rsi_14") - 50) / 50 * v).alias("rsi_x_vix"), (F.col("sector_vs_spy_5d") * F.col("_t")).alias("sector_x_trend"),
        (F.col("atr_14_pct") * v).alias("atr_x_vix"), ((F.col("volume_trend") - 1) * v).alias("vol_trend_x_vix"),
    )


def as_of_market(dates: DataFrame, market: DataFrame, value: str = "spy") -> DataFrame:
    """(date, value): the newest value on or before each date. The window has no key, but its rows are dates."""
    both = dates.select("date", F.lit(1).alias("_q")).join(market.select("date", value), "date", "full_outer")
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(w)).where("_q = 1").select("date", value)


def dispersion_on(panel: DataFrame, dispersion: DataFrame) -> DataFrame:
    """A panel (ticker, date) with the cross-section's dispersion as of each date, 0 before the first."""
    d = as_of_market(panel.select("date").distinct(), dispersion, "xsect_dispersion")
    return panel.join(d, "date", "left").fillna(0.0, ["xsect_dispersion"])


def sector_momentum(bars: DataFrame, sector_of: DataFrame, etf: DataFrame, skip: int = 21, window: int = 252) -> DataFrame:
    """(ticker, date, sector_mom_pct): momentum of the ticker's sector series (sector, date, etf) over its rows but the newest `skip`; null without a sector."""
    df = bars.select("ticker", "date").join(sector_of, "ticker", "left").join(etf, ["sector", "date"], "left")
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_e", F.last("etf", ignorenulls=True).over(w))
    return df.select("ticker", "date", (safe(lag("_e", skip), lag("_e", window)) - 1).alias("sector_mom_pct"))


def feature_matrix(panel: DataFrame, columns: list[str]) -> DataFrame:
    """(ticker, date, features): the columns as one array of floats, in order."""
    return panel.select("ticker", "date", F.array(*[F.col(c).cast("float") for c in columns]).alias("features"))


def technicals_snapshot(df: DataFrame, least: int = 30, rounded: bool = True) -> DataFrame:
    """Each ticker's newest technicals, each null until the history it needs is there, rounded to 4 digits (RSI to 2); tickers with fewer than `least` rows have none.

    df: ticker, date, close, rsi_14, _hist (MACD line less signal), as `oscillators` gives."""
    by = Window.partitionBy("ticker").orderBy("date")
    n = F.row_number().over(by)
    year = rows(252)
    df = df.where("close > 0").withColumns({"_k": n, "_hi": F.max("close").over(year), "_lo": F.min("close").over(year), "_50": F.avg("close").over(rows(50)), "_200": F.avg("close").over(rows(200)), "_20d": change("close", 20), "_60d": change("close", 60)})
    last = df.withColumn("_d", F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))).where((F.col("_d") == 1) & (F.col("_k") >= least))
    r = lambda x, d=4: F.round(x, d) if rounded else x
    when = lambda k, x: F.when(F.col("_k") >= k, x)
    c, width = F.col("close"), F.col("_hi") - F.col("_lo")
    return last.select(
        "ticker", "date", r(F.col("rsi_14"), 2).alias("rsi_14"), r(F.col("_hist")).alias("macd_hist"), when(50, r(F.col("_50"))).alias("ma_50"), when(200, r(F.col("_200"))).alias("ma_200"),
        when(50, r(c / F.col("_50") - 1)).alias("pct_to_ma_50"), when(200, r(c / F.col("_200") - 1)).alias("pct_to_ma_200"), r(F.col("_hi")).alias("high_52w"), r(F.col("_lo")).alias("low_52w"),
        F.when(width > 0, r((c - F.col("_lo")) / width)).alias("pct_in_52w_range"), r(c / F.col("_hi") - 1).alias("pct_from_52wk_high"), r(F.col("_20d")).alias("mom_20d"), r(F.col("_60d")).alias("mom_60d"),
    )


def factor_loadings(panel: DataFrame, loadings: dict[str, str] | None = None) -> DataFrame:
    """ticker, date and each loading's robust z-score on its date; size is that of the log of a positive market value. Columns that the panel lacks are null."""
    loadings = loadings or LOADINGS
    have = [c for c in loadings if c in panel.columns]
    value = {c: F.when(F.col(c) > 0, F.log(c)) if c == "market_cap_raw" else F.col(c) for c in have}
    wide = panel.select("ticker", "date", *[F.when(F.abs(value[c]) < float("inf"), value[c]).alias(c) for c in have])
    z = cross_section.robust_zscores_wide(wide, "date", have).groupBy("ticker", "date").agg(*[F.max(c).alias(c) for c in have])  # rows of a date are in one place: no shuffle
    return z.select("ticker", "date", *[(F.col(c) if c in have else F.lit(None).cast("double")).alias(out) for c, out in loadings.items()])


def updated(stored: DataFrame, fresh: DataFrame, after: str) -> DataFrame:
    """A stored table by (ticker, date) in which the dates after the given one are replaced by fresh rows."""
    day = F.lit(after).cast("date")
    return stored.where(F.col("date") <= day).unionByName(fresh.where(F.col("date") > day))


def series_anomalies(bars: DataFrame, move: float = 0.5, spike: float = 10.0, window: int = 20, least: int = 10, enough: int = 25) -> DataFrame:
    """`gates.series_gate` with volume spikes: days above `spike` times the exact median of the last rows (the day's own included), for series long enough."""
    w = rows(window)
    usual = F.when(F.count("volume").over(w) >= least, F.percentile("volume", 0.5).over(w))
    df = bars.select("ticker", "volume", usual.alias("_m"))
    g = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("_n"), F.sum(((F.col("_m") > 0) & (F.col("volume") / F.col("_m") > spike)).cast("int")).alias("_s"))
    g = g.select("ticker", F.when(F.col("_n") >= enough, F.coalesce("_s", F.lit(0))).otherwise(0).cast("long").alias("volume_spikes"))
    s = gates.series_gate(bars, move).join(g, "ticker")
    some = F.expr("bad_range > 0 or nonpositive > 0 or large_moves > 0 or zero_volume > 0 or gaps > 0 or volume_spikes > 0")
    return s.withColumn("status", F.when(some, "anomaly").otherwise("clean"))


def sector_returns(bars: DataFrame, sector_of: DataFrame, etf: DataFrame, sessions: int = 5) -> DataFrame:
    """(ticker, date, sector_ret, beat_sector): the sector series' return over so many sessions, and whether the ticker's own was higher.

    Sessions are those of the panel; null without a sector or where the series has no price on either day."""
    cal = bars.select("date").distinct().withColumn("_s", F.row_number().over(Window.orderBy("date")))
    p = bars.select("ticker", "date", "close").join(cal, "date").join(sector_of, "ticker", "left")
    e = etf.join(cal, "date").select("sector", "_s", "etf")
    later = p.select("ticker", (F.col("_s") - sessions).alias("_s"), F.col("close").alias("c1"))
    df = p.join(later, ["ticker", "_s"]).join(e.withColumnRenamed("etf", "e0"), ["sector", "_s"], "left").join(e.select("sector", (F.col("_s") - sessions).alias("_s"), F.col("etf").alias("e1")), ["sector", "_s"], "left")
    r = safe(F.col("e1"), F.col("e0")) - 1
    return df.select("ticker", "date", r.alias("sector_ret"), (safe(F.col("c1"), F.col("close")) - 1 > r).alias("beat_sector"))


def priced_on(asked: DataFrame, bars: DataFrame, before: str) -> DataFrame:
    """(eval_date, date): the session whose prices count for an asked date: its own if any ticker traded, else the next one, so it is before the given date."""
    days = bars.select("date").distinct()
    both = asked.select(F.col("eval_date").alias("date"), F.lit(1).alias("_q")).unionByName(days.select("date", F.lit(0).alias("_q")))
    w = Window.orderBy("date", F.desc("_q")).rowsBetween(0, Window.unboundedFollowing)  # a calendar
    nxt = F.first(F.when(F.col("_q") == 0, F.col("date")), ignorenulls=True).over(w)
    return both.withColumn("_d", nxt).where("_q = 1").where(F.col("_d") < F.lit(before).cast("date")).select(F.col("date").alias("eval_date"), F.col("_d").alias("date"))

