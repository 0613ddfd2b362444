"""Per-ticker technical, macro and risk features as row-based windows over one sort by (ticker, date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.sliding import block_windows
from barloom.functions.windows import by_ticker, change, ewms, joined, known, lag, lags, moments, numbered, rows, safe, spread, streak, summed

YEAR = 252


def price_features(bars: DataFrame) -> DataFrame:
    """Moves, distances, volumes and oscillators of each ticker's own bars: (ticker, date, open, high, low, close, volume, vwap) in, the features added.

    One sort by (ticker, date). A sliding frame costs its width at each row, and a deviation some four times what a sum does, so frames are 5 or 10 rows wide and all others are put
    together from theirs at fixed distances: 200 rows are four times 50, those five times 10, and 63 three times 20 and three rows. Each piece is reckoned anew at its row, so an
    infinite or missing price leaves a feature with the window that held it."""
    c, v, prior = F.col("close"), F.col("volume"), F.col("_prior")
    year = F.sqrt(F.lit(YEAR))
    full = lambda n, x, value: F.when(F.col(f"_n_{x}") >= n, value)
    part = lambda n, x, by=None: (n, F.col(f"_mean_{x}" + (f"_{by}" if by else "")), F.col(f"_squares_{x}" + (f"_{by}" if by else "")))
    deviation = lambda n, x, squares: full(n, x, F.sqrt(squares / (n - 1)))
    streaks = lambda *xs: {f"_n_{x}": streak(x) for x in xs}
    behind = lambda x, *distances: lags(f"_mean_{x}", *distances) | lags(f"_squares_{x}", *distances)

    df = numbered(bars.withColumn("_prior", lag("close", 1)))
    df = df.withColumns({
        "_log": F.log(c / prior), "_ret": safe(c, prior) - 1, "_delta": c - prior, "_overnight": safe(F.col("open"), prior) - 1, "_intraday": safe(c, F.col("open")) - 1,
        "_mf": F.coalesce(safe((c - F.col("low")) - (F.col("high") - c), F.col("high") - F.col("low")), F.lit(0.0)) * v,
    })
    df = df.withColumns({
        **streaks("close", "volume", "high", "_overnight", "_intraday", "_log", "_ret", "_mf"), **moments("close", 10), **moments("_ret", 10), **moments("_log", 10),
        "_ten": F.sum("close").over(rows(10)), "_top": F.max("close").over(rows(10)), "_low": F.min("close").over(rows(10)),
        "_volume5": F.sum("volume").over(rows(5)), "_high5": F.max("high").over(rows(5)), "_overnight5": F.sum("_overnight").over(rows(5)), "_intraday5": F.sum("_intraday").over(rows(5)), "_mf5": F.sum("_mf").over(rows(5)),
        "_expanding": F.when(F.count("volume").over(by_ticker()) >= 20, F.avg("volume").over(by_ticker())), "_obv": F.sum(F.coalesce(F.signum("_delta"), F.lit(0.0)) * v).over(by_ticker()),
        "momentum_5d": change("close", 5), "momentum_20d": change("close", 20), "return_60d": change("close", 60), "return_120d": change("close", 120),
        "mom_12_1_pct": safe(lag("close", 21), lag("close", 252)) - 1,
    })
    df = df.withColumns({
        "price_accel": F.col("momentum_5d") - F.col("momentum_20d"), "overnight_return_5d": full(5, "_overnight", F.col("_overnight5")), "intraday_return_5d": full(5, "_intraday", F.col("_intraday5")), "_sd10": deviation(10, "_log", F.col("_squares__log")),
        "dist_from_5d_high": c / full(5, "high", F.col("_high5")) - 1, "vwap_divergence_pct": safe(c - F.col("vwap"), F.col("vwap")),
    })
    df = df.withColumns({
        **streaks("_obv"), **behind("close", 10), **behind("_ret", 10), **behind("_log", 10, 20),
        "_twenty": summed("_ten", 10, 2), "_fifty": summed("_ten", 10, 5), "_top30": spread(F.greatest, "_top", 10, 3), "_low30": spread(F.least, "_low", 10, 3), "_peak": spread(F.greatest, "_top", 10, 6),
        "_volume20": summed("_volume5", 5, 4), "_mf20": summed("_mf5", 5, 4), "_high20": spread(F.greatest, "_high5", 5, 4), "_obv5": F.sum("_obv").over(rows(5)),
    })
    close20, ret20, log30 = joined(part(10, "close"), part(10, "close", 10)), joined(part(10, "_ret"), part(10, "_ret", 10)), joined(part(10, "_log"), part(10, "_log", 10), part(10, "_log", 20))
    df = df.withColumns({
        "_sd20": deviation(20, "close", close20[1]), "realized_vol_20d": deviation(20, "_ret", ret20[1]) * year,
        "_mean__ret": ret20[0], "_squares__ret": ret20[1], "_mean__log": log30[0], "_squares__log": log30[1], "_dd": c / full(60, "close", F.col("_peak")) - 1,
        "avg_volume_20d_raw": full(20, "volume", F.col("_volume20") / 20), "price_vs_ma50": c / full(50, "close", F.col("_fifty") / 50) - 1, "dist_from_20d_high": c / full(20, "high", F.col("_high20")) - 1,
    })
    df = df.withColumn("bollinger_pct", F.coalesce(safe(c - (full(20, "close", F.col("_twenty") / 20) - 2 * F.col("_sd20")), 4 * F.col("_sd20")), F.lit(0.5)))
    df = df.withColumns({
        **streaks("realized_vol_20d", "_dd"), **moments("realized_vol_20d", 10), **behind("_ret", 20, 40), **lags("_ret", 60, 61, 62), **behind("_log", 30),
        "_200": summed("_fifty", 50, 4), "_top252": F.greatest(spread(F.greatest, "_top30", 30, 8), lag("_top30", 222)), "_low252": F.least(spread(F.least, "_low30", 30, 8), lag("_low30", 222)),
        "_obv20": summed("_obv5", 5, 4), "_dd10": F.min("_dd").over(rows(10)),
    })
    ret63 = joined(part(20, "_ret"), part(20, "_ret", 20), part(20, "_ret", 40), *[(1, F.col(f"_ret_{n}"), None) for n in (60, 61, 62)])
    log60 = joined(part(30, "_log"), part(30, "_log", 30))
    df = df.withColumns({
        "price_vs_ma200": c / full(200, "close", F.col("_200") / 200) - 1,
        "dist_from_52w_high": c / full(252, "close", F.col("_top252")) - 1, "dist_from_52w_low": c / full(252, "close", F.col("_low252")) - 1,
        "volume_trend": F.coalesce(safe(full(5, "volume", F.col("_volume5") / 5), F.col("avg_volume_20d_raw")), F.lit(1.0)),
        "avg_volume_20d": F.coalesce(safe(F.col("avg_volume_20d_raw"), F.col("_expanding")), F.when(F.col("_expanding") == 0, F.lit(1.0))),
        "rel_volume_ratio": F.coalesce(safe(v, F.col("avg_volume_20d_raw")), F.lit(1.0)),
        "vol_ratio_10_60": F.coalesce(safe(F.col("_sd10"), deviation(60, "_log", log60[1])), F.lit(1.0)), "realized_vol_63d": deviation(63, "_ret", ret63[1]) * year,
        "obv_slope_10d": safe(full(5, "_obv", F.col("_obv5") / 5) - full(20, "_obv", F.col("_obv20") / 20), F.col("avg_volume_20d_raw")),
    })
    df = df.withColumns({**behind("realized_vol_20d", 10, 20), "max_drawdown_60d": full(60, "_dd", spread(F.least, "_dd10", 10, 6))})
    vol30 = joined(part(10, "realized_vol_20d"), part(10, "realized_vol_20d", 10), part(10, "realized_vol_20d", 20))
    return df.withColumns({"cmf_20_ratio": safe(full(20, "_mf", F.col("_mf20")), full(20, "volume", F.col("_volume20"))), "vol_of_vol_30d": deviation(30, "realized_vol_20d", vol30[1]), "volume_price_div": F.signum(F.col("volume_trend") - 1) * F.signum("momentum_5d")})


def oscillators(df: DataFrame) -> DataFrame:
    """RSI, MACD with its newest cross, EMA cross and ATR from exponentially weighted means (adjust=False)."""
    prior = lag("close", 1)
    df = df.withColumns({"_d": F.col("close") - prior})
    df = df.withColumns({"_up": F.greatest("_d", F.lit(0.0)), "_down": F.greatest(-F.col("_d"), F.lit(0.0)), "_tr": F.greatest(F.col("high") - F.col("low"), F.coalesce(F.abs(F.col("high") - prior), F.lit(0.0)), F.coalesce(F.abs(F.col("low") - prior), F.lit(0.0)))})
    df = df.withColumns({n: F.when(F.col("_d").isNotNull(), F.col(n)) for n in ("_up", "_down")})
    df = ewms(df, [("_up", 1 / 14, "_gain"), ("_down", 1 / 14, "_loss"), ("close", 2 / 13, "_e12"), ("close", 2 / 27, "_e26"), ("close", 2 / 9, "_e8"), ("close", 2 / 22, "_e21"), ("_tr", 2 / 15, "_atr")])
    df = df.withColumns({"rsi_14": 100 - 100 / (1 + safe(F.col("_gain"), F.col("_loss"))), "macd_line_last": F.col("_e12") - F.col("_e26"), "ema_cross_8_21": safe(F.col("_e8"), F.col("_e21")) - 1, "atr_14_pct": safe(F.col("_atr"), F.col("close"))})
    df = ewms(df, [("macd_line_last", 2 / 10, "_signal")]).withColumn("_hist", F.col("macd_line_last") - F.col("_signal"))
    before = lag("_hist", 1)
    df = df.withColumn("_cross", F.when((F.col("_hist") > 0) & (before <= 0), 1.0).when((F.col("_hist") < 0) & (before >= 0), -1.0))
    # the newest of the last three rows' crosses
    newest = F.coalesce(F.col("_cross"), lag("_cross", 1), lag("_cross", 2), F.lit(0.0))
    return df.withColumns({"macd_above_zero": F.coalesce((F.col("macd_line_last") > 0).cast("double"), F.lit(0.0)), "macd_cross": newest, "rsi_slope_5d": (F.col("rsi_14") - lag("rsi_14", 5)) / 5})


def market_features(bars: DataFrame, market: DataFrame) -> DataFrame:
    """Beta, idiosyncratic volatility and residual momentum against a market series of (date, spy); the market side is joined by exact date."""
    m = market.select("date", "spy")
    df = numbered(bars.join(F.broadcast(m), "date", "left"))  # a row a date: bars stay as they are dealt
    df = df.withColumns({"_r": F.log(F.col("close") / lag("close", 1)), "_m": F.log(F.col("spy") / lag("spy", 1)), "return_vs_spy_5d": change("close", 5) - change("spy", 5)})
    df = df.withColumn("_p", F.when(F.col("_r").isNotNull() & F.col("_m").isNotNull(), F.lit(1)))
    df = df.withColumn("beta_60d", F.when(known(60, "_p"), safe(F.covar_samp("_r", "_m").over(rows(60)), F.var_samp("_m").over(rows(60)))))
    df = df.withColumn("_e", F.col("_r") - F.col("beta_60d") * F.col("_m"))
    df = block_windows(df, {20: {"_v": ("sd", "_e")}, 60: {"idio_vol_60d": ("sd", "_e")}, 231: {"_s": ("sum", "_e")}})
    return df.withColumn("idio_vol_60d", F.col("idio_vol_60d") * F.sqrt(F.lit(YEAR))).withColumn("residual_momentum_ratio", safe(lag("_s", 21), F.col("_v") * F.sqrt(F.lit(231.0))))


def dispersion(bars: DataFrame) -> DataFrame:
    """The cross-section's standard deviation of daily returns, for each date."""
    df = bars.withColumn("_r", change("close", 1))
    return df.groupBy("date").agg(F.stddev_samp("_r").alias("xsect_dispersion"), F.count("_r").alias("names"))


def latest(df: DataFrame, n: int = 1) -> DataFrame:
    """Each ticker's n newest rows."""
    by = Window.partitionBy("ticker").orderBy(F.desc("date"))
    return df.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= n).drop("_n")


def admitted(df: DataFrame, least: int = 265, tail: int = 585) -> DataFrame:
    """Tickers with enough history, each cut to its newest rows."""
    by = Window.partitionBy("ticker")
    df = df.withColumn("_c", F.count(F.lit(1)).over(by)).where(F.col("_c") >= least).drop("_c")
    return latest(df, tail)
