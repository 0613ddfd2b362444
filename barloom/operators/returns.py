"""Forward returns, outcomes and performance statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.merge import sessions

HORIZONS = (1, 3, 5, 10, 21)
#: All horizons of the survey's row R1.
ALL_HORIZONS = (1, 3, 5, 10, 15, 21, 30, 60, 90)


def forward_returns(bars: DataFrame, market: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Per (ticker, date, horizon): simple and log return after so many sessions of the calendar, the market's, and whether it was beaten.

    bars and market have a row for each (ticker, date) and date. Horizons count sessions, not the ticker's rows, so the later bar is found by its ordinal; windows that are not closed give no row.

    Later bars are taken from windows over the ticker's sessions, so bars are sorted once where they are, whatever the number of horizons; the market's values come with the
    calendar, which has a row for each date and is sent to the tasks."""
    after = lambda by, n: by.rangeBetween(n, n)
    calendar = Window.orderBy("session")
    cal = sessions(bars).join(market.select("date", "spy"), "date", "left")
    cal = cal.select("date", "session", F.col("spy").alias("m0"), F.array(*[F.max("spy").over(after(calendar, n)) for n in horizons]).alias("m"))
    p = bars.where("ticker is not null").select("ticker", "date", F.col("close").alias("c0")).join(F.broadcast(cal), "date")
    own = Window.partitionBy("ticker").orderBy("session")
    found = {f"_{n}": F.first(F.struct(F.col("c0").alias("c1"))).over(after(own, n)) for n in horizons}  # null where the ticker has no bar, whatever its close
    later = F.array(*[F.struct(F.lit(n).alias("horizon"), F.col(f"_{n}").alias("bar"), F.get("m", F.lit(k)).alias("m1")) for k, n in enumerate(horizons)])
    df = p.withColumns(found).select("ticker", "date", "c0", "m0", F.inline(F.filter(later, lambda x: x.bar.isNotNull()))).withColumn("c1", F.col("bar.c1"))
    r, rm = F.col("c1") / F.col("c0") - 1, F.col("m1") / F.col("m0") - 1
    return df.select("ticker", "date", "horizon", r.alias("ret"), F.log(F.col("c1") / F.col("c0")).alias("log_ret"), rm.alias("spy_ret"), F.log(F.col("m1") / F.col("m0")).alias("log_spy"), (r > rm).alias("beat_spy"))


def outcomes(signals: DataFrame, forward: DataFrame) -> DataFrame:
    """Signals (signal_id, ticker, date, label) scored against their forward returns: log alpha, and whether an UP or DOWN label was right."""
    df = signals.join(forward, ["ticker", "date"])
    alpha = F.col("log_ret") - F.coalesce("log_spy", F.lit(0.0))
    right = F.when(F.col("label") == "UP", alpha > 0).when(F.col("label") == "DOWN", alpha < 0)
    return df.select("signal_id", "horizon", "ticker", "date", "label", alpha.alias("log_alpha"), right.alias("correct"))


def hit_rates(scored: DataFrame) -> DataFrame:
    return scored.groupBy("horizon", "label").agg(F.count(F.lit(1)).alias("n"), F.count("correct").alias("graded"), F.avg(F.col("correct").cast("double")).alias("hit_rate"), F.avg("log_alpha").alias("mean_alpha"))


def risk_stats(bars: DataFrame, least: int = 60, year: float = 252.0) -> DataFrame:
    """Per ticker: annualised volatility, Sharpe and Sortino ratios (no risk-free rate; downside deviation over all returns) and maximum drawdown."""
    w = Window.partitionBy("ticker").orderBy("date")
    df = bars.withColumns({"r": F.col("close") / F.lag("close").over(w) - 1, "peak": F.max("close").over(w)})
    g = df.groupBy("ticker").agg(F.count("r").alias("n"), F.avg("r").alias("mu"), F.stddev_samp("r").alias("sd"), F.sqrt(F.avg(F.when(F.col("r").isNotNull(), F.pow(F.least("r", F.lit(0.0)), F.lit(2.0))))).alias("down"), F.min(F.col("close") / F.col("peak") - 1).alias("max_drawdown"))
    return g.where(F.col("n") >= least).select("ticker", "n", (F.col("sd") * year**0.5).alias("volatility"), (F.col("mu") / F.col("sd") * year**0.5).alias("sharpe"), (F.col("mu") / F.nullif("down", F.lit(0.0)) * year**0.5).alias("sortino"), "max_drawdown")


def market_beta(bars: DataFrame, market: DataFrame) -> DataFrame:
    """Per ticker over common dates: population beta, and total return in excess of the market's."""
    df = bars.select("ticker", "date", "close").join(market.select("date", "spy"), "date")
    w = Window.partitionBy("ticker").orderBy("date")
    df = df.withColumns({"r": F.col("close") / F.lag("close").over(w) - 1, "m": F.col("spy") / F.lag("spy").over(w) - 1})
    total = lambda c: F.max_by(c, "date") / F.min_by(c, "date") - 1
    return df.groupBy("ticker").agg(F.count("r").alias("n"), (F.covar_pop("r", "m") / F.var_pop(F.when(F.col("r").isNotNull(), F.col("m")))).alias("beta"), (total("close") - total("spy")).alias("excess_return"))


def period_returns(bars: DataFrame, years: tuple[int, ...] = (1, 3, 5), year_to_date: bool = False) -> DataFrame:
    """Per ticker the return from the first close on or after the start of each period, where its history covers that start.

    The year to date begins on the first of January of the newest bar's year."""
    span = Window.partitionBy("ticker")
    df = bars.withColumns({"end": F.max("date").over(span), "begin": F.min("date").over(span)})
    starts = {f"{y}y": F.add_months("end", -12 * y) for y in years} | ({"ytd": F.trunc("end", "year")} if year_to_date else {})
    aggs = [F.max_by("close", "date").alias("last")]
    for n, start in starts.items():
        inside = (F.col("date") >= start) & (F.col("begin") <= start)
        aggs.append(F.min_by(F.when(inside, F.col("close")), F.when(inside, F.col("date"))).alias(f"c{n}"))
    g = df.groupBy("ticker").agg(*aggs)
    return g.select("ticker", *[(F.col("last") / F.col(f"c{n}") - 1).alias(f"return_{n}") for n in starts])
