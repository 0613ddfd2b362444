"""A day's append with all of its passes: guards, the gate of whole series, and features of a ticker, against the market, of macro series, of factors and across the day's names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import cross_section, documents, macro, stores, technicals
from barloom.sources import snapshots

#: Rows of a ticker that its longest chain of windows reaches: 60 for beta, 231 for its residuals, 21 skipped, and the warm-up of the exponential means.
REACH = 585
MARKET = ["return_vs_spy_5d", "beta_60d", "idio_vol_60d", "residual_momentum_ratio"]
MACRO = ["vix_level", "yield_10y", "yield_curve_slope", "vix_term_slope", "gold_mom_5d", "vix_term_ratio"]


def _written(df: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder, so that the passes after it do not plan and compute them again."""
    path = snapshots.scratch(df.sparkSession, "append")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def series_with_today(history: DataFrame, today: DataFrame, limits: dict[str, int]) -> DataFrame:
    """The series gate on history and today together, for today's tickers only: a row of today replaces the stored one of its ticker and date.

    (ticker, gates that exceed their limits, those of them that only today's row brought about, quarantine). One pass: the gate
    without today is the gate's counts less what today's row adds (today is after all other rows), so history is neither read nor sorted twice. A ticker without history has its one row judged."""
    new = today.select(*history.columns).withColumn("_today", F.lit(True))
    old = history.join(new.select("ticker").distinct(), "ticker", "left_semi").join(new.select("ticker", "date"), ["ticker", "date"], "left_anti").withColumn("_today", F.lit(False))
    both = old.select(*history.columns, "_today").unionByName(new)
    w = Window.partitionBy("ticker").orderBy("date")
    prior, before = F.lag("close").over(w), F.lag("date").over(w)
    rules = {
        "bad_range": F.col("high") < F.col("low"), "nonpositive": F.col("close") <= 0, "large_moves": F.abs(F.col("close") / F.nullif(prior, F.lit(0.0)) - 1) > 0.5,
        "zero_volume": F.col("volume") == 0, "gaps": F.datediff("date", before) > 5,
    }
    if unknown := limits.keys() - rules.keys():
        raise ValueError(f"no such gates: {', '.join(sorted(unknown))}")
    hit = both.select("ticker", "_today", *[F.coalesce(rules[k], F.lit(False)).cast("int").alias(k) for k in limits])
    n = hit.groupBy("ticker").agg(*[a for k in limits for a in (F.sum(k).alias(k), F.sum(F.when(~F.col("_today"), F.col(k)).otherwise(0)).alias(f"_{k}"))])
    over = documents.quarantined(n, limits)
    fresh = F.array_compact(F.array(*[F.when((F.col(k) > m) & (F.col(f"_{k}") <= m), F.lit(k)) for k, m in limits.items()]))
    return n.select("ticker", F.array_join(fresh, ",").alias("fresh_gates")).join(over, "ticker")


def judged_all(stored: DataFrame, incoming: DataFrame, day: str, limits: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """(the last REACH rows of the accepted tickers, verdicts of the day's bars): row gate, splice guard, then the series gate with `limits`, whose verdict is `quarantined`.

    The judged rows and the verdicts are each written once, and reread by what follows."""
    at = F.lit(day).cast("date")
    rows, first = (_written(df) for df in stores.judged(stored, incoming, day, REACH))
    bad = series_with_today(rows.where(F.col("date") < at), rows.where(F.col("date") == at), limits).where("quarantine").select("ticker", F.col("gates").alias("series_gates"))
    verdicts = _written(first.join(bad, "ticker", "left").withColumn("verdict", F.when(F.col("series_gates").isNotNull(), "quarantined").otherwise(F.col("verdict"))))
    return rows.join(verdicts.where("verdict = 'accepted'").select("ticker"), "ticker", "left_semi"), verdicts


def append_all(
    stored: DataFrame, incoming: DataFrame, day: str, market: DataFrame, series: DataFrame, names: list[str], limits: dict[str, int], factors: list[str], scored: list[str],
    *, window: int = 231, skip: int = 21, quantile: float = 0.3, min_names: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """A day's append with every pass: (features of the day, verdicts of the day's bars).

    Bars are judged by `judged_all`. Passes over the last REACH rows of the accepted tickers, all windows of a ticker in one partitioning: price features, oscillators, market (date,
    spy). Then the day's row of macro features (series: series_id, date, value), joined by date; the factor momentum ratio, from long-short returns of the `factors` in the same rows; and z_<name>, robust z-scores across the day's names, of the columns `scored`. `unknown` counts a row's null features.

    The day's features are written once, before they are compared with one another.
    A day without accepted bars gives no rows; a series or market without the day gives nulls (or the pass's neutral value), not a lost row."""
    at = F.lit(day).cast("date")
    kept, verdicts = judged_all(stored, incoming, day, limits)
    own = technicals.oscillators(technicals.price_features(kept))
    own_names = [c for c in own.columns if not c.startswith("_") and c not in kept.columns]
    full = _written(technicals.market_features(own, market).where(F.col("date") == at).select("ticker", "date", *own_names, *MARKET))

    calendar = stored.where(F.col("date") < at).select("date").distinct().orderBy(F.desc("date")).limit(REACH).union(stored.sparkSession.range(1).select(at.alias("date")))
    weather = macro.macro_features(macro.aligned(calendar, series.where(F.col("date") <= at), names)).where(F.col("date") == at)

    panel = own.select("ticker", "date", F.col("_ret").alias("ret"), *factors).unpivot(["ticker", "date", "ret"], factors, "factor", "loading")
    momentum = cross_section.factor_momentum(cross_section.factor_returns(panel, quantile, min_names), window, skip).where(F.col("date") == at).select("factor", "momentum")
    by = Window.partitionBy("factor")
    sd = F.stddev_samp("loading").over(by)
    loads = full.unpivot(["ticker"], factors, "factor", "loading").withColumn("z", F.when(sd > 1e-9, (F.col("loading") - F.avg("loading").over(by)) / sd))
    ratio = loads.join(momentum, "factor").groupBy("ticker").agg(F.avg(F.col("z") * F.col("momentum")).alias("factor_momentum_ratio"))

    z = cross_section.robust_zscores(full.unpivot(["ticker"], scored, "factor", "x"), ("factor",))
    wide = z.groupBy("ticker").agg(*[F.max(F.when(F.col("factor") == c, F.col("z"))).alias(f"z_{c}") for c in scored])

    out = full.join(weather, "date", "left").join(ratio, "ticker", "left").join(wide, "ticker", "left")
    features = [c for c in out.columns if c not in ("ticker", "date")]
    nulls = sum((F.col(c).isNull().cast("int") for c in features), F.lit(0))
    return out.select("ticker", "date", *features, nulls.alias("unknown")), verdicts
