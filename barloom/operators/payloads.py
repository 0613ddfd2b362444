"""Provider payloads as columns: choice of keys, units, bounds, defaults, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical(df: DataFrame, schema: list[tuple[str, str]], fill: bool = True) -> DataFrame:
    """The schema's columns in its order: others go; missing ones become null, or stay away where fill is False."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in schema if fill or c in have])


def closed_set(source: str, known: list[str]) -> Column:
    """The source, or `unknown` for one outside the set (null included)."""
    return F.when(F.col(source).isin(known), F.col(source)).otherwise("unknown")


def vendor_symbol(ticker: str) -> Column:
    """Index carets go; one share-class letter after a dash follows a dot instead."""
    return F.regexp_replace(F.regexp_replace(F.col(ticker), r"^\^", ""), r"^([A-Z]+)-([A-Z])$", "$1.$2")


def picked(keys: list[str], default: float = 0.0) -> Column:
    """The first key with a value."""
    return F.coalesce(*[F.col(k) for k in keys], F.lit(default))


def clipped(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def shaped(metrics: DataFrame, keys: dict[str, list[str]], units: dict[str, tuple[float, float, float]]) -> DataFrame:
    """Each field from its first known key, divided and clipped (divisor, low, high); `absent` lists the fields without any key."""
    gone = [F.when(F.coalesce(*[F.col(k) for k in ks]).isNull(), F.lit(f)) for f, ks in keys.items()]
    cols = [clipped(picked(ks) / units[f][0], *units[f][1:]).alias(f) for f, ks in keys.items()]
    return metrics.select("ticker", *cols, F.concat_ws(",", F.array_sort(F.array_compact(F.array(*gone)))).alias("absent"))


def newest(payloads: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """Each key's newest payload (all other columns)."""
    rest = [c for c in payloads.columns if c not in keys]
    by = F.struct(*([order] if isinstance(order, str) else order))
    return payloads.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_p")).select(*keys, "_p.*")


def with_defaults(base: DataFrame, values: DataFrame, keys: list[str], defaults: dict[str, float]) -> DataFrame:
    """Left join, with the default where a value is missing."""
    return base.join(values.select(*keys, *defaults), keys, "left").fillna(defaults)


def implied_over_realized(df: DataFrame) -> DataFrame:
    """Implied over realised volatility; 1 where either is missing or not positive."""
    ok = (F.col("atm_iv") > 0) & (F.col("realized_vol_20d") > 0)
    return df.withColumn("iv_vs_rv", F.when(ok, F.col("atm_iv") / F.col("realized_vol_20d")).otherwise(1.0))


def revision(df: DataFrame, newest_first: list[str]) -> DataFrame:
    """Percent change of the first column against the third, and the steps from newest to oldest before the first fall or gap."""
    a, b = F.col(newest_first[0]), F.col(newest_first[2])
    ups = F.array(*[F.coalesce(F.col(x) >= F.col(y), F.lit(False)) for x, y in zip(newest_first, newest_first[1:])])
    stop = F.array_position(ups, F.lit(False))
    return df.withColumn("revision_4w", (a - b) / F.nullif(F.abs(b), F.lit(0.0)) * 100).withColumn("streak", F.when(stop == 0, F.size(ups)).otherwise(stop - 1).cast("long"))


def analyst_label(buys: Column, holds: Column, sells: Column) -> Column:
    """Buy, Sell or Hold from the number of each; null without any."""
    return F.when(buys + holds + sells == 0, F.lit(None)).when((buys > sells) & (buys >= holds), "Buy").when(sells > buys, "Sell").otherwise("Hold")


def options_signals(chain: DataFrame, target: int = 30, low: int = 15, high: int = 60) -> DataFrame:
    """Of the expiry nearest to the target days (the earlier on ties): put/call open interest, mean volatility at the money, expected move.

    chain: ticker, days, kind ('call'/'put'), open_interest, iv, moneyness. At the money is the smallest |moneyness| of each kind."""
    within = chain.where(F.col("days").between(low, high))
    by = F.struct(F.abs(F.col("days") - target), F.col("days"))
    expiry = within.groupBy("ticker").agg(F.min_by("days", by).alias("days"))
    near = within.join(expiry, ["ticker", "days"], "left_semi")
    g = near.groupBy("ticker", "days", "kind").agg(F.sum("open_interest").alias("oi"), F.min_by("iv", F.struct(F.abs("moneyness"), "iv")).alias("iv"))
    side = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    out = g.groupBy("ticker", "days").agg((side("put", "oi") / F.nullif(side("call", "oi"), F.lit(0.0))).alias("put_call_ratio"), F.avg("iv").alias("atm_iv"))
    return out.withColumn("expected_move", F.col("atm_iv") * F.sqrt(F.col("days") / 365))


def recent_summary(filings: DataFrame, as_of: str, days: int = 90, keep: int = 10) -> DataFrame:
    """Per ticker the filings of the last days, their value, age of the newest, and the ids of the newest few.

    filings: ticker, filing_id, date, value."""
    day = F.lit(as_of).cast("date")
    w = Window.partitionBy("ticker").orderBy(F.desc("date"), F.desc("filing_id"))
    f = filings.where(F.col("date").between(F.date_sub(day, days), day)).withColumn("n", F.row_number().over(w))
    ids = F.array_sort(F.collect_list(F.when(F.col("n") <= keep, F.col("filing_id"))))
    return f.groupBy("ticker").agg(F.count(F.lit(1)).alias("filings"), F.sum("value").alias("value"), F.min(F.datediff(day, "date")).alias("days_ago"), F.array_join(ids.cast("array<string>"), ",").alias("newest"))
