"""Reports over series, filings and gates: snapshots, ranks, changes, verdicts, routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.windows import cosine, full, lag, safe

# Index and fund symbols that are no stocks, the benchmark that stays, and the prefix of sector funds.
NO_STOCKS = ["SPY", "VIX", "VIX3M", "TNX", "IRX", "GLD", "USO", "^VIX", "^VIX3M", "^TNX", "^IRX", "SMH", "IGV", "XBI", "PPH", "XOP", "KRE", "ITA", "GDX"]
BENCHMARK, SECTOR_PREFIX = "SPY", "XL"


def admitted_stocks(bars: DataFrame, least: int = 265, tail: int = 585) -> DataFrame:
    """Bars of stocks with enough history and of the benchmark, each ticker's newest rows; other indexes and funds are no members."""
    stock = ~F.col("ticker").isin(NO_STOCKS) & ~F.col("ticker").startswith(SECTOR_PREFIX)
    by = Window.partitionBy("ticker")
    df = bars.where(stock | (F.col("ticker") == BENCHMARK)).withColumns({"_n": F.count(F.lit(1)).over(by), "_k": F.row_number().over(by.orderBy(F.desc("date")))})
    return df.where((F.col("_n") >= least) & (F.col("_k") <= tail)).drop("_n", "_k")


def macro_levels(series: DataFrame, names: dict[str, str], long: str, short: str, prices: str) -> DataFrame:
    """One row: each series' newest known value under its name, the slope between two of them in basis points to one digit, and the yearly change of the price index in percent.

    series: series_id, date, value; a missing observation is null. The price index is monthly: its newest value against that 12 observations before."""
    known = series.where(F.col("value").isNotNull())
    last = known.where(F.col("series_id").isin(list(names))).groupBy("series_id").agg(F.max_by("value", "date").alias("v"))
    one = last.agg(*[F.max(F.when(F.col("series_id") == k, F.col("v"))).alias(n) for k, n in names.items()])
    w = Window.orderBy(F.desc("date"))
    index = known.where(F.col("series_id") == prices).withColumn("_k", F.row_number().over(w)).where("_k in (1, 13)")  # a monthly index
    cpi = index.agg(F.max(F.when(F.col("_k") == 1, F.col("value"))).alias("_a"), F.max(F.when(F.col("_k") == 13, F.col("value"))).alias("_b"))
    slope = F.round((F.col(names[long]) - F.col(names[short])) * 100, 1)
    return one.withColumn("yield_curve_slope", slope).crossJoin(F.broadcast(cpi.select(((safe(F.col("_a"), F.col("_b")) - 1) * 100).alias("cpi_yoy"))))  # one row each


def latest_surprises(reports: DataFrame, keep: int = 4) -> DataFrame:
    """(ticker, surprises): the newest few reports as (date, actual, estimated, surprise_pct), a missing surprise taken from actual and estimate.

    reports: ticker, date, actual, estimated, surprise_pct."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    from_both = F.round((F.col("actual") - F.col("estimated")) / F.abs(F.nullif("estimated", F.lit(0.0))) * 100, 2)
    df = reports.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= keep).withColumn("surprise_pct", F.coalesce("surprise_pct", from_both))
    row = F.struct("_k", "date", "actual", "estimated", "surprise_pct")
    return df.groupBy("ticker").agg(F.transform(F.array_sort(F.collect_list(row)), lambda s: F.struct(s["date"].alias("date"), s["actual"].alias("actual"), s["estimated"].alias("estimated"), s["surprise_pct"].alias("surprise_pct"))).alias("surprises"))


def volatility_rank(bars: DataFrame, implied: DataFrame, least: int = 10, enough: int = 30, days: int = 252) -> DataFrame:
    """(ticker, iv_rank): the share, in percent to one digit, of the last year's 20-row realised volatilities below the implied one (ticker, atm_iv); null with too little history."""
    by = Window.partitionBy("ticker").orderBy("date")
    df = bars.withColumn("_k", F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))).where(F.col("_k") <= days)
    df = df.withColumn("_r", safe(F.col("close"), F.lag("close").over(by)) - 1).withColumn("_v", full(20, F.stddev_samp("_r"), "_r") * F.sqrt(F.lit(252)))
    g = df.join(implied, "ticker").groupBy("ticker").agg(F.count(F.lit(1)).alias("_n"), F.count("_v").alias("_m"), F.avg((F.col("_v") < F.col("atm_iv")).cast("double")).alias("_s"))
    return g.select("ticker", F.when((F.col("_n") >= enough) & (F.col("_m") >= least), F.round(F.col("_s") * 100, 1)).alias("iv_rank"))


def filing_changes(centroids: DataFrame, lazy: float = 0.05, risk: str = "Risk Factors", moved: float = 0.90) -> DataFrame:
    """The newest filing of each (ticker, doc_type) against the one before: similarity of their centroids and of each section's that both have, least change first.

    centroids: ticker, doc_type, filed_date, section (null for the whole filing), centroid, n. Adds change_score, lazy_flag and risk_factor_change_flag."""
    key = ["ticker", "doc_type"]
    dates = centroids.where("section is null").select(*key, "filed_date").distinct()
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("filed_date")))
    two = dates.withColumn("_k", nth).where("_k <= 2")
    c = centroids.join(two, [*key, "filed_date"])
    part = lambda k: c.where(F.col("_k") == k).select(*key, F.coalesce("section", F.lit("")).alias("section"), F.col("centroid").alias(f"c{k}"), F.col("filed_date").alias(f"d{k}"), F.col("n").alias(f"n{k}"))
    both = part(1).join(part(2), [*key, "section"]).withColumn("_s", cosine(F.col("c1"), F.col("c2")))
    whole = lambda x: F.max(F.when(F.col("section") == "", x))
    g = both.groupBy(*key).agg(whole(F.col("d2")).alias("prev_date"), whole(F.col("d1")).alias("curr_date"), whole(F.round("_s", 4)).alias("overall_similarity"), whole(F.round(1 - F.col("_s"), 4)).alias("change_score"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("section") != "", F.struct("section", F.round("_s", 4)))))).alias("section_similarities"), whole(F.col("n2")).alias("n_prev_chunks"), whole(F.col("n1")).alias("n_curr_chunks"))
    g = g.where("change_score is not null").withColumns({"lazy_flag": F.col("change_score") < lazy, "risk_factor_change_flag": F.coalesce(F.col("section_similarities")[risk] < moved, F.lit(False))})
    return g.orderBy("change_score", *key)


def lookback(tickers: DataFrame, marks: DataFrame, now: str, least: int, most: int) -> DataFrame:
    """(ticker, hours) of tickers that are due: one window for all, from the oldest mark and a tenth more, or the longest if one was never taken in; none if all are current.

    marks: ticker, mark (timestamp)."""
    at = F.lit(now).cast("timestamp")
    age = (at.cast("double") - F.col("mark").cast("double")) / 3600
    due = tickers.select("ticker").distinct().join(marks, "ticker", "left").withColumn("_a", age).where(F.col("mark").isNull() | (F.col("_a") >= least))
    span = due.agg(F.max(F.col("mark").isNull()).alias("_new"), F.max("_a").alias("_old"))
    hours = F.when(F.col("_new"), F.lit(most)).otherwise(F.least(F.lit(most), F.greatest(F.lit(least), F.floor(F.col("_old") * 1.1).cast("int") + 1))).cast("int")
    return due.crossJoin(F.broadcast(span)).select("ticker", hours.alias("hours"))  # one row for all


def splice_verdicts(history: DataFrame, incoming: DataFrame, applied: DataFrame, soft: float = 1.5, tolerance: float = 0.02) -> DataFrame:
    """ticker, date, close (restated where needed), verdict (ok, restated, refused, unexplained) of each incoming row against the ticker's history.

    A gap that a split applied to the store (ticker, ex_date, factor) with a later ex-date explains is restated by that factor. A split-like difference from a stored row of
    the same date is refused, the market moves no row; without such a row the gap may be a real move, and the row passes as unexplained."""
    day = incoming.select("ticker", "date", "close")
    both = history.select("ticker", "date", F.col("close").alias("_h"), F.lit(None).cast("double").alias("close")).unionByName(day.withColumn("_h", F.lit(None).cast("double")))
    both = both.groupBy("ticker", "date").agg(F.max("_h").alias("_h"), F.max("close").alias("close"))
    before = F.last("_h", ignorenulls=True).over(Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    d = both.withColumn("_p", before).where("close is not null").withColumn("_r", safe(F.col("close"), F.when(F.col("_p") > 0, F.col("_p"))))
    inside = lambda r: (r > 1 / soft) & (r < soft)
    s = applied.where("factor > 0").select("ticker", "ex_date", "factor")
    why = d.join(s, "ticker").where((F.col("ex_date") > F.col("date")) & (F.abs(F.col("_r") * F.col("factor") - 1) <= tolerance)).groupBy("ticker", "date").agg(F.min_by("factor", "ex_date").alias("_f"))
    d = d.join(why, ["ticker", "date"], "left")
    verdict = F.when(F.col("_r").isNull() | (F.col("close") <= 0) | inside(F.col("_r")), "ok").when(F.col("_f").isNotNull(), "restated").when((F.col("_h") > 0) & ~inside(F.col("close") / F.col("_h")), "refused").otherwise("unexplained")
    return d.withColumn("verdict", verdict).select("ticker", "date", F.when(F.col("verdict") == "restated", F.col("close") * F.col("_f")).otherwise(F.col("close")).alias("close"), "verdict")


def scoped_reconciliation(a: DataFrame, b: DataFrame, actions: DataFrame, since: str, tolerance: float = 0.01, days: int = 5) -> DataFrame:
    """Per ticker the largest relative deviation of two close series since a date, both based on their first common date there, its date, the verdict, and the action nearest to that date.

    actions: ticker, ex_date. Tickers without common dates are no_overlap."""
    j = a.select("ticker", "date", F.col("close").alias("x")).join(b.select("ticker", "date", F.col("close").alias("y")), ["ticker", "date"]).where(F.col("date") >= F.lit(since).cast("date"))
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dev = F.abs(safe(F.col("x") / F.first("x").over(w), F.col("y") / F.first("y").over(w)) - 1)
    g = j.withColumn("d", dev).groupBy("ticker").agg(F.max("d").alias("max_deviation"), F.max_by("date", F.struct("d", "date")).alias("at"), F.count(F.lit(1)).alias("n"))
    near = g.join(actions.select("ticker", "ex_date").distinct(), "ticker").withColumn("_d", F.abs(F.datediff("ex_date", "at"))).where(F.col("_d") <= days).groupBy("ticker").agg(F.min_by("ex_date", F.struct("_d", "ex_date")).alias("nearest_action"))
    names = a.select("ticker").union(b.select("ticker")).distinct()
    out = names.join(g, "ticker", "left").join(near, "ticker", "left")
    verdict = F.when(F.col("n").isNull(), "no_overlap").when(F.col("max_deviation") <= tolerance, "within_tol").otherwise("out_of_tol")
    return out.select("ticker", verdict.alias("verdict"), "max_deviation", "at", F.when(F.col("max_deviation") > tolerance, F.col("nearest_action")).alias("nearest_action"))


def drift_status(expected: DataFrame, present: DataFrame, most: int, key: str = "ticker") -> DataFrame:
    """One row: how many keys are missing and how many are extra, and whether either is more than the threshold."""
    side = lambda d, c: d.select(key).distinct().withColumn(c, F.lit(1))
    j = side(expected, "_e").join(side(present, "_p"), key, "full_outer")
    g = j.agg(F.count_if(F.col("_p").isNull()).alias("missing"), F.count_if(F.col("_e").isNull()).alias("extra"))
    return g.withColumn("status", F.when((F.col("missing") > most) | (F.col("extra") > most), "drift").otherwise("ok"))


def fresh_or_gap(bars: DataFrame, asked: DataFrame, sessions: int) -> tuple[DataFrame, DataFrame]:
    """The bars of asked tickers whose last one is among the panel's newest sessions, and the asked tickers (ticker) without such bars."""
    floor = bars.select("date").distinct().orderBy(F.desc("date")).limit(sessions).agg(F.min("date")).first()[0]
    ok = bars.groupBy("ticker").agg(F.max("date").alias("_l")).where(F.col("_l") >= F.lit(floor)).select("ticker").join(asked.select("ticker").distinct(), "ticker", "left_semi")
    return bars.join(ok, "ticker", "left_semi"), asked.select("ticker").distinct().join(ok, "ticker", "left_anti")


def release_dates(events: DataFrame, day: str, horizon: int) -> DataFrame:
    """(kind, dates): the distinct dates of each kind from the day on within the horizon, sorted."""
    at = F.lit(day).cast("date")
    return events.where(F.col("date").between(at, F.date_add(at, horizon))).groupBy("kind").agg(F.array_sort(F.collect_set("date")).alias("dates"))


def quarantine(statuses: DataFrame, bad: list[str]) -> DataFrame:
    """(status, n, tickers): a tally of the statuses of (ticker, status), with the sorted tickers of the bad ones only."""
    gated = F.array_sort(F.collect_set(F.when(F.col("status").isin(bad), F.col("ticker"))))
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n"), gated.alias("tickers"))


def reconciled_load(loaded: DataFrame, recorded: int, key: str = "ticker") -> DataFrame:
    """One row: loaded keys, recorded ones, and the shortfall; that nothing at all was loaded is an error."""
    n = loaded.select(key).distinct().count()
    if not n:
        raise ValueError(f"none of {recorded} {key}s was loaded")
    return loaded.sparkSession.range(1).select(F.lit(n).cast("long").alias("loaded"), F.lit(recorded).cast("long").alias("recorded"), F.lit(max(0, recorded - n)).cast("long").alias("shortfall"))


def energy_and_credit(frame: DataFrame) -> DataFrame:
    """(date, oil_mom_5d, hy_oas_credit_spread_pct) of an aligned frame; a series that the frame lacks, or does not know yet, is 0."""
    w = Window.orderBy("date")
    has = lambda c: F.col(c) if c in frame.columns else F.lit(None).cast("double")
    df = frame.select("date", has("USO").alias("_o"), has("HYOAS").alias("_h"))
    return df.select("date", F.coalesce(safe(F.col("_o"), lag("_o", 5, w)) - 1, F.lit(0.0)).alias("oil_mom_5d"), F.coalesce("_h", F.lit(0.0)).alias("hy_oas_credit_spread_pct"))
