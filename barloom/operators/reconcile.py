"""Two versions of one series: rebased deviation, discrepancies and their explanation, scale of archive rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebased_deviation(a: DataFrame, b: DataFrame, tolerance: float) -> DataFrame:
    """Per ticker the largest relative deviation of two close series after both are rebased to their first common date.

    Status: within_tol, out_of_tol, or no_overlap."""
    x = a.select("ticker", "date", F.col("close").alias("a")).where("a > 0")
    y = b.select("ticker", "date", F.col("close").alias("b")).where("b > 0")
    both = x.join(y, ["ticker", "date"])
    first = both.groupBy("ticker").agg(F.min_by(F.struct("a", "b"), "date").alias("f"))
    dev = F.abs((F.col("a") / F.col("f.a")) / (F.col("b") / F.col("f.b")) - 1)
    worst = both.join(first, "ticker").groupBy("ticker").agg(F.count(F.lit(1)).alias("common"), F.max(dev).alias("deviation"))
    got = a.select("ticker").distinct().join(worst, "ticker", "left")
    status = F.when(F.col("common").isNull(), "no_overlap").when(F.col("deviation") <= tolerance, "within_tol").otherwise("out_of_tol")
    return got.select("ticker", F.coalesce("common", F.lit(0)).cast("long").alias("common"), "deviation", status.alias("status"))


def discrepancies(old: DataFrame, new: DataFrame, events: DataFrame, warn: float = 0.01, error: float = 0.05, tolerance: float = 0.005, restated: DataFrame | None = None) -> DataFrame:
    """Cells whose close changed by more than the warning level, as warning, error, explained, or restated: an index whose only source revises it (`restated` has their tickers).

    An error is explained by an event of the ticker (ticker, ex_date, factor) from 3 days before to 60 days after, whose factor or inverse fits the ratio; of several the earliest one counts."""
    both = old.select("ticker", "date", F.col("close").alias("prior")).join(new.select("ticker", "date", F.col("close").alias("now")), ["ticker", "date"]).where("prior > 0 and now > 0")
    both = both.withColumn("ratio", F.col("now") / F.col("prior")).withColumn("change", F.abs(F.col("ratio") - 1)).where(F.col("change") > warn)
    fits = (F.abs(F.col("ratio") / F.col("factor") - 1) <= tolerance) | (F.abs(F.col("ratio") * F.col("factor") - 1) <= tolerance)
    near = both.select("ticker", "date", "ratio").join(events, "ticker").where(F.col("ex_date").between(F.date_sub("date", 3), F.date_add("date", 60)) & fits)
    why = near.groupBy("ticker", "date").agg(F.min("ex_date").alias("explained_by"))
    if restated is None:
        both = both.withColumn("_revised", F.lit(False))
    else:
        names = restated.select("ticker").distinct().withColumn("_revised", F.lit(True))
        both = both.join(names, "ticker", "left").fillna(False, ["_revised"])
    level = F.when(F.col("change") <= error, "warning").when(F.col("_revised"), "restated").when(F.col("explained_by").isNotNull(), "explained").otherwise("error")
    return both.join(why, ["ticker", "date"], "left").withColumn("level", level).drop("_revised")


def uniform_groups(errors: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Per ticker whether its unexplained ratios, of two dates at least, agree within the tolerance of their mean: one event then (ticker, date, ratio)."""
    mean = errors.groupBy("ticker").agg(F.avg("ratio").alias("mean_ratio"), F.count(F.lit(1)).alias("dates"), F.max("ratio").alias("hi"), F.min("ratio").alias("lo"))
    one = (F.col("dates") >= 2) & (F.greatest(F.col("hi") - F.col("mean_ratio"), F.col("mean_ratio") - F.col("lo")) <= tolerance * F.col("mean_ratio"))
    return mean.select("ticker", "dates", "mean_ratio", one.alias("uniform"))


def archive_scale(candidate: Column, reference: Column, factor: Column, tolerance: float) -> Column:
    """`old` where the reference is the factor away from the candidate, `new` where both are alike, else `unknown`."""
    ratio = reference / candidate
    usable = (candidate > 0) & (reference > 0) & (factor > 0)
    return F.when(usable & (F.abs(ratio - factor) <= tolerance * factor), "old").when(usable & (F.abs(ratio - 1) <= tolerance), "new").otherwise("unknown")


def touched_dates(window: DataFrame, splits: DataFrame) -> DataFrame:
    """Dates of each ticker's window before its newest split (ticker, ex_date)."""
    last = splits.groupBy("ticker").agg(F.max("ex_date").alias("ex_date"))
    return window.join(last, "ticker").where(F.col("date") < F.col("ex_date")).select("ticker", "date")


def nearest_event(rows: DataFrame, events: DataFrame, days: int) -> DataFrame:
    """Each row with the ticker's event nearest in time within so many days, the earlier one on ties; rows without one stay (ticker, ex_date)."""
    near = rows.join(events.select("ticker", "ex_date"), "ticker").where(F.abs(F.datediff("ex_date", "date")) <= days)
    best = near.groupBy("ticker", "date").agg(F.min_by("ex_date", F.struct(F.abs(F.datediff("ex_date", "date")), F.col("ex_date"))).alias("nearest"))
    return rows.join(best, ["ticker", "date"], "left")


def to_apply(evidence: DataFrame, applied: DataFrame) -> DataFrame:
    """What becomes of each split: already_applied, apply, apply_inverse, or refused (ticker, ex_date, factor, evidence; applied: ticker, ex_date).

    `use` is the factor to restate with; null for the others."""
    a = applied.select("ticker", "ex_date").distinct().withColumn("_a", F.lit(True))
    df = evidence.join(a, ["ticker", "ex_date"], "left")
    status = F.when(F.col("_a"), "already_applied").when(F.col("evidence") == "direct", "apply").when(F.col("evidence") == "inverse", "apply_inverse").otherwise("refused")
    df = df.withColumn("status", status).drop("_a")
    return df.withColumn("use", F.when(F.col("status") == "apply", F.col("factor")).when(F.col("status") == "apply_inverse", 1 / F.col("factor")))
