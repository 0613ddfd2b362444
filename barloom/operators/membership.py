"""Index membership, rosters and ownership."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def roster_changes(rosters: DataFrame) -> DataFrame:
    """ADDED and REMOVED events between consecutive rosters of (date, ticker).

    A ticker's run of rosters begins with ADDED, unless on the first date, and ends with REMOVED on the roster after its last."""
    cal = rosters.select("date").distinct().withColumn("n", F.row_number().over(Window.orderBy("date")))  # one row per roster
    df = rosters.distinct().join(cal, "date")
    w = Window.partitionBy("ticker").orderBy("n")
    df = df.withColumns({"before": F.lag("n").over(w), "after": F.lead("n").over(w)})
    added = df.where("n > 1 and (before is null or before < n - 1)").select("date", "ticker", F.lit("ADDED").alias("action"))
    gone = df.where("after is null or after > n + 1").select((F.col("n") + 1).alias("n"), "ticker").join(cal, "n").select("date", "ticker", F.lit("REMOVED").alias("action"))
    return added.union(gone)


def point_in_time(dates: DataFrame, current: DataFrame, changes: DataFrame) -> DataFrame:
    """Membership on each date, replayed backwards from the current roster: a ticker's next change on or after a date tells what it was before.

    Before ADDED it was out, before REMOVED in; with no later change it is what it is now. Membership before a date excludes that date's own change.
    A ticker's changes cut time into stretches; only those in which it was a member meet the dates that they hold, so the rows made are the members."""
    cal = dates.select("date").distinct().withColumn("n", F.row_number().over(Window.orderBy("date")))  # one row per asked date
    total = cal.agg(F.max("n")).first()[0] or 0
    c = changes.groupBy("ticker", "date").agg(F.max("action").alias("action"))
    now = current.select("ticker").distinct().withColumn("now", F.lit(True))
    ends = c.union(now.select("ticker", F.lit(None).cast("date"), F.lit("REMOVED")))  # whoever is a member now leaves at the end of time
    w = Window.partitionBy("ticker").orderBy(F.col("date").asc_nulls_last())
    stretch = ends.withColumn("after", F.lag("date").over(w)).where("action = 'REMOVED'")
    # the first asked date after the last change, and the last one up to this change, by their places in the calendar
    marks = cal.select("date", "n", F.lit(1).alias("q")).unionByName(c.select("date").distinct().select("date", F.lit(None).cast("int").alias("n"), F.lit(2).alias("q")))
    place = marks.withColumn("p", F.coalesce(F.max("n").over(Window.orderBy("date", "q").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))).where("q = 2").select("date", "p")
    s = stretch.join(place.select(F.col("date").alias("after"), F.col("p").alias("lo")), "after", "left").join(place.select("date", F.col("p").alias("hi")), "date", "left")
    s = s.select("ticker", F.coalesce("lo", F.lit(0)).alias("lo"), F.coalesce("hi", F.lit(total)).alias("hi")).where("hi > lo")
    return s.select("ticker", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))).alias("n")).join(cal, "n").select("date", "ticker")


def membership_windows(membership: DataFrame) -> DataFrame:
    return membership.groupBy("ticker").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_distinct("date").alias("dates"))


def divergence(observed: DataFrame, reference: DataFrame, since: str) -> DataFrame:
    """(ticker, action) pairs since a date that only one of two change sets has."""
    pick = lambda d: d.where(F.col("date") >= F.lit(since).cast("date")).select("ticker", "action").distinct()
    a, b = pick(observed), pick(reference)
    return a.exceptAll(b).withColumn("only_in", F.lit("observed")).union(b.exceptAll(a).withColumn("only_in", F.lit("reference")))


def holdings_by_ticker(holdings: DataFrame, top: int = 5) -> DataFrame:
    """Per (quarter, ticker): distinct holders, total shares and value, and the share of the largest `top` (null with fewer holders)."""
    h = holdings.groupBy("quarter", "ticker", "filer").agg(F.sum("shares").alias("shares"), F.sum("market_value").alias("value"))
    w = Window.partitionBy("quarter", "ticker").orderBy(F.desc("shares"), "filer")
    h = h.withColumn("rn", F.row_number().over(w))
    g = h.groupBy("quarter", "ticker").agg(F.count_distinct("filer").alias("holders"), F.sum("shares").alias("shares"), F.sum("value").alias("value"), F.sum(F.when(F.col("rn") <= top, F.col("shares"))).alias("_top"))
    return g.withColumn("top_share", F.when(F.col("holders") >= top, F.col("_top") / F.nullif("shares", F.lit(0.0)))).drop("_top")


def quarter_deltas(current: DataFrame, prior: DataFrame, keys: list[str], x: str = "shares") -> DataFrame:
    """Full outer comparison of two quarters: new, exited, increased, decreased or unchanged positions."""
    j = current.select(*keys, F.col(x).alias("now")).join(prior.select(*keys, F.col(x).alias("before")), keys, "full_outer")
    status = F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "exited").when(F.col("now") > F.col("before"), "increased").when(F.col("now") < F.col("before"), "decreased").otherwise("unchanged")
    return j.withColumn("status", status).withColumn("delta", F.coalesce("now", F.lit(0.0)) - F.coalesce("before", F.lit(0.0)))
