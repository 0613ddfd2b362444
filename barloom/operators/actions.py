"""Corporate actions: restatement, evidence, total return, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def action_id(df: DataFrame) -> DataFrame:
    """Content-hashed ids of (type, ticker, ex_date, split_from, split_to, cash_amount)."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("type", "ticker", "ex_date", "split_from", "split_to", "cash_amount")]
    return df.withColumn("action_id", F.sha2(F.concat_ws("|", *cols), 256))


def later_product(rows: DataFrame, events: DataFrame, out: str) -> DataFrame:
    """For each row the product of `factor` over its ticker's events (ticker, ex_date, factor) with ex_date after the row's date; no range join: events and rows are sorted together."""
    e = events.groupBy("ticker", "ex_date").agg(F.product("factor").alias("_f"))
    held = F.struct(*[F.col(c) for c in rows.columns])
    both = rows.select("ticker", "date", held.alias("_row"), F.lit(1.0).alias("_f"), F.lit(1).alias("_q"))
    both = both.unionByName(e.select("ticker", F.col("ex_date").alias("date"), "_f", F.lit(0).alias("_q")), allowMissingColumns=True)
    # on one date events come first, so they reach earlier rows only
    w = Window.partitionBy("ticker").orderBy("date", "_q").rowsBetween(1, Window.unboundedFollowing)
    return both.withColumn(out, F.coalesce(F.product("_f").over(w), F.lit(1.0))).where("_q = 1").select("_row.*", out)


def restate_splits(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """Prices times, and volume over, the cumulative split factor of later events (split_from / split_to)."""
    events = splits.select("ticker", "ex_date", (F.col("split_from") / F.col("split_to")).alias("factor"))
    df = later_product(bars, events, "split_factor")
    f = F.col("split_factor")
    return df.withColumns({c: F.col(c) * f for c in ("open", "high", "low", "close") if c in bars.columns} | {"volume": F.bround(F.col("volume") / f)})


def total_return(bars: DataFrame, dividends: DataFrame) -> DataFrame:
    """Closes restated for dividends (ticker, ex_date, cash_amount): a factor 1 - cash / close before, over all earlier rows.

    Dividends that share the row before them add up; those before any row, or that are worth the whole close, count for nothing."""
    d = dividends.groupBy("ticker", "ex_date").agg(F.sum("cash_amount").alias("cash"))
    both = bars.select("ticker", "date", "close", F.lit(0.0).alias("cash"), F.lit(1).alias("q")).union(d.select("ticker", F.col("ex_date").alias("date"), F.lit(None).cast("double"), "cash", F.lit(0)))
    w = Window.partitionBy("ticker").orderBy("date", "q")
    prev = F.last(F.when(F.col("q") == 1, F.struct("date", "close")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    per = both.withColumn("_p", prev).where("q = 0 and _p is not null").groupBy("ticker", F.col("_p.date").alias("date"), F.col("_p.close").alias("c")).agg(F.sum("cash").alias("cash"))
    f = per.where("cash < c and c > 0").select("ticker", "date", (1 - F.col("cash") / F.col("c")).alias("_f"))
    df = bars.join(f, ["ticker", "date"], "left").withColumn("_f", F.coalesce("_f", F.lit(1.0)))
    here = Window.partitionBy("ticker").orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn("total_return_close", F.col("close") * F.product("_f").over(here)).drop("_f")


def orientation(splits: DataFrame, bars: DataFrame, days: int = 4, tolerance: float = 0.15, small: float = 1.45) -> DataFrame:
    """What the prices say of each split: direct, inverse, ambiguous, none, or uncovered where no bars are near."""
    w = Window.partitionBy("ticker").orderBy("date")
    moves = bars.select("ticker", "date", (F.col("close") / F.lag("close").over(w)).alias("move")).where("move is not null")
    s = splits.withColumn("f", F.col("split_from") / F.col("split_to"))
    near = s.join(moves, (s.ticker == moves.ticker) & (F.abs(F.datediff(moves.date, s.ex_date)) <= days), "left").drop(moves.ticker)
    fits = lambda r: F.abs(F.col("move") / r - 1) <= tolerance
    g = near.groupBy("ticker", "ex_date", "f").agg(F.count("move").alias("n"), F.max(fits(F.col("f"))).alias("d"), F.max(fits(1 / F.col("f"))).alias("i"))
    d, i = F.col("d"), F.col("i") & ~F.col("f").between(1 / small, small)
    status = F.when(F.col("n") == 0, "uncovered").when(d & i, "ambiguous").when(d, "direct").when(i, "inverse").otherwise("none")
    return g.select("ticker", "ex_date", F.col("f").alias("factor"), F.col("n").alias("moves"), status.alias("evidence"))


def residual_jumps(bars: DataFrame, splits: DataFrame, screen: float = 0.18, days: int = 4, tolerance: float = 0.15) -> DataFrame:
    """Large moves, each missed (a split nearby explains it) or suspected (none does)."""
    w = Window.partitionBy("ticker").orderBy("date")
    j = bars.select("ticker", "date", (F.col("close") / F.lag("close").over(w)).alias("move")).where(F.abs(F.col("move") - 1) > screen)
    s = splits.select(F.col("ticker").alias("t"), "ex_date", (F.col("split_from") / F.col("split_to")).alias("f"))
    fits = (F.abs(F.col("move") / F.col("f") - 1) <= tolerance) | (F.abs(F.col("move") * F.col("f") - 1) <= tolerance)
    g = j.join(s, (F.col("ticker") == F.col("t")) & (F.abs(F.datediff("date", "ex_date")) <= days) & fits, "left")
    return g.groupBy("ticker", "date", "move").agg(F.min("ex_date").alias("explained_by")).withColumn("kind", F.when(F.col("explained_by").isNotNull(), "missed").otherwise("suspected"))


def splice_guard(bars: DataFrame, limit: float = 1.5) -> DataFrame:
    """Whether each bar continues its history: ok, split_like (the ratio is a whole number or its inverse within 0.5 %), or refused."""
    r = F.col("close") / F.lag("close").over(Window.partitionBy("ticker").orderBy("date"))
    big = F.greatest(r, 1 / r)
    whole = (F.abs(big / F.bround(big) - 1) <= 0.005) & F.bround(big).between(2, 50)
    return bars.select("ticker", "date", r.alias("ratio"), F.when(r.isNull() | (big <= limit), "ok").when(whole, "split_like").otherwise("refused").alias("verdict"))
