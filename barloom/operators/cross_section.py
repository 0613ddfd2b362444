"""Operators across the names of a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.selection import medians

MAD = 1.4826


def unpivot(df: DataFrame, ids: list[str], cols: list[str], name: str = "factor", value: str = "x") -> DataFrame:
    return df.unpivot(ids, cols, name, value)


def robust_zscores(long: DataFrame, keys: tuple[str, ...] = ("factor", "date"), x: str = "x", clip: float = 3.0) -> DataFrame:
    """Winsorised z-scores: clip at median +- 3 scaled MADs, then centre and scale by the population deviation.

    Missing values stay so and count for nothing. Null where a cross-section has fewer than two values, no spread around its median, or no deviation. Works on the long
    form: one shuffle by factor and date, whatever the number of columns; medians and deviations are windows over it."""
    w = Window.partitionBy(*keys)
    df = long.withColumns({"_med": F.median(x).over(w), "_n": F.count(x).over(w)})
    df = df.withColumn("_mad", F.median(F.abs(F.col(x) - F.col("_med"))).over(w) * MAD)
    df = df.withColumn("_w", F.when(F.col(x).isNotNull(), F.least(F.greatest(F.col(x), F.col("_med") - clip * F.col("_mad")), F.col("_med") + clip * F.col("_mad"))))
    df = df.withColumns({"_mu": F.avg("_w").over(w), "_sd": F.stddev_pop("_w").over(w)})
    z = F.when((F.col("_n") >= 2) & (F.col("_mad") > 0) & (F.col("_sd") > 0), (F.col("_w") - F.col("_mu")) / F.col("_sd"))
    return df.withColumn("z", z).drop("_med", "_n", "_mad", "_w", "_mu", "_sd")


def robust_zscores_wide(df: DataFrame, by: str, columns: list[str], clip: float = 3.0) -> DataFrame:
    """df with each of these columns replaced by its `robust_zscores` among the rows of `by`: one shuffle and sort of the rows as they are, where the long form moves and sorts a row for each column.

    A task holds the rows of one value of `by`, with all columns."""
    w = Window.partitionBy(by)
    name = lambda kind: {c: F.col(f"_{kind}_{c}") for c in columns}
    med, n, mad, cut, mu, sd = map(name, ("med", "n", "mad", "w", "mu", "sd"))
    df = df.withColumns({f"_med_{c}": F.median(c).over(w) for c in columns} | {f"_n_{c}": F.count(c).over(w) for c in columns})
    df = df.withColumns({f"_mad_{c}": F.median(F.abs(F.col(c) - med[c])).over(w) * MAD for c in columns})
    df = df.withColumns({f"_w_{c}": F.when(F.col(c).isNotNull(), F.least(F.greatest(c, med[c] - clip * mad[c]), med[c] + clip * mad[c])) for c in columns})
    df = df.withColumns({f"_mu_{c}": F.avg(cut[c]).over(w) for c in columns} | {f"_sd_{c}": F.stddev_pop(cut[c]).over(w) for c in columns})
    df = df.withColumns({c: F.when((n[c] >= 2) & (mad[c] > 0) & (sd[c] > 0), (cut[c] - mu[c]) / sd[c]) for c in columns})
    return df.drop(*[f"_{kind}_{c}" for kind in ("med", "n", "mad", "w", "mu", "sd") for c in columns])


#: Rows of a group that are joined with its numbers in one task; larger groups are dealt over several.
SHARE = 1 << 18


def with_numbers(rows: DataFrame, numbers: DataFrame, on: list[str], share: int = SHARE) -> DataFrame:
    """Rows joined with their group's numbers (one row a group, `_n` values in it; rows of other groups get nulls). A group of more than `share` values is cut into parts, each with a copy of the numbers.

    The groups that are cut are at most rows / share, so their names can be sent to all tasks."""
    cut = numbers.where(F.col("_n") > share).select(*on, F.ceil(F.col("_n") / share).alias("_parts"))
    dealt = rows.join(F.broadcast(cut), on, "left").withColumn("_part", F.coalesce(F.monotonically_increasing_id() % F.col("_parts"), F.lit(0).cast("bigint"))).drop("_parts")
    copies = numbers.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("_n") / share), F.lit(1)) - 1)))
    return dealt.join(copies, [*on, "_part"], "left").drop("_part")


def robust_zscores_counted(long: DataFrame, keys: tuple[str, ...] = ("factor", "date"), x: str = "x", clip: float = 3.0) -> DataFrame:
    """`robust_zscores` for groups of any size: medians by counting, mean and deviation by map-side sums; rows are joined with their group's numbers, and a hot group can be split.

    x as double; keys must not be null. Rows keep all their columns."""
    on = list(keys)
    rows = long.withColumn(x, F.col(x).cast("double"))
    values = rows.where(F.col(x).isNotNull()).select(*on, x)
    middle = medians(rows, on, x, "_med", "_n").localCheckpoint()  # one row a group, and so are the next two: their plans would be repeated in each that follows
    far = with_numbers(values, middle, on).withColumn("_far", F.abs(F.col(x) - F.col("_med")))
    mad = medians(far, on, "_far", "_mad", "_m").drop("_m").localCheckpoint()
    known = middle.join(mad, on, "left").withColumn("_mad", F.col("_mad") * MAD)
    held = F.least(F.greatest(F.col(x), F.col("_med") - clip * F.col("_mad")), F.col("_med") + clip * F.col("_mad"))
    spread = with_numbers(values, known, on).withColumn("_w", held).groupBy(*on).agg(F.avg("_w").alias("_mu"), F.stddev_pop("_w").alias("_sd"))
    df = with_numbers(rows, known.join(spread, on).localCheckpoint(), on).withColumn("_w", F.when(F.col(x).isNotNull(), held))
    z = F.when((F.col("_n") >= 2) & (F.col("_mad") > 0) & (F.col("_sd") > 0), (F.col("_w") - F.col("_mu")) / F.col("_sd"))
    return df.select(*long.columns, z.alias("z"))


def zscores(df: DataFrame, x: str, out: str) -> DataFrame:
    """Plain z-scores with the sample deviation; null where that is not above 1e-9."""
    day = Window.partitionBy("date")
    sd = F.stddev_samp(x).over(day)
    return df.withColumn(out, F.when(sd > 1e-9, (F.col(x) - F.avg(x).over(day)) / sd))


def _days(panel: DataFrame, quantile: float, min_names: int) -> DataFrame:
    """factor, date, factor_return, names and the mean and deviation of all loadings (mu, sd), of days with enough names: one shuffle by day."""
    before = Window.partitionBy("factor", "ticker").orderBy("date")
    df = panel.withColumn("l", F.lag("loading").over(before)).withColumn("valid", F.expr("l is not null and ret is not null"))
    day = Window.partitionBy("factor", "date")
    df = df.withColumns({"n": F.count(F.when(F.col("valid"), 1)).over(day), "rn": F.row_number().over(day.orderBy(F.desc("valid"), "l", "ticker"))}).where(F.col("n") >= min_names)
    k = F.greatest(F.expr(f"bround(n * {quantile})"), F.lit(1))
    top, bottom = (F.avg(F.when(F.col("valid") & at, F.col("ret"))) for at in (F.col("rn") > F.col("n") - k, F.col("rn") <= k))
    return df.groupBy("factor", "date").agg((top - bottom).alias("factor_return"), F.max("n").alias("names"), F.avg("loading").alias("mu"), F.stddev_samp("loading").alias("sd"))


def factor_returns(panel: DataFrame, quantile: float = 0.3, min_names: int = 20) -> DataFrame:
    """Long-short returns per (factor, date): the mean return of the top names by the loading of the day before, less the bottom's.

    panel: ticker, date, factor, loading, ret. Ties go by ticker."""
    return _days(panel, quantile, min_names).drop("mu", "sd")


def factor_momentum(returns: DataFrame, window: int = 231, skip: int = 21) -> DataFrame:
    """The sum of `window` daily factor returns, `skip` sessions ago."""
    by = Window.partitionBy("factor").orderBy("date")
    w = by.rowsBetween(-(window - 1), 0)
    df = returns.withColumn("_s", F.when(F.count("factor_return").over(w) == window, F.sum("factor_return").over(w)))
    return df.withColumn("momentum", F.lag("_s", skip).over(by)).drop("_s")


def factor_momentum_ratio(panel: DataFrame, window: int = 231, skip: int = 21, quantile: float = 0.3, min_names: int = 20) -> DataFrame:
    """For each (ticker, date) the mean over factors of its z-scored loading times the factor's momentum."""
    days = factor_momentum(_days(panel, quantile, min_names), window, skip).select("factor", "date", "momentum", "mu", "sd")
    z = F.when(F.col("sd") > 1e-9, (F.col("loading") - F.col("mu")) / F.col("sd"))
    rows = panel.select("ticker", "date", "factor", "loading").join(F.broadcast(days), ["factor", "date"])  # a row a factor and day, however many names
    return rows.groupBy("ticker", "date").agg(F.avg(z * F.col("momentum")).alias("factor_momentum_ratio"))


def breadth(features: DataFrame) -> DataFrame:
    """Per date: share of names above their 50- and 200-row means, and advancing against declining names over five sessions."""
    above = lambda c: F.avg((F.col(c) > 0).cast("double"))
    return features.groupBy("date").agg(above("price_vs_ma50").alias("pct_above_50"), above("price_vs_ma200").alias("pct_above_200"), F.sum((F.col("momentum_5d") > 0).cast("int")).alias("advancing"), F.sum((F.col("momentum_5d") < 0).cast("int")).alias("declining"), F.count(F.lit(1)).alias("names"))


def positive_medians(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Exact medians of positive values per group, with their number; found by counting, so that no group meets in one task. Groups without positive values have nulls."""
    long = df.select(*by, *[F.when((F.col(c) > 0) & (F.col(c) < float("inf")), F.col(c).cast("double")).alias(c) for c in cols]).unpivot(by, cols, "_column", "_x")
    found = medians(long, [*by, "_column"], "_x", "_median", "_n")
    groups = df.select(*by).distinct()
    aggs = [a for c in cols for a in (F.max(F.when(F.col("_column") == c, F.col("_median"))).alias(f"median_{c}"), F.coalesce(F.max(F.when(F.col("_column") == c, F.col("_n"))), F.lit(0)).alias(f"n_{c}"))]
    wide = found.groupBy(*by).agg(*aggs)
    on = F.lit(True)
    for k in by:
        on = on & groups[k].eqNullSafe(wide[k])
    return groups.join(wide, on, "left").select(*[groups[k] for k in by], *[x for c in cols for x in (wide[f"median_{c}"], F.coalesce(wide[f"n_{c}"], F.lit(0).cast("bigint")).alias(f"n_{c}"))])


def dead_columns(df: DataFrame, cols: list[str], least: int = 20, exempt: tuple[str, ...] = ()) -> DataFrame:
    """Per column that is not exempt: values, deviation, and whether it is all null or does not vary."""
    cols = [c for c in cols if c not in exempt]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "x")
    g = long.groupBy("column").agg(F.count("x").alias("n"), F.stddev_pop("x").alias("sd"))
    return g.select("column", "n", (F.col("n") == 0).alias("all_null"), F.coalesce((F.col("n") >= least) & (F.col("sd") == 0), F.lit(False)).alias("zero_variance"))


def modal_share(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per field the share of rows that hold its most frequent value (ties: the least value)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "field", "v").where("v is not null")
    n = long.groupBy("field", "v").count()
    g = n.groupBy("field").agg(F.max(F.struct("count", F.lit(0))).alias("_m"), F.sum("count").alias("n"), F.max("count").alias("top"))
    return g.select("field", "n", (F.col("top") / F.col("n")).alias("modal_share"))


def coverage(df: DataFrame, by: str, cols: list[str], floor: float) -> DataFrame:
    """Share of rows with any of the columns, per source, against a floor."""
    has = F.coalesce(*[F.col(c).cast("string") for c in cols]).isNotNull()
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(has.cast("double")).alias("ok_ratio"))
    return g.withColumn("ok", F.col("ok_ratio") >= floor)
