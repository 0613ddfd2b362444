"""Row-based windows over keyed time series. Windows count sessions, never calendar days; missing values are null, not NaN."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_ticker() -> WindowSpec:
    """Each ticker's rows in date order."""
    return Window.partitionBy("ticker").orderBy("date")


def rows(n: int, by: WindowSpec | None = None) -> WindowSpec:
    """The last n rows up to the current one."""
    return (by or by_ticker()).rowsBetween(-(n - 1), 0)


def full(n: int, agg: Column, x: str | Column, by: WindowSpec | None = None) -> Column:
    """An aggregate over n rows, null until n values of x are there."""
    return F.when(F.count(x).over(rows(n, by)) == n, agg.over(rows(n, by)))


def lag(x: str | Column, n: int, by: WindowSpec | None = None) -> Column:
    return F.lag(x, n).over(by or by_ticker())


def safe(x: Column, y: Column) -> Column:
    """Division that gives null for a zero or null divisor."""
    return x / F.nullif(y, F.lit(0.0))


def change(x: str, n: int, by: WindowSpec | None = None) -> Column:
    return safe(F.col(x), lag(x, n, by)) - 1


#: Rows after which the running sums of an EWM start anew; (1 - alpha) ** BLOCK is below 1e-16 for the spans in use.
BLOCK = 500


def ewm(df: DataFrame, x: str, alpha: float, out: str, keys: tuple[str, ...] = ("ticker",), order: str = "date") -> DataFrame:
    """e_t = alpha x_t + (1 - alpha) e_(t-1), seeded with the first value; leading nulls stay null.

    In closed form a decayed running sum: x is scaled by (1 - alpha) ** -i, summed, and scaled back. The scale starts
    anew every BLOCK rows, with the value at the end of the block before decaying into the next."""
    by = Window.partitionBy(*keys).orderBy(order)
    d = 1 - alpha
    df = df.withColumn("_i", F.sum(F.col(x).isNotNull().cast("int")).over(by) - 1)
    df = df.withColumn("_b", F.floor(F.col("_i") / BLOCK)).withColumn("_j", F.col("_i") % BLOCK)
    z = F.when(F.col("_i") == 0, F.col(x)).otherwise(alpha * F.col(x))
    inside = Window.partitionBy(*keys, "_b").orderBy(order)
    df = df.withColumn("_s", F.pow(F.lit(d), F.col("_j")) * F.sum(z * F.pow(F.lit(d), -F.col("_j"))).over(inside))
    # the last value of the block before: that of the row _j + 1 rows back
    first = F.when(F.col("_j") == 0, F.lag("_s", 1).over(by))
    df = df.withColumn("_c", F.max(first).over(inside))
    return df.withColumn(out, F.when(F.col("_i") >= 0, F.col("_s") + F.coalesce(F.pow(F.lit(d), F.col("_j") + 1) * F.col("_c"), F.lit(0.0)))).drop("_i", "_b", "_j", "_s", "_c")


def ewms(df: DataFrame, series: list[tuple[str, float, str]], keys: tuple[str, ...] = ("ticker",), order: str = "date") -> DataFrame:
    """`ewm` of several (x, alpha, out) at once, for series whose nulls only lead: all of them share two sorts."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    df = df.withColumn("_r", place).withColumns({"_b": F.floor(F.col("_r") / BLOCK), "_j": F.col("_r") % BLOCK})
    by = Window.partitionBy(*keys).orderBy("_b", order)  # the order of `inside`, so one sort serves both
    inside = Window.partitionBy(*keys, "_b").orderBy(order)
    df = df.withColumns({f"_n_{x}": F.count(x).over(by) for x, _, _ in series})
    z = lambda x, a: F.when(F.col(f"_n_{x}") == 1, F.col(x)).otherwise(a * F.col(x)) * F.pow(F.lit(1 - a), -F.col("_j"))
    df = df.withColumns({f"_s_{out}": F.pow(F.lit(1 - a), F.col("_j")) * F.sum(z(x, a)).over(inside) for x, a, out in series})
    df = df.withColumns({f"_l_{out}": F.when(F.col("_j") == 0, F.lag(f"_s_{out}", 1).over(by)) for _, _, out in series})
    df = df.withColumns({f"_c_{out}": F.max(f"_l_{out}").over(inside) for _, _, out in series})
    value = lambda x, a, out: F.when(F.col(f"_n_{x}") > 0, F.coalesce(f"_s_{out}", F.lit(0.0)) + F.coalesce(F.pow(F.lit(1 - a), F.col("_j") + 1) * F.col(f"_c_{out}"), F.lit(0.0)))
    gone = [f"_{k}_{out}" for _, _, out in series for k in "slc"] + [f"_n_{x}" for x, _, _ in series]
    return df.withColumns({out: value(x, a, out) for x, a, out in series}).drop("_r", "_b", "_j", *gone)


def known(n: int, x: str) -> Column:
    """Whether the last n rows all have x, from the place of the last null instead of a sliding count; needs the column `_rn` (row numbers from 1)."""
    return F.col("_rn") - F.coalesce(F.max(F.when(F.col(x).isNull(), F.col("_rn"))).over(by_ticker()), F.lit(0)) >= n


def numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(by_ticker()))


def streak(x: str) -> Column:
    """How many rows up to this one have x, without a gap; needs the column `_rn`. A window of n rows is full where it is n or more."""
    return F.col("_rn") - F.coalesce(F.max(F.when(F.col(x).isNull(), F.col("_rn"))).over(by_ticker()), F.lit(0))


def moments(x: str, n: int) -> dict[str, Column]:
    """Of the last n rows the mean of x, and the squares of its distances from it, summed: columns `_mean_x` and `_squares_x`."""
    return {f"_mean_{x}": F.avg(x).over(rows(n)), f"_squares_{x}": F.var_pop(x).over(rows(n)) * n}


def lags(x: str, *distances: int) -> dict[str, Column]:
    """Columns x_n, the x of n rows before."""
    return {f"{x}_{n}": lag(x, n) for n in distances}


def joined(*parts: tuple[int, Column, Column | None]) -> tuple[Column, Column]:
    """Mean and squares of rows that are given in two or more parts of (rows, mean, squares), the squares None for a single row.

    All is reckoned from the first part's mean, so that values that are all equal have squares of 0."""
    first, total = parts[0][1], sum(n for n, _, _ in parts)
    far = [(n, mean - first) for n, mean, _ in parts[1:]]
    shift = _plus(d * n for n, d in far)
    squares = _plus(q for _, _, q in parts if q is not None) + _plus(d * d * n for n, d in far) - shift * shift / total
    return first + shift / total, F.greatest(squares, F.lit(0.0))


def _plus(terms: Iterable[Column]) -> Column:
    return functools.reduce(lambda a, b: a + b, terms)


def spread(combine, x: str, step: int, times: int) -> Column:  # noqa: ANN001
    """An extreme (greatest or least) over step * times rows from the column x of extremes over step rows."""
    return combine(*[F.col(x) if k == 0 else lag(x, k * step) for k in range(times)])


def summed(x: str, step: int, times: int) -> Column:
    """A sum over step * times rows from the column x of sums over step rows."""
    out = F.col(x)
    for k in range(1, times):
        out = out + lag(x, k * step)
    return out


def as_of(calendar: DataFrame, series: DataFrame, value: str, out: str, order: str = "date") -> DataFrame:
    """For each date of the calendar the newest value on or before it, with its date (out_date). One row per date on both sides."""
    both = calendar.select(order).withColumn("_v", F.lit(None).cast(dict(series.dtypes)[value])).withColumn("_q", F.lit(1))
    both = both.union(series.select(order, F.col(value), F.lit(0)))
    seen = F.when(F.col("_v").isNotNull(), F.struct(F.col(order).alias("d"), F.col("_v").alias("v")))
    by = Window.orderBy(order, "_q").rowsBetween(Window.unboundedPreceding, 0)  # a calendar: some thousands of dates
    got = both.withColumn("_l", F.last(seen, ignorenulls=True).over(by)).where("_q = 1")
    return got.select(order, F.col("_l.v").alias(out), F.col("_l.d").alias(f"{out}_date"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, 0 where a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(dot(a, b) / norm)
