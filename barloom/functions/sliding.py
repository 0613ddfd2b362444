"""Aggregates over the last n rows at a cost that does not depend on n."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is kept of x for each kind of aggregate.
_PARTS = {"sum": ("count", "sum"), "avg": ("count", "sum"), "max": ("count", "max"), "min": ("count", "min"), "sd": ("count", "avg", "var")}
_FUNCTIONS = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "var": F.var_pop}


def block_windows(df: DataFrame, frames: dict[int, dict[str, tuple[str, str]]], keys: tuple[str, ...] = ("ticker",), order: str = "date") -> DataFrame:
    """df with a column for each entry of frames: {n: {out: (kind, x)}}, the kind (sum, avg, max, min, sd: sample deviation) of x over the last n rows of its key.

    Rows are numbered and cut into blocks of n. Within a block each row gets the aggregate from the block's first row to it and from it to the block's last row. Any n rows are
    the end of one block and the start of the next, so a window is one of each: its aggregate costs the same at any width, holds nothing from outside of it (an infinite value or a
    NaN leaves with its row), and is summed anew in each block, so that no digits are lost as a history grows. Deviations are joined by means and squares (Chan).

    Null until all of the n rows have x. Rows without a key are a key of their own; ties in the order are in some order; empty in, empty out."""
    columns = df.columns
    df = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    name = lambda side, part, x: f"_{side}_{part}_{x}"
    made: list[str] = []
    for n, outs in frames.items():
        parts = sorted({(part, x) for kind, x in outs.values() for part in _PARTS[kind]})
        df = df.withColumn("_block", (F.col("_at") / n).cast("int"))
        end = Window.partitionBy(*keys, "_block").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
        start = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        through = Window.partitionBy(*keys).orderBy("_block", order)  # the same order as by date, and the one that `start` has sorted by
        df = df.withColumns({name("z", part, x): _FUNCTIONS[part](x).over(end) for part, x in parts})
        df = df.withColumns({name("a", part, x): _FUNCTIONS[part](x).over(start) for part, x in parts})
        df = df.withColumns({name("l", part, x): F.lag(name("z", part, x), n - 1).over(through) for part, x in parts})
        made += outs
        df = df.select(*columns, "_at", *[c for c in made if c not in outs], *[_joined(n, kind, x, name).alias(c) for c, (kind, x) in outs.items()])
    return df.drop("_at")


def _joined(n: int, kind: str, x: str, name: Callable[[str, str, str], str]) -> Column:
    """The aggregate of n rows from the part of the row's own block and that of the block before."""
    a, b = (lambda part: F.col(name("a", part, x))), (lambda part: F.col(name("l", part, x)))
    whole = F.col("_at") % n == n - 1  # the window is a block
    if kind in ("sum", "avg"):
        value = F.when(whole, a("sum")).otherwise(a("sum") + b("sum"))
        value = value / n if kind == "avg" else value
    elif kind == "sd":
        p = F.col("_at") % n + 1
        far = b("avg") - a("avg")
        far = F.when(F.abs(far) > 1e-15 * (F.abs(a("avg")) + F.abs(b("avg"))), far).otherwise(0.0)  # means of one value may differ in the last bit
        value = F.when(whole, a("var") * n).otherwise(a("var") * p + b("var") * (n - p) + far * far * p * (n - p) / n)
        value = F.sqrt(value / (n - 1))
    else:
        value = F.when(whole, a(kind)).otherwise((F.greatest if kind == "max" else F.least)(a(kind), b(kind)))
    full = F.when(whole, a("count")).otherwise(a("count") + b("count"))
    return F.when(full == n, value)
