"""Queries registered beside their SQL; doubles of both are rounded alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.sql import NUDGE

#: Digits to which doubles are rounded in results that two engines are to agree on.
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, with no negative zero; a nudge takes exact halves off the border, where two engines' last bits would decide.

    They are rounded as one array: written out for each of many columns, the code of a row is too long to be compiled."""
    columns = df.columns
    doubles = {c: n for n, c in enumerate(c for c, t in df.dtypes if t == "double")}
    if not doubles:
        return df
    nudged = F.transform(F.array(*[F.col(f"`{c}`") for c in doubles]), lambda x: x + NUDGE)
    values = F.transform(nudged, lambda x: _round(x, digits) + 0.0)
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in doubles], values.alias("_doubles"))
    return df.select(*[F.get("_doubles", F.lit(doubles[c])).alias(c) if c in doubles else F.col(f"`{c}`") for c in columns])


def _round(x: Column, digits: int) -> Column:
    """As DuckDB rounds: to whole multiples, halves away from zero; what has no finite multiple stays. Spark's own writes each double out in decimal digits and reads them back."""
    y = x * 10.0**digits
    whole = F.when(F.abs(y - F.rint(y)) == 0.5, y + F.signum(y) * 0.5).otherwise(F.rint(y))
    return F.when(F.abs(y) < float("inf"), whole / 10.0**digits).otherwise(x)


def merged(*parts: dict) -> dict:
    """All entries of the parts; a name may stand in only one."""
    out: dict = {}
    for part in parts:
        if twice := out.keys() & part.keys():
            raise ValueError(f"registered twice: {', '.join(sorted(twice))}")
        out |= part
    return out


class Registry:
    """Queries and SQL by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, text: str | None = None, doubles: str = "") -> Callable:
        """Registers a query with its SQL and the names of its double columns, which are rounded."""
        fields = ", ".join(f"round({c} + {NUDGE!r}::DOUBLE, {DIGITS}) + 0.0 AS {c}" for c in doubles.split())

        def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
            if f.__name__ in self.queries:
                raise ValueError(f"registered twice: {f.__name__}")
            self.queries[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
            if text:
                self.sql[f.__name__] = f"SELECT * REPLACE ({fields}) FROM ({text})" if fields else text
            return f

        return add
