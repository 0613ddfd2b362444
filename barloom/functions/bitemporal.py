"""Joins on two time axes: the period that a value is about, and the day from which it was known."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def known_on(panel: DataFrame, facts: DataFrame, values: list[str], key: str = "ticker", date: str = "date", period: str = "period", known_at: str = "known_at", block: str = "month") -> DataFrame:
    """Each row of the panel (key, date, ...) with the values of the newest period that was known on its date, as they were known then.

    facts: key, period, known_at, values. A row of facts counts from its own known_at on, its day included. Of what is known the newest period is taken, and of that
    period what was known last: a restatement of an older period changes nothing, one of the newest period only the rows from its own known_at on. Of facts that
    agree in both dates the one with the greatest values is taken. Rows before the first fact, and rows without key or date, get nulls; facts without key, period or known_at are left out; columns of the panel with the names of those added are replaced.

    No range join: facts and panel rows are sorted together and the greatest (period, known_at) so far is carried along. A key's rows are windowed
    by blocks of time (`month`, `quarter` or `year`), each of which starts with what the blocks before it have known, one row for each block, so that a key with a very long history, or a
    third of all rows, is spread over tasks. The panel is shuffled once."""
    return all_known_on(panel, {"": (facts, values)}, key, date, period, known_at, block)


def all_known_on(panel: DataFrame, parts: dict[str, tuple[DataFrame, list[str]]], key: str = "ticker", date: str = "date", period: str = "period", known_at: str = "known_at", block: str = "month") -> DataFrame:
    """`known_on` for several tables of facts, parts of name: (facts, values), in one shuffle and one sort of the panel; the names come before those of the columns of dates (name + period, name + known_at)."""
    of_block = lambda d: F.date_trunc(block, F.col(d)).cast("date")
    names = [f"_f{i}" for i in range(len(parts))]
    facts_of = []
    for facts, values in parts.values():
        fact = F.struct(F.col(period).alias("p"), F.col(known_at).alias("k"), F.struct(*[F.col(v) for v in values]).alias("v"))
        known = facts.where(F.col(key).isNotNull() & F.col(period).isNotNull() & F.col(known_at).isNotNull())
        facts_of.append(known.select(F.col(key).alias("_k"), F.col(known_at).alias("_d"), of_block(known_at).alias("_b"), fact.alias("_f")))
    none = {f: F.lit(None).cast(d.schema["_f"].dataType).alias(f) for f, d in zip(names, facts_of, strict=True)}
    known = reduce(DataFrame.unionByName, [d.select("_k", "_d", "_b", *[F.col("_f").alias(f) if f == mine else none[f] for f in names]) for mine, d in zip(names, facts_of, strict=True)])
    rest = F.struct(*[F.col(f"`{c}`") for c in panel.columns])
    asked = panel.select(F.col(key).alias("_k"), F.col(date).alias("_d"), of_block(date).alias("_b"), rest.alias("_row"))
    # what each block starts with: the greatest facts of all blocks before it
    blocks = known.select("_k", "_b", *names).unionByName(asked.select("_k", "_b").distinct().select("_k", "_b", *none.values()))
    blocks = blocks.groupBy("_k", "_b").agg(*[F.max(f).alias(f) for f in names])
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("_k", "_b", *[F.max(f).over(before).alias(f) for f in names]).where(" or ".join(f"{f} is not null" for f in names))
    no_row = F.lit(None).cast(asked.schema["_row"].dataType).alias("_row")
    rows = known.select("_k", "_b", "_d", *names, no_row, F.lit(1).alias("_kind"))
    rows = rows.unionByName(carried.select("_k", "_b", F.col("_b").alias("_d"), *names, no_row, F.lit(0).alias("_kind")))
    rows = rows.unionByName(asked.select("_k", "_b", "_d", *none.values(), "_row", F.lit(2).alias("_kind")))
    so_far = Window.partitionBy("_k", "_b").orderBy("_d", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    got = rows.select("_kind", "_row", *[F.max(f).over(so_far).alias(f) for f in names]).where("_kind = 2")
    added = [x for (name, (_, values)), f in zip(parts.items(), names, strict=True) for x in (F.col(f"{f}.p").alias(name + period), F.col(f"{f}.k").alias(name + known_at), *[F.col(f"{f}.v.{v}").alias(v) for v in values])]
    replaced = {x for name, (_, values) in parts.items() for x in (name + period, name + known_at, *values)}
    return got.select(*[F.col(f"_row.`{c}`") for c in panel.columns if c not in replaced], *added)
