"""Feature packs: order, checks, and Python per key."""

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from barloom.functions.packs import PackError, Packs


def registry():
    packs = Packs()

    @packs.table("b_scaled", ["streak"], {"scaled": "double"})
    def scaled(df):
        return df.withColumn("scaled", F.col("streak") / 10.0)

    @packs.per_key("a_streak", ["close"], {"streak": "bigint"})
    def streak(t: pa.Table) -> pa.Table:
        out, n, before = [], 0, None
        for x in t.column("close").to_pylist():
            n = n + 1 if before is not None and x is not None and x > before else 0
            out.append(n)
            before = x
        return pa.table({"streak": pa.array(out, pa.int64())})

    @packs.table("c_other", ["close", "scaled"], {"other": "double"})
    def other(df):
        return df.withColumn("other", F.col("close") + F.col("scaled"))

    return packs


def panel(spark):
    return spark.createDataFrame([(t, d, x) for t in ("a", "b") for d, x in ((3, 2.0), (1, 1.0), (2, 1.5), (5, None), (4, 0.5))], "ticker string, date int, close double").repartition(3)


def test_packs_run_after_what_they_need(spark):
    packs = registry()
    assert [p.name for p in packs.ordered(["ticker", "date", "close"])] == ["a_streak", "b_scaled", "c_other"]
    assert [p.name for p in packs.ordered(["ticker", "date", "close"], ["scaled"])] == ["a_streak", "b_scaled"]
    assert packs.ordered(["ticker", "date", "close", "streak", "scaled"], ["scaled"]) == []
    got = packs.apply(panel(spark))
    assert got.columns == ["ticker", "date", "close", "streak", "scaled", "other"]
    assert sorted(tuple(r)[1:] for r in got.where("ticker = 'a'").collect()) == [(1, 1.0, 0, 0.0, 1.0), (2, 1.5, 1, 0.1, 1.6), (3, 2.0, 2, 0.2, 2.2), (4, 0.5, 0, 0.0, 0.5), (5, None, 0, 0.0, None)]
    assert packs.apply(panel(spark).limit(0), ["streak"]).columns == ["ticker", "date", "close", "streak"]


def test_packs_are_held_to_their_word(spark):
    packs = registry()
    with pytest.raises(PackError, match="twice"):
        packs.table("a_streak", [], {})(lambda df: df)
    with pytest.raises(PackError, match="gives streak, which a_streak has"):
        packs.table("d", [], {"streak": "bigint"})(lambda df: df)
    with pytest.raises(PackError, match="gives close, which the table has"):
        Packs.apply(_with("e", [], {"close": "double"}, lambda df: df), panel(spark))
    with pytest.raises(PackError, match="needs x, which nothing gives"):
        _with("e", ["x"], {"y": "int"}, lambda df: df).apply(panel(spark))
    with pytest.raises(PackError, match="declares"):
        _with("e", [], {"y": "int"}, lambda df: df.withColumn("y", F.lit("s"))).apply(panel(spark))
    with pytest.raises(PackError, match="declares"):
        _with("e", [], {"y": "int"}, lambda df: df.drop("close").withColumn("y", F.lit(1))).apply(panel(spark))
    round_ = _with("e", ["z"], {"y": "int"}, lambda df: df)
    round_.table("f", ["y"], {"z": "int"})(lambda df: df)
    with pytest.raises(PackError, match="e -> f -> e"):
        round_.apply(panel(spark))
    short = Packs()
    short.per_key("s", ["close"], {"y": "double"})(lambda t: pa.table({"y": pc.cast(t.column("close"), pa.float64()).slice(1)}))
    with pytest.raises(Exception, match="s gives 4 rows for 5"):
        short.apply(panel(spark)).collect()


def _with(*args):
    packs = Packs()
    packs.table(*args[:3])(args[3])
    return packs
