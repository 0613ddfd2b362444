"""Operators over the market tables: oracle parity at the smallest scale, invariants, merge rules, streams."""

import datetime as dt
import math
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import windows
from barloom.operators import actions, cross_section, gates, membership, merge, technicals
from barloom.plans import catalog
from barloom.sources import tables
from barloom.streaming import jobs

SF = "/root/testdata/sf0.001"


def rows(found, columns):
    at = [found.index(c) for c in sorted(found)]

    def norm(x):
        if isinstance(x, float):
            return None if math.isnan(x) else float(f"{x:.9g}")
        return x.isoformat() if isinstance(x, (dt.date, dt.datetime)) else x

    return sorted((tuple(norm(r[i]) for i in at) for r in columns), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return con


@pytest.mark.parametrize("name", ["bars", "oscillators", "authority_merge", "total_return", "roster_changes", "point_in_time_membership", "forward_returns", "source_agreement"])
def test_matches_sql(spark, duck, name):
    df, want = catalog.queries()[name](spark, SF), duck.sql(catalog.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def series(spark, n, ticker="A"):
    import numpy as np

    g = np.random.default_rng(7)
    close = 100 * np.exp(np.cumsum(g.normal(0, 0.02, n)))
    pdf = pd.DataFrame({"ticker": ticker, "date": [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)], "close": close})
    pdf["open"], pdf["high"], pdf["low"], pdf["vwap"], pdf["volume"] = close, close * 1.01, close * 0.99, close, g.integers(1, 100, n).astype(float)
    return pdf, spark.createDataFrame(pdf)


def test_ewm_over_block_borders(spark):
    pdf, df = series(spark, 1300)
    got = windows.ewm(df, "close", 2 / 9, "e").orderBy("date").toPandas()["e"]
    assert (got - pdf["close"].ewm(span=8, adjust=False).mean()).abs().max() < 1e-9


def test_past_does_not_change_with_the_future(spark):
    _, df = series(spark, 300)
    cut = F.col("date") <= F.lit("2020-08-01").cast("date")
    whole = technicals.price_features(df).where(cut).select("date", "momentum_20d", "max_drawdown_60d")
    part = technicals.price_features(df.where(cut)).select("date", "momentum_20d", "max_drawdown_60d")
    assert whole.exceptAll(part).isEmpty()


def test_degenerate_cross_sections_are_null(spark):
    df = spark.createDataFrame([("f", "d", 1.0), ("f", "d", 1.0), ("g", "d", 2.0), ("h", "d", None)], "factor string, date string, x double")
    assert [r["z"] for r in cross_section.robust_zscores(df).collect()] == [None] * 4


def test_merge_rules(spark):
    s = "ticker int, date int, close double, source string"
    new = spark.createDataFrame([(1, 1, 5.0, "low"), (2, 1, 6.0, "high"), (3, 1, None, "high"), (5, 1, 1.0, "high")], s)
    old = spark.createDataFrame([(1, 1, 4.0, "high"), (2, 1, 3.0, "high"), (3, 1, 2.0, "low"), (4, 1, 9.0, "low")], s)
    got = {r["ticker"]: (r["close"], r["status"]) for r in merge.merge_by_authority(new, old, {"high": 3, "low": 1}).collect()}
    assert got == {1: (4.0, "downgrade_blocked"), 2: (6.0, "overwritten"), 3: (2.0, "downgrade_blocked"), 4: (9.0, "retained"), 5: (1.0, "new")}


def test_splits_reach_earlier_rows_only(spark):
    _, df = series(spark, 5)
    e = spark.createDataFrame([("A", dt.date(2020, 1, 3), 1.0, 2.0)], "ticker string, ex_date date, split_from double, split_to double")
    assert [r["split_factor"] for r in actions.restate_splits(df, e).orderBy("date").collect()] == [0.5, 0.5, 1.0, 1.0, 1.0]


def test_agreement_gate(spark):
    q = spark.createDataFrame([("A", 1, "x", 100.0), ("A", 1, "y", 100.05), ("B", 1, "x", 100.0), ("B", 1, "y", 101.0), ("C", 1, "x", 5.0), ("D", 1, "x", None)], "ticker string, date int, source string, close double")
    assert {r["ticker"]: r["status"] for r in gates.source_agreement(q).collect()} == {"A": "agreed", "B": "quarantine", "C": "provisional", "D": "no_data"}


def test_membership_round_trip(spark):
    r = tables.read(spark, SF, "lineitem").select(F.year("l_shipdate").alias("y"), F.col("l_suppkey").alias("ticker")).where("ticker % 2 = y % 3").select(F.make_date("y", F.lit(1), F.lit(1)).alias("date"), "ticker").distinct()
    newest = r.agg(F.max("date").alias("date"))
    back = membership.point_in_time(r, r.join(newest, "date", "left_semi"), membership.roster_changes(r))
    # before the change of a date, membership is that of the roster before
    dates = [x["date"] for x in r.select("date").distinct().orderBy("date").collect()]
    have = {(x["date"], x["ticker"]) for x in r.collect()}
    want = {(b, t) for a, b in zip(dates, dates[1:]) for d, t in have if d == a} | {(dates[0], t) for d, t in have if d == dates[0]}
    assert {(x["date"], x["ticker"]) for x in back.collect()} == want


def test_stream_equals_batch(spark, tmp_path):
    e = tables.read(spark, SF, "events")
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    s = jobs.stream(spark, str(tmp_path / "in"), e.schema)
    jobs.windowed_counts(s, delay="365 days").writeStream.format("memory").queryName("counts").outputMode("complete").start().processAllAvailable()
    got = {(r["start"], r["event_type"], r["n"]) for r in spark.table("counts").collect()}
    assert got == {(r["start"], r["event_type"], r["n"]) for r in jobs.windowed_counts(e).collect()}
    for q in spark.streams.active:
        q.stop()


def test_stream_merge_equals_batch(spark, tmp_path):
    c = tables.closes(spark, SF).drop("run")
    c.repartition(3).write.parquet(str(tmp_path / "in"))
    ranks = {"click": 3, "view": 2, "signup": 1}
    jobs.merge_into(str(tmp_path / "out"), ranks, str(tmp_path / "cp"))(jobs.stream(spark, str(tmp_path / "in"), c.schema)).awaitTermination()
    got = jobs.merged(spark, str(tmp_path / "out"))
    best = merge.keep_last(c.withColumn("p", merge.priority("source", ranks)), ["ticker", "date"], [F.desc("p")]).select("ticker", "date", "p")
    both = got.withColumn("p", merge.priority("source", ranks)).select("ticker", "date", "p")
    assert both.exceptAll(best).isEmpty() and best.exceptAll(both).isEmpty()


def test_stream_state_of_last_bars(spark, tmp_path):
    b = tables.bars(spark, SF).select("ticker", "date", "close")
    b.repartition(3).write.parquet(str(tmp_path / "in"))
    jobs.last_bars(jobs.stream(spark, str(tmp_path / "in"), b.schema)).writeStream.format("memory").queryName("last").outputMode("complete").start().processAllAvailable()
    want = technicals.latest(b)
    assert spark.table("last").exceptAll(want).isEmpty() and want.exceptAll(spark.table("last")).isEmpty()
    for q in spark.streams.active:
        q.stop()


def test_stream_sessions_and_deduplication(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=m)
    rows = [("a", t(0)), ("a", t(10)), ("a", t(100)), ("b", t(5)), ("b", t(5)), ("z", t(5000))]
    e = spark.createDataFrame(rows, "user_id string, ts timestamp").coalesce(1)
    e.write.parquet(str(tmp_path / "in"))
    got = {(r["user_id"], r["n"]) for r in jobs.sessions(e).collect()}
    assert got == {("a", 2), ("a", 1), ("b", 2), ("z", 1)}
    s = jobs.stream(spark, str(tmp_path / "in"), e.schema)
    jobs.sessions(s).writeStream.format("memory").queryName("sessions").outputMode("append").start().processAllAvailable()
    once = jobs.deduplicated(s, "user_id", "ts", "30 days")
    once.writeStream.format("memory").queryName("once").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start().processAllAvailable()
    assert sorted(r["user_id"] for r in spark.table("once").collect()) == ["a", "b", "z"]
    assert {(r["user_id"], r["n"]) for r in spark.table("sessions").collect()} <= got
    for q in spark.streams.active:
        q.stop()


def test_means_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    orders = tables.read(spark, "/root/testdata/sf0.01", "orders")
    found = []
    for n, by in enumerate([F.col("o_totalprice"), F.desc("o_totalprice"), F.hash("o_orderkey")]):
        (tmp_path / str(n)).mkdir()
        orders.coalesce(1).sortWithinPartitions(by).write.parquet(f"{tmp_path}/{n}/orders.parquet")
        found.append([sorted(map(tuple, f(spark, f"{tmp_path}/{n}").collect())) for f in (tables.macro, tables.benchmark)])
    assert found[0] == found[1] == found[2]


def test_windows_over_bars_need_one_shuffle_and_one_sort(spark):
    plan = technicals.price_features(tables.bars(spark, SF))._jdf.queryExecution().sparkPlan()
    done = spark._jvm.org.apache.spark.sql.execution.QueryExecution.prepareExecutedPlan(spark._jsparkSession, plan).toString()
    assert done.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in done and done.count("Sort [") == 1


def test_loadings_move_each_row_once(spark):
    """The long form moved a row for each loading, twice; duplicates, missing and infinite values count as before."""
    from barloom.operators import cross_section, panels

    rows = [(t, dt.date(2024, 1, 1 + t % 3), [float(t % 7), None, float("inf"), float("nan")][t % 4 if t % 5 == 0 else 0], float(t * t % 11), 3.0, float(t)) for t in range(40)]
    panel = spark.createDataFrame([*rows, rows[4]], "ticker int, date date, m double, v double, flat double, market_cap_raw double")
    names = {"m": "zm", "v": "zv", "flat": "zf", "market_cap_raw": "zs", "missing": "zx"}
    got = panels.factor_loadings(panel, names)
    finite = {c: F.when(F.abs(x) < float("inf"), x).alias(c) for c, x in {"m": F.col("m"), "v": F.col("v"), "flat": F.col("flat"), "market_cap_raw": F.when(F.col("market_cap_raw") > 0, F.log("market_cap_raw"))}.items()}
    long = panel.select("ticker", "date", *finite.values()).unpivot(["ticker", "date"], list(finite), "factor", "x")
    want = {(r["ticker"], r["factor"]): r["z"] for r in cross_section.robust_zscores(long).collect()}
    assert got.count() == 40 and {r["zx"] for r in got.collect()} == {None}
    for r in got.collect():
        for c in finite:
            assert r[names[c]] == (want[r["ticker"], c] if want[r["ticker"], c] is None else pytest.approx(want[r["ticker"], c], abs=1e-12))
    assert panels.factor_loadings(panel, names)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_factor_momentum_ratio_deals_its_long_rows_once(spark):
    """By day, for the ranks; the loadings of a ticker stay where its bars are."""
    import re

    df = catalog.factor_momentum_ratio(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = set(re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan))
    assert not [x for x in dealt if "ticker" in x] and len([x for x in re.findall(r"Exchange hashpartitioning\(factor#\d+, date#\d+", plan)]) == 1
