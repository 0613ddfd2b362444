"""Due dates, seeds, pending rows, gates and snapshots: small cases beside the parity with SQL."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import tracking
from barloom.sources import snapshots


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def bars(spark, n, tickers=("A",)):
    return spark.createDataFrame([(t, day(i), 100.0 + i, 10.0) for t in tickers for i in range(n)], "ticker string, date date, close double, volume double")


def test_dates_come_up_again_until_the_long_window_is_stored(spark):
    stored = spark.createDataFrame([(day(0), True, False), (day(1), True, True), (day(8), True, False)], "date date, has_short boolean, has_long boolean")
    due = {r.date: r.long_closed for r in tracking.due_dates(bars(spark, 30), stored).collect()}
    assert due[day(0)] is True  # its long window has closed since
    assert day(1) not in due and day(8) not in due  # complete, and complete for now
    assert due[day(2)] is True and due[day(9)] is False
    assert max(due) == day(23)  # five sessions on is before the newest one


def test_lag_counts_sessions_and_is_never_negative(spark):
    graded = spark.createDataFrame([(day(20), 5), (day(8), 21)], "date date, horizon int")
    assert {r.horizon: r.lag for r in tracking.grading_lag(bars(spark, 30), graded).collect()} == {5: 3, 21: 0}


def test_array_beats_map_and_only_buys_seed(spark):
    docs = spark.createDataFrame(
        [(day(0), [("A", "BUY", 1.0), ("B", "HOLD", 2.0)], {"A": ("BUY", 9.0), "C": ("BUY", 3.0)}), (day(1), None, {"B": ("SELL", 1.0)})],
        "date date, universe array<struct<ticker string, signal string, score double>>, by_ticker map<string, struct<signal string, score double>>",
    )
    sectors = spark.createDataFrame([("A", "tech")], "ticker string, sector string")
    got = {r.ticker: (r.score, r.sector) for r in tracking.seed_signals(docs, sectors).collect()}
    assert got == {"A": (1.0, "tech"), "C": (3.0, None)}


def test_settled_rows_stay(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, None), (3, None)], "k int, x double")
    found = spark.createDataFrame([(1, 7.0), (2, 8.0)], "k int, x double")
    assert sorted(tuple(r) for r in tracking.resolve_pending(rows, found, ["k"], "x").collect() if r.k != 3) == [(1, 2.0, False), (2, 8.0, True)]


def test_rating_falls_back_but_target_does_not(spark):
    schema = "ticker string, rating string, target double"
    a = spark.createDataFrame([("A", None, 5.0), ("B", "buy", None), ("D", None, None)], schema)
    b = spark.createDataFrame([("A", "hold", 6.0), ("B", "sell", 7.0), ("C", "buy", 8.0)], schema)
    got = {r.ticker: (r.rating, r.rating_score, r.target) for r in tracking.consensus(a, b, {"buy": 4, "hold": 3}).collect()}
    assert got == {"A": ("hold", 3.0, 5.0), "B": ("buy", 4.0, None), "C": ("buy", 4.0, 8.0)}


def test_summary_of_nothing(spark):
    none = spark.createDataFrame([], "ticker string, date date, anomalies array<string>")
    assert tuple(tracking.validation_summary(none).first()) == (0, 0, 0, "", False)


def test_widening_asserts_its_columns(spark):
    with pytest.raises(ValueError):
        tracking.widened(bars(spark, 2), {"x": F.lit(1)}, ["ticker", "date"])


def test_snapshots_read_back_by_range(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    snapshots.write_groups(bars(spark, 60, ("A", "B")), path, {"prices": ["close"], "macro": ["volume"]})
    got = snapshots.read_range(spark, path, "prices", "2024-01-30", "2024-02-02")
    assert got.count() == 8 and got.columns == ["ticker", "date", "close"]
    assert "PartitionFilters: [isnotnull(month" in got._jdf.queryExecution().toString()
    assert snapshots.read_date(spark, path, "macro", "2024-02-02").count() == 1
    assert snapshots.latest_date(spark, path, "prices").first()[0] == day(59)
    with pytest.raises(ValueError):
        snapshots.delta(bars(spark, 3), "2030-01-01", "2030-02-01")
