"""Whole passes of a day, and entries that share keys with earlier ones, on odd and random rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import daily, macro, news
from barloom.sources import readers

BAR = "ticker string, date date, open double, high double, low double, close double, volume double, vwap double"
DAY = dt.date(2024, 3, 1)


def bars(ticker, closes, last=DAY):
    """A ticker's bars on consecutive days, the last one on the given day."""
    return [(ticker, last - dt.timedelta(days=len(closes) - 1 - n), c, c * 1.01, c * 0.99, c, 100.0 + n % 7, c) for n, c in enumerate(closes)]


def reader(rows):
    """What one who goes through the rows in order keeps."""
    seen, kept = {}, []
    for topic, seq, *keys in sorted(rows, key=lambda r: r[1]):
        marks = seen.setdefault(topic, [set() for _ in keys])
        if not any(k in m for k, m in zip(keys, marks, strict=True)):
            kept.append(seq)
            for k, m in zip(keys, marks, strict=True):
                m.add(k)
    return kept


@pytest.mark.parametrize("seed", range(3))
def test_first_seen_is_what_a_reader_keeps(spark, seed):
    rng = random.Random(seed)
    seqs = rng.sample(range(10_000), 400)
    rows = [(rng.choice(["x", "y", None]), s, rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"[: 5 + 7 * seed]]), str(rng.randrange(20 + 20 * seed))) for s in seqs]
    df = spark.createDataFrame(rows, "topic string, seq long, url string, title string")
    got = news.first_seen(df, ["url", "title"], "seq", "topic")
    assert got.columns == df.columns and sorted(r["seq"] for r in got.collect()) == sorted(reader(rows))


def test_first_seen_chains_hot_keys_and_nothing(spark):
    schema = "topic string, seq long, url string, title string"
    # each entry waits for the one before: every second is kept, which no order of two plain passes gives
    chain = [("t", n, f"u{n // 2}", f"v{(n + 1) // 2}") for n in range(12)]
    assert [r["seq"] for r in news.first_seen(spark.createDataFrame(chain, schema), ["url", "title"], "seq", "topic").orderBy("seq").collect()] == reader(chain) == list(range(0, 12, 2))
    hot = [("t", n, "u", f"v{n % 5}") for n in range(500)]
    assert [r["seq"] for r in news.first_seen(spark.createDataFrame(hot, schema), ["url", "title"], "seq", "topic").collect()] == [0]
    assert news.first_seen(spark.createDataFrame([], schema), ["url", "title"], "seq", "topic").count() == 0


def test_entries_are_capped_not_stories(spark):
    rows = [(1, 0.9, DAY, "wire", []), (2, -0.8, DAY, None, ["B", "A", "B"]), (3, 0.7, DAY, "Noise", ["C"]), (4, None, DAY, "wire", ["D"]), (5, 0.5, None, "wire", ["E"]), (6, 0.5, DAY, "wire", ["F"])]
    a = spark.createDataFrame(rows, "id long, score double, published_at date, source string, tickers array<string>")
    got = news.portfolio_entries(a, "nOISE", 5).orderBy("rank").collect()
    assert [(r["rank"], r["id"], r["ticker"]) for r in got] == [(1, 2, "B"), (2, 2, "A"), (3, 2, "B"), (4, 6, "F"), (5, 5, "E")]
    assert [r["ticker"] for r in news.portfolio_entries(a, "none", 50).orderBy("rank").collect()][-1] == "D"
    empty = news.portfolio_entries(a.limit(0), "x")
    topics = spark.createDataFrame([], "topic string, rank int, id long, published_at date, source string")
    doc = news.digest_document(empty, topics, ["macro"]).orderBy("pos").collect()
    assert [(r["section"], r["n"], r["entries"]) for r in doc] == [("portfolio", 0, []), ("macro", 0, [])]


def test_series_are_judged_with_today(spark):
    history = spark.createDataFrame(bars("A", [10.0, 30.0, 10.0, 10.0]) + bars("B", [10.0] * 4) + bars("C", [10.0, 30.0]), BAR)
    after = DAY + dt.timedelta(days=1)
    today = spark.createDataFrame(bars("A", [30.0], after) + bars("B", [10.0], after) + bars("N", [-1.0], after), BAR)
    got = {r["ticker"]: (r["fresh_gates"], r["gates"], r["quarantine"]) for r in daily.series_with_today(history, today, {"large_moves": 2, "nonpositive": 0}).collect()}
    assert got == {"A": ("large_moves", "large_moves", True), "B": ("", "", False), "N": ("nonpositive", "nonpositive", True)}
    # a row of today in place of a stored one counts once
    again = spark.createDataFrame(bars("A", [10.0]), BAR)
    assert daily.series_with_today(history, again, {"large_moves": 1}).first()["quarantine"] and not daily.series_with_today(history, again, {"large_moves": 2}).first()["quarantine"]
    with pytest.raises(ValueError, match="other"):
        daily.series_with_today(history, today, {"other": 1})


def test_an_append_without_market_or_bars(spark):
    rng = random.Random(5)
    walk = lambda: [100 + rng.random() for _ in range(120)]
    before = DAY - dt.timedelta(days=1)
    stored = spark.createDataFrame([r for t in "ABC" for r in bars(t, walk(), before)], BAR)
    new = spark.createDataFrame(bars("A", [100.5]) + bars("B", [100.1]) + bars("C", [-5.0]), BAR)
    market = spark.createDataFrame([], "date date, spy double")
    series = spark.createDataFrame([("VIX", before, 20.0)], "series_id string, date date, value double")
    args = (market, series, ["VIX", "VIX3M", "TNX", "IRX", "GLD"], {"large_moves": 5}, ["momentum_20d"], ["rsi_14"])
    features, verdicts = daily.append_all(stored, new, str(DAY), *args)
    assert {(r["ticker"], r["verdict"]) for r in verdicts.collect()} == {("A", "accepted"), ("B", "accepted"), ("C", "blocked")}
    got = {r["ticker"]: r for r in features.collect()}
    assert got.keys() == {"A", "B"}
    for r in got.values():
        assert r["vix_level"] == 1.0 and r["yield_10y"] is None and r["gold_mom_5d"] == 0.0 and r["beta_60d"] is None and r["momentum_20d"] is not None and 0 <= r["rsi_14"] <= 100
        assert r["unknown"] == sum(r[c] is None for c in features.columns)
    none, verdicts = daily.append_all(stored, new.limit(0), str(DAY), *args)
    assert none.count() == 0 and verdicts.count() == 0 and none.columns == features.columns


def test_labelled_history_and_registry(spark):
    months = [("CPI", dt.date(2020 + n // 12, n % 12 + 1, 1), 0.0 if n == 2 else 100.0 + n) for n in range(26)] + [("X", dt.date(2020, 1, 1), 1.0)]
    about = spark.createDataFrame([("CPI", "Prices", "index", "M"), ("YOY", "Inflation", "pct", "M")], "series_id string, label string, units string, frequency string")
    got = macro.labelled_history(spark.createDataFrame(months, "series_id string, date date, value double"), about, {"YOY": "CPI"})
    yoy = {r["date"]: r["value"] for r in got.where("series_id = 'YOY'").collect()}
    assert len(yoy) == 13 and dt.date(2021, 3, 1) not in yoy and yoy[dt.date(2021, 1, 1)] == 12.0 and got.where("series_id = 'X'").count() == 0
    t = spark.createDataFrame([(1, None), (2, "b")], "`a.b` int, c string")
    reg = {r["column"]: (r["filled"], r["rows"], r["type"]) for r in readers.filled_registry(spark, {"g": ["a.b", "c", "zz"]}, {"t": t}).collect()}
    assert reg == {"a.b": (2, 2, "int"), "c": (1, 2, "string")}
    assert readers.filled_registry(spark, {"g": ["zz"]}, {"t": t}).where(F.lit(True)).count() == 0
