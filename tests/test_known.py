"""Joins on two time axes against a plain reading of their rule."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.functions.bitemporal import known_on
from barloom.operators import panels

DAY = dt.date(2020, 1, 1)


def made(seed):
    r = random.Random(seed)
    day = lambda: DAY + dt.timedelta(r.randrange(400))
    facts = [(r.choice(["a", "b", "hot", "hot", None]), DAY + dt.timedelta(90 * r.randrange(5)), r.choice([day(), day(), None]), r.choice([None, r.randrange(9)]), float(r.randrange(3))) for _ in range(150)]
    panel = [(r.choice(["a", "b", "hot", "hot", "none", None]), r.choice([day(), day(), day(), None]), k) for k in range(200)]
    return panel + panel[:5], facts + facts[:5]


def plain(panel, facts):
    out = []
    for key, date, x in panel:
        seen = [(p, k, (v is not None, v), w) for f, p, k, v, w in facts if date and k and f == key and key is not None and k <= date]
        best = max(seen, default=None)
        out.append((key, date, x, *((None,) * 4 if best is None else (best[0], best[1], best[2][1], best[3]))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", ["month", "year"])
def test_newest_period_known_on_each_date(spark, block):
    panel, facts = made(len(block))
    p = spark.createDataFrame(panel, "ticker string, date date, n int")
    f = spark.createDataFrame(facts, "ticker string, period date, known_at date, v int, w double")
    got = known_on(p.withColumn("w", F.lit("old")), f, ["v", "w"], block=block)
    assert got.columns == ["ticker", "date", "n", "period", "known_at", "v", "w"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(panel, facts)
    assert known_on(p, f.limit(0), ["v", "w"]).where("period is null").count() == len(panel) and known_on(p.limit(0), f, ["v", "w"]).count() == 0


def test_later_restatements_leave_earlier_rows(spark):
    days = [("t", DAY + dt.timedelta(10 * k)) for k in range(30)]
    fields = {c: float(n + 1) for n, c in enumerate(panels.FUNDAMENTALS)}
    row = lambda period, known, times: ("t", period, known, *[x * times for x in fields.values()])
    first, second = DAY, DAY + dt.timedelta(91)
    facts = [row(first, DAY + dt.timedelta(40), 1), row(second, DAY + dt.timedelta(120), 2)]
    late = [row(first, DAY + dt.timedelta(200), 7), row(second, DAY + dt.timedelta(250), 3)]  # the first restates a period that is no longer the newest
    schema = "ticker string, period date, known_at date, " + ", ".join(f"{c} double" for c in fields)
    panel = spark.createDataFrame(days, "ticker string, date date")
    ask = lambda rows, **o: {r["date"]: r["roe"] / fields["roe"] for r in panels.with_fundamentals_known(panel, spark.createDataFrame(rows, schema), **o).collect()}
    before, after = ask(facts), ask(facts + late)
    for d in before:
        n = (d - DAY).days
        assert before[d] == (0 if n < 40 else 1 if n < 120 else 2) and after[d] == (before[d] if n < 250 else 3)
    assert set(ask(facts + late, broadcast=True).values()) == {3}


def test_alternative_parts_have_days_of_their_own(spark):
    panel = spark.createDataFrame([("t", DAY + dt.timedelta(k), 0.2 if k else None) for k in range(5)] + [("u", DAY, 0.1)], "ticker string, date date, realized_vol_20d double")
    earnings = spark.createDataFrame([("t", DAY, DAY + dt.timedelta(1), 3.0, 9.0)], "ticker string, period date, known_at date, surprise_pct double, days_since_earnings double")
    options = spark.createDataFrame([("t", DAY, DAY + dt.timedelta(3), 1.5, None, 0.5)], "ticker string, period date, known_at date, put_call_ratio double, iv_rank double, atm_iv double")
    got = {(r["ticker"], (r["date"] - DAY).days): r for r in panels.with_alternative_known(panel, {"earnings": earnings, "options": options}).collect()}
    assert [got["t", k]["earnings_surprise_pct"] for k in range(5)] == [0, 3, 3, 3, 3]
    assert [round(got["t", k]["days_since_earnings"] * 90) for k in range(5)] == [90, 9, 10, 11, 12]
    assert [got["t", k]["iv_vs_rv"] for k in range(5)] == [1, 1, 1, 2.5, 2.5] and got["t", 4]["iv_rank"] == 0.5 and got["t", 4]["eps_revision_4w"] == 0
    assert got["u", 0]["days_since_earnings"] == 1


def test_several_tables_of_facts_are_joined_in_one_sort_of_the_panel(spark):
    from barloom.plans import known

    d = "/root/testdata/sf0.001"
    panel = known.technicals.price_features(known.tables.bars(spark, d)).select("ticker", "date", "realized_vol_20d")
    parts = {n: known._part(spark, d, n) for n in known._VALUES}
    df = known.panels.with_alternative_known(panel, parts)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Window [" in x and "_kind" in x]) == 1
    one = known.panels.known_on(panel, parts["revision"], ["eps_revision_4w", "revision_streak"])
    got = df.select("ticker", "date", "eps_revision_4w", "revision_streak")
    want = one.selectExpr("ticker", "date", "coalesce(eps_revision_4w, 0.0D) AS eps_revision_4w", "coalesce(revision_streak, 0.0D) AS revision_streak")
    assert got.exceptAll(want).count() == 0 and got.count() == panel.count()
