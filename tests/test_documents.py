"""Nested documents, shapes and contracts: small cases beside the parity with SQL."""

from pyspark.sql import functions as F

from barloom.operators import documents


def test_surprise_falls_back_to_the_newest_quarter(spark):
    rows = [
        ("own", '{"eps_revision": {"surprise_pct": 2.0, "streak": 3}, "analyst_consensus": {"earnings_surprises": [{"surprise_pct": 9.0}]}}'),
        ("listed", '{"eps_revision": null, "analyst_consensus": {"earnings_surprises": [{"surprise_pct": -0.8}, {"surprise_pct": 5.0}]}}'),
        ("none", '{"options_flow": {"iv_rank": 40.0}}'),
        ("unlisted", '{"analyst_consensus": {"earnings_surprises": [{"date": "2024-06-30"}]}}'),
    ]
    got = {r.ticker: r for r in documents.alternative_features(spark.createDataFrame(rows, "ticker string, payload string")).collect()}
    assert got["own"].surprise_pct == 0.02 and got["own"].revision_streak == 3
    assert got["listed"].surprise_pct == -0.008 and got["listed"].days_since_earnings == 0.0
    assert got["none"].surprise_pct == 0.0 and got["none"].iv_rank == 40.0
    assert got["unlisted"].surprise_pct is None  # a quarter is listed, but has none


def test_options_rows_need_one_field(spark):
    df = spark.createDataFrame([("A", 1.0, None), ("B", None, None)], "ticker string, a double, b double")
    assert [r.ticker for r in documents.options_mirror(df, ["a", "b"]).collect()] == ["A"]


def test_short_interest_keeps_zero_and_drops_the_unknown(spark):
    df = spark.createDataFrame([("A", 0.01234, 1.005, 10), ("B", None, None, None), ("C", 0.0, None, None)], "ticker string, fraction double, days double, shares long")
    got = {r.ticker: (r.short_pct_float, r.shares_short) for r in documents.short_interest(df).collect()}
    assert got == {"A": (1.23, 10), "C": (0.0, None)}


def test_slope_is_relative_to_at_least_one(spark):
    s = spark.createDataFrame([("VIX", 1, 0.5), ("VIX3M", 1, 1.5), ("VIX3M", 2, 9.0), ("VIX", 3, 20.0)], "series_id string, date int, value double")
    got = documents.backfill_macro(documents.wide(s, ["VIX", "VIX3M", "TNX", "IRX", "GLD"])).orderBy("date").collect()
    assert [(r.date, r.vix_term_slope_rel) for r in got] == [(1, 1.0), (3, None)]


def test_broken_documents_are_named(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, None), (3, '{"x": 1}')], "id int, doc string")
    got = {r.id: r.warnings for r in documents.contract_warnings(df, "id", "doc", "k int", {"k_even": F.col("p.k") % 2 == 0}).collect()}
    assert got == {1: ["k_even"], 2: ["not a document"], 3: ["k_even"]}


def test_gates_of_an_empty_table_fail(spark):
    none = spark.createDataFrame([], "ticker long, date date, open double, close double")
    got = documents.contract_gates(none, F.col("ticker") == 0, 5, {"rising": (F.col("close") > F.col("open"), 0.3)}).collect()
    assert all(not r.passed for r in got) and {r.gate for r in got} <= {"anchor_age", "fresh", "rising"}
