"""Texts, files and stores: small cases beside the parity with SQL."""

import datetime as dt

from pyspark.sql import functions as F

from barloom.operators import filings, panels, stores
from barloom.sources import readers


def test_scores_are_bounded_shares_of_all_words(spark):
    lex = spark.createDataFrame([("good", True, False, False), ("bad", False, True, False), ("may", True, False, True)], "word string, positive boolean, negative boolean, uncertainty boolean")
    docs = spark.createDataFrame([(1, "Good, GOOD bad thing 7 may"), (2, None), (3, "123 é"), (4, "bad")], "id int, text string")
    got = {r["id"]: (r["words"], r["positive"], r["negative"], r["uncertainty"], r["score"]) for r in filings.lexicon_scores(docs, "id", "text", lex, 0.5).collect()}
    assert got == {1: (5, 3, 1, 1, 0.4), 2: (0, 0, 0, 0, 0.0), 3: (0, 0, 0, 0, 0.0), 4: (1, 0, 1, 0, -0.5)}


def test_events_come_from_tags_and_text_in_order(spark):
    rows = [(1, "CEO steps down\nas outage hits", ["Q3 Results"]), (2, "A quiet day", ["weather"]), (3, "  ", ["earnings"]), (4, None, ["earnings"]), (5, "raises guidance", None)]
    got = {}
    for r in filings.event_rules(spark.createDataFrame(rows, "id int, text string, tags array<string>"), "id", "text", "tags").collect():
        got.setdefault(r["id"], []).append((r["category"], r["description"], r["severity"]))
    assert got == {1: [("earnings_release", "CEO steps down", 0.5), ("management_change", "CEO steps down", 0.5), ("operational_disruption", "CEO steps down", 0.5)], 5: [("earnings_guidance", "raises guidance", 0.5)]}


def test_sections_end_at_the_next_item_and_short_ones_go(spark):
    long = "risky " * 60
    html = f"<html><script>Item 1A. Risk Factors</script><h2>Item 1A. Risk Factors</h2><p>{long}</p><p>Item 1B. Unresolved &amp; open</p><p>Business</p><p>short</p></html>"
    df = spark.createDataFrame([(1, html), (2, None)], "id int, html string").select("id", filings.page_lines("html").alias("t"))
    got = {(r["id"], r["s"]["name"]): r["s"]["body"] for r in df.select("id", F.explode(filings.sections("t")).alias("s")).collect()}
    assert got == {(1, "Risk Factors"): "Item 1A. Risk Factors\n" + long.strip()}
    assert df.where("id = 1").first()["t"].split("\n")[2] == "Item 1B. Unresolved & open"


def test_calls_are_cut_at_the_first_question(spark):
    t = "x" * 120
    turns = [(1, 0, "Executive", "Ann", t + "?"), (1, 1, "", "Op", "silence"), (1, 2, None, "Caller", "a question? " + t), (1, 3, "Executive", "Ann", t), (1, 4, "Executive", "Ann", ""), (2, 0, "Executive", "Bo", "short")]
    s = filings.speakers(spark.createDataFrame(turns, "conv_id int, turn int, role string, name string, text string"), ["analyst"], [""]).collect()
    got = {(r["conv_id"], r["section"]): r["body"] for r in s}
    assert got == {(1, "prepared_remarks"): f"**Ann** (executive): {t}?\n\n**Op**: silence", (1, "qa_session"): f"**Caller**: a question? {t}\n\n**Ann** (executive): {t}"}


def test_fundamentals_without_keys_are_neutral(spark):
    m = spark.createDataFrame([("A", 60.0, None, -4.0, 250.0), ("B", None, 900.0, 4.0, None)], "ticker string, peTTM double, peNormalizedAnnual double, pfcfShareTTM double, grossMarginTTM double")
    got = {r["ticker"]: r for r in panels.fundamentals(m).collect()}
    assert (got["A"]["pe_ratio"], got["A"]["fcf_yield"], got["A"]["gross_margin"], got["A"]["roe"]) == (2.0, 0.0, 1.0, 0.0)
    assert (got["B"]["pe_ratio"], got["B"]["fcf_yield"], got["B"]["market_cap_raw"]) == (3.0, 0.25, 0.0)
    assert "gross_margin" in got["B"]["absent"] and "pe_ratio" not in got["B"]["absent"] and len(got["A"]["absent"]) == 11


def test_a_store_without_days_has_its_schema(spark, tmp_path):
    schema = "ticker bigint, n bigint, date date"
    at = f"file://{tmp_path}/days"
    assert readers.read_days(spark, at, schema, "2024-01-01", "2024-01-31").columns == ["ticker", "n", "date"]
    day = lambda n: dt.date(2024, 1, n)
    readers.write_days(spark.createDataFrame([(1, 1, day(1)), (2, 1, day(2))], schema), at)
    readers.write_days(spark.createDataFrame([(3, 5, day(2))], schema), at)
    assert sorted(map(tuple, readers.read_days(spark, at, schema, "2024-01-01", "2024-01-31").collect())) == [(1, 1, day(1)), (3, 5, day(2))]
    assert readers.read_days(spark, at, schema, "2025-01-01", "2025-01-31").count() == 0


def test_holdings_keep_equities_with_a_cusip(spark, tmp_path):
    (tmp_path / "t.txt").write_text("CUSIP|Shares |MARKET_VALUE|put_call\n123456789|1,200|3,000.5|\n123456789|5|6|PUT\n12345678X|5|6|\n987654321|n/a||  \n")
    got = [tuple(r) for r in readers.holdings_table(spark, f"file://{tmp_path}/t.txt").collect()]
    assert got == [("123456789", 1200.0, 3000.5), ("987654321", None, None)]


def test_registry_names_columns_of_groups(spark):
    df = spark.createDataFrame([(1, 2.0)], "ticker int, rsi double")
    assert [tuple(r) for r in readers.registry(spark, {"keys": ["ticker"], "technical": ["rsi", "none"]}, {"bars": df}).collect()] == [("keys", "ticker", "int", "bars"), ("technical", "rsi", "double", "bars")]


def test_renames_are_no_changes(spark):
    day = lambda n: dt.date(2024, 1, n)
    r = spark.createDataFrame([(day(1), "BK"), (day(1), "X"), (day(2), "BNY"), (day(2), "Y")], "date date, ticker string")
    changes, swaps = stores.renamed_changes(r, spark.createDataFrame([("BK", "BNY")], "old_ticker string, new_ticker string"))
    assert sorted((c["ticker"], c["action"]) for c in changes.collect()) == [("X", "REMOVED"), ("Y", "ADDED")]
    assert [(s["left"], s["joined"]) for s in swaps.collect()] == [(["X"], ["Y"])]


def test_content_hash_knows_no_order(spark):
    rows = [(str(n % 7), n) for n in range(500)]
    h = lambda r: stores.content_hash(spark.createDataFrame(r, "a string, n int").repartition(3), ["a", "n"]).first()["content_hash"]
    assert h(rows) == h(rows[::-1]) and h(rows) != h([*rows[1:], ("x", 0)]) and h(rows) != h(rows[1:])
