"""Names of registered queries."""

import duckdb
import pytest

from barloom.operators import returns
from barloom.plans import catalog, filings, known, panels, passes, registry, reports, series, shapes, stores, tolerant, trees

SF = "/root/testdata/sf0.001"


def test_every_definition_is_registered():
    assert len(catalog.queries()) == len(catalog._queries) + sum(len(m.R.queries) for m in catalog.MODULES)
    assert catalog.oracle_sql()["alternative_features"] == series.R.sql["alternative_features"]
    assert catalog.oracle_sql()["alternative_payloads"] == shapes.R.sql["alternative_payloads"]


def test_a_name_is_registered_once():
    r = registry.Registry()

    def twice(spark, d):
        return None

    r.query("SELECT 1")(twice)
    with pytest.raises(ValueError, match="twice"):
        r.query("SELECT 2")(twice)
    with pytest.raises(ValueError, match="twice"):
        registry.merged({"a": 1}, {"b": 2}, {"a": 3})


#: Queries that may find nothing in so small a table.
EMPTY = {"change_divergence_since"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = [*known.R.sql, *passes.R.sql, *trees.R.sql, *tolerant.R.sql, *filings.R.sql, *panels.R.sql, *stores.R.sql, *reports.R.sql, "alternative_features", "alternative_payloads", "forward_returns_all_horizons", "exit_prices_all_horizons", "period_returns_all"]
CHECKED += ["price_features", "oscillators", "robust_zscores", "news_daily", "article_records", "article_dedupe", "roster_changes", "point_in_time_membership", "series_gate", "contract_gates", "change_hash"]


@pytest.mark.parametrize("name", CHECKED)
def test_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(catalog.oracle_sql()[name])
    got = catalog.queries()[name](spark, SF)
    assert sorted(rel.columns) == sorted(got.columns)
    plain = lambda x: round(x, 6) + 0.0 if isinstance(x, float) else x if isinstance(x, (int, str)) or x is None else str(x)
    rows = lambda it: sorted(([plain(x) for x in r] for r in it), key=repr)
    cols = sorted(rel.columns)
    want = rows(rel.project(", ".join(f'"{c}"' for c in cols)).fetchall())
    assert rows(tuple(r) for r in got.select(*[f"`{c}`" for c in cols]).collect()) == want and (want or name in EMPTY)


def test_all_horizons_have_rows(spark):
    got = catalog.queries()["forward_returns_all_horizons"](spark, SF).groupBy("horizon").count().collect()
    assert {r["horizon"] for r in got if r["count"]} == {1, 3, 5, 10, 15, 21, 30, 60, 90}
    exits = catalog.queries()["exit_prices_all_horizons"](spark, SF)
    assert {r["horizon"] for r in exits.select("horizon").distinct().collect()} == {5, 10, 21, 30} and exits.where("ticker % 3 > 0").count() > 0


def test_long_periods_and_the_year_to_date(spark):
    rows = [("A", f"{y}-{m:02d}-15", 100.0 + 12 * (y - 2000) + m) for y in range(2000, 2012) for m in range(1, 13)] + [("B", "2011-03-01", 10.0), ("B", "2011-12-15", 12.0)]
    b = spark.createDataFrame(rows, "ticker string, date string, close double").selectExpr("ticker", "date(date) AS date", "close")
    got = {r["ticker"]: r for r in returns.period_returns(b, (1, 10), year_to_date=True).collect()}
    assert got["A"]["return_10y"] == pytest.approx(244 / 124 - 1) and got["A"]["return_ytd"] == pytest.approx(244 / 233 - 1) and got["A"]["return_1y"] == pytest.approx(244 / 232 - 1)
    assert got["B"]["return_10y"] is None and got["B"]["return_ytd"] is None


def test_forward_returns_shuffle_no_row_per_horizon(spark):
    """Bars are shuffled as they are: no join of a row for each horizon."""
    days = [f"2020-01-{n:02d}" for n in range(1, 11)]
    rows = [(t, day, 10.0 * t + n) for t in (1, 2) for n, day in enumerate(days) if not (t == 2 and n == 4)] + [(None, days[0], 1.0)]
    bars = spark.createDataFrame(rows, "ticker int, date string, close double").selectExpr("ticker", "date(date) AS date", "close")
    market = bars.where("ticker = 1 and day(date) != 3").selectExpr("date", "close AS spy")
    df = returns.forward_returns(bars, market, (1, 3))
    got = {(r["ticker"], r["date"].day, r["horizon"]): r for r in df.collect()}
    assert len(got) == 9 + 7 + 7 + 5 and df.count() == len(got)
    assert (2, 4, 1) not in got and got[2, 4, 3]["ret"] == pytest.approx(26 / 23 - 1) and got[1, 3, 1]["spy_ret"] is None and got[1, 2, 1]["spy_ret"] is None
    assert got[1, 1, 3]["spy_ret"] == pytest.approx(13 / 10 - 1) and got[1, 1, 3]["beat_spy"] is False
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan and "horizon" not in "".join(x for x in plan.splitlines() if "Join" in x)


def test_regime_products_join_no_two_passes_of_one_bars(spark):
    plan = catalog.queries()["regime_products_all"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Join Inner" in x and "ticker#" in x and "date#" in x]) == 2  # with the sectors' returns, and the join inside these
