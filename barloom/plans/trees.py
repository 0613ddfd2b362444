"""Registered queries over hash trees of change sets and bars, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import merkle
from barloom.plans import sql
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()

_MOVES = "moves AS (SELECT l_suppkey AS ticker, l_shipdate::DATE AS date, CASE WHEN l_returnflag = 'A' THEN 'added' ELSE 'removed' END AS action FROM lineitem WHERE l_returnflag <> 'N')"


def _moves(spark, d):  # noqa: ANN001, ANN202
    """Trades stand for changes of membership; some are there twice."""
    t = tables.read(spark, d, "lineitem").where("l_returnflag <> 'N'")
    return t.select(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"), F.expr("CASE WHEN l_returnflag = 'A' THEN 'added' ELSE 'removed' END").alias("action"))


@R.query(f"""WITH {_MOVES}, e AS (SELECT sha256('{{"action":"' || action || '","date":"' || date || '","ticker":' || ticker || '}}') AS digest, count(*) AS times FROM moves GROUP BY ALL),
l2 AS (SELECT substr(digest, 1, 2) AS prefix, sum(times) AS n, sha256(string_agg(digest || ':' || times, ',' ORDER BY digest || ':' || times)) AS hash FROM e GROUP BY ALL),
l1 AS (SELECT substr(prefix, 1, 1) AS prefix, sum(n) AS n, sha256(string_agg(substr(prefix, 2, 1) || ':' || hash, ',' ORDER BY prefix)) AS hash FROM l2 GROUP BY substr(prefix, 1, 1)),
l0 AS (SELECT '' AS prefix, sum(n) AS n, sha256(string_agg(prefix || ':' || hash, ',' ORDER BY prefix)) AS hash FROM l1)
SELECT level::INT AS level, prefix, n::BIGINT AS n, hash FROM (SELECT 2 AS level, * FROM l2 UNION ALL SELECT 1, * FROM l1 UNION ALL SELECT 0, * FROM l0)""")
def change_set_tree(spark, d):  # noqa: ANN001, ANN201
    return merkle.tree(merkle.entries(_moves(spark, d)), 2)


_RESTATED = "CASE WHEN ticker % 40 = 3 AND date < DATE '1996-01-01' THEN close / 2 ELSE close END"


@R.query(f"""WITH {sql._BARS}, a AS (SELECT ticker, date, close FROM bars), b AS (SELECT ticker, date, {_RESTATED} AS close FROM bars WHERE NOT (ticker % 50 = 7 AND date >= DATE '1998-06-01') UNION ALL SELECT ticker, date, close FROM bars WHERE ticker % 90 = 11),
ca AS (SELECT ticker, date, close, count(*) AS in_a FROM a GROUP BY ALL), cb AS (SELECT ticker, date, close, count(*) AS in_b FROM b GROUP BY ALL)
SELECT ticker, date, close, coalesce(in_a, 0)::BIGINT AS in_a, coalesce(in_b, 0)::BIGINT AS in_b FROM ca FULL JOIN cb USING (ticker, date, close) WHERE coalesce(in_a, 0) <> coalesce(in_b, 0)""", "close")
def divergence_of_stores(spark, d):  # noqa: ANN001, ANN201
    """Two stores of closes: one restated for some tickers, cut short for others, with rows twice for a few.

    The second is made of the first's rows one by one, so that both come from one shuffle of the trades."""
    a = tables.bars(spark, d).select("ticker", "date", "close")
    kept = F.expr(f"CASE WHEN NOT (ticker % 50 = 7 AND date >= DATE '1998-06-01') THEN struct({_RESTATED} AS close) END")
    twice = F.expr("CASE WHEN ticker % 90 = 11 THEN struct(close) END")
    b = a.select("ticker", "date", F.explode(F.filter(F.array(kept, twice), lambda x: x.isNotNull())).alias("_of")).select("ticker", "date", "_of.close")
    return merkle.difference_by_key(a, b, ["ticker"], tables.read(spark, d, "lineitem").count())
