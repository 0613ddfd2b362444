"""Registered queries over panels joined point in time, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.selection import medians
from barloom.operators import cross_section, panels, technicals
from barloom.plans import sql
from barloom.plans.panels import _FIELDS, _FUND, _metrics
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()

_FACTS = f"""facts AS (SELECT ticker, DATE '1993-06-30' + (k * 182)::INT AS period, DATE '1993-06-30' + (k * 182 + 40 + ticker % 25 + r * 210)::INT AS known_at,
 {', '.join(f'{f} * (10 + k) / 10 * (4 + r) / 4 AS {f}' for f in _FIELDS)} FROM fund, range(10) x(k), range(2) y(r) WHERE r = 0 OR (ticker + k) % 3 = 0)"""


def _facts(spark, d):  # noqa: ANN001, ANN202
    """Ten half-years of each ticker, known some weeks later; every third is restated 210 days after that."""
    f = panels.fundamentals(_metrics(spark, d, 1 << 18)).select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("r"))
    f = f.where("r = 0 or (ticker + k) % 3 = 0")
    day = "date_add(date'1993-06-30', cast(k * 182 {} as int))"
    return f.select("ticker", F.expr(day.format("")).alias("period"), F.expr(day.format("+ 40 + ticker % 25 + r * 210")).alias("known_at"), *[(F.col(c) * (10 + F.col("k")) / 10 * (4 + F.col("r")) / 4).alias(c) for c in _FIELDS])


@R.query(f"""WITH {sql._BARS}, {_FUND}, {_FACTS}, j AS (SELECT b.ticker, b.date, max_by(f, row(f.period, f.known_at)) AS f FROM bars b LEFT JOIN facts f ON f.ticker = b.ticker AND f.known_at <= b.date GROUP BY ALL)
SELECT ticker, date, {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in _FIELDS)} FROM j""", " ".join(_FIELDS))
def fundamental_panel_known(spark, d):  # noqa: ANN001, ANN201
    return panels.with_fundamentals_known(tables.bars(spark, d).select("ticker", "date"), _facts(spark, d))


@R.query(f"""WITH {sql._BARS}, {_FUND}, {_FACTS}, n AS (SELECT ticker, max_by(facts, row(period, known_at)) AS f FROM facts GROUP BY ticker)
SELECT ticker, date, {', '.join(f'coalesce(f.{c}, 0) AS {c}' for c in _FIELDS)} FROM bars LEFT JOIN n USING (ticker)""", " ".join(_FIELDS))
def fundamental_panel_newest(spark, d):  # noqa: ANN001, ANN201
    """The same facts with each ticker's newest values on all of its rows."""
    return panels.with_fundamentals_known(tables.bars(spark, d).select("ticker", "date"), _facts(spark, d), broadcast=True)


#: Fields of each part from an event's value v and number k.
_VALUES = {
    "earnings": {"surprise_pct": "v / 7", "days_since_earnings": "k * 1.0"}, "revision": {"eps_revision_4w": "k / 50.0", "revision_streak": "k % 4 * 1.0"},
    "options": {"put_call_ratio": "v / 30", "iv_rank": "k / 100.0", "atm_iv": "k / 80.0"},
}
_EVENT_DAY = {"earnings": (37, 3), "revision": (53, 2), "options": (71, 1)}


def _part_sql(name: str) -> str:
    step, late = _EVENT_DAY[name]
    fields = ", ".join(f"arg_max(({x})::DOUBLE, event_id) AS {f}" for f, x in _VALUES[name].items())
    return f"""{name} AS (SELECT ticker, date_trunc('month', known_at - (event_id % {late + 2} * 30)::INT)::DATE AS period, known_at, {fields}
FROM (SELECT user_id AS ticker, event_id, value AS v, (props->>'k')::INT AS k, DATE '1993-01-01' + (event_id * {step} % 2000)::INT AS known_at FROM events) WHERE k % {late + 3} > 0 GROUP BY ALL)"""


def _part(spark, d, name):  # noqa: ANN001, ANN202
    """Events stand for reports: some are about an older month than one that is known already."""
    step, late = _EVENT_DAY[name]
    e = tables.read(spark, d, "events").select(F.col("user_id").alias("ticker"), "event_id", F.col("value").alias("v"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    e = e.where(f"k % {late + 3} > 0").withColumn("known_at", F.expr(f"date_add(date'1993-01-01', cast(event_id * {step} % 2000 as int))"))
    e = e.withColumn("period", F.expr(f"cast(date_trunc('month', date_add(known_at, cast(event_id % {late + 2} * -30 as int))) as date)"))
    return e.groupBy("ticker", "period", "known_at").agg(*[F.max_by(F.expr(x).cast("double"), "event_id").alias(f) for f, x in _VALUES[name].items()])


_NEUTRAL = f"""SELECT ticker, date, coalesce(e.surprise_pct, 0) AS earnings_surprise_pct, CASE WHEN e IS NULL THEN 1 ELSE coalesce(e.days_since_earnings + (date - e.known_at), 90) / 90 END AS days_since_earnings,
 coalesce(r.eps_revision_4w, 0) AS eps_revision_4w, coalesce(r.revision_streak, 0) AS revision_streak, coalesce(o.put_call_ratio, 0) AS put_call_ratio, coalesce(o.iv_rank, 0.5) AS iv_rank,
 CASE WHEN realized_vol_20d > 0 AND o.atm_iv > 0 THEN o.atm_iv / realized_vol_20d ELSE 1 END AS iv_vs_rv FROM j"""


def _as_of_sql(name: str, letter: str) -> str:
    return f"{letter}j AS (SELECT p.ticker, p.date, max_by(x, row(x.period, x.known_at)) AS {letter} FROM price p JOIN {name} x ON x.ticker = p.ticker AND x.known_at <= p.date GROUP BY ALL)"


@R.query(f"""WITH {sql._PRICE}, {', '.join(map(_part_sql, _VALUES))}, {_as_of_sql('earnings', 'e')}, {_as_of_sql('revision', 'r')}, {_as_of_sql('options', 'o')},
j AS (SELECT p.ticker, p.date, realized_vol_20d, e, r, o FROM price p LEFT JOIN ej USING (ticker, date) LEFT JOIN rj USING (ticker, date) LEFT JOIN oj USING (ticker, date)) {_NEUTRAL}""", " ".join(panels.ALTERNATIVE))
def alternative_panel_known(spark, d):  # noqa: ANN001, ANN201
    p = technicals.price_features(tables.bars(spark, d)).select("ticker", "date", "realized_vol_20d")
    return panels.with_alternative_known(p, {n: _part(spark, d, n) for n in _VALUES})


_HOT = "CASE WHEN l_orderkey % 10 > 0 THEN 'hot' ELSE l_linestatus END"


@R.query(f"SELECT {_HOT} AS grp, l_returnflag, median(l_extendedprice / l_quantity) AS price, count(l_extendedprice / l_quantity) AS n FROM lineitem GROUP BY ALL UNION ALL SELECT 'all', NULL, median(l_discount - 0.05), count(*) FROM lineitem", "price")
def medians_of_hot_groups(spark, d):  # noqa: ANN001, ANN201
    """Nine tenths of the rows in one group, and all of them in another."""
    t = tables.read(spark, d, "lineitem").select(F.expr(_HOT).alias("grp"), "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("x"), "l_discount")
    every = t.select(F.lit("all").alias("grp"), F.lit(None).cast("string").alias("l_returnflag"), (F.col("l_discount") - 0.05).alias("x"))
    return medians(t.drop("l_discount").union(every), ["grp", "l_returnflag"], "x", "price", "n")


@R.query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, {_HOT} AS grp, l_extendedprice / l_quantity AS x FROM lineitem), m AS (SELECT grp, median(x) AS med FROM t GROUP BY grp),
a AS (SELECT grp, med, 1.4826 * median(abs(x - med)) AS mad FROM t JOIN m USING (grp) GROUP BY ALL), w AS (SELECT t.*, least(greatest(x, med - 3 * mad), med + 3 * mad) AS w FROM t JOIN a USING (grp)), s AS (SELECT grp, avg(w) AS mu, stddev_pop(w) AS sd FROM w GROUP BY grp)
SELECT l_orderkey, l_linenumber, grp, (w - mu) / sd AS z FROM w JOIN s USING (grp)""", "z")
def robust_zscores_of_hot_groups(spark, d):  # noqa: ANN001, ANN201
    t = tables.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT).alias("grp"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("x"))
    return cross_section.robust_zscores_counted(t, ("grp",)).drop("x")
