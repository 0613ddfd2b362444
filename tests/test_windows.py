"""Windows of constant cost, exact medians by counting, and hash trees."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.functions.selection import medians
from barloom.functions.sliding import block_windows
from barloom.operators import cross_section, merkle, technicals

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("n", [1, 2, 5, 7])
def test_block_windows_against_slices(spark, n):
    r = random.Random(n)
    rows = [(t, d, r.choice([None, 0.1, 0.1, 3.0, -2.5, 1e9, INF if d == 20 else 4.0])) for t in ("a", "b", None) for d in range(45)] + [("one", 1, 2.0)]
    df = spark.createDataFrame(rows, "ticker string, date int, x double").repartition(3)
    kinds = {"s": "sum", "m": "avg", "hi": "max", "lo": "min", **({"sd": "sd"} if n > 1 else {})}
    got = {(x["ticker"], x["date"]): x for x in block_windows(df, {n: {k: (v, "x") for k, v in kinds.items()}}).collect()}
    assert len(got) == len(rows)
    plain = {"sum": sum, "avg": lambda v: sum(v) / n, "max": max, "min": min, "sd": lambda v: statistics.stdev(v) if INF not in v else NAN}
    for t in ("a", "b", None, "one"):
        own = [x for k, _, x in rows if k == t]
        for i in range(len(own)):
            window = own[max(0, i - n + 1) : i + 1]
            for k, kind in kinds.items():
                x = got[t, i if t != "one" else 1][k]
                if len(window) < n or None in window:
                    assert x is None
                else:
                    want = plain[kind](window)
                    assert (math.isnan(x) and (math.isnan(want) or want == INF)) if math.isnan(x) else x == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_one_infinite_price_leaves_with_its_windows(spark):
    days = 700
    rows = [("t", d, 100.0 + d % 7, 102.0 + d % 7, 99.0, INF if d == 300 else 100.0 + (d * 13) % 11, 10.0 + d % 5, 100.0) for d in range(days)]
    b = spark.createDataFrame(rows, "ticker string, date int, open double, high double, low double, close double, volume double, vwap double")
    got = {r["date"]: r for r in technicals.price_features(b).collect()}
    bad = lambda c: {d for d in range(260, days) if got[d][c] is None or math.isnan(got[d][c]) or math.isinf(got[d][c]) or got[d][c] == -1}
    assert bad("price_vs_ma50") == set(range(300, 350)) and bad("price_vs_ma200") == set(range(300, 500)) and bad("dist_from_52w_high") == set(range(300, 552)) | {300}
    assert max(bad("realized_vol_63d")) == 300 + 62 and max(bad("max_drawdown_60d")) <= 300 + 2 * 60
    market = spark.createDataFrame([(d, 50.0 + (d * 7) % 5) for d in range(days)], "date int, spy double")
    m = {r["date"]: r for r in technicals.market_features(b, market).collect()}
    assert m[699]["residual_momentum_ratio"] is not None and not math.isnan(m[699]["residual_momentum_ratio"]) and not math.isnan(m[500]["idio_vol_60d"])


def test_medians_of_groups_of_any_size(spark):
    r = random.Random(2)
    values = [0.0, -0.0, 1.5, -1.5, 1e-310, -1e300, 1e300, INF, -INF, 7.25, None]
    rows = [("hot" if r.random() < 0.9 else r.choice(["a", "b", None]), r.choice([*values, r.gauss(100, 1), r.gauss(100, 1)])) for _ in range(3000)] + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("nan", NAN), ("nan", 1.0), ("nan", NAN), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {x["k"]: (x["median"], x["n"]) for x in medians(df, ["k"], "x").collect()}
    for k in ("hot", "a", "b", None, "one", "two"):
        own = [x for j, x in rows if j == k and x is not None]
        assert got[k] == (statistics.median(own), len(own))
    assert math.isnan(got["nan"][0]) and got["nan"][1] == 3 and "none" not in got
    assert medians(df.limit(0), ["k"], "x").count() == 0
    by_two = {(x["k"], x["even"]): x["median"] for x in medians(df.withColumn("even", F.col("x") > 100), ["k", "even"], "x").collect()}
    assert by_two["hot", True] == statistics.median([x for k, x in rows if k == "hot" and x is not None and x > 100])


def test_counted_scores_equal_those_by_windows(spark):
    r = random.Random(5)
    rows = [(r.choice(["f", "g"]), r.randrange(4), n, r.choice([None, 1.0, r.gauss(0, 1), r.gauss(0, 30)])) for n in range(400)] + [("h", 0, 1000, 1.0), ("h", 1, 1001, None), ("h", 2, 1002, 5.0), ("h", 2, 1003, 5.0)]
    df = spark.createDataFrame(rows, "factor string, date int, id int, x double")
    one, two = ({x["id"]: x["z"] for x in f(df).collect()} for f in (cross_section.robust_zscores, cross_section.robust_zscores_counted))
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) if one[k] is not None else two[k] is None for k in one) and any(one.values())


def test_positive_medians_keep_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, -1.0), ("a", INF, 2.0), ("b", -1.0, None), (None, 4.0, 4.0)], "s string, x double, y double")
    got = {r["s"]: tuple(r)[1:] for r in cross_section.positive_medians(df, ["s"], ["x", "y"]).collect()}
    assert got == {"a": (2.0, 2, 2.0, 1), "b": (None, 0, None, 0), None: (4.0, 1, 4.0, 1)}


def test_roots_do_not_depend_on_order_and_lead_to_differences(spark):
    r = random.Random(9)
    rows = [(n % 700, f"s{n % 13}", r.choice([None, float(n)])) for n in range(1500)]
    a = spark.createDataFrame(rows, "k int, s string, x double")
    shuffled = spark.createDataFrame(r.sample(rows, len(rows)), "k int, s string, x double").repartition(7).select("x", "k", "s")
    assert merkle.root(a) == merkle.root(shuffled) and merkle.root(a)[0] == 1500
    changed = [*rows[:40], (rows[40][0], "other", rows[40][2]), *rows[41:], rows[3], (1, None, None)]
    b = spark.createDataFrame(changed, "k int, s string, x double")
    assert merkle.root(b)[1] != merkle.root(a)[1]
    got = sorted(map(tuple, merkle.difference(a, b, leaf=8).collect()), key=repr)
    times = lambda of, row: sum(x == row for x in of)
    want = {x for x in {*rows, *changed} if times(rows, x) != times(changed, x)}
    assert got == sorted(((*x, times(rows, x), times(changed, x)) for x in want), key=repr) and len(want) == 4
    ea, eb = merkle.entries(a), merkle.entries(b)
    assert merkle.unequal(merkle.tree(ea, 2), merkle.tree(eb, 2), 2).count() <= 4  # few of some 250 leaves are looked at
    empty = a.limit(0)
    assert merkle.root(empty) == (0, "") and merkle.difference(a, empty).count() == a.distinct().count() and merkle.difference(empty, empty).count() == 0


def test_the_walk_down_joins_each_level_once(spark):
    rows = spark.range(50).select("id")
    tree = merkle.tree(merkle.entries(rows), 5)
    plan = merkle.unequal(tree, tree, 5)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join FullOuter") == 6


def test_a_hot_group_is_joined_in_parts(spark):
    rows = spark.range(2000, numPartitions=3).select("id", F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") < 1900, "b").otherwise("none").alias("g"), F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("x"))
    numbers = rows.where("g <> 'none'").groupBy("g").agg(F.count("x").alias("_n"), F.max("x").alias("top"))
    tops = {r["g"]: r["top"] for r in numbers.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = cross_section.with_numbers(rows, numbers, ["g"], share=50).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(r["id"] for r in got) == list(range(2000)) and all(r["top"] == tops.get(r["g"]) for r in got)
    assert len({r["p"] for r in got if r["g"] == "hot"}) > 1 and len({r["p"] for r in got if r["g"] == "b"}) > 1


def test_price_features_slide_over_ten_rows_at_most(spark):
    """A frame of 63 rows was gone through anew at each row; and code of over 8,000 bytes would not be compiled."""
    import re

    from barloom.plans import catalog

    df = catalog.queries()["price_features"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert max(int(n) for n in re.findall(r"specifiedwindowframe\(RowFrame, -(\d+), currentrow", plan)) == 9
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    on = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = catalog.queries()["price_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", on)
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000


def test_pieced_windows_against_slices(spark):
    """Deviations, means and extremes put together from pieces, over random prices, over one price (no last bit of a deviation may stay) and around missing ones."""
    r = random.Random(7)
    close = {"random": [100 * math.exp(r.gauss(0, 0.3)) for _ in range(300)], "one": [0.1] * 300, "gap": [None if d == 120 else 50 + 0.1 * (d % 3) for d in range(300)]}
    rows = [(t, d, x, x, x, x, 5.0 + d % 4, x) for t, xs in close.items() for d, x in enumerate(xs)]
    b = spark.createDataFrame(rows, "ticker string, date int, open double, high double, low double, close double, volume double, vwap double")
    got = {(x["ticker"], x["date"]): x for x in technicals.price_features(b).collect()}
    for t, xs in close.items():
        ret = [None] + [None if None in (x, y) else y / x - 1 for x, y in zip(xs, xs[1:])]
        log = [None] + [None if None in (x, y) else math.log(y / x) for x, y in zip(xs, xs[1:])]
        window = lambda of, d, n: of[d - n + 1 : d + 1] if d >= n - 1 and None not in of[d - n + 1 : d + 1] else None
        same = lambda x, y: (x is None) == (y is None) and (x is None or x == pytest.approx(y, rel=1e-9, abs=1e-14))
        sd = lambda w, k=1.0: None if w is None else statistics.stdev(w) * k
        vols = [sd(window(ret, d, 20), math.sqrt(252)) for d in range(300)]
        for d in range(300):
            x, c = got[t, d], xs[d]
            assert same(x["realized_vol_20d"], vols[d]) and same(x["realized_vol_63d"], sd(window(ret, d, 63), math.sqrt(252))) and same(x["vol_of_vol_30d"], sd(window(vols, d, 30)))
            s10, s60 = sd(window(log, d, 10)), sd(window(log, d, 60))
            assert same(x["vol_ratio_10_60"], s10 / s60 if s10 is not None and s60 else 1.0)
            for n, k in ((50, "price_vs_ma50"), (200, "price_vs_ma200")):
                assert same(x[k], c / statistics.fmean(window(xs, d, n)) - 1 if window(xs, d, n) else None)
            for f, k in ((max, "dist_from_52w_high"), (min, "dist_from_52w_low")):
                assert same(x[k], c / f(window(xs, d, 252)) - 1 if window(xs, d, 252) else None)
    assert got["one", 299]["bollinger_pct"] == 0.5 and got["one", 299]["realized_vol_63d"] == 0 == got["one", 299]["vol_of_vol_30d"]


def test_doubles_are_rounded_as_duckdb_rounds(spark):
    """Whole multiples with halves away from zero; the last digit of large values differed."""
    import duckdb

    from barloom.plans import registry

    r = random.Random(3)
    xs = [None, INF, -INF, NAN, 0.0, -0.0, 1e308, -1e305, 5e-324, 1e10 + 0.1234567, 2610062970.0373473, -842919142.0930204] + [r.gauss(0, 10.0 ** r.randrange(-6, 17)) for _ in range(20000)]
    got = registry.rounded(spark.createDataFrame(list(enumerate(xs)), "i int, x double").select("i", "x", F.lit("kept").alias("note"), F.col("x").alias("a.b"))).collect()
    con = duckdb.connect()
    for t in got:
        x = xs[t["i"]]
        want = None if x is None else con.execute("SELECT round(?::DOUBLE + ?::DOUBLE, 6) + 0.0", [x, registry.NUDGE]).fetchone()[0] if t["i"] < 3000 else t["x"]
        assert repr(t["x"]) == repr(want) and repr(t["a.b"]) == repr(t["x"]) and t["note"] == "kept"
    whole = registry.rounded(spark.range(2).select("id"))
    assert whole.columns == ["id"] and whole.count() == 2


def test_difference_by_key_equals_that_by_rows(spark):
    """Keys on one side only, changed, repeated, reordered, missing and equal ones; rows with missing values; empty tables."""
    r = random.Random(11)
    rows = [(r.choice([None, *range(60)]), r.choice("xyz"), d, r.choice([None, 1.5, -0.0, float(d)])) for d in range(900)]
    other = [x for x in rows if x[0] != 7 and not (x[0] == 9 and x[2] > 500)]
    other = [(k, p, d, -1.0 if k in (3, None) and d % 5 == 0 else v) for k, p, d, v in other] + [x for x in rows if x[0] == 11] + [(99, "x", 1, None), (0, None, 2, 2.0), (0, None, 2, 2.0)]
    r.shuffle(other)
    schema = "k int, p string, d int, v double"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema).repartition(3).select("v", "d", "p", "k")
    plain = lambda df: sorted(map(tuple, df.select("k", "p", "d", "v", "in_a", "in_b").collect()), key=repr)
    want = plain(merkle.difference(a, b))
    assert len(want) > 50 and {x[0] for x in want} >= {None, 0, 3, 7, 9, 11, 99}
    for bound in (1, 100, 10**6):
        assert plain(merkle.difference_by_key(a, b, ["k"], bound)) == want
    assert plain(merkle.difference_by_key(a, b, ["k", "p"], 900)) == want
    empty = a.limit(0)
    assert plain(merkle.difference_by_key(a, empty, ["k"], 60)) == plain(merkle.difference(a, empty)) and merkle.difference_by_key(a, a, ["k"], 60).count() == 0 == merkle.difference_by_key(empty, empty, ["k"], 0).count()


def test_divergence_of_stores_shuffles_trades_once(spark):
    """They were shuffled nine times, and each row's digest five times."""
    from barloom.plans import catalog

    df = catalog.queries()["divergence_of_stores"](spark, "/root/testdata/sf0.001")
    assert df.collect()
    done = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    trades = [x for x in done.splitlines() if "Exchange hashpartitioning(l_suppkey" in x and "Reused" not in x]
    assert len(trades) == 1
    rows = [x for x in done.splitlines() if "Exchange hashpartitioning(" in x and "Reused" not in x and "digest" in x]
    assert len(rows) == 1  # of a row a key and store; what differs is compared where it lies
