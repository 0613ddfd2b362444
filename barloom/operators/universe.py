"""Sets of tickers and the state of their series: assembly, differences, allowlists, routing, pruning, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assembled(parts: dict[str, DataFrame]) -> DataFrame:
    """The union of the parts' tickers, with the names of the parts each one is in."""
    tagged = reduce(DataFrame.union, [df.select("ticker", F.lit(name).alias("origin")) for name, df in parts.items()])
    return tagged.groupBy("ticker").agg(F.array_join(F.array_sort(F.collect_set("origin")), ",").alias("origins"))


def former(ever: DataFrame, live: DataFrame, retained: DataFrame) -> DataFrame:
    """Tickers that were members once and are neither live nor retained."""
    return ever.select("ticker").distinct().join(live, "ticker", "left_anti").join(retained, "ticker", "left_anti")


def priced(index: DataFrame, held: DataFrame) -> DataFrame:
    """Index and held tickers with their currency; the holding's wins (ticker, currency on both sides)."""
    i, h = index.withColumnRenamed("currency", "_i"), held.withColumnRenamed("currency", "_h")
    return i.join(h, "ticker", "full").select("ticker", F.coalesce("_h", "_i").alias("currency"), F.col("_h").isNotNull().alias("held"))


def change_events(table: DataFrame) -> DataFrame:
    """(date, ticker, action) of a table with one row per change (date, added, removed as text); rows with bad dates or tickers go."""
    long = table.select(F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date").alias("date"), F.explode(F.array(F.struct(F.col("added").alias("ticker"), F.lit("ADDED").alias("action")), F.struct(F.col("removed").alias("ticker"), F.lit("REMOVED").alias("action")))).alias("_e"))
    return long.select("date", F.trim("_e.ticker").alias("ticker"), "_e.action").where(F.col("date").isNotNull() & F.col("ticker").rlike("^[A-Z0-9.-]+$"))


def swaps(changes: DataFrame) -> DataFrame:
    """Dates on which tickers both came and went, with the numbers of each."""
    g = changes.groupBy("date").agg(F.sum((F.col("action") == "ADDED").cast("long")).alias("added"), F.sum((F.col("action") == "REMOVED").cast("long")).alias("removed"))
    return g.where("added > 0 and removed > 0")


def set_divergence(a: DataFrame, b: DataFrame) -> DataFrame:
    """(ticker, action) pairs that only one of two change sets has; dates do not count."""
    k = ["ticker", "action"]
    one = lambda x, y, s: x.select(*k).distinct().join(y, k, "left_anti").withColumn("only_in", F.lit(s))
    return one(a, b, "first").union(one(b, a, "second"))


def allowlist_state(allowed: DataFrame, covered: DataFrame, members: DataFrame) -> DataFrame:
    """For each allowlisted ticker whether it is covered again today (healed), still absent, or no longer a member."""
    m = lambda df, c: df.select("ticker").distinct().withColumn(c, F.lit(True))
    df = allowed.select("ticker").distinct().join(m(covered, "_c"), "ticker", "left").join(m(members, "_m"), "ticker", "left")
    state = F.when(F.col("_m").isNull(), "not_member").when(F.col("_c"), "healed").otherwise("still_absent")
    return df.select("ticker", state.alias("state"))


def routed(bars: DataFrame, sessions: int) -> DataFrame:
    """Per ticker `cached` where its last bar is among the newest sessions of the panel, else `gap`."""
    last = bars.groupBy("ticker").agg(F.max("date").alias("last_date"))
    days = bars.select("date").distinct().orderBy(F.desc("date")).limit(sessions).agg(F.min("date").alias("floor"))
    return last.crossJoin(F.broadcast(days)).select("ticker", "last_date", F.when(F.col("last_date") >= F.col("floor"), "cached").otherwise("gap").alias("route"))


def regressions(planned: DataFrame, stored: DataFrame) -> DataFrame:
    """Tickers whose planned last date precedes the stored one (ticker, date on both sides)."""
    newest = lambda df, c: df.groupBy("ticker").agg(F.max("date").alias(c))
    return newest(planned, "planned_last").join(newest(stored, "stored_last"), "ticker").where("planned_last < stored_last")


def warmed_up(live: DataFrame, other: DataFrame, least: int) -> DataFrame:
    """Tickers with fewer rows than the least get the other history's rows for dates of their own lack; live rows win."""
    short = live.groupBy("ticker").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < least).select("ticker")
    fill = other.join(short, "ticker", "left_semi").join(live.select("ticker", "date"), ["ticker", "date"], "left_anti")
    return live.withColumn("origin", F.lit("live")).unionByName(fill.withColumn("origin", F.lit("stitched")))


def pruned(bars: DataFrame, members: DataFrame, renamed: DataFrame, as_of: Column, stale_days: int = 14) -> DataFrame:
    """Tickers to move to the archive: no members, not renamed, and without bars for more than so many days."""
    last = bars.groupBy("ticker").agg(F.max("date").alias("last_date"), F.count(F.lit(1)).alias("rows"))
    gone = last.join(members, "ticker", "left_anti").join(renamed, "ticker", "left_anti")
    return gone.where(F.datediff(as_of, "last_date") > stale_days)


def coverage(expected: DataFrame, present: DataFrame, day: str, max_age: int, floor: float) -> DataFrame:
    """Per kind the share of expected keys that are fresh, stale or missing, and the verdict (key, kind; present has a date)."""
    newest = present.groupBy("key", "kind").agg(F.max("date").alias("date"))
    age = F.datediff(F.lit(day).cast("date"), "date")
    g = expected.join(newest, ["key", "kind"], "left").groupBy("kind").agg(
        F.count(F.lit(1)).alias("expected"), F.sum(F.coalesce(age <= max_age, F.lit(False)).cast("long")).alias("fresh"), F.sum(F.coalesce(age > max_age, F.lit(False)).cast("long")).alias("stale"), F.sum(F.isnull("date").cast("long")).alias("missing")
    )
    return g.withColumn("verdict", F.when(F.col("fresh") / F.col("expected") >= floor, "fresh").when(F.col("missing") < F.col("expected"), "stale").otherwise("missing"))


def nested(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """One row: how many tickers of the inner set the outer lacks, how many are no tickers, and whether the gate passes."""
    out = inner.select("ticker").distinct().join(outer.select("ticker").distinct().withColumn("_o", F.lit(1)), "ticker", "left")
    g = out.agg(F.sum(F.isnull("_o").cast("long")).alias("outside"), F.sum((~F.col("ticker").cast("string").rlike("^[A-Z0-9.-]{1,10}$")).cast("long")).alias("malformed"))
    return g.withColumn("passes", (F.col("outside") == 0) & (F.col("malformed") == 0))


def reconciled(loaded: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per source the tickers loaded against the number the producer recorded: complete, short, or empty (source, ticker; source, recorded)."""
    n = loaded.groupBy("source").agg(F.countDistinct("ticker").alias("loaded"))
    df = manifest.join(n, "source", "left").withColumn("loaded", F.coalesce("loaded", F.lit(0)).cast("long"))
    return df.withColumn("status", F.when(F.col("loaded") == 0, "empty").when(F.col("loaded") < F.col("recorded"), "short").otherwise("complete"))


def low_quality_sessions(closes: DataFrame, canonical: str) -> DataFrame:
    """Dates with rows from another source than the canonical one or without a close, and how many."""
    bad = ~F.col("source").eqNullSafe(canonical) | F.col("close").isNull()
    g = closes.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.sum(bad.cast("long")).alias("low_quality"))
    return g.where("low_quality > 0")


def completeness(table: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Percent of rows with all columns known, by a key."""
    ok = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
    return table.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), (F.avg(ok.cast("int")) * 100).alias("complete_pct"))


def uncovered_dates(signals: DataFrame, outcomes: DataFrame, as_of: str, age: int) -> DataFrame:
    """Signal dates old enough to have matured of which no outcome is stored, with their signals."""
    old = signals.where(F.col("date") <= F.date_sub(F.lit(as_of).cast("date"), age))
    return old.groupBy("date").agg(F.count(F.lit(1)).alias("signals")).join(outcomes.select("date").distinct(), "date", "left_anti")


def repaired(rows: DataFrame, donors: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Null columns filled from the donor row of the key; known values stay."""
    d = donors.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    return rows.join(d, keys, "left").withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def renamed_history(bars: DataFrame, renames: DataFrame) -> DataFrame:
    """Histories under their new tickers; where the new ticker has rows already, the old ones are dropped, never merged (old_ticker, new_ticker)."""
    taken = renames.join(bars.select(F.col("ticker").alias("new_ticker")).distinct(), "new_ticker", "left_semi").select("old_ticker", F.lit(True).alias("_t"))
    r = renames.join(taken, "old_ticker", "left")
    df = bars.join(r, F.col("ticker") == F.col("old_ticker"), "left").where(F.col("_t").isNull())
    return df.withColumn("ticker", F.coalesce("new_ticker", "ticker")).drop("old_ticker", "new_ticker", "_t")
