"""Nested documents and odd shapes brought to the columns that other operators read, and rules that documents keep to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields of an alternative-data payload; a section that is null has no fields.
ALTERNATIVE = """struct<eps_revision: struct<surprise_pct: double, days_since_earnings: double, revision_4w: double, streak: int>,
analyst_consensus: struct<earnings_surprises: array<struct<date: string, surprise_pct: double>>>, options_flow: struct<put_call_ratio: double, iv_rank: double, expected_move_pct: double>>"""


def alternative_features(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Earnings, revision and option fields of JSON payloads (ticker, payload).

    The surprise is in percent points, the section's own or else that of the newest quarter listed, and becomes a fraction."""
    p = df.select("ticker", F.from_json(payload, ALTERNATIVE).alias("p"))
    listed = F.col("p.analyst_consensus.earnings_surprises")
    fallback = F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, F.get(listed, 0)["surprise_pct"]).otherwise(0.0)
    eps, options = F.col("p.eps_revision"), F.col("p.options_flow")
    return p.select(
        "ticker", (F.coalesce(eps["surprise_pct"], fallback) / 100.0).alias("surprise_pct"), F.coalesce(eps["days_since_earnings"], F.lit(0.0)).alias("days_since_earnings"),
        F.coalesce(eps["revision_4w"], F.lit(0.0)).alias("eps_revision_4w"), F.coalesce(eps["streak"], F.lit(0)).alias("revision_streak"),
        options["put_call_ratio"].alias("put_call_ratio"), options["iv_rank"].alias("iv_rank"), options["expected_move_pct"].alias("atm_iv"),
    )


def options_mirror(features: DataFrame, fields: list[str]) -> DataFrame:
    """Tickers that have any of the option fields, with these alone."""
    return features.where(F.coalesce(*[F.col(f) for f in fields]).isNotNull()).select("ticker", *fields)


def short_interest(df: DataFrame) -> DataFrame:
    """Short interest (ticker, fraction of the float, days, shares) in percent, rounded; rows without any value go."""
    known = df.where(F.coalesce("fraction", "days", F.col("shares").cast("double")).isNotNull())
    return known.select("ticker", F.round(F.col("fraction") * 100, 2).alias("short_pct_float"), F.round("days", 2).alias("short_ratio"), F.col("shares").cast("long").alias("shares_short"))


def as_bars(series: DataFrame, source: str) -> DataFrame:
    """A series (series_id, date, value) in the shape of bars: the value as every price, no volume, no VWAP."""
    v = F.col("value").cast("double")
    return series.select(F.col("series_id").alias("ticker"), "date", *[v.alias(c) for c in ("open", "high", "low", "close", "adj_close")], F.lit(0).cast("long").alias("volume"), F.lit(None).cast("double").alias("vwap"), F.lit(source).alias("source"))


def backfill_macro(frame: DataFrame) -> DataFrame:
    """Macro features on the dates of VIX, for a wide frame (date, VIX, VIX3M, TNX, IRX, GLD); the term slope is relative to VIX, at least 1."""
    f = frame.where(F.col("VIX").isNotNull()).withColumn("_g", F.lag("GLD", 5).over(Window.orderBy("date")))  # one row per date of the calendar
    slope = (F.col("VIX3M") - F.col("VIX")) / F.greatest("VIX", F.lit(1.0))
    return f.select("date", (F.col("VIX") / 20).alias("vix_level"), (F.col("TNX") / 10).alias("yield_10y"), ((F.col("TNX") - F.col("IRX")) / 10).alias("yield_curve_slope"), (F.col("GLD") / F.nullif("_g", F.lit(0.0)) - 1).alias("gold_mom_5d"), slope.alias("vix_term_slope_rel"))


def wide(series: DataFrame, names: list[str]) -> DataFrame:
    """One row per date with a column for each named series (series_id, date, value)."""
    return series.where(F.col("series_id").isin(names)).groupBy("date").agg(*[F.max(F.when(F.col("series_id") == n, F.col("value"))).alias(n) for n in names])


def first_tickers(df: DataFrame, n: int) -> DataFrame:
    """The rows of the first n tickers in order."""
    return df.join(df.select("ticker").distinct().orderBy("ticker").limit(n), "ticker", "left_semi")


def contract_gates(bars: DataFrame, anchor: Column, max_age: int, floors: dict[str, tuple[Column, float]]) -> DataFrame:
    """Gates (gate, value, passed) of a table: its anchor series and its tickers are fresh against the newest date, and each named share of rows reaches its floor."""
    last = bars.groupBy("ticker").agg(F.max("date").alias("last"), F.max(anchor).alias("anchor"), F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_{k}") for k, (c, _) in floors.items()])
    newest = bars.agg(F.max("date")).first()[0]
    aged = last.withColumn("age", F.datediff(F.lit(newest).cast("date"), "last"))
    one = aged.agg(F.max(F.when(F.col("anchor"), F.col("age"))).cast("double").alias("anchor_age"), F.avg((F.col("age") <= max_age).cast("double")).alias("fresh"), *[(F.sum(f"_{k}") / F.sum("n")).alias(k) for k in floors])
    long = one.unpivot([], ["anchor_age", "fresh", *floors], "gate", "value")
    least = F.coalesce(*[F.when(F.col("gate") == k, F.lit(float(x))) for k, (_, x) in floors.items()], F.lit(1.0))
    passed = F.when(F.col("gate") == "anchor_age", F.col("value") <= max_age).otherwise(F.col("value") >= least)
    return long.select("gate", "value", F.coalesce(passed, F.lit(False)).alias("passed"))


def contract_warnings(df: DataFrame, id_col: str, payload: str, schema: str, rules: dict[str, Column], keep: int = 10) -> DataFrame:
    """The first few warnings of each JSON document: `not a document`, or the names of the rules that the parsed struct `p` breaks."""
    parsed = df.select(id_col, F.from_json(payload, schema).alias("p"))
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    return parsed.select(id_col, F.when(F.col("p").isNull(), F.array(F.lit("not a document"))).otherwise(F.slice(broken, 1, keep)).alias("warnings"))


def quarantined(series_flags: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Tickers of a series gate (ticker and counts of anomalies) with the gates that exceed their limits; `quarantine` where any does."""
    over = F.array_compact(F.array(*[F.when(F.col(k) > n, F.lit(k)) for k, n in limits.items()]))
    return series_flags.select("ticker", F.array_join(over, ",").alias("gates"), (F.size(over) > 0).alias("quarantine"))


def thesis_text(df: DataFrame, fields: dict[str, str]) -> Column:
    """Labelled paragraphs of the fields (label: column) that are not empty."""
    return F.concat_ws("\n\n", *[F.when(F.trim(F.col(c).cast("string")) != "", F.concat(F.lit(f"{label}: "), F.col(c).cast("string"))) for label, c in fields.items()])


def trailing(bars: DataFrame, sessions: int) -> DataFrame:
    """The rows of the last so many sessions, for features of the newest dates that look back no further."""
    first = bars.select("date").distinct().orderBy(F.desc("date")).limit(sessions)
    return bars.join(first, "date", "left_semi")


def mapped(holdings: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Holdings with the ticker of their identifier; those that the dimension (key, ticker) does not know are dropped."""
    return holdings.join(dimension.where("ticker is not null").select(key, "ticker").dropDuplicates([key]), key)


def stale(expected: DataFrame, bars: DataFrame, reference: str, days: int) -> DataFrame:
    """Expected tickers whose newest bar is more than so many days before the reference date, or that have none (age is null)."""
    newest = bars.groupBy("ticker").agg(F.max("date").alias("last_date"))
    df = expected.join(newest, "ticker", "left").withColumn("age", F.datediff(F.lit(reference).cast("date"), "last_date"))
    return df.where(F.col("age").isNull() | (F.col("age") > days)).select("ticker", "last_date", "age")


def price_source(universe: DataFrame, macro: DataFrame) -> DataFrame:
    """The universe's bars and the macro series in the shape of bars as one table; columns that one side lacks are null there."""
    return universe.unionByName(macro, allowMissingColumns=True)


def annotations(scores: DataFrame, events: DataFrame) -> DataFrame:
    """Scores (id, score) and event flags (id, category) of articles as one long table (id, kind, name, value)."""
    a = scores.select("id", F.lit("score").alias("kind"), F.lit("sentiment").alias("name"), F.col("score").alias("value"))
    return a.union(events.select("id", F.lit("event"), F.col("category"), F.lit(1.0)))
