"""Which dates, rows and tickers a run still has to handle, and what it settles: windows, seeds, pending rows, gates, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.merge import sessions


def _by_session(bars: DataFrame) -> DataFrame:
    """date, session and last (the newest session) of the calendar, which has some thousands of dates."""
    return sessions(bars).withColumn("last", F.max("session").over(Window.partitionBy()))


def due_dates(bars: DataFrame, stored: DataFrame, short: int = 5, long: int = 21) -> DataFrame:
    """Dates whose short window has closed and that are not complete.

    stored is (date, has_short, has_long). A date is complete when the short return is stored and the long one is too or is not due yet,
    so a date whose long window closes later comes up again."""
    df = _by_session(bars).join(stored, "date", "left")
    closed = lambda h: F.col("session") + h < F.col("last")
    complete = F.coalesce("has_short", F.lit(False)) & (F.coalesce("has_long", F.lit(False)) | ~closed(long))
    return df.where(closed(short) & ~complete).select("date", closed(long).alias("long_closed"))


def grading_lag(bars: DataFrame, graded: DataFrame, horizons: tuple[int, ...] = (5, 21)) -> DataFrame:
    """Per horizon of graded (date, horizon): the newest date whose window has closed, the newest graded one, and the sessions between; 0 where one is missing."""
    cal = _by_session(bars)
    each = cal.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    closed = each.where(F.col("session") + F.col("horizon") < F.col("last")).groupBy("horizon").agg(F.max("date").alias("newest_closed"), F.max("session").alias("s1"))
    newest = graded.join(cal, "date").groupBy("horizon").agg(F.max("date").alias("newest_graded"), F.max("session").alias("s0"))
    lag = F.greatest(F.coalesce(F.col("s1") - F.col("s0"), F.lit(0)), F.lit(0)).cast("long")
    return newest.join(closed, "horizon", "left").select("horizon", "newest_closed", "newest_graded", lag.alias("lag"))


def exit_prices(entries: DataFrame, forward: DataFrame, digits: int = 2) -> DataFrame:
    """entries (ticker, date, entry) with the price that each horizon's stored return leads to, rounded half up."""
    x = F.col("entry") * (1 + F.col("ret"))
    return entries.join(forward.select("ticker", "date", "horizon", "ret"), ["ticker", "date"]).select("ticker", "date", "horizon", "entry", (F.floor(x * 10.0**digits + 0.5) / 10.0**digits).alias("exit"))


def seed_signals(documents: DataFrame, sectors: DataFrame, wanted: str = "BUY") -> DataFrame:
    """One row per (ticker, date) with the wanted signal, from documents of two shapes, with its sector.

    A document lists its names in `universe`, an array, or in `by_ticker`, a map from ticker; where both name a ticker the array counts."""
    listed = documents.select("date", F.explode("universe").alias("e")).select("date", "e.ticker", "e.signal", "e.score", F.lit(0).alias("shape"))
    mapped = documents.select("date", F.explode("by_ticker").alias("ticker", "e")).select("date", "ticker", "e.signal", "e.score", F.lit(1).alias("shape"))
    rows = listed.union(mapped).where(F.col("signal") == wanted)
    one = rows.groupBy("ticker", "date").agg(F.min(F.struct("shape", "score")).alias("m"))
    return one.join(sectors, "ticker", "left").select("ticker", "date", F.col("m.score").alias("score"), "sector")


def new_predictions(live: DataFrame, challengers: DataFrame, stored: DataFrame, order: str) -> DataFrame:
    """Predictions that are not stored: live ones by (ticker, date), whose version is null, and challengers by (ticker, date, version)."""
    first = lambda df, keys: df.groupBy(*keys).agg(F.min(F.struct(order, "value")).alias("m"))
    a = first(live, ["ticker", "date"]).join(stored.where("version is null"), ["ticker", "date"], "left_anti").select("ticker", "date", F.lit(None).cast("string").alias("version"), "m.value")
    b = first(challengers, ["ticker", "date", "version"]).join(stored, ["ticker", "date", "version"], "left_anti").select("ticker", "date", "version", "m.value")
    return a.union(b)


def resolve_pending(rows: DataFrame, found: DataFrame, keys: list[str], column: str) -> DataFrame:
    """rows with the nulls of a column filled from found, which has one row per key; what is settled stays. `resolved` marks the filled ones."""
    df = rows.join(found.select(*keys, F.col(column).alias("_found")), keys, "left")
    return df.select(*[c for c in rows.columns if c != column], F.coalesce(column, "_found").alias(column), (F.col(column).isNull() & F.col("_found").isNotNull()).alias("resolved"))


def validation_summary(checked: DataFrame, limit: float = 0.05, keep: int = 20) -> DataFrame:
    """One row for checked (ticker, date, anomalies): rows, clean, anomalous, the first few of these as text, and whether their share is above the limit."""
    bad = F.size("anomalies") > 0
    total = checked.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("anomalous"), F.lit(None).cast("string").alias("details"))
    some = checked.where(bad).orderBy("ticker", "date").limit(keep)
    line = F.concat_ws(" ", F.col("ticker").cast("string"), F.date_format("date", "yyyy-MM-dd"), F.array_join("anomalies", "+"))
    details = some.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ticker", "date", line.alias("line")))), lambda e: e["line"]), ";").alias("details"))
    one = total.unionByName(details, allowMissingColumns=True).agg(F.max("n").alias("n"), F.max("anomalous").alias("anomalous"), F.max("details").alias("details"))
    return one.select("n", (F.col("n") - F.col("anomalous")).alias("clean"), "anomalous", "details", (F.col("anomalous") > F.col("n") * limit).alias("failed"))


def anomaly_policy(checked: DataFrame, blocking: list[str]) -> DataFrame:
    """Per kind of anomaly: rows, and whether it blocks or warns."""
    kinds = checked.select(F.explode("anomalies").alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return kinds.select("kind", "n", F.when(F.col("kind").isin(blocking), "block").otherwise("warn").alias("action"))


def status_tally(agreement: DataFrame) -> DataFrame:
    """Per status of a source agreement: records, tickers, and the widest spread."""
    return agreement.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ticker").alias("tickers"), F.max("spread_bps").alias("widest"))


def classification(members: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """members (ticker, sector, key) by country of places (key, country, area): names, and the shares with a sector and with a country."""
    df = members.join(places, key, "left")
    share = lambda c: F.avg(F.col(c).isNotNull().cast("double"))
    return df.groupBy("area").agg(F.count(F.lit(1)).alias("names"), share("sector").alias("sector_coverage"), share("country").alias("country_coverage"))


def consensus(primary: DataFrame, second: DataFrame, scores: dict[str, float]) -> DataFrame:
    """Per ticker rating, its score and target: a missing rating comes from the second source, and where only that has the ticker its target too."""
    b = second.where("rating is not null").select("ticker", F.col("rating").alias("rating2"), F.col("target").alias("target2"))
    df = primary.withColumn("_has", F.lit(True)).join(b, "ticker", "full").withColumn("rating", F.coalesce("rating", "rating2"))
    df = df.withColumn("target", F.when(F.col("_has"), F.col("target")).otherwise(F.col("target2")))
    score = F.coalesce(*[F.when(F.col("rating") == k, F.lit(float(v))) for k, v in scores.items()])
    return df.select("ticker", "rating", score.alias("rating_score"), "target").where("rating is not null or target is not null")


def etf_of(names: DataFrame, by_industry: dict[str, str], sector_etf: DataFrame) -> DataFrame:
    """The fund of each name's sub-industry, or else that of its sector; a name with neither is left out."""
    own = F.coalesce(*[F.when(F.col("sub_industry") == k, F.lit(v)) for k, v in by_industry.items()])
    return names.join(sector_etf, "sector", "left").select("ticker", F.coalesce(own, "etf").alias("etf")).where("etf is not null")


def rescan(closes: DataFrame, canonical: str, n: int) -> DataFrame:
    """The last n sessions: rows, and whether each can be skipped since all of its rows are from the canonical source and have a close."""
    g = closes.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.coalesce((F.col("source") == canonical) & F.col("close").isNotNull(), F.lit(False))).alias("skip"))
    return g.orderBy(F.desc("date")).limit(n)


def absent(bars: DataFrame, today: DataFrame) -> DataFrame:
    """Tickers in store without a row in today, with their newest date."""
    return bars.groupBy("ticker").agg(F.max("date").alias("last_date")).join(today.select("ticker").distinct(), "ticker", "left_anti")


def widened(table: DataFrame, added: dict[str, Column], expected: list[str]) -> DataFrame:
    """The table with computed columns, which must then be exactly the expected ones."""
    out = table.withColumns(added)
    if out.columns != expected:
        raise ValueError(f"columns {out.columns} are not {expected}")
    return out


def ratio_series(macro: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """macro (series_id, date, value) and, as one more series, a over b where both have a value."""
    pick = lambda s: F.max(F.when(F.col("series_id") == s, F.col("value")))
    both = macro.where(F.col("series_id").isin(a, b)).groupBy("date").agg(pick(a).alias("x"), pick(b).alias("y"))
    return macro.select("series_id", "date", "value").union(both.where("x is not null and y <> 0").select(F.lit(name), "date", F.col("x") / F.col("y")))


def supplemental(bars: DataFrame, held: DataFrame, covered: DataFrame) -> DataFrame:
    """The bars of held tickers that the main universe does not cover; one without history has no row."""
    return bars.join(held.select("ticker").distinct().join(covered, "ticker", "left_anti"), "ticker", "left_semi")


def daily_returns(bars: DataFrame) -> DataFrame:
    prior = F.lag("close").over(Window.partitionBy("ticker").orderBy("date"))
    return bars.select("ticker", "date", (F.col("close") / F.nullif(prior, F.lit(0.0)) - 1).alias("ret"))


def chunk_body(variants: DataFrame) -> DataFrame:
    """Per fingerprint the title, an empty line, and the longest excerpt (the first of equals by id), without outer white space."""
    longest = F.max_by(F.coalesce("excerpt", F.lit("")), F.struct(F.length(F.coalesce("excerpt", F.lit(""))), -F.col("id")))
    g = variants.groupBy("fingerprint").agg(F.min_by("title", "id").alias("title"), longest.alias("excerpt"))
    body = F.concat_ws("\n\n", *[F.when(F.col(c) != "", F.col(c)) for c in ("title", "excerpt")])
    return g.select("fingerprint", F.regexp_replace(body, r"^\s+|\s+$", "").alias("body"))


def expected_factor(splits: DataFrame) -> DataFrame:
    """The factor of closes before each split, null (and flagged) where a side of the ratio is missing or 0."""
    f = F.when((F.col("split_from") != 0) & (F.col("split_to") != 0), F.col("split_from") / F.col("split_to"))
    return splits.select("ticker", "ex_date", f.alias("factor"), f.isNull().alias("incomplete"))
