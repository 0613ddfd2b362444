"""News, filings and analyst records: daily aggregates, article records, digests, sections, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.sources import snapshots


def daily_aggregate(articles: DataFrame, scores: DataFrame, events: DataFrame, trust: Column) -> DataFrame:
    """Per (ticker, date): articles, their trust, sentiment plain and weighted, words, events, their severity and the three gravest ones' descriptions, sources as sorted JSON.

    articles: id, tickers (array), date, source; scores: id, words, positive, negative, uncertainty, score; events: id, category, description, severity, at most one row per
    (id, category). A hot ticker is aggregated map-side; events are folded per article first, so articles are not multiplied, and an article brings its three gravest at most."""
    ev = events.groupBy("id").agg(F.count(F.lit(1)).alias("e_n"), F.max("severity").alias("e_max"), F.sum("severity").alias("e_sum"), F.collect_set("category").alias("e_cat"))
    grave = lambda key: Window.partitionBy(*key).orderBy(F.desc("severity"), "id", "category")
    gravest = events.withColumn("_n", F.row_number().over(grave(["id"]))).where("_n <= 3").join(articles.select("id", F.explode(F.array_distinct("tickers")).alias("ticker"), "date"), "id")
    gravest = gravest.withColumn("_n", F.row_number().over(grave(["ticker", "date"]))).where("_n <= 3").groupBy("ticker", "date").agg(F.array_sort(F.collect_list(F.struct("_n", "description"))).alias("_d"))
    gravest = gravest.select("ticker", "date", F.array_join(F.transform("_d", lambda x: x["description"]), "; ").alias("top_events"))
    a = articles.select("id", F.explode(F.array_distinct("tickers")).alias("ticker"), "date", "source", trust.alias("w"))
    a = a.join(scores, "id", "left").join(ev, "id", "left")
    per = a.groupBy("ticker", "date", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum("score").alias("s"), F.count("score").alias("sn"), F.max("score").alias("hi"), F.min("score").alias("lo"),
        F.sum(F.col("w") * F.col("score")).alias("ws"), F.sum(F.when(F.col("score").isNotNull(), F.col("w"))).alias("sw"), F.sum("positive").alias("p"), F.sum("negative").alias("g"), F.sum("uncertainty").alias("u"), F.sum("words").alias("t"),
        F.sum("e_n").alias("e"), F.max("e_max").alias("em"), F.sum("e_sum").alias("es"), F.array_distinct(F.flatten(F.collect_set("e_cat"))).alias("c"),
    )
    out = per.groupBy("ticker", "date").agg(
        F.sum("n").alias("articles"), F.sum("w").alias("trusted_weight"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n"))))).alias("by_source"),
        (F.sum("s") / F.nullif(F.sum("sn"), F.lit(0))).alias("sentiment_mean"), F.max("hi").alias("sentiment_max"), F.min("lo").alias("sentiment_min"), (F.sum("ws") / F.nullif(F.sum("sw"), F.lit(0.0))).alias("sentiment_trusted"),
        F.sum("p").alias("positive"), F.sum("g").alias("negative"), F.sum("u").alias("uncertainty"), F.sum("t").alias("words"), F.coalesce(F.sum("e"), F.lit(0)).alias("events"), F.coalesce(F.max("em"), F.lit(0.0)).alias("severity_max"),
        F.coalesce(F.sum("es") / F.nullif(F.sum("e"), F.lit(0)), F.lit(0.0)).alias("severity_mean"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("c")))), ",").alias("categories"),
    )
    return out.join(gravest, ["ticker", "date"], "left").withColumn("top_events", F.coalesce("top_events", F.lit("")))


def article_records(variants: DataFrame, trust: Column) -> DataFrame:
    """One record per fingerprint: the most trusted source, the body of the most trusted variant that has one, all tags, mean score, gravest event (fingerprint, source, body, tags, score, event, severity).

    Ties go to the source that sorts last."""
    v = variants.withColumn("_w", trust)
    has = F.trim(F.coalesce("body", F.lit(""))) != ""
    return v.groupBy("fingerprint").agg(
        F.max_by("source", F.struct("_w", "source")).alias("primary_source"), F.max_by(F.when(has, F.col("body")), F.when(has, F.struct("_w", "source", "body"))).alias("body"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))), ",").alias("tags"), F.avg("score").alias("score_mean"), F.count(F.lit(1)).alias("variants"),
        F.max_by("event", F.when(F.col("event").isNotNull(), F.struct("severity", "event"))).alias("top_event"),
    )


def digest(articles: DataFrame, exclude: str, keep: int = 30) -> DataFrame:
    """The strongest stories that the excluded source did not write, newest first among equals, one row per ticker (id, tickers, score, published_at, source)."""
    top = articles.where(~F.col("source").eqNullSafe(exclude)).orderBy(F.desc(F.abs(F.coalesce("score", F.lit(0.0)))), F.desc("published_at"), "id").limit(keep)
    return top.select("id", "score", "published_at", F.posexplode("tickers").alias("pos", "ticker"))


def topic_feed(entries: DataFrame, cutoff: str, keep: int) -> DataFrame:
    """Per topic the newest entries since the cutoff; undated ones stay and sort last. Of one URL (case and last slashes aside), then of one title, the first by seq stays.

    entries: topic, seq, title, url, published_at. Without title or URL an entry goes."""
    e = entries.where((F.trim("url") != "") & (F.trim("title") != "")).where(F.col("published_at").isNull() | (F.col("published_at") >= F.lit(cutoff).cast("timestamp")))
    for key in (F.lower(F.regexp_replace(F.trim("url"), "/+$", "")), F.lower(F.trim("title"))):
        e = e.withColumn("_k", key)
        e = e.join(e.groupBy("topic", "_k").agg(F.min("seq").alias("seq")), ["topic", "_k", "seq"], "left_semi").drop("_k")
    w = Window.partitionBy("topic").orderBy(F.desc_nulls_last("published_at"), "seq")
    return e.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def portfolio_entries(articles: DataFrame, exclude: str, keep: int = 30) -> DataFrame:
    """The portfolio's part of a digest: entries of (rank, id, pos, ticker, score, published_at, source), a story standing once for each of its tickers, and at most `keep` entries in all.

    Stories by the size of their score (none counts as 0), newest first among equals, then by id; tickers in their order, repeated ones as often as they stand. The excluded source is
    told by name whatever its case; a story without a source stays, one without tickers has no entry, so it takes no place from others."""
    e = articles.where(F.lower(F.coalesce("source", F.lit(""))) != exclude.lower()).select("id", "score", "published_at", "source", F.posexplode("tickers").alias("pos", "ticker"))
    order = [F.desc(F.abs(F.coalesce("score", F.lit(0.0)))), F.desc_nulls_last("published_at"), F.asc("id"), F.asc("pos")]
    top = e.orderBy(*order).limit(keep)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "id", "pos", "ticker", F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"), "published_at", "source")


def first_seen(entries: DataFrame, keys: list[str], order: str, within: str) -> DataFrame:
    """The entries that a reader going through each group (`within`) in order would keep, who passes over an entry that shares any of the keys with one kept before.

    An entry passed over leaves no mark, so dropping repeats by one key and then by the next gives another result. It is found in rounds instead of row by row: an entry that comes first
    among the undecided ones of all its keys is kept, and those that share a key with it go. The first undecided entry of a group is always decided, and chains of n entries that each
    wait for the one before take n rounds; others few. Equal combinations of keys are folded first, so a frequent key costs a row for each partner it has. A null key is a value as any other.
    `order` must not repeat within a group. Rounds are cut by checkpoints."""
    spark = entries.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(snapshots.scratch(spark, "rounds"))
    text = lambda c: F.to_json(F.array(F.col(c).cast("string")))  # noqa: E731  null becomes a value
    names = [f"_k{i}" for i in range(len(keys))]
    rows = entries.select(text(within).alias("_g"), F.col(order).alias("_o"), *[text(k).alias(n) for k, n in zip(keys, names, strict=True)])
    undecided, kept = rows.groupBy("_g", *names).agg(F.min("_o").alias("_o")).checkpoint(), None
    while not undecided.isEmpty():
        marked = undecided
        for k in names:
            marked = marked.join(undecided.groupBy("_g", k).agg(F.min("_o").alias(f"_first{k}")), ["_g", k])
        first = marked.where(" AND ".join(f"_o = _first{k}" for k in names)).select("_g", "_o", *names).checkpoint()
        kept = first if kept is None else kept.union(first)
        for k in names:
            undecided = undecided.join(first.select("_g", k), ["_g", k], "left_anti")
        undecided = undecided.checkpoint()
    if kept is None:
        return entries.limit(0)
    return entries.withColumns({"_g": text(within), "_o": F.col(order)}).join(kept.select("_g", "_o"), ["_g", "_o"], "left_semi").select(*entries.columns)


def topic_stories(entries: DataFrame, cutoff: str, keep: int) -> DataFrame:
    """`topic_feed` for a reader who goes through a topic's entries by seq and passes over those whose URL or title stands on one kept before; newest first, undated last."""
    e = entries.where((F.trim("url") != "") & (F.trim("title") != "")).where(F.col("published_at").isNull() | (F.col("published_at") >= F.lit(cutoff).cast("timestamp")))
    e = e.withColumns({"_url": F.lower(F.regexp_replace(F.trim("url"), "/+$", "")), "_title": F.lower(F.trim("title"))})
    w = Window.partitionBy("topic").orderBy(F.desc_nulls_last("published_at"), "seq")
    return first_seen(e, ["_url", "_title"], "seq", "topic").drop("_url", "_title").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def digest_document(portfolio: DataFrame, topics: DataFrame, names: list[str]) -> DataFrame:
    """The sections of a digest in order (pos, section, n, entries): the portfolio's entries, then each named topic's by rank; a topic without stories has an empty list.

    portfolio: as of `portfolio_entries`; topics: topic, rank, id, published_at, source. Both are cut to a few entries a section before they come here, so a section's list is bounded."""
    entry = lambda label: F.struct("rank", "id", label, "score", "published_at", "source")
    own = portfolio.select(F.lit("portfolio").alias("section"), entry(F.col("ticker").cast("string").alias("ticker")).alias("e"))
    feed = topics.where(F.col("topic").isin(names)).select(F.col("topic").alias("section"), "rank", "id", F.lit(None).cast("string").alias("ticker"), F.lit(None).cast("double").alias("score"), F.col("published_at"), "source")
    lists = own.union(feed.select("section", F.struct("rank", "id", "ticker", "score", "published_at", "source"))).groupBy("section").agg(F.array_sort(F.collect_list("e")).alias("entries"))
    want = portfolio.sparkSession.createDataFrame(list(enumerate(["portfolio", *names])), "pos int, section string")
    return want.join(lists, "section", "left").select("pos", "section", F.coalesce(F.size("entries"), F.lit(0)).alias("n"), F.coalesce("entries", F.array()).alias("entries"))


def ownership_text(rows: DataFrame) -> DataFrame:
    """A sentence on each (ticker, quarter): holders, shares, value and the change (ticker, quarter, holders, shares, prior_shares)."""
    pct = F.when(F.col("prior_shares") > 0, (F.col("shares") - F.col("prior_shares")) * 100 / F.col("prior_shares"))
    turn = F.when(pct > 0, "up").when(pct < 0, "down").otherwise("unchanged")
    words = F.concat_ws(" ", F.format_string("%s: %d holders with %d shares in %s,", F.col("ticker").cast("string"), "holders", F.col("shares").cast("long"), "quarter"), F.when(pct.isNull(), "new").otherwise(turn))
    return rows.select("ticker", "quarter", words.alias("body"))


def new_documents(incoming: DataFrame, stored: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Incoming documents whose key is not stored and whose text has at least so many characters, one per key: that with the least id."""
    w = Window.partitionBy(*keys).orderBy("doc_id")
    fresh = incoming.where(F.length("text") >= least).join(stored.select(*keys).distinct(), keys, "left_anti")
    return fresh.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def daily_snapshots(docs: DataFrame) -> DataFrame:
    """Each (ticker, source, date)'s snapshot fetched last."""
    rest = [c for c in docs.columns if c not in ("ticker", "source", "date")]
    return docs.groupBy("ticker", "source", "date").agg(F.max_by(F.struct(*rest), "fetched_at").alias("_s")).select("ticker", "source", "date", "_s.*")


def analyst_revisions(snapshots: DataFrame, preference: list[str], as_of: str, slack: int = 6) -> DataFrame:
    """Target and rating on the day against 7 and 30 days before, tolerating up to `slack` earlier days; fields come from the first preferred source that has them.

    snapshots: ticker, source, date, mean_target, rating. One pass over the window, no self-join."""
    day = F.lit(as_of).cast("date")
    pick = lambda c: F.coalesce(*[F.max(F.when(F.col("source") == s, F.col(c))) for s in preference]).alias(c)
    daily = snapshots.where(F.col("date").between(F.date_sub(day, 30 + slack), day)).groupBy("ticker", "date").agg(pick("mean_target"), pick("rating"))
    age = F.datediff(day, "date")
    at = lambda c, n: F.max_by(F.when(age.between(n, n + slack), F.col(c)), F.when(age.between(n, n + slack) & F.col(c).isNotNull(), F.col("date")))
    now = lambda c: F.max(F.when(age == 0, F.col(c)))
    g = daily.groupBy("ticker").agg(now("mean_target").alias("target"), at("mean_target", 7).alias("target_7d"), at("mean_target", 30).alias("target_30d"), now("rating").alias("rating"), at("rating", 30).alias("rating_30d"), F.count(F.lit(1)).alias("days"))
    return g.withColumns({"delta_7d": F.col("target") - F.col("target_7d"), "delta_30d": F.col("target") - F.col("target_30d"), "pct_30d": (F.col("target") - F.col("target_30d")) / F.nullif("target_30d", F.lit(0.0)) * 100, "rating_changed": F.coalesce(F.col("rating") != F.col("rating_30d"), F.lit(False))})


def latest_filings(filings: DataFrame, keep: int) -> DataFrame:
    """Filings of each ticker's newest few distinct dates."""
    w = Window.partitionBy("ticker").orderBy(F.desc("filed_date"))
    return filings.withColumn("nth", F.dense_rank().over(w)).where(F.col("nth") <= keep)
