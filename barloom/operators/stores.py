"""Stores kept up to date: splits and dividends applied, repairs, daily appends; rosters with renames; content hashes and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import actions, gates, membership, merge, technicals


def renamed_changes(rosters: DataFrame, renames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes between consecutive rosters without those that a rename (old_ticker, new_ticker) on one date explains, and the dates with unexplained swaps.

    Swaps: date, left and joined (sorted tickers); their changes stay, since most are real."""
    c = membership.roster_changes(rosters)
    gone, came = c.where("action = 'REMOVED'").select("date", F.col("ticker").alias("old_ticker")), c.where("action = 'ADDED'").select("date", F.col("ticker").alias("new_ticker"))
    same = gone.join(renames.select("old_ticker", "new_ticker").distinct(), "old_ticker").join(came, ["date", "new_ticker"])
    drop = same.select("date", F.col("old_ticker").alias("ticker"), F.lit("REMOVED").alias("action")).union(same.select("date", F.col("new_ticker"), F.lit("ADDED")))
    left = c.join(drop, ["date", "ticker", "action"], "left_anti").select("date", "ticker", "action")
    side = lambda a: F.array_sort(F.collect_list(F.when(F.col("action") == a, F.col("ticker"))))
    swaps = left.groupBy("date").agg(side("REMOVED").alias("left"), side("ADDED").alias("joined")).where("size(left) > 0 and size(joined) > 0")
    return left, swaps


def total_return_on_basis(bars: DataFrame, dividends: DataFrame, splits: DataFrame) -> DataFrame:
    """`actions.total_return` for bars on today's split basis: a dividend's cash, paid on the shares of its own date, is put on that basis by the splits after it."""
    last = bars.groupBy("ticker").agg(F.max("date").alias("_last"))
    s = splits.join(last, "ticker").where(F.col("ex_date") <= F.col("_last")).select("ticker", "ex_date", (F.col("split_from") / F.col("split_to")).alias("factor"))
    d = actions.later_product(dividends.select("ticker", F.col("ex_date").alias("date"), "cash_amount"), s, "_k")
    return actions.total_return(bars, d.select("ticker", F.col("date").alias("ex_date"), (F.col("cash_amount") * F.col("_k")).alias("cash_amount")))


def crsp_basis(bars: DataFrame, dividends: DataFrame, splits: DataFrame) -> DataFrame:
    """Bars restated for splits, with the total-return close of that level beside them."""
    return total_return_on_basis(actions.restate_splits(bars, splits), dividends, splits)


def apply_splits(bars: DataFrame, splits: DataFrame, applied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars restated for the splits that are due, and each split's status (ticker, ex_date, status).

    Already applied ones (ticker, ex_date) are left alone. What the prices say decides the rest: `direct` is applied, `inverse` with the factor turned,
    `ambiguous` refused, and what prices do not confirm waits."""
    seen = actions.orientation(splits, bars)
    done = applied.select("ticker", "ex_date").distinct().withColumn("_done", F.lit(True))
    said = {"direct": "applied", "inverse": "applied_inverse", "ambiguous": "refused"}
    status = F.coalesce(*[F.when(F.col("evidence") == k, F.lit(v)) for k, v in said.items()], F.lit("unconfirmed"))
    s = seen.join(done, ["ticker", "ex_date"], "left").withColumn("status", F.when(F.col("_done"), "already_applied").otherwise(status))
    due = s.where("status like 'applied%'").select("ticker", "ex_date", F.when(F.col("status") == "applied", F.col("factor")).otherwise(1 / F.col("factor")).alias("split_from"), F.lit(1.0).alias("split_to"))
    return actions.restate_splits(bars, due), s.select("ticker", "ex_date", "status")


def sync_stores(history: DataFrame, archive: DataFrame, splits: DataFrame, markers: DataFrame, tolerance: float = 0.02) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History and archive (ticker, date, close) after their splits, and the new markers (ticker, ex_date, store).

    The history of a ticker is restated as a whole, once: a marker of the store `history` tells that it is. An archive row is multiplied only where it is still on the
    old scale, that is, where its close is the restated history's close over the split factor within the tolerance; rows on the new
    scale, or on neither, stay. Markers are for the caller to write after both tables."""
    due = splits.join(markers.where("store = 'history'").select("ticker", "ex_date"), ["ticker", "ex_date"], "left_anti")
    new_history = actions.restate_splits(history.withColumn("volume", F.lit(0.0)), due).select("ticker", "date", "close")
    events = splits.select("ticker", "ex_date", (F.col("split_from") / F.col("split_to")).alias("factor"))
    a = actions.later_product(archive.select("ticker", "date", "close"), events, "_f").join(new_history.withColumnRenamed("close", "_c"), ["ticker", "date"], "left")
    near = lambda x: F.coalesce(F.abs(x / F.col("_c") - 1) <= tolerance, F.lit(False))
    old = near(F.col("close") * F.col("_f")) & ~near(F.col("close"))
    new_archive = a.select("ticker", "date", F.when(old, F.col("close") * F.col("_f")).otherwise(F.col("close")).alias("close"), old.alias("rescaled"))
    both = F.explode(F.array(F.lit("history"), F.lit("archive"))).alias("store")
    fresh = splits.select("ticker", "ex_date", both).join(markers, ["ticker", "ex_date", "store"], "left_anti")
    return new_history, new_archive, fresh


def series_repair(stored: DataFrame, observed: DataFrame, first: str, last: str) -> DataFrame:
    """A stored series table (series_id, date, value) in which the dates from first to last hold the newest observation on or before them; only cells that differ change.

    observed: series_id, date, value. Adds `repaired`."""
    q = stored.select("series_id", "date", F.col("value").alias("_v"), F.lit(1).alias("_q")).unionByName(observed.select("series_id", "date", F.col("value").alias("_v"), F.lit(0).alias("_q")))
    w = Window.partitionBy("series_id").orderBy("date", "_q").rowsBetween(Window.unboundedPreceding, 0)
    seen = q.withColumn("_o", F.last(F.when(F.col("_q") == 0, F.col("_v")), ignorenulls=True).over(w)).where("_q = 1")
    inside = F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & F.col("_o").isNotNull() & ~F.col("_v").eqNullSafe(F.col("_o"))
    return seen.select("series_id", "date", F.when(inside, F.col("_o")).otherwise(F.col("_v")).alias("value"), inside.alias("repaired"))


def content_hash(df: DataFrame, columns: list[str], parts: int = 64) -> DataFrame:
    """SHA-256 over a set of rows whatever their order: each row is hashed, each of the parts of the hashes' range is the hash of its sorted hashes, and the result that of all parts in order.

    Sorted parts follow one another, so their order is that of all rows; rows are never gathered, and a part's hashes are at most a share of them."""
    row = F.sha2(F.to_json(F.array(*[F.col(c).cast("string") for c in columns])), 256)
    rows = df.select(row.alias("h")).withColumn("p", F.floor(F.conv(F.substring("h", 1, 4), 16, 10).cast("int") * parts / 65536))
    part = rows.groupBy("p").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ","), 256).alias("s"), F.count(F.lit(1)).alias("n"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "s"))), lambda x: x["s"]), ",")
    return part.agg(F.sha2(joined, 256).alias("content_hash"), F.sum("n").alias("rows"))


def manifest_by_day(docs: DataFrame, chunks: DataFrame, types: list[str]) -> DataFrame:
    """Per day: documents of each type, all, and their chunks; docs: doc_id, doc_type, day, ts; chunks: doc_id. Days without chunks count none; newest is the latest time."""
    n = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    d = docs.join(n, "doc_id", "left")
    cols = [F.count_distinct(F.when(F.col("doc_type") == t, F.col("doc_id"))).alias(t) for t in types]
    return d.groupBy("day").agg(*cols, F.count_distinct("doc_id").alias("documents"), F.coalesce(F.sum("_n"), F.lit(0)).alias("chunks"), F.max("ts").alias("newest"))


def documents_per_key(docs: DataFrame, key: str = "ticker") -> DataFrame:
    """Discrete quartiles of the number of documents per key, with the number of keys."""
    n = docs.groupBy(key).agg(F.count_distinct("doc_id").alias("n"))
    q = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n)").cast("long")
    return n.agg(F.count(F.lit(1)).alias("keys"), F.min("n").alias("least"), q(0.25).alias("q1"), q(0.5).alias("q2"), q(0.75).alias("q3"), F.max("n").alias("most"))


def missing_dates(bars: DataFrame, calendar: DataFrame, since: str) -> DataFrame:
    """Per ticker the sessions of the calendar since a date, and since its own first bar, that it lacks, newest first.

    Found as gaps between a ticker's consecutive sessions, so that tickers and dates are never crossed."""
    cal = calendar.select("date").distinct().where(F.col("date") >= F.lit(since).cast("date")).withColumn("_s", F.row_number().over(Window.orderBy("date")))
    total = cal.agg(F.max("_s")).first()[0] or 0
    b = bars.select("ticker", "date").join(cal, "date")
    nxt = F.coalesce(F.lead("_s").over(Window.partitionBy("ticker").orderBy("_s")), F.lit(total + 1))
    holes = b.withColumn("_e", nxt).where("_e > _s + 1").select("ticker", F.explode(F.expr("sequence(_s + 1, _e - 1)")).alias("_s"))
    return holes.join(cal, "_s").groupBy("ticker").agg(F.sort_array(F.collect_list("date"), asc=False).alias("missing"), F.count(F.lit(1)).alias("n"))


def digest_sections(digest: DataFrame, keep: int = 5) -> DataFrame:
    """A digest (id, score, published_at, ticker) as sections of JSON: the best and the worst stories, and each ticker's count, largest first."""
    story = digest.dropDuplicates(["id"]).select("id", "score", "published_at")
    text = lambda d: F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_k", "id", "score"))), lambda x: F.struct(x["id"].alias("id"), F.round(x["score"], 4).alias("score"))))  # noqa: E731, ARG005
    part = lambda name, order: story.orderBy(*order).limit(keep).withColumn("_k", F.row_number().over(Window.orderBy(*order))).agg(text(None).alias("body")).select(F.lit(name).alias("section"), "body")
    best = part("best", [F.desc("score"), F.asc("id")])
    worst = part("worst", [F.asc("score"), F.asc("id")])
    per = digest.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    tickers = per.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "ticker", "n"))), lambda x: F.struct(x["ticker"].alias("ticker"), x["n"].alias("n")))).alias("body")).select(F.lit("tickers").alias("section"), "body")
    return best.union(worst).union(tickers)


def judged(stored: DataFrame, incoming: DataFrame, day: str, least: int) -> tuple[DataFrame, DataFrame]:
    """The last `least` rows of each ticker whose bar of the day passes the row gate and the splice guard, that bar included, and what became of each incoming bar of the day."""
    cols = ["ticker", "date", "open", "high", "low", "close", "volume", "vwap"]
    at = F.lit(day).cast("date")
    new = incoming.where(F.col("date") == at).select(*cols).withColumn("_new", F.lit(True))
    old = stored.where(F.col("date") < at).select(*cols).join(new.select("ticker").distinct(), "ticker", "left_semi").withColumn("_new", F.lit(False))
    recent = old.withColumn("_n", F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))).where(F.col("_n") < least).drop("_n")
    both = recent.unionByName(new)
    gate = gates.row_gate(both).where("_new").select("ticker", "date", F.array_join("blocking", ",").alias("blocking"))
    splice = actions.splice_guard(both).where(F.col("date") == at).select("ticker", "date", F.col("verdict").alias("splice"))
    verdict = F.when(F.col("blocking") != "", "blocked").when(F.col("splice") != "ok", F.col("splice")).otherwise("accepted")
    verdicts = gate.join(splice, ["ticker", "date"]).withColumn("verdict", verdict)
    return both.join(verdicts.where("verdict = 'accepted'").select("ticker"), "ticker", "left_semi").drop("_new"), verdicts


def daily_append(stored: DataFrame, incoming: DataFrame, day: str, least: int = 265) -> tuple[DataFrame, DataFrame]:
    """A day's append: the features of that day, and what became of each incoming row (`daily.append_all` has all passes).

    Incoming bars of the day pass the row gate against their own history and the splice guard; accepted ones replace stored rows of the day, and the features of the
    day are computed on each ticker's last `least` rows, which is all that its windows reach. Returns (features of the day, verdicts); the accepted rows
    are those with verdict `accepted`."""
    accepted, verdicts = judged(stored, incoming, day, least)
    return technicals.price_features(accepted).where(F.col("date") == F.lit(day).cast("date")), verdicts


def appended(stored: DataFrame, incoming: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The store with the incoming rows that were accepted; of a ticker's day the incoming row stays."""
    ok = incoming.join(verdicts.where("verdict = 'accepted'").select("ticker", "date"), ["ticker", "date"], "left_semi")
    return merge.upsert(stored, ok.select(*stored.columns), ["ticker", "date"])
