"""News, filings and transcripts as rows: fingerprints, de-duplication, sentiment, events, chunks, centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.windows import cosine


def fingerprint(title: str, url: str) -> Column:
    """SHA-1 of the normalised title and the hash of the URL without query and fragment."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"[^a-z0-9 ]", " "), r" +", " "))
    u = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"[?#].*$", "")
    return F.sha1(F.concat(t, F.lit("|"), F.sha1(u)))


def canonical_articles(articles: DataFrame, trust: dict[str, float]) -> DataFrame:
    """One row per fingerprint: longest title, URL of the most trusted source, earliest time, sources, all tickers, and its variants (their number, and source and URL of each).

    articles: fingerprint, title, url, source, published_at, tickers. Ties go to the title and URL that sort last."""
    w = F.coalesce(*[F.when(F.col("source") == s, F.lit(float(v))) for s, v in trust.items()], F.lit(0.5))
    a = articles.withColumn("w", w)
    return a.groupBy("fingerprint").agg(
        F.max_by("title", F.struct(F.length("title"), "title")).alias("title"), F.max_by("url", F.struct("w", "url")).alias("url"), F.min("published_at").alias("published_at"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count(F.lit(1)).alias("variants"), F.max("w").alias("trust"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("tickers")))).alias("tickers"), F.array_sort(F.collect_list(F.struct("source", "url"))).alias("records"),
    )


def word_chunks(docs: DataFrame, id_col: str, text_col: str, size: int = 307, overlap: int = 38) -> DataFrame:
    """Chunks of `size` words, each beginning size - overlap words after the last; a trailing chunk may lie wholly in the overlap."""
    step = size - overlap
    w = F.filter(F.split(F.coalesce(text_col, F.lit("")), r"\s+"), lambda t: t != "")
    df = docs.select(id_col, w.alias("_w")).where(F.size("_w") > 0)
    df = df.select(id_col, "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step))).alias("_s"))
    return df.select(id_col, F.floor(F.col("_s") / step).cast("int").alias("chunk"), F.array_join(F.slice("_w", F.col("_s") + 1, size), " ").alias("body"))


def transcript_sections(turns: DataFrame, asker: str = "user") -> DataFrame:
    """Per conversation, its text before and from the second turn of the asking role on, with their turns."""
    by = Window.partitionBy("conv_id").orderBy("turn")
    asked = F.sum((F.col("role") == asker).cast("int")).over(by)
    df = turns.withColumn("section", F.when(asked >= 2, "q_and_a").otherwise("remarks"))
    return df.groupBy("conv_id", "section").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"), F.min("turn").alias("first_turn"))


def centroids(vectors: DataFrame, by: list[str], sets: list[list[str]], value: str = "embedding") -> DataFrame:
    """Element-wise means of vectors for each grouping set, with grouping() flags and the number of vectors; one pass, partial sums."""
    long = vectors.select(*by, F.posexplode(value).alias("pos", "x"))
    g = long.groupingSets([[F.col(c) for c in s] + [F.col("pos")] for s in sets], *[F.col(c) for c in by], F.col("pos"))
    g = g.agg(*[F.grouping(c).alias(f"all_{c}") for c in by], F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return g.groupBy(*by, *[f"all_{c}" for c in by]).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"), F.max("n").alias("n"))


def drift_between(centroid_rows: DataFrame, key: str, order: str, lazy: float = 0.05) -> DataFrame:
    """Cosine of each centroid with the one before in its key, the change 1 - cosine, and whether it is all but none."""
    w = Window.partitionBy(key).orderBy(order)
    df = centroid_rows.withColumn("_p", F.lag("centroid").over(w)).where("_p is not null")
    c = cosine(F.col("centroid"), F.col("_p"))
    return df.select(key, order, c.alias("similarity"), (1 - c).alias("change"), (1 - c < lazy).alias("lazy"))


def corpus_manifest(docs: DataFrame, by: str, size: str) -> DataFrame:
    """Per group: documents, total, and discrete quartiles of a size."""
    q = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {size})")
    return docs.groupBy(by).agg(F.count(F.lit(1)).alias("docs"), F.sum(size).alias("total"), q(0.25).alias("q1"), q(0.5).alias("q2"), q(0.75).alias("q3"))
