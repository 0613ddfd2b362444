"""Articles joined with the bars after them: an interval join of two streams, or of two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def reactions(articles: DataFrame, bars: DataFrame, within: str = "3 days", delay: str = "2 days") -> DataFrame:
    """(article_id, ticker, published_at, bar_at, close): each article with every bar of its ticker after it and at most `within` later; an article without one has nulls.

    Of two streams, both have a watermark and the condition bounds the time between the sides, so that state is dropped on either side: bars once
    no article before them can come, articles once no bar within their interval can, and only then an article without a bar is sent. Articles with
    the same id are joined each by itself; rows without ticker or time match nothing, and articles without a time are left out, as no watermark could release them."""
    a = articles.select("article_id", "ticker", F.col("published_at").cast("timestamp").alias("published_at")).where("published_at is not null").withWatermark("published_at", delay)
    b = bars.select(F.col("ticker").alias("_t"), F.col("bar_at").cast("timestamp").alias("bar_at"), "close").where("bar_at is not null and _t is not null").withWatermark("bar_at", delay)
    near = (F.col("ticker") == F.col("_t")) & (F.col("bar_at") > F.col("published_at")) & (F.col("bar_at") <= F.col("published_at") + F.expr(f"INTERVAL {within}"))
    return a.join(b, near, "left_outer").select("article_id", "ticker", "published_at", "bar_at", "close")


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query has dropped since it started because the watermark had passed them."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
