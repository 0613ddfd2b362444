"""Structured Streaming versions of the incremental jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators import merge


def stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:  # noqa: ANN001
    """New Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def deduplicated(articles: DataFrame, key: str = "fingerprint", ts: str = "published_at", delay: str = "1 day") -> DataFrame:
    """The first row of each key; state is dropped once the watermark passes."""
    return articles.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", value: str = "value", delay: str = "10 minutes", length: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums in tumbling or sliding event-time windows."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    g = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(w, by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("stop"), by, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", by: str = "user_id", gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions of each key, closed by a gap."""
    g = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(F.session_window(ts, gap), by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), by, "n")


def last_bars(bars: DataFrame) -> DataFrame:
    """Each ticker's newest bar so far: one row of state per key, updated as bars come in any order (to be written in update mode)."""
    rest = [c for c in bars.columns if c != "ticker"]
    return bars.groupBy("ticker").agg(F.max_by(F.struct(*rest), F.struct("date")).alias("_b")).select("ticker", "_b.*")


def merge_into(path: str, ranks: dict[str, int], checkpoint: str) -> Callable[[DataFrame], StreamingQuery]:
    """Starts a keyed merge by source authority of a stream into a table below path, of folders version=n/month=YYYY-MM.

    A micro-batch reads and writes the months that its rows fall in, and no others: their newest version before it, and its own. A batch that is run
    again replaces its own output. `merged` reads the newest version of each month. Rows of one batch are reduced to one per key first."""

    def batch(df: DataFrame, n: int) -> None:
        new = merge.keep_last(df.withColumn("_p", merge.priority("source", ranks)), ["ticker", "date"], [F.desc("_p"), F.col("close").desc_nulls_last()]).drop("_p")
        months = [r[0] for r in new.select(F.date_format("date", "yyyy-MM")).distinct().collect()]  # a month each
        prior = merged(df.sparkSession, path, before=n, months=months)
        prior = new.limit(0) if prior is None else prior.select(*new.columns)
        out = merge.merge_by_authority(new, prior, ranks).drop("status").withColumn("month", F.date_format("date", "yyyy-MM"))
        out.write.mode("overwrite").partitionBy("month").parquet(f"{path}/version={n}")

    return lambda df: df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, path: str, before: int | None = None, months: list[str] | None = None) -> DataFrame | None:
    """The table that merge_into keeps: each month's newest version, of those before a batch and of some months where asked; None while there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    kept = F.lit(True) if before is None else F.col("version") < before
    kept = kept if months is None else kept & F.col("month").isin(months)
    df = spark.read.option("basePath", path).parquet(path).withColumn("month", F.col("month").cast("string")).where(kept)
    newest = df.groupBy("month").agg(F.max("version").alias("version"))
    return df.join(newest, ["month", "version"], "left_semi").drop("month", "version")
