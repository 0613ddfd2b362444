"""Proportional stratified interleaving into shards, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._shared import text_or_empty

#: Cells whose sizes are summed together.
RUN = 4096


def ranked(rows: DataFrame, within: list[str], cell: str, order: list[Column], out: str, start: str | None = None) -> DataFrame:
    """Row numbers from 0 in (cell, *order) order within the columns `within`, without gathering a group in one task.

    Cells cut each group into ordered pieces: rows are numbered within a piece, and the pieces' sizes
    give what comes before each, summed within runs of RUN cells and over the runs. Cells must be of bounded size and increase in order."""
    sizes = rows.groupBy(*[F.col(c).alias(f"_w_{c}") for c in within], F.col(cell).alias("_cell"), F.floor(F.col(cell) / RUN).alias("_run")).count()
    by = [f"_w_{c}" for c in within]
    before = lambda keys, order, x: F.coalesce(F.sum(x).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = sizes.groupBy(*by, "_run").agg(F.sum("count").alias("_of_run"))
    runs = runs.select(*[F.col(c).alias(f"_r{c}") for c in by], F.col("_run").alias("_r_run"), before(by, "_run", "_of_run").alias("_far"))
    met = F.col("_run") == F.col("_r_run")
    for c in by:
        met = met & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    sizes = sizes.withColumn("_near", before([*by, "_run"], "_cell", "count")).join(runs, met).select(*by, "_cell", (F.col("_near") + F.col("_far")).alias("_before"))
    same = F.col(cell) == F.col("_cell")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    n = F.row_number().over(Window.partitionBy(*within, cell).orderBy(*order))
    return rows.withColumn("_n", n).join(sizes, same).withColumn(out, F.col("_before") + F.col("_n") - 1).drop("_n", "_cell", "_before", *[f"_w_{c}" for c in within])


def seeded(seed: int, id_col: str) -> Column:
    """60 bits of a digest of seed and id, the shuffle's key: the same in any engine with MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def interleave(docs: DataFrame, shards: int = 8, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", rows_per_cell: int = 4096) -> DataFrame:
    """Give each row a shard and a slot so that every shard has the sources in the corpus's proportions.

    Rows of a source are shuffled by a seeded digest and ranked; the r-th of n rows (from 0) has the
    fractional rank (2r+1)/2n. Sorted by it, sources interleave evenly, and cutting that order into
    equal runs gives shards whose row counts differ by one at most (law `rows`) and whose counts of
    any source differ from its share by less than one row for the ends of the run.

    size is the text's UTF-8 bytes plus 1, text_crc32 its unsigned CRC-32; a null text counts as empty
    in both. A null source is a source of its own. Ties (repeated ids) are ordered by CRC and size, so
    only rows that agree in all result columns are interchangeable. Very long texts are taken whole; a null id is an id like any other. Empty in, empty out; further columns, whatever their names, are not read."""
    text = F.encode(text_or_empty(text_col), "UTF-8")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.col(source_col).cast("string").alias("source"), seeded(seed, id_col).alias("shuffle"))
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("of_source"))
    total = docs.sparkSession.range(1).select(F.lit(docs.select(id_col).count()).alias("of_all")).first()["of_all"]
    cells = max(1, -(-total // rows_per_cell))
    # the digest is uniform, so equal ranges of it are equal cells of any source
    rows = rows.withColumn("cell", F.floor(F.col("shuffle") / F.lit(float(1 << 60)) * cells))
    order = [F.col("shuffle"), F.col("id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    rows = ranked(rows, ["source"], "cell", order, "r").drop("cell")
    rows = rows.join(per_source.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("fraction", (2 * F.col("r") + 1) / (2 * F.col("of_source")))
    rows = rows.withColumn("all", F.lit(0)).withColumn("cell", F.floor(F.col("fraction") * cells))
    rows = ranked(rows, ["all"], "cell", [F.col("fraction"), *order, F.col("source")], "at")
    if total * (shards + 1) >= 1 << 63:
        raise ValueError(f"{total} rows in {shards} shards: positions leave 64 bits")
    shard = F.expr(f"at * {shards} div {max(1, total)}")
    rows = rows.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return rows.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("at") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source", "fraction")
