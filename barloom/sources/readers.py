"""Files as tables: price histories, holdings, filings in XML, nested JSON payloads, rosters, and stores with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.sources import ownership_forms


def price_history(spark: SparkSession, path: str | list[str], schema: StructType | str, ticker: str | None = None) -> DataFrame:
    """Bars of one file, or of many in one read, with not-a-numbers as nulls; rows without a date go.

    With a column name for `ticker` it is taken from each file's name. The schema is given, so no file is opened to infer one."""
    paths = [path] if isinstance(path, str) else path
    df = spark.read.schema(schema).parquet(*paths)
    if ticker:
        df = df.withColumn("_path", F.input_file_name()).withColumn(ticker, _named("_path")).drop("_path")
    clean = [F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    return df.select(*clean).where("date is not null")


def _named(path: str) -> Column:
    """The name of a file, or of the folder of a part file, without .parquet. By cuts at slashes: a pattern without a fixed start is tried at each place of the path, for each row."""
    last = F.substring_index(path, "/", -1)
    name = F.when(last.startswith("part-"), F.substring_index(F.substring_index(path, "/", -2), "/", 1)).otherwise(last)
    return F.when(name.endswith(".parquet") & (F.length(name) > 8), name.substr(F.lit(1), F.length(name) - 8)).otherwise(name)


def nested_payloads(spark: SparkSession, path: str, value: str, on_or_before: str, key: str = "ticker") -> DataFrame:
    """(date, ticker, value struct): the newest payload file's entries on or before a date.

    Payloads lie in folders date=YYYY-MM-DD, each line an object of ticker to value (a DDL type). Folders after the date are not read."""
    df = spark.read.schema(f"payload map<string, {value}>, date date").json(path)
    df = df.where(F.col("date") <= F.lit(on_or_before).cast("date"))
    newest = df.agg(F.max("date")).first()[0]
    return df.where(F.col("date") == F.lit(newest)).select("date", F.explode("payload").alias(key, "value"))


def holdings_table(spark: SparkSession, path: str) -> DataFrame:
    """cusip, shares, market_value of a pipe-separated holdings table: names in lower case, thousands commas gone, options and rows without a CUSIP of nine digits dropped."""
    df = spark.read.option("header", True).option("sep", "|").csv(path)
    df = df.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in df.columns])
    if "cusip" not in df.columns:
        return df.sparkSession.createDataFrame([], "cusip string, shares double, market_value double")
    number = lambda c: F.expr(f"try_cast(replace({c}, ',', '') AS double)").alias(c) if c in df.columns else F.lit(None).cast("double").alias(c)
    if "put_call" in df.columns:
        df = df.where(F.trim(F.coalesce("put_call", F.lit(""))) == "")
    return df.where(F.col("cusip").rlike(r"^\d{9}$")).select("cusip", number("shares"), number("market_value"))


def ownership_transactions(forms: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """`ownership_forms.insider_transactions` in short: id, issuer, owner, table, nth, security, date, code, acquired, shares, price, after, with missing texts as null."""
    t = ownership_forms.insider_transactions(forms, id_col, xml_col)
    none = lambda c, out: F.nullif(F.col(c), F.lit("")).alias(out)
    table = F.when(F.col("is_derivative"), "derivative").otherwise("non_derivative").alias("table")
    return t.select("id", none("ticker", "issuer"), none("owner", "owner"), table, "nth", none("security", "security"), "date", none("code", "code"), none("acquired", "acquired"), "shares", "price", "after")


def rosters(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """(date, tickers): the distinct members of each roster from first to last, of folders date=YYYY-MM-DD; others are not read."""
    df = spark.read.schema("ticker string, date date").parquet(path).where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return df.groupBy("date").agg(F.array_sort(F.collect_set("ticker")).alias("tickers"))


def write_days(df: DataFrame, path: str, day: str = "date") -> None:
    """A day's rows each in a folder of its own; days that come again are replaced, others stay."""
    df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def read_days(spark: SparkSession, path: str, schema: StructType | str, first: str, last: str, day: str = "date") -> DataFrame:
    """The rows of the days from first to last under a fixed schema; a store or a range without any day is an empty table of that schema."""
    empty = spark.createDataFrame([], schema)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return empty
    return spark.read.schema(empty.schema).parquet(path).where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).select(*empty.columns)


def registry(spark: SparkSession, groups: dict[str, list[str]], tables: dict[str, DataFrame]) -> DataFrame:
    """(group, column, type, table) of the columns that the groups name and the tables have, as a table to export."""
    found = [(g, c, t, n) for n, df in tables.items() for c, t in df.dtypes for g, names in groups.items() if c in names]
    return spark.createDataFrame(found, "group string, column string, type string, table string")



def filled_registry(spark: SparkSession, groups: dict[str, list[str]], tables: dict[str, DataFrame]) -> DataFrame:
    """`registry` with the values and rows that each column has (filled, rows): one scan of each table, over the named columns only."""
    counts = None
    for name, df in tables.items():
        cols = sorted({c for names in groups.values() for c in names if c in df.columns})
        if not cols:
            continue
        one = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols], F.count(F.lit(1)).alias("_rows"))
        long = one.unpivot(["_rows"], [F.col(f"`{c}`") for c in cols], "column", "filled").select(F.lit(name).alias("table"), "column", "filled", F.col("_rows").alias("rows"))
        counts = long if counts is None else counts.union(long)
    found = registry(spark, groups, tables)
    if counts is None:
        return found.withColumns({"filled": F.lit(0).cast("bigint"), "rows": F.lit(0).cast("bigint")})
    return found.join(counts, ["table", "column"]).select("group", "column", "type", "table", "filled", "rows")
