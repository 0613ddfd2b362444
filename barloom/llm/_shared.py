"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where that is unset and Spark runs on one machine."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    made = getattr(shared_dir, "made", None)
    if made is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        made = shared_dir.made = "file://" + tempfile.mkdtemp(prefix="barloom-")
    return made


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/barloom/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside are deleted at the end, but those to be kept; they belong to the scope around, if there is one.

    What is still to be read later, such as the tables behind a result that is not computed yet, must be kept."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: the lineage ends there and a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    if len(_scopes) > keep:
        _scopes[-2 if keep else -1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
