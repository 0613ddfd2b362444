"""Exact de-duplication through an extendible-hash index on shared files, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, partitions, scratch, text_or_empty

#: Runs of white space that are not one blank already.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Entries of a bucket above which it is split, and bits of the largest directory (so it has at most 2**20 rows).
CAPACITY, DEPTH = 50_000, 20
#: Parts of a group of copies that are counted apart before they meet at their owner.
SALTS = 16


def normalized(text: str | Column) -> Column:
    """The text with each run of ASCII white space as one blank; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), _RUNS, " ")


def _slot(key: str, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, key: str, capacity: int, depth: int, owners: int = 1) -> DataFrame:
    """Extendible-hash directory over 64-bit keys: for each used slot of 2**depth its bucket, the bucket's local_depth, and its owner.

    It begins with one bucket. A bucket covers all slots that share its first local_depth bits; while one holds
    more than `capacity` keys it is split on its next bit, round by round, and where its local depth reaches the global one the
    directory doubles. Only at `depth` bits a bucket may stay overfull. Each round's state is a table in the shared folder.
    Owners take runs of buckets with about equal numbers of keys."""
    slots = keys.groupBy(_slot(key, depth).alias("slot")).agg(F.count(F.lit(1)).alias("filled"))
    state = slots.select("slot", "filled", F.lit(0).alias("local_depth"), F.lit(0).cast("long").alias("bucket"))
    in_bucket = Window.partitionBy("bucket")
    while True:
        state = materialize(state.withColumn("overfull", (F.sum("filled").over(in_bucket) > capacity) & (F.col("local_depth") < depth)), "directory")
        if state.where("overfull").isEmpty():
            break
        deeper = state.withColumn("local_depth", F.col("local_depth") + F.col("overfull").cast("int"))
        start = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
        state = deeper.withColumn("bucket", start).select("slot", "filled", "local_depth", "bucket")
    buckets = state.groupBy("bucket").agg(F.sum("filled").alias("size"))
    upto = F.sum("size").over(Window.orderBy("bucket"))  # no more than 2**depth buckets
    total = F.sum("size").over(Window.partitionBy())
    owner = F.least(F.lit(owners - 1), F.floor((upto - F.col("size")) * owners / total)).cast("int").alias("owner")
    return state.select("slot", "local_depth", "bucket").join(buckets.select("bucket", owner), "bucket")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key and digest of each row, in the shared folder."""
    norm = docs.select(F.col(id_col).alias("id"), normalized(text_col).alias("norm"))
    return materialize(norm.select("id", F.xxhash64("norm").alias("key"), F.unhex(F.sha2(F.encode("norm", "UTF-8"), 256)).alias("digest")), "rows", keep=True)


def build_index(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """Index of the distinct normalised texts, written to shared files by the owners of its buckets.

    The directory (see there) is made from the keys of `rows`. Texts are first counted in SALTS parts by hash and bytes, with sums on the
    map side, so that a group of copies of any size reaches its owner as a few entries. Each entry then goes to the owner of
    its bucket. An owner compares the bytes of entries with one key: equal ones are added up to one link of the
    key's chain, others get a link of their own. Columns: bucket, local_depth, key, chain (from 1), digest (SHA-256), keep_id
    (smallest id, null if there is none), group_size. Beyond capacity * 2**(depth - 4) texts the buckets grow instead of the directory."""
    owners = partitions(docs.sparkSession)
    texts = rows.select("key", "digest").distinct()
    n = texts.count()
    capacity = max(capacity, n >> max(0, depth - 4))
    bits = min(depth, max(0, math.ceil(math.log2(max(1, n / capacity)))) + 4)
    slots = directory(texts.select("key"), "key", capacity, bits, owners)
    text = docs.select(F.col(id_col).alias("id"), normalized(text_col).alias("norm"))
    entries = text.groupBy(F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"), F.xxhash64("norm").alias("key"), "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    placed = entries.withColumn("slot", _slot("key", bits)).join(F.broadcast(slots), "slot")  # 2**20 rows at most
    dealt = placed.repartitionById(owners, F.col("owner"))
    links = dealt.groupBy("owner", "bucket", "local_depth", "key", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    links = links.withColumn("digest", F.unhex(F.sha2(F.encode("norm", "UTF-8"), 256))).drop("norm")
    chain = F.row_number().over(Window.partitionBy("owner", "bucket", "key").orderBy("digest"))
    return materialize(links.select("bucket", "local_depth", "key", chain.alias("chain"), "digest", "keep_id", "group_size"), "index", keep=True)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (of the normalised text), all read from the index.

    Of equal normalised texts the row with the smallest id stays. Null texts count as empty, and all
    empty texts are one group; very long texts are taken whole. Rows with a null id stay only where no row of the group has an id; of
    several rows with the same id and text exactly one stays; one id may stand on several texts, each with a group of its own. An empty table gives an empty result;
    further columns of docs, whatever their names, are not read."""
    with scratch(docs.sparkSession):
        rows = _rows(docs, id_col, text_col)
        index = build_index(docs, rows, id_col, text_col, capacity)
    times = rows.groupBy("id", "key", "digest").agg(F.count(F.lit(1)).alias("times"))
    found = times.join(index.select("key", "digest", "keep_id", "group_size"), ["key", "digest"])
    found = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _row_key(id_: str, digest: Column) -> Column:
    """Id and text digest of a row as one value that is never null."""
    return F.concat(digest, F.encode(F.coalesce(F.concat(F.lit("="), F.col(id_).cast("string")), F.lit("")), "UTF-8"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns.

    Rows are known by id and normalised text. Of rows that agree in both, one stays: that with the least text, and
    then the one whose other columns come first as JSON. Nulls, empty and long texts are as in exact_dedup; empty in, empty out."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_id"), "text_sha256").select(_row_key("_id", F.unhex("text_sha256")).alias("_key"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.unhex(F.sha2(F.encode(normalized(text_col), "UTF-8"), 256)).alias("_digest"))
    joined = named.select("_row", _row_key("_id", F.col("_digest")).alias("_key")).join(kept, "_key", "left_semi")
    rest = F.to_json(F.struct(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in (id_col, text_col)], F.lit(0).alias("_0")))
    one = Window.partitionBy("_key").orderBy(text_or_empty(F.col(f"_row.`{text_col}`")), rest)
    return joined.withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*")
