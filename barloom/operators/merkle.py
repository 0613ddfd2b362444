"""A hash tree over a set of rows: equal roots show equal sets, unequal ones lead down to the rows that differ."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries that a leaf is to have on average; an inner node has at most 16 children, one for each hex digit.
LEAF = 256


def entries(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(digest, times): each distinct row as the SHA-256 of its JSON, with how often it is there. Column order plays no part; a null field counts as absent."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns or df.columns)]))
    return df.select(F.sha2(row, 256).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("times"))


def keyed_entries(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(digest, key, times, hash): each key with its SHA-256, the number of its rows and the SHA-256 of theirs, in order. A key's digests stand in one list; rows dealt by key are not moved."""
    of = df.select(*[F.col(f"`{k}`") for k in keys], _digest(columns).alias("_row")).groupBy(*[F.col(f"`{k}`") for k in keys])
    of = of.agg(F.count(F.lit(1)).alias("times"), F.sha2(F.array_join(F.array_sort(F.collect_list("_row")), ","), 256).alias("hash"))
    return of.select(_digest(keys).alias("digest"), F.struct(*[F.col(f"`{k}`") for k in keys]).alias("key"), "times", "hash")


def _digest(columns: list[str]) -> Column:
    return F.coalesce(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])), 256), F.lit(""))  # never null, so that no plan filters it


def depth_for(rows: int, leaf: int = LEAF) -> int:
    """Levels below the root, so that leaves have about `leaf` entries: digests spread evenly, so it follows from their number."""
    return max(0, math.ceil(math.log(max(rows, 1) / leaf, 16)))


def tree(of: DataFrame, depth: int) -> DataFrame:
    """(level, prefix, n, hash) of all nodes, from entries, with the hashes of those that have one. A node's prefix is the first `level` digits of the digests below it.

    A leaf's hash is that of its entries in order, an inner node's that of its children's digits and hashes in order, so it does not depend on how rows lie or are partitioned. Levels
    are made one from the other, each with map-side counts and at most 16 children a node. An empty set has no nodes."""
    line = F.concat_ws(":", "digest", F.col("times").cast("string"), *["hash" for c in of.columns if c == "hash"])
    level = of.groupBy(F.substring("digest", 1, depth).alias("prefix")).agg(F.sum("times").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ","), 256).alias("hash"))
    level = level.select(F.lit(depth).alias("level"), "prefix", "n", "hash")
    out = level
    for k in range(depth - 1, -1, -1):
        child = F.concat_ws(":", F.substring("prefix", k + 1, 1), "hash")
        level = level.groupBy(F.substring("prefix", 1, k).alias("prefix")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(child)), ","), 256).alias("hash"))
        level = level.select(F.lit(k).alias("level"), "prefix", "n", "hash")
        out = out.unionByName(level)
    return out


def root(df: DataFrame, columns: list[str] | None = None) -> tuple[int, str]:
    """Number of rows and root hash of a table; two tables of equal rows have equal ones, whatever their order, partitioning and column order."""
    of = entries(df, columns)
    n = of.count()
    top = tree(of, depth_for(n)).where("level = 0").first()
    return (top["n"], top["hash"]) if top else (0, "")


def unequal(a: DataFrame, b: DataFrame, depth: int) -> DataFrame:
    """The leaf prefixes at which two trees of one depth differ, found from the root down: of each level only children of nodes that differ stay.

    Each level of the trees is joined once and refers to the level above once, so that the plan grows with the depth, not with a power of it."""
    side = lambda t, k, out: t.where(f"level = {k}").select("prefix", F.col("hash").alias(out))
    open_ = None
    for k in range(depth + 1):
        differ = side(a, k, "_a").join(side(b, k, "_b"), "prefix", "full_outer").where("not (_a <=> _b)").select("prefix")
        if open_ is not None:
            differ = differ.join(open_.withColumnRenamed("prefix", "_up"), F.substring("prefix", 1, k - 1) == F.col("_up"), "left_semi")
        open_ = differ
    return open_


def difference_by_key(a: DataFrame, b: DataFrame, keys: list[str], bound: int, columns: list[str] | None = None) -> DataFrame:
    """As `difference`, for tables that are dealt by their keys: a tree over keys, each with the hash of its rows. Rows of keys that agree are never compared, and no row moves.

    `bound` is a number that keys do not exceed, from which the depth follows, so that they need no count. All is one plan, in which what a and b share is shuffled once."""
    cols, depth = sorted(columns or a.columns), depth_for(bound)
    side = lambda t, n: keyed_entries(t, cols, keys).select("digest", F.struct(F.lit(n).alias("side"), "key", "times", "hash").alias("_of"))
    pairs = side(a, 0).unionByName(side(b, 1)).groupBy("digest").agg(F.collect_list("_of").alias("_sides"))  # all in one column, which no plan cuts or filters: each use of it has the same shuffle
    of = lambda n: F.get(F.filter("_sides", lambda x: x["side"] == n), F.lit(0))
    nodes = lambda n: tree(pairs.select("digest", of(n).alias("_of")).where("_of is not null").select("digest", "_of.times", "_of.hash"), depth)
    open_ = unequal(nodes(0), nodes(1), depth).withColumnRenamed("prefix", "_leaf")
    differ = pairs.where(~of(0)["hash"].eqNullSafe(of(1)["hash"])).join(open_, F.substring("digest", 1, depth) == F.col("_leaf")).select(F.get("_sides", F.lit(0))["key"].alias("_key")).select("_key.*", F.lit(True).alias("_open"))

    def near(t: DataFrame, in_a: int, in_b: int) -> DataFrame:
        unkeyed = functools.reduce(lambda x, y: x | y, [F.col(f"`{k}`").isNull() for k in keys])  # always compared, as a join finds no nulls
        t = t.join(differ, keys, "left").where(F.col("_open") | unkeyed)
        return t.select(*[F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(keys)], _digest(cols).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.lit(in_a).alias("in_a"), F.lit(in_b).alias("in_b"))

    both = near(a, 1, 0).unionByName(near(b, 0, 1)).groupBy(*[f"_k{n}" for n in range(len(keys))], "digest").agg(F.any_value("row").alias("row"), F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
    return both.where("in_a <> in_b").select("row.*", "in_a", "in_b")


def difference(a: DataFrame, b: DataFrame, columns: list[str] | None = None, leaf: int = LEAF) -> DataFrame:
    """The rows (of `columns`, or of the columns of a) in which two tables differ, with how often each has them: in_a and in_b.

    Both trees get the depth of the larger table; rows of leaves that agree are never compared. Repeated rows count; an empty table differs in all rows of the other one."""
    cols = sorted(columns or a.columns)
    ea, eb = entries(a, cols), entries(b, cols)
    depth = depth_for(max(ea.count(), eb.count()), leaf)
    open_ = unequal(tree(ea, depth), tree(eb, depth), depth).withColumnRenamed("prefix", "_leaf")
    row = F.struct(*[F.col(f"`{c}`") for c in cols])

    def counted(t: DataFrame, out: str) -> DataFrame:
        full = t.select(row.alias("row"), F.sha2(F.to_json(row), 256).alias("digest"))
        near = full.join(open_, F.substring("digest", 1, depth) == F.col("_leaf"), "left_semi")
        return near.groupBy("digest").agg(F.any_value("row").alias(f"row_{out}"), F.count(F.lit(1)).alias(out))

    both = counted(a, "in_a").join(counted(b, "in_b"), "digest", "full_outer")
    both = both.select(F.coalesce("row_in_a", "row_in_b").alias("row"), F.coalesce("in_a", F.lit(0).cast("bigint")).alias("in_a"), F.coalesce("in_b", F.lit(0).cast("bigint")).alias("in_b"))
    return both.where("in_a <> in_b").select("row.*", "in_a", "in_b")
