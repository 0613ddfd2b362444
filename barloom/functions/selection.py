"""Exact ranks and medians of groups of any size, by counting: no group is sorted, or brought into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a value that a round settles; a group's histogram has at most 2 ** STEP bins in each round.
STEP = 16


def ordered_bits(x: Column) -> Column:
    """A double as a whole number of 64 bits in the same order; -0.0 is 0.0, and NaN the greatest."""
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def from_bits(bits: Column) -> Column:
    """The double of `ordered_bits`."""
    raw = F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)
    return F.call_function("reflect", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw).cast("double")


def medians(df: DataFrame, keys: list[str], x: str, out: str = "median", count: str = "n") -> DataFrame:
    """(keys, median, n): the exact median of x in each group, the mean of the two in the middle where their number is even, and the number of values.

    Values are counted (with map-side sums, spread by group and value), then found bit by bit: a histogram over the leading STEP bits of each group tells which bin holds
    the rank, the next round counts the bits after that in this bin only, until all 64 are known. What a task holds of a group is a histogram.

    Nulls count for nothing, groups with nothing else have none; NaN is a value above all others; null keys are a group; empty in, empty out."""
    names = [f"_k{n}" for n in range(len(keys))]
    counts = df.where(F.col(x).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], ordered_bits(F.col(x).cast("double")).alias("_v"))
    counts = counts.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_c"))
    total = counts.groupBy(*names).agg(F.sum("_c").alias("_n"))
    # the ranks in the middle, one or two of them
    sought = total.select(*names, "_n", F.explode(F.array(F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1"))).alias("_rank"), F.lit(0).cast("bigint").alias("_prefix")).distinct()
    sought = sought.withColumn("_which", F.col("_rank"))
    for shift in range(64 - STEP, -1, -STEP):
        first = shift == 64 - STEP
        c = counts.withColumn("_bin", F.shiftright("_v", shift))
        if first:
            bins = c.groupBy(*names, "_bin").agg(F.sum("_c").alias("_c"))
            over = Window.partitionBy(*names).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
            bins = bins.withColumn("_to", F.sum("_c").over(over))
            b, s = bins.alias("b"), sought.alias("s")
            hit = b.join(s, _same(names) & (F.col("s._rank") <= F.col("b._to")) & (F.col("s._rank") > F.col("b._to") - F.col("b._c")))
        else:
            inside = c.withColumn("_prefix", F.shiftright("_v", shift + STEP)).alias("b").join(sought.alias("s"), _same(names) & (F.col("b._prefix") == F.col("s._prefix")))
            inside = inside.select(*[F.col(f"b.{n}").alias(n) for n in names], "_bin", "_c", "_n", "_rank", "_which")
            bins = inside.groupBy(*names, "_n", "_which", "_rank", "_bin").agg(F.sum("_c").alias("_c"))
            over = Window.partitionBy(*names, "_which").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
            hit = bins.withColumn("_to", F.sum("_c").over(over)).where("_rank <= _to and _rank > _to - _c").alias("b")
        side = "s" if first else "b"
        sought = hit.select(*[F.col(f"b.{n}").alias(n) for n in names], F.col(f"{side}._n").alias("_n"), F.col(f"{side}._which").alias("_which"), (F.col(f"{side}._rank") - (F.col("b._to") - F.col("b._c"))).alias("_rank"), F.col("b._bin").alias("_prefix"))
    got = sought.groupBy(*names).agg(F.min("_prefix").alias("_lo"), F.max("_prefix").alias("_hi"), F.max("_n").alias("_n"))
    middle = (from_bits(F.col("_lo")) + from_bits(F.col("_hi"))) / 2
    return got.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], F.when(F.col("_lo") == F.col("_hi"), from_bits(F.col("_lo"))).otherwise(middle).alias(out), F.col("_n").alias(count))


def _same(names: list[str]) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & F.col(f"b.{n}").eqNullSafe(F.col(f"s.{n}"))
    return on
