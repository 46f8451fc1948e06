"""Range joins as equi-joins on bins, and a sweep where only counts of covering intervals are asked. Spark has no range join of its own; these would be nested loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _bin(c: Column, size: int) -> Column:
    return F.floor(c / size).cast("long")


def near_pairs(a: DataFrame, b: DataFrame, keys: list[str], distance: int, a_pos: str = "pos", b_pos: str = "b_pos") -> DataFrame:
    """Pairs of rows with equal ``keys`` whose positions differ by at most ``distance``.

    ``b`` (best the smaller side) is repeated for its bin and the two beside it.
    Null keys and positions pair with nothing.
    """
    size = distance + 1
    left = a.withColumn("__bin", _bin(F.col(a_pos), size))
    right = b.withColumn("__bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: _bin(F.col(b_pos), size) + i)))
    return left.join(right, [*keys, "__bin"]).where(F.abs(F.col(a_pos) - F.col(b_pos)) <= distance).drop("__bin")


def near_any(a: DataFrame, b: DataFrame, keys: list[str], distance: int, pos: str = "pos") -> DataFrame:
    """Rows of ``a`` that have a row of ``b`` within ``distance``: a semi-join over distinct positions."""
    size = distance + 1
    right = b.select(*keys, F.col(pos).alias("__p")).distinct()
    right = right.withColumn("__bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: _bin(F.col("__p"), size) + i)))
    left = a.withColumn("__bin", _bin(F.col(pos), size))
    on = [left[k] == right[k] for k in [*keys, "__bin"]] + [F.abs(left[pos] - right["__p"]) <= distance]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(right, cond, "left_semi").drop("__bin")


def in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str, bin_size: int = 1000) -> DataFrame:
    """Pairs of points and half-open intervals that hold them, for intervals of any length.

    Intervals are binned by their length: bins are the least of ``bin_size`` times a power of four that is no shorter, so an interval is repeated for two
    bins at most, however long it is. A point looks into one bin of each size that occurs (16 sizes at most, in one broadcast row).
    An interval that ends at or before its start holds nothing; null keys and positions pair with nothing.
    """
    length = F.col(end) - F.col(start)
    size = F.least(F.greatest(F.ceil(F.log(4.0, length.cast("double") / bin_size) - 1e-9), F.lit(0)), F.lit(15)).cast("int")
    width = lambda c: (F.lit(bin_size) * F.pow(F.lit(4.0), c)).cast("long")
    sized = intervals.where(length > 0).withColumn("__size", size)
    step = width(F.col("__size"))
    right = sized.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / step), F.floor((F.col(end) - 1) / step))))
    sizes = F.broadcast(sized.agg(F.collect_set("__size").alias("__sizes")))
    left = points.crossJoin(sizes).withColumn("__size", F.explode("__sizes")).drop("__sizes").withColumn("__bin", F.floor(F.col(point) / step))
    return left.join(right, [*keys, "__size", "__bin"]).where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("__size", "__bin")


def covering(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str, kinds: dict[str, Column], block: int = 1_000_000) -> DataFrame:
    """Different points (``keys``, ``point``) and, for each of ``kinds``, how many intervals of that kind (a condition) cover them, half open.

    A sweep: an interval counts from its start and no longer from its end, so its cost does not depend on its length. Positions
    are swept by blocks, each with the sum of all blocks before it, which is one row a block. Intervals that end at or before their start cover nothing;
    null keys and positions are left out.
    """
    names = list(kinds)
    size = {n: F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0).cast("long") for n, c in kinds.items()}
    ranges = intervals.where(F.col(end) > F.col(start)).select(*keys, F.col(start).cast("long").alias("__s"), F.col(end).cast("long").alias("__e"), *(c.alias(n) for n, c in size.items()))
    edge = lambda at, sign: ranges.select(*keys, F.col(at).alias("__at"), *((F.col(n) * sign).alias(n) for n in names))
    changes = edge("__s", 1).unionByName(edge("__e", -1)).groupBy(*keys, "__at").agg(*(F.sum(n).alias(n) for n in names)).withColumn("__point", F.lit(False))
    asked = points.select(*keys, F.col(point).cast("long").alias("__at")).distinct().select("*", *(F.lit(0).cast("long").alias(n) for n in names), F.lit(True).alias("__point"))
    known = F.col("__at").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    of_block = lambda rows: rows.where(known).withColumn("__block", F.floor(F.col("__at") / block))
    before = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    sums = of_block(changes).groupBy(*keys, "__block").agg(*(F.sum(n).alias(n) for n in names))
    # blocks that are asked but have no change of their own take what the last one before them leaves
    blocks = sums.unionByName(of_block(asked).select(*keys, "__block", *names).distinct()).groupBy(*keys, "__block").agg(*(F.sum(n).alias(n) for n in names))
    carried = blocks.select(*keys, "__block", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__{n}") for n in names))
    within = W.partitionBy(*keys, "__block").orderBy("__at", "__point").rowsBetween(W.unboundedPreceding, 0)
    swept = of_block(changes.unionByName(asked)).select(*keys, "__block", "__at", "__point", *(F.sum(n).over(within).alias(n) for n in names)).where("__point")
    return swept.join(carried, [*keys, "__block"]).select(*keys, F.col("__at").alias(point), *((F.col(n) + F.col(f"__{n}")).alias(n) for n in names))
