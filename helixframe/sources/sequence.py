"""Reference sequences as tables of their lines, and the bases around places of them. No contig is ever one row or one array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions.variant import chrom_norm

#: Bases of one chunk.
CHUNK = 1000


def read_sequence(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``contig``, ``start`` (from 0) and ``bases`` (upper case) of each line of the files; lines may be of any width, and files are read by block."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), F.regexp_replace("value", r"\s+$", "").alias("value")
    )
    return place_lines(lines)


def place_lines(lines: DataFrame) -> DataFrame:
    """``contig``, ``start`` and ``bases`` of lines (``file``, ``block``, ``line``, ``value``) whose order is that of ``block`` and ``line`` within a file.

    A line with ``>`` names the contig that follows, up to white space; lines before the first and empty lines are left out, and so are contigs without
    a line. The place of a line is the sum of what stands before it in its block since the last name, and, in a block's first stretch, of the blocks before: their sums are
    one row a block, so that no window spans more than a block or the list of blocks of a file.
    """
    # names and lengths are told behind the shuffle, so that all that is read from it, bases or lengths, reads the same one
    rows = lines.where(F.length("value") > 0).select("file", "block", "line", "value").repartition("file", "block").withColumn("name", F.when(F.col("value").startswith(">"), F.get(F.split(F.substring("value", 2, 1 << 20), r"\s+"), F.lit(0))))
    rows = rows.withColumn("n", F.when(F.col("name").isNull(), F.length("value")).otherwise(0).cast("long"))
    by_line = W.partitionBy("file", "block").orderBy("line")
    rows = rows.withColumn("part", F.count("name").over(by_line))  # stretches of a block; 0 continues what came before
    before = W.partitionBy("file", "block", "part").orderBy("line").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    own = W.partitionBy("file", "block", "part")
    rows = rows.withColumn("own", F.max("name").over(own))
    sums = rows.groupBy("file", "block", "part").agg(F.sum("n").alias("n"), F.max("name").alias("name"))
    last = sums.groupBy("file", "block").agg(F.max_by(F.struct("part", "name", "n"), "part").alias("l"))
    blocks = W.partitionBy("file").orderBy("block")
    # a block with a name starts a new run; later blocks without one add to it
    last = last.withColumn("run", F.count("l.name").over(blocks))
    run = W.partitionBy("file", "run").orderBy("block")
    last = last.withColumns({"so_far": F.sum("l.n").over(run), "named": F.first("l.name").over(run)})
    carried = last.select("file", "block", F.lag("named").over(blocks).alias("named"), F.lag("so_far").over(blocks).alias("so_far"))
    out = rows.where("name is null").join(carried, ["file", "block"])
    first = F.col("part") == 0
    out = out.select(F.when(first, F.col("named")).otherwise(F.col("own")).alias("contig"), (F.col("at") + F.when(first, F.coalesce("so_far", F.lit(0))).otherwise(0)).alias("start"), F.upper("value").alias("bases"))
    return out.where("contig is not null")


def chunks(sequence: DataFrame, size: int = CHUNK, overlap: int = 0) -> DataFrame:
    """``contig``, ``chunk_id``, ``start1`` and ``seq``: ``size`` bases each from ``chunk_id * size`` on, and the ``overlap`` bases that follow.

    ``sequence`` has rows of any length with their ``contig``, ``start`` and ``bases``; each is cut at the chunks that it touches.
    """
    size, end = F.lit(size), F.col("start") + F.length("bases")
    low = F.greatest(F.floor((F.col("start") - overlap) / size), F.lit(0))
    rows = sequence.where(F.length("bases") > 0).select("contig", "start", "bases", F.explode(F.sequence(low, F.floor((end - 1) / size))).alias("chunk_id"))
    first = F.greatest(F.col("chunk_id") * size - F.col("start"), F.lit(0))
    stop = F.least((F.col("chunk_id") + 1) * size + overlap, end) - F.col("start")
    rows = rows.where(stop > first).select("contig", F.col("chunk_id").cast("int").alias("chunk_id"), F.struct("start", F.substr("bases", (first + 1).cast("int"), (stop - first).cast("int")).alias("b")).alias("p"))
    joined = rows.groupBy("contig", "chunk_id").agg(F.sort_array(F.collect_list("p")).alias("l"))
    return joined.select("contig", "chunk_id", (F.col("chunk_id") * size + 1).alias("start1"), F.array_join(F.col("l.b"), "").alias("seq"))


def with_context(df: DataFrame, sequence: DataFrame, chrom: str, start: Column, end: Column, out: str, size: int = CHUNK, reach: int = 100) -> DataFrame:
    """``df`` with ``out``: the bases from ``start`` to ``end``, both 1-based and included.

    Null if the contig is unknown, ``start`` is below 1, or the contig ends before ``end``. Contig names match with or
    without chr. A chunk also holds the ``reach`` bases that follow it: a place that ends there joins the one chunk
    it begins in. Of longer ones the different places join the chunks they touch, each by contig and number.
    """
    ref = chunks(sequence.withColumn("contig", chrom_norm(F.col("contig"))), size, reach).select(F.col("contig").alias("__c"), F.col("chunk_id").cast("long").alias("__k"), "seq")
    df = df.drop(out)
    asked = df.withColumns({"__c": chrom_norm(F.col(chrom)), "__s": start.cast("long"), "__e": end.cast("long")})
    there = F.coalesce((F.col("__s") >= 1) & (F.col("__e") >= F.col("__s")), F.lit(False)) & F.col("__c").isNotNull()
    n, at = F.col("__e") - F.col("__s") + 1, F.pmod(F.col("__s") - 1, F.lit(size))
    long = there & (at + n > size + reach)
    # what is no place begins in no chunk
    short = asked.where(~long).withColumn("__k", F.when(there, F.floor((F.col("__s") - 1) / size))).join(ref, ["__c", "__k"], "left")
    bases = F.substr("seq", (at + 1).cast("int"), n.cast("int"))
    short = short.select(*df.columns, F.when(there & (F.length("seq") >= at + n), bases).alias(out))
    asked = asked.where(long)
    places = asked.select("__c", "__s", "__e").distinct()
    touched = places.withColumn("__k", F.explode(F.sequence(F.floor((F.col("__s") - 1) / size), F.floor((F.col("__e") - 1) / size))))
    first = F.greatest(F.col("__s") - 1 - F.col("__k") * size, F.lit(0))
    stop = F.least(F.col("__e") - F.col("__k") * size, F.lit(size))
    cut = touched.join(ref, ["__c", "__k"]).select("__c", "__s", "__e", F.struct("__k", F.substr("seq", (first + 1).cast("int"), (stop - first).cast("int")).alias("b")).alias("p"))
    text = cut.groupBy("__c", "__s", "__e").agg(F.array_join(F.sort_array(F.collect_list("p"))["b"], "").alias(out))
    text = text.where(F.length(out) == F.col("__e") - F.col("__s") + 1)
    return short.unionByName(asked.join(text, ["__c", "__s", "__e"], "left").select(*df.columns, out))
