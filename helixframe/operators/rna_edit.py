"""RNA-edit branch: positions seen in DNA go, signature and depth filters, known sites, motif, lane collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import variant as v
from ..sources.sequence import chunks


def without_positions(calls: DataFrame, other: DataFrame) -> DataFrame:
    """Calls at no position of ``other``; alleles and filters do not count, chromosome names are taken as they are."""
    key = ["patient", "chrom", "pos"]
    return calls.join(other.select(*key).distinct(), key, "left_anti")


def with_signature(calls: DataFrame) -> DataFrame:
    ref, alt = F.col("ref"), F.col("alt")
    return calls.withColumns({"snv": v.is_snv(ref, alt), "adar": v.has_change(ref, alt, v.ADAR), "apobec3": v.has_change(ref, alt, v.APOBEC3)})


def edit_signature(calls: DataFrame, adar_only: bool = False, keep_non_snv: bool = False) -> DataFrame:
    """Calls whose change reads as an edit; anything but single bases goes unless kept on request."""
    rows = with_signature(calls)
    wanted = F.col("adar") if adar_only else F.col("adar") | F.col("apobec3")
    return rows.where((F.col("snv") & wanted) | (~F.col("snv") if keep_non_snv else F.lit(False)))


def signature_counts(calls: DataFrame) -> DataFrame:
    s = with_signature(calls)
    n = lambda c, name: F.count_if(c).alias(name)
    a, b, snv = F.col("adar"), F.col("apobec3"), F.col("snv")
    return s.groupBy("patient").agg(F.count("*").alias("total"), n(~snv, "non_snv"), n(snv & ~a & ~b, "no_signature"), n(snv & a & ~b, "adar_only"), n(snv & b & ~a, "apobec3_only"), n(snv & a & b, "both"))


def paired_qc(calls: DataFrame, min_dp: int = 10, normal_max_alt: int = 1, normal_max_vaf: float = 0.05, rna_min_alt: int = 3, rna_min_vaf: float = 0.05) -> DataFrame:
    """``drop_reason``, the first check that fails, else null. Counts are arrays ``normal_ad`` and ``rna_ad``; where the columns
    ``normal_dp`` and ``rna_dp`` are there and not null they are the depths, else the counts are added up."""
    n, r = F.col("normal_ad"), F.col("rna_ad")
    depth = lambda side: v.sample_depth(F.col(f"{side}_dp") if f"{side}_dp" in calls.columns else F.lit(None).cast("long"), F.col(f"{side}_ad"))
    gone = v.vaf_of(n).isNull() | v.vaf_of(r).isNull()
    checks = [
        (gone, "MISSING"), (depth("normal") < min_dp, "NORMAL_DP"), (v.alt_total(n) > normal_max_alt, "NORMAL_ALT"), (v.vaf_of(n) >= normal_max_vaf, "NORMAL_VAF"),
        (depth("rna") < min_dp, "RNA_DP"), (v.alt_total(r) < rna_min_alt, "RNA_ALT"), (v.vaf_of(r) < rna_min_vaf, "RNA_VAF"),
    ]
    reason = F.lit(None).cast("string")
    for test, name in reversed(checks):
        reason = F.when(test, name).otherwise(reason)
    return calls.withColumn("drop_reason", reason)


def with_known_sites(calls: DataFrame, known: DataFrame) -> DataFrame:
    """``known_db`` of the exact variant, null if it is not listed; of repeated entries the least name. Spark broadcasts small lists by itself."""
    key = ["chrom", "pos", "ref", "alt"]
    return calls.join(known.groupBy(*key).agg(F.min("known_db").alias("known_db")), key, "left")


def collapse_lanes(lanes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per record: counts added element by element over lanes in order, depth, allele fraction and genotype made anew.

    The lists are ``ad`` and those of ``f1r2``, ``f2r1``, ``fad`` and ``sb`` that ``lanes`` has.
    """
    more = [c for c in ("f1r2", "f2r1", "fad", "sb") if c in lanes.columns]
    rows = lanes.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*order, "ad", "dp", *more))).alias("l"))
    rows = rows.select(*key, v.add_lists(F.col("l.ad")).alias("ad"), *(v.add_lists(F.col(f"l.{c}")).alias(c) for c in more), F.filter("l.dp", lambda x: x.isNotNull()).alias("dps"))
    dp = F.when(F.size("dps") > 0, F.aggregate("dps", F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(v.depth_of(F.col("ad")))
    rows = rows.withColumn("dp", dp)
    gt = F.when(F.col("ad").isNull(), "./.").when(v.alt_total(F.col("ad")) > 0, "0/1").otherwise("0/0")
    return rows.withColumns({"af": v.recomputed_af(F.col("ad"), F.col("dp")), "gt": gt}).drop("dps")


def piece_chunks(pieces: DataFrame, order: str, size: int = 10_000, overlap: int = 8, prefix: int = 9) -> DataFrame:
    """Chunks (see ``sequence.chunks``) of sequences that are spelt by the rows of ``pieces`` (``contig``, ``seq``) in order of the string ``order``.

    No sequence is built as a whole: rows are placed within runs of an equal ``prefix`` of
    ``order`` (which sorts as ``order`` does), and runs by the sums of those before.
    """
    rows = pieces.where("contig is not null and length(seq) > 0").select("contig", "seq", F.col(order).alias("o"), F.substring(order, 1, prefix).alias("run"), F.length("seq").cast("long").alias("n"))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    upto = lambda by, *place: F.coalesce(F.sum("n").over(before.partitionBy(*by).orderBy(*place)), F.lit(0))
    runs = rows.groupBy("contig", "run").agg(F.sum("n").alias("n")).select("contig", F.col("run").alias("of"), upto(["contig"], "run").alias("at"))
    placed = rows.withColumn("within", upto(["contig", "run"], "o", "seq")).join(runs.withColumnRenamed("contig", "on"), (F.col("contig") == F.col("on")) & F.col("run").eqNullSafe(F.col("of")))
    return chunks(placed.select("contig", (F.col("at") + F.col("within")).alias("start"), F.col("seq").alias("bases")), size, overlap)


def with_motif(calls: DataFrame, chunks: DataFrame, size: int = 10_000) -> DataFrame:
    """``motif``: whether the APOBEC3 motif surrounds the call. Unknown contigs and places before 1 have none."""
    context = lambda first, name: (
        F.when((F.col("pos") + first >= 1) & (F.length(F.substring("seq", (F.col("pos") + first - F.col("start1") + 1).cast("int"), F.lit(5))) == 5), F.substring("seq", (F.col("pos") + first - F.col("start1") + 1).cast("int"), F.lit(5))).alias(name)
    )
    rows = calls.withColumn("chunk_id", F.floor((F.greatest(F.col("pos") - 4, F.lit(0))) / size).cast("int"))
    rows = rows.join(chunks.withColumnRenamed("contig", "chrom"), ["chrom", "chunk_id"], "left")
    rows = rows.select(*calls.columns, context(-3, "__b"), context(-1, "__a"))
    return rows.select(*calls.columns, v.motif_hit(F.col("ref"), F.col("alt"), F.col("__b"), F.col("__a")).alias("motif"))


def drop_counts(judged: DataFrame, reason: str = "drop_reason") -> DataFrame:
    """``patient``, the reason and ``n``: calls dropped for each reason of ``paired_qc``; those without one are the kept ones."""
    return judged.groupBy("patient", reason).agg(F.count("*").alias("n"))
