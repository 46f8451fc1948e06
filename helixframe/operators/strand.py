"""Strand support: gene strands at a position, reads over it, and the decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import variant as v
from .ranges import covering, in_intervals


def gene_strands(calls: DataFrame, gtf: DataFrame, block: int = 1_000_000) -> DataFrame:
    """``strands`` of each call: those of exonic features over it, else those of transcripts, else empty; worked out once for each position."""
    chrom = v.chrom_norm(F.col("chrom"))
    genes = gtf.where(F.col("strand").isin("+", "-")).select(chrom.alias("__c"), "start0", "end0", "strand", F.col("feature").isin(*v.EXONIC).alias("exonic"))
    kinds = {f"__{tier}{i}": (F.col("exonic") == (tier == "e")) & (F.col("strand") == s) for tier in "et" for i, s in enumerate("+-")}
    rows = calls.withColumns({"__c": chrom, "__p": F.col("pos") - 1})
    counts = covering(rows, genes, ["__c"], "__p", "start0", "end0", kinds, block)
    own = lambda tier: F.filter(F.array(*(F.when(F.col(f"__{tier}{i}") > 0, s) for i, s in enumerate("+-"))), lambda x: x.isNotNull())
    sets = counts.select("__c", "__p", F.when(F.size(own("e")) > 0, own("e")).otherwise(own("t")).alias("strands"))
    out = rows.join(sets, ["__c", "__p"], "left").select(*calls.columns, "strands")
    return out.withColumn("strands", F.coalesce("strands", F.array().cast("array<string>")))


def aligned_blocks(reads: DataFrame) -> DataFrame:
    """One row per aligned block of a read: reference start and end (0-based, half open) and the place in the read."""
    ops = F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(0))
    step = F.transform(ops, lambda o: F.struct(F.regexp_extract(o, r"^\d+", 0).cast("long").alias("n"), F.substring(o, -1, 1).alias("op")))
    zero = F.struct(F.lit(0).cast("long").alias("r"), F.lit(0).cast("long").alias("q"), F.array().cast("array<struct<r:bigint,q:bigint,n:bigint>>").alias("b"))

    def walk(a, s):
        m, n = s["op"].isin("M", "=", "X"), s["n"]
        return F.struct(
            (a["r"] + F.when(m | s["op"].isin("D", "N"), n).otherwise(0)).alias("r"), (a["q"] + F.when(m | s["op"].isin("I", "S"), n).otherwise(0)).alias("q"),
            F.when(m, F.concat(a["b"], F.array(F.struct(a["r"].alias("r"), a["q"].alias("q"), n.alias("n"))))).otherwise(a["b"]).alias("b"),
        )

    rows = reads.withColumn("b", F.explode(F.aggregate(step, zero, walk)["b"]))
    return rows.withColumns({"block_start": F.col("pos0") + F.col("b.r"), "block_end": F.col("pos0") + F.col("b.r") + F.col("b.n"), "q0": F.col("b.q")}).drop("b")


def alt_support(calls: DataFrame, reads: DataFrame, protocol: str = "fr-firststrand", min_mapq: int = 20, min_qual: int = 20) -> DataFrame:
    """ALT reads of each call with one gene strand: on the expected strand, on the other, and all.

    Primary, mapped, passing, non-duplicate reads count. A base counts if it equals the alternate, whatever the case, so longer alternates have
    no support, and if its own quality in the array ``quals`` reaches ``min_qual``; reads without qualities count. Calls without any such read are left out.
    """
    return with_alt_support(calls.select("rid", "patient", "chrom", "pos", "alt", "strands"), reads, protocol, min_mapq, min_qual).where("alt_reads > 0").select("rid", "expected", "opposite", "alt_reads")


def with_alt_support(calls: DataFrame, reads: DataFrame, protocol: str = "fr-firststrand", min_mapq: int = 20, min_qual: int = 20) -> DataFrame:
    """``calls`` with ``expected``, ``opposite`` and ``alt_reads`` of ``alt_support``, 0 without any.

    Reads that are alike are one with their number, and bases are counted once for each different position that a call with one strand asks for; the calls
    take their counts from there by position and base. So pairs of calls and reads are never made.
    """
    good = reads.where((F.col("mapq") >= min_mapq) & (F.col("flag").bitwiseAND(F.lit(0x4 | 0x100 | 0x200 | 0x400 | 0x800)) == 0))
    good = good.select("patient", F.col("contig").alias("chrom"), "pos0", "cigar", "seq", "quals", v.transcript_strand_of_read(F.col("flag"), protocol).alias("read_strand"))
    alike = good.groupBy(*good.columns).agg(F.count("*").alias("n"))
    blocks = aligned_blocks(alike).select("patient", "chrom", "block_start", "block_end", "q0", "seq", "quals", "read_strand", "n")
    rows = calls.withColumn("__p0", F.col("pos") - 1)
    points = rows.where(F.size("strands") == 1).select("patient", "chrom", F.col("__p0").alias("p0")).distinct()
    hits = in_intervals(points, blocks, ["patient", "chrom"], "p0", "block_start", "block_end", 1000)
    at = (F.col("p0") - F.col("block_start") + F.col("q0")).cast("int")
    hits = hits.where(F.coalesce(F.get("quals", at) >= min_qual, F.lit(True))).select("patient", "chrom", "p0", F.upper(F.substring("seq", at + 1, F.lit(1))).alias("__base"), "read_strand", "n")
    on = lambda s: F.coalesce(F.sum(F.when(F.col("read_strand") == s, F.col("n"))), F.lit(0)).alias(f"__{s}")
    counts = hits.groupBy("patient", "chrom", F.col("p0").alias("__p0"), "__base").agg(on("+"), on("-"))
    # calls of no or several strands ask for nothing
    base = F.when(F.size("strands") == 1, F.upper("alt"))
    out = rows.withColumn("__base", base).join(counts, ["patient", "chrom", "__p0", "__base"], "left")
    plus, minus, forward = F.coalesce("__+", F.lit(0)), F.coalesce("__-", F.lit(0)), F.get("strands", F.lit(0)) == "+"
    return out.select(*calls.columns, F.when(forward, plus).otherwise(minus).alias("expected"), F.when(forward, minus).otherwise(plus).alias("opposite"), (plus + minus).alias("alt_reads"))


def decide(calls: DataFrame, support: DataFrame | None, contigs: DataFrame, min_fraction: float = 0.8) -> DataFrame:
    """``reason``, the first that applies; all but PASS are on the blacklist. ``support`` is that of ``alt_support``; without it ``calls`` has its columns."""
    rows = calls if support is None else calls.join(support, "rid", "left").fillna(0, ["expected", "opposite", "alt_reads"])
    rows = rows.join(contigs.select(F.col("patient"), F.col("contig").alias("chrom"), F.lit(True).alias("__there")).distinct(), ["patient", "chrom"], "left")
    fraction = F.try_divide("expected", "alt_reads")
    reason = (
        F.when(F.size("strands") == 0, "MISSING_TRANSCRIPT_STRAND").when(F.size("strands") > 1, "AMBIGUOUS_TRANSCRIPT_STRAND").when(F.col("__there").isNull(), "MISSING_BAM_CONTIG")
        .when(F.col("alt_reads") == 0, "NO_ALT_READ_SUPPORT").when(fraction < min_fraction, "OPPOSITE_STRAND_ENRICHED").otherwise("PASS")
    )
    return rows.withColumns({"fraction": fraction, "reason": reason}).drop("__there")


def reason_counts(decided: DataFrame) -> DataFrame:
    """Calls by ``reason`` of ``decide``."""
    return decided.groupBy("reason").agg(F.count("*").alias("n"))
