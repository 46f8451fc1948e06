"""Genome-wide views of calls: one running coordinate, depth trend, cluster of each call, log density, copies by pair of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import variant as v
from .clusters import same_copy_flags, source_counter_columns
from .ranges import in_intervals

SOURCES = ("GERMLINE", "SOMATIC", "RNA_EDIT")


def genome_offsets(calls: DataFrame, gap: int = 20_000_000) -> DataFrame:
    """``chrom``, ``offset``: where each chromosome starts when all are laid end to end, ``gap`` apart.

    One row per chromosome, so the ordering window over all of them is small.
    """
    last = calls.where("chrom is not null").groupBy("chrom").agg(F.max("pos").alias("last")).withColumn("order", v.chrom_order(F.col("chrom")))
    before = W.orderBy("order", "chrom").rowsBetween(W.unboundedPreceding, -1)
    return last.select("chrom", F.coalesce(F.sum(F.coalesce("last", F.lit(0)) + gap).over(before), F.lit(0)).alias("offset"))


def with_genome_position(calls: DataFrame, gap: int = 20_000_000) -> DataFrame:
    """``calls`` with ``gpos``, the position on the running coordinate; null chromosomes keep their position."""
    return calls.join(genome_offsets(calls, gap), "chrom", "left").withColumn("gpos", F.col("pos") + F.coalesce("offset", F.lit(0))).drop("offset")


def depth_trend(calls: DataFrame, depth: str, bins: int = 300) -> DataFrame:
    """``bin``, mean ``gpos`` and mean depth of equal-width bins of ``gpos``, each closed at its right end.

    Calls without a depth or position are left out; where all positions are equal there is one bin.
    """
    rows = calls.where(F.col("gpos").isNotNull() & F.col(depth).isNotNull())
    # summed by position first: its shuffle serves the ends and the bins, so the calls are read once
    at = rows.groupBy("gpos").agg(F.sum(F.col(depth).cast("double")).alias("depth"), F.count("*").alias("n"))
    ends = at.agg(F.min("gpos").alias("low"), F.max("gpos").alias("high"))  # one row
    width = F.greatest(F.col("high") - F.col("low"), F.lit(1))
    place = F.greatest(F.ceil((F.col("gpos") - F.col("low")) * bins / width) - 1, F.lit(0)).cast("int")
    mean = lambda c: F.sum(c) / F.sum("n")
    return at.crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(mean(F.col("gpos") * F.col("n").cast("double")).alias("mean_gpos"), mean("depth").alias("mean_depth"))


def cluster_of(calls: DataFrame, clusters: DataFrame) -> DataFrame:
    """``calls`` with ``cluster_id`` of the first cluster (by start, end, id) whose closed interval holds them, else null.

    ``clusters`` has ``patient``, ``chrom``, ``start``, ``end``, ``cluster_id``; ``calls`` has a unique ``rid``.
    """
    spans = clusters.select("patient", "chrom", "start", "end", (F.col("end") + 1).alias("stop"), "cluster_id").where("start <= end")
    hits = in_intervals(calls.select("rid", "patient", "chrom", "pos"), spans, ["patient", "chrom"], "pos", "start", "stop", 1000)
    first = hits.groupBy("rid").agg(F.min(F.struct("start", "end", "cluster_id")).alias("c")).select("rid", F.col("c.cluster_id").alias("cluster_id"))
    return calls.drop("cluster_id").join(first, "rid", "left")


def log_density(bins: DataFrame, value: str) -> DataFrame:
    """``bins`` with ``density``: log1p of the value (at least 0), as a share of the chromosome's greatest; 0 if that is 0. Null counts as 0."""
    x = F.log1p(F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0)))
    top = F.max(x).over(W.partitionBy("chrom"))
    return bins.withColumn("density", F.when(top > 0, x / top).otherwise(0.0))


#: What a directed pair of sources is counted by.
COUNTERS = ("hom_any", "het_same", "het_cis")


def same_copy_counts(calls: DataFrame, distance: int = 33) -> DataFrame:
    """Per patient and directed pair of sources: ``hom_any``, ``het_same`` and ``het_cis``, the calls of the first with those flags (see ``first_same_copy``).

    Of the edits only those at known sites (``known_db``) take part. One pass serves all six pairs; rids are unique within a source.
    """
    known = calls.where(F.col("source_set").isin(*SOURCES) & ((F.col("source_set") != "RNA_EDIT") | v.known_site(F.col("known_db")))).select("patient", "chrom", "pos", "gt", "ps", "rid", F.col("source_set").alias("a"))
    flags = same_copy_flags(known, v.has_alt(F.col("gt")), {s: F.col("a") == s for s in SOURCES}, distance)
    others = F.array(*(F.struct(F.lit(s).alias("b"), F.col("__flags")[s].alias("f")) for s in SOURCES))
    each = flags.select("patient", "a", F.explode(others).alias("x")).where("a <> x.b and x.f is not null")
    return each.groupBy("patient", "a", F.col("x.b").alias("b")).agg(*(F.count_if(F.col("x.f")[c]).alias(c) for c in COUNTERS))


def input_totals(germline: DataFrame, somatic: DataFrame, rna: DataFrame) -> DataFrame:
    """What each patient's three inputs hold; patients that lack one are left out. With ``allowed`` (see ``records.has_allowed``), somatic calls and edits are those allowed."""
    n = lambda df: F.count_if("allowed") if "allowed" in df.columns else F.count("*")
    out = germline.groupBy("patient").agg(F.count("*").alias("germline_selected_total"))
    out = out.join(somatic.groupBy("patient").agg(n(somatic).alias("somatic_filtered_total")), "patient")
    return out.join(rna.groupBy("patient").agg(n(rna).alias("rna_filtered_total"), F.count("*").alias("rna_filtered_total_with_noncoding")), "patient")


#: Column names of the report: its sources, and the counters of a pair in the order of ``COUNTERS`` (fixed values).
SHORT = {"GERMLINE": "germline", "SOMATIC": "somatic", "RNA_EDIT": "rna"}
PAIR_COLUMNS = ("{a}_hom_adj_{b}_any", "{a}_het_samecopy_with_{b}", "{a}_het_samecopy_with_{b}_phasedcis")


def same_copy_report(totals: DataFrame, counters: DataFrame, counts: DataFrame) -> DataFrame:
    """43 columns for each patient of ``totals`` and ``counters``: both tables' columns, and three for each directed pair of sources, 0 without a neighbour."""
    return _with_pairs(totals.join(counters, "patient"), counts)


def pair_columns() -> dict[str, Column]:
    """Name and value of each column of the report that speaks of a directed pair."""
    return {
        name.format(a=SHORT[a], b=SHORT[b]): F.sum(F.when((F.col("a") == a) & (F.col("b") == b), F.col(c)))
        for a in SOURCES for b in SOURCES if a != b for c, name in zip(COUNTERS, PAIR_COLUMNS)
    }


def _with_pairs(sums: DataFrame, counts: DataFrame) -> DataFrame:
    wide = counts.groupBy("patient").agg(*(F.coalesce(c, F.lit(0)).alias(n) for n, c in pair_columns().items()))
    return sums.join(wide, "patient", "left").fillna(0, wide.columns[1:])


def report_of(calls: DataFrame) -> DataFrame:
    """``same_copy_report`` of one table of calls with ``source_set`` and ``allowed``: totals and counters come from one aggregate over it.

    Patients that lack one of the three sources are left out. Only germline calls and allowed others are neighbours.
    """
    mine = {s: F.coalesce(F.col("source_set") == s, F.lit(False)) for s in SOURCES}
    ok = F.coalesce(F.col("allowed"), F.lit(False))
    inputs = {"germline_selected_total": mine["GERMLINE"], "somatic_filtered_total": mine["SOMATIC"] & ok, "rna_filtered_total": mine["RNA_EDIT"] & ok, "rna_filtered_total_with_noncoding": mine["RNA_EDIT"]}
    present = F.count_if(mine["SOMATIC"]).alias("__somatic")
    sums = calls.groupBy("patient").agg(present, *(F.count_if(c).alias(n) for n, c in inputs.items()), *source_counter_columns(True))
    sums = sums.where("germline_selected_total > 0 and __somatic > 0 and rna_filtered_total_with_noncoding > 0").drop("__somatic")
    return _with_pairs(sums, same_copy_counts(calls.where(mine["GERMLINE"] | ok)))
