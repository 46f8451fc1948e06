"""Germline branch: filter labels, dense calls, proximity to tumour sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranges import near_any, near_pairs


def filter_labels(calls: DataFrame, min_dp: int = 10, min_qd: float = 2.0, cluster: int = 3, window: int = 15) -> DataFrame:
    """``filter``: names of failed checks joined by ``;``, or PASS. Null values fail nothing.

    A call is in a dense cluster if ``cluster`` calls of its patient and chromosome, itself
    one of them, lie within ``window`` bases.
    """
    w = W.partitionBy("patient", "chrom").orderBy("pos", "rid")
    spans = []
    for before in range(cluster):
        first = F.lag("pos", before).over(w) if before else F.col("pos")
        after = cluster - 1 - before
        last = F.lead("pos", after).over(w) if after else F.col("pos")
        spans.append(F.coalesce(last - first < window, F.lit(False)))
    dense = spans[0]
    for s in spans[1:]:
        dense = dense | s
    names = F.array(F.when(F.col("dp") < min_dp, "LowDepth"), F.when(F.col("qd") < min_qd, "LowQualityByDepth"), F.when(dense, "SnpCluster"))
    return calls.withColumn("filter", F.coalesce(F.nullif(F.array_join(F.filter(names, lambda x: x.isNotNull()), ";"), F.lit("")), F.lit("PASS")))


def near_tumour(germline: DataFrame, *tumour: DataFrame, distance: int = 33) -> DataFrame:
    """Germline calls within ``distance`` bases of a call of any of the tumour tables."""
    sites = tumour[0].select("patient", "chrom", "pos")
    for t in tumour[1:]:
        sites = sites.unionByName(t.select("patient", "chrom", "pos"))
    return near_any(germline, sites, ["patient", "chrom"], distance)


def near_phased(germline: DataFrame, somatic: DataFrame, distance: int = 33) -> DataFrame:
    """Germline calls near a somatic one that are homozygous, or phased alike in one block (null blocks match nothing)."""
    other = somatic.select("patient", "chrom", F.col("pos").alias("b_pos"), F.col("gt").alias("b_gt"), F.col("ps").alias("b_ps"))
    phased = (F.instr("gt", "|") > 0) & (F.col("gt") == F.col("b_gt")) & (F.col("ps") == F.col("b_ps"))
    hits = near_pairs(germline, other, ["patient", "chrom"], distance).where(F.col("gt").isin("1/1", "1|1") | phased)
    return germline.join(hits.select("rid").distinct(), "rid", "left_semi")


def with_somatic(calls: DataFrame, distance: int = 33) -> DataFrame:
    """All somatic calls and the germline ones of ``near_phased``; calls of other sources (``source_set``) go. Each patient stands for itself."""
    somatic = calls.where("source_set = 'SOMATIC'")
    return somatic.unionByName(near_phased(calls.where("source_set = 'GERMLINE'"), somatic, distance))
