"""Hand-written cases of the landscape and small-input operators."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators import landscape
from helixframe.sources import lists


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_offsets_follow_chromosome_order(spark):
    df = spark.createDataFrame([("chr10", 5), ("chr2", 7), ("chr2", 3), ("chrX", 1), (None, 4)], "chrom string, pos bigint")
    assert rows(landscape.with_genome_position(df, gap=100), "chrom", "gpos") == [("chr10", 112), ("chr2", 3), ("chr2", 7), ("chrX", 213), (None, 4)]
    assert landscape.genome_offsets(df.limit(0)).count() == 0


def test_trend_bins_close_at_the_right(spark):
    df = spark.createDataFrame([(0, 1.0), (10, 3.0), (11, 5.0), (20, 7.0), (5, None), (None, 2.0)], "gpos bigint, dp double")
    assert rows(landscape.depth_trend(df, "dp", bins=2), "bin", "mean_gpos", "mean_depth") == [(0, 5.0, 2.0), (1, 15.5, 6.0)]
    assert rows(landscape.depth_trend(df.where("gpos = 10"), "dp"), "bin", "mean_depth") == [(0, 3.0)]
    assert landscape.depth_trend(df.limit(0), "dp").count() == 0


def test_first_cluster_holds_a_call(spark):
    calls = spark.createDataFrame([("a", "P", "1", 5), ("b", "P", "1", 9), ("c", "P", "1", 10), ("d", "Q", "1", 5), ("e", None, "1", 5)], "rid string, patient string, chrom string, pos bigint")
    spans = spark.createDataFrame([("P", "1", 5, 9, "y"), ("P", "1", 3, 8, "x"), ("P", "1", 20, 10, "bad")], "patient string, chrom string, start bigint, end bigint, cluster_id string")
    assert rows(landscape.cluster_of(calls, spans), "rid", "cluster_id") == [("a", "x"), ("b", "y"), ("c", None), ("d", None), ("e", None)]


def test_density_is_zero_without_depth(spark):
    df = spark.createDataFrame([("1", 0.0), ("1", -3.0), ("2", 1.0), ("2", None), ("2", 3.0)], "chrom string, x double")
    assert rows(landscape.log_density(df, "x"), "chrom", "x", "density") == [("1", -3.0, 0.0), ("1", 0.0, 0.0), ("2", 1.0, 0.5), ("2", 3.0, 1.0), ("2", None, 0.0)]


def test_typing_text(spark):
    lines = [("P", 2, "HLA-A*01:02 x HLA-B*07:08 HLA-C:01:02 HLA-A:3:4"), ("P", 1, "HLA-C:01:02 HLA-A:01:02:03"), ("P", 3, None), ("Q", 1, "none")]
    got = lists.typing_alleles(spark.createDataFrame(lines, "patient string, line_no int, line string"))
    # line 1 has two triples; line 2 adds a starred allele and, after it, another triple
    assert rows(got, "patient", "alleles") == [("P", "HLA-C:01:02,HLA-A:01:02,HLA-B:07:08,HLA-A:3:4"), ("Q", "")]


def test_manifest(spark):
    made = lists.manifest(spark.createDataFrame([("P=a.vcf",), ("Q=b.vcf=c=d.bam",), (None,)], "item string"))
    assert rows(made, "patient", "path", "reads") == [("P", "a.vcf", None), ("Q", "b.vcf", "c=d.bam")]
    assert rows(lists.skipped_patients(made, made.where("patient = 'P'")), "patient") == [("Q",)]
    with pytest.raises(Exception, match="not PATIENT=PATH"):
        lists.manifest(spark.createDataFrame([("nothing",)], "item string")).collect()
    pairs = spark.createDataFrame([("k", "b", 2), ("k", "a", 1), (None, "z", 0)], "key string, value string, line_no int")
    assert rows(lists.first_values(pairs), "key", "value") == [("k", "a")]
