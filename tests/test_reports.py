"""Hand-written cases of counters, reports, joint allele counts and the choice of a stage."""

import pytest

from helixframe.operators import alternates, annotate, clusters, landscape, merge, records


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


CALLS = "patient string, chrom string, pos bigint, alt string, source_set string, gt string, ps bigint, edit_sig string, known_db string, rid string"


@pytest.fixture(scope="module")
def calls(spark):
    return spark.createDataFrame(
        [
            ("P", "chr1", 10, "A", "GERMLINE,SOMATIC", "0|1", 1, None, None, "a"),
            ("P", "chr1", 12, "G", "RNA_EDIT", "0|1", 1, "ADAR|APOBEC3", "x", "b"),
            ("P", "chr1", 14, "G", "RNA_EDIT", "./.", None, "adar", ".", "c"),
            ("P", "chr1", 15, "C,T", "SOMATIC", "1/1", None, None, None, "d"),
            ("P", "chr1", 16, "C", None, None, None, None, None, "e"),
            ("P", "chr1", 17, "C", "SOMATIC", "1", None, None, None, "f"),
        ],
        CALLS,
    )


def test_twenty_counters(calls):
    r = clusters.source_counters(calls).first().asDict()
    assert len(r) == 21
    got = {k.removeprefix("merged_"): n for k, n in r.items() if k != "patient" and n}
    assert got == {
        "total": 6, "other_total": 1, "germline_total": 1, "germline_gt_phased": 1, "germline_het_alt": 1, "somatic_total": 2, "somatic_gt_unphased": 1, "somatic_hom_alt": 1,
        "rna_edit_total": 2, "rna_edit_gt_phased": 1, "rna_edit_gt_unphased": 1, "rna_edit_het_alt": 1, "rna_edit_adar_total": 2, "rna_edit_apobec3_total": 1, "rna_edit_known_db_total": 1,
    }
    assert clusters.source_counters(calls.limit(0)).count() == 0


def test_calls_that_are_not_allowed_count_in_the_total_only(spark, calls):
    allowed = spark.createDataFrame([("P", "1", 15, "T"), ("P", "1", 15, "T"), ("P", "1", 12, "A"), (None, "1", 14, "G")], "patient string, chrom string, pos bigint, alt string")
    marked = records.has_allowed(calls, allowed)
    assert rows(marked.where("allowed"), "rid") == [("d",)] and marked.count() == 6
    r = clusters.source_counters(marked).first()
    assert (r.merged_total, r.merged_germline_total, r.merged_somatic_total, r.merged_rna_edit_total) == (6, 1, 1, 0)


def test_report_has_43_columns_and_leaves_out_patients_without_an_input(spark, calls):
    more = calls.unionByName(calls.where("rid = 'b'").selectExpr("'Q' AS patient", *(f for f in calls.columns if f != "patient")))
    one = more.where("rid in ('a', 'b', 'c', 'd')").replace("GERMLINE,SOMATIC", "GERMLINE", "source_set")
    of = lambda s: one.where(f"source_set = '{s}'")
    out = landscape.same_copy_report(landscape.input_totals(of("GERMLINE"), of("SOMATIC"), of("RNA_EDIT")), clusters.source_counters(one), landscape.same_copy_counts(one))
    assert len(out.columns) == len(set(out.columns)) == 43
    (r,) = out.collect()
    assert r.patient == "P" and (r.germline_selected_total, r.somatic_filtered_total, r.rna_filtered_total, r.rna_filtered_total_with_noncoding) == (1, 1, 2, 2)
    # the edit without a known site takes no part
    assert (r.germline_het_samecopy_with_rna, r.germline_het_samecopy_with_rna_phasedcis, r.rna_hom_adj_germline_any) == (1, 1, 0)
    assert (r.somatic_hom_adj_rna_any, r.somatic_hom_adj_germline_any, r.germline_het_samecopy_with_somatic, r.germline_het_samecopy_with_somatic_phasedcis) == (1, 1, 1, 0)


def test_joint_allele_counts(spark):
    df = spark.createDataFrame([(1, "C,T", "0/1", "2|2"), (2, "C", None, "./."), (3, "C,T", "1", "./2")], "rid int, alts string, x string, y string")
    got = rows(merge.joint_allele_counts(df, ["x", "y"]), "rid", "alt", "an", "ac", "af")
    assert got[:2] == [(1, "C", 4, 1, 0.25), (1, "T", 4, 2, 0.5)] and got[2] == (2, "C", 0, 0, None)
    assert [g[:2] for g in got[3:]] == [(3, "C"), (3, "T")]


def test_modes_of_the_stage_choice(spark):
    patients = spark.createDataFrame([("P",), ("Q",), ("Q",)], "patient string")
    made = spark.createDataFrame([("P", "b", "pb"), ("P", "a", None)], "patient string, stage string, path string")
    pick = lambda mode: rows(alternates.proximity_source(patients, made, ["a", "b"], mode), "patient", "stage", "status")
    assert pick("AUTO") == [("P", "b", "USED"), ("Q", None, "NONE_FOUND")]
    assert pick("yes")[1] == ("Q", None, "REQUESTED_NOT_FOUND")
    assert pick("0") == [("P", None, "DISABLED"), ("Q", None, "DISABLED")]
    with pytest.raises(ValueError, match="mode"):
        pick("maybe")


def test_dedup_counts_and_metrics(spark):
    cols = "patient string, uploaded string, location string, alt string, feature string, feature_type string, consequence string, protein_position string, amino_acids string, extra string, rid string, t int, source_set string, known_db string, tier string"
    one = lambda p, u, f, kind, s, db, tier: (p, u, "1:5", "A", f, "Transcript", kind, "-", "-", "", f"r{u}", 0, s, db, tier)
    data = [one("P", "u", "t1", "missense_variant", "SOMATIC", "x", "full"), one("P", "u", "t2", "synonymous_variant", "SOMATIC", "x", "full"), one("Q", "v", "t1", "missense_variant", None, ".", "none")]
    ranked = annotate.ranked_transcripts(spark.createDataFrame(data, cols))
    got = rows(annotate.dedup_counts(ranked).where("patient is null"), "stage", "source_set", "primary_consequence", "known_db_hit", "count")
    assert got == [
        ("dedup_kept_rows", "NA", "missense_variant", "0", 1), ("dedup_kept_rows", "SOMATIC", "missense_variant", "1", 1), ("filtered_transcript_rows", "SOMATIC", "synonymous_variant", "1", 1),
        ("raw_rows", "NA", "missense_variant", "0", 1), ("raw_rows", "SOMATIC", "missense_variant", "1", 1), ("raw_rows", "SOMATIC", "synonymous_variant", "1", 1),
    ]
    assert tuple(annotate.cohort_metrics(annotate.dedup_metrics(ranked)).first()) == (2, 3, 2, 1, 2, 1, 1)
    assert annotate.dedup_counts(ranked.limit(0)).count() == 0


def test_top_names_of_a_cluster(spark):
    df = spark.createDataFrame(
        [("P", "1", "c", 1, "ADAR", 2.0, "1", "", None, "a"), ("P", "1", "c", 2, "ADAR", None, "1", "g", "", "b"), ("P", "1", "d", 1, "OTHER", 10.0, "1", None, "t2", "x"), ("P", "1", "d", 2, "APOBEC3", 11.0, "2", None, "t1", "y"), ("P", "1", "d", 3, "ADAR", 11.0, "2", None, "t1", "z"),
         ("P", "2", "e", 3, None, None, ".", "g2", None, "z"), ("P", "2", "e", 4, "ADAR", None, None, "g1", None, "z")],
        "patient string, chrom string, cluster_id string, pos bigint, signature string, dp double, ps string, gene string, transcript string, rid string",
    )
    names = ("cluster_id", "start", "end", "n_variants", "adar_count", "apobec_count", "other_count", "mean_rna_dp", "single_ps_block", "top_gene", "top_transcript")
    assert rows(clusters.cluster_summary(df), *names) == [("c", 1, 2, 2, 2, 0, 0, 2.0, 1, "g", ""), ("d", 1, 3, 3, 1, 1, 1, 10.667, 0, "", "t1"), ("e", 3, 4, 2, 1, 0, 0, 0.0, 0, "g2", "")]
    assert clusters.cluster_summary(df.limit(0)).count() == 0


def test_a_full_match_without_a_value_takes_none_from_the_other_tier(spark):
    key = "patient string, chrom string, pos bigint, ref string, alt string"
    at = spark.createDataFrame([("P", "1", 5, "A", "G")], key)
    found = spark.createDataFrame([("P", "1", 5, "A", "G", "a", None), ("P", "1", 5, "T", "G", "b", "x")], f"{key}, rid string, db string")
    assert rows(annotate.two_tier(at, found, ["db"]), "tier", "db") == [("full", None)]
