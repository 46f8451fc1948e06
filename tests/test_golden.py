"""Hand-written cases, one per branch of a rule."""

import random

from pyspark.sql import functions as F

from helixframe.functions import variant as v
from helixframe.operators import alternates, annotate, clusters, germline, merge, ranges, records, rna_edit, strand
from helixframe.sources import sequence


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_signature(spark):
    rows = [("A", "G"), ("T", "C"), ("C", "T"), ("G", "A"), ("A", "C"), ("AT", "A"), ("A", "G,T"), ("a", "g")]
    got = values(spark, rows, "ref string, alt string", v.signature(F.col("ref"), F.col("alt")), v.is_snv(F.col("ref"), F.col("alt")))
    assert got == [("ADAR", True), ("ADAR", True), ("APOBEC3", True), ("APOBEC3", True), ("OTHER", True), ("OTHER", False), ("ADAR", True), ("OTHER", True)]


def test_lists(spark):
    got = values(spark, [("3,4",), (".",), ("1,x",), (None,)], "s string", v.int_list(F.col("s")))
    assert got == [([3, 4],), (None,), (None,), (None,)]
    lanes = [([[1, 2], [3, 4]],), ([[1, 2], [3], [5, 6]],), ([None, [1, 1]],), ([],)]
    assert values(spark, lanes, "l array<array<int>>", v.add_lists(F.col("l"))) == [([4, 6],), ([5, 6],), ([1, 1],), (None,)]


def test_info_and_format(spark):
    got = values(spark, [("A=1;FLAG;B=x=y;A=2",), (".",), (None,), (";".join(f"K{i % 500}={i}" for i in range(3000)),)], "s string", v.info_map(F.col("s")))
    assert got[:3] == [({"FLAG": "1", "B": "x=y", "A": "2"},), ({},), (None,)] and got[3][0] == {f"K{i}": str(2500 + i) for i in range(500)}
    assert values(spark, [("GT:AD:DP", "0/1:3,4")], "k string, s string", v.format_map(F.col("k"), F.col("s"))) == [({"GT": "0/1", "AD": "3,4"},)]


def test_genotypes(spark):
    rows = [("1/1",), ("0|1",), ("1|2",), (".|1",), ("./.",), ("0/0",), (None,), ("1",)]
    got = values(spark, rows, "g string", v.hom_alt(F.col("g")), v.has_alt(F.col("g")), v.alt_sides(F.col("g")))
    assert got == [(True, True, []), (False, True, [2]), (False, True, [1, 2]), (False, True, [2]), (False, False, []), (False, False, []), (False, False, None) if got[6][2] is None else (False, False, []), (False, False, [])]


def test_labels(spark):
    got = values(spark, [("P1_DNA_TUMOR",), ("P1_DNA_TUMOUR.0001",), ("dna_tumour",), ("P1_NORMAL",)], "s string", v.label_tier(F.col("s"), "DNA_TUMOR"), v.patient_name(F.col("s"), ["DNA_TUMOR"]))
    assert got == [(1, "P1"), (2, "P1_DNA_TUMOUR.0001"), (0, "dna_tumour"), (None, "P1_NORMAL")]


def test_uploaded_and_numbers(spark):
    got = values(spark, [("chr1_KI2_v1_77_A/G",), ("nonsense",)], "u string", v.uploaded_parts(F.col("u"))["pos"], v.uploaded_parts(F.col("u"))["chrom"])
    assert got == [(77, "1_KI2_v1"), (None, None)]
    assert values(spark, [(2.0,), (0.25,), (None,), (100.0,)], "x double", v.number_text(F.col("x"))) == [("2",), ("0.25",), ("NA",), ("100",)]


def test_qc_boundaries(spark):
    rows = [([10, 0], [10, 3]), ([9, 0], [10, 3]), ([10, 2], [10, 3]), ([19, 1], [10, 3]), ([20, 1], [58, 3]), ([20, 0], [9, 0]), ([5], [9, 9]), ([0, 0], [9, 9]), ([20, 0], [20, 2]), ([20, 0], [57, 3])]
    got = [r.drop_reason for r in rna_edit.paired_qc(spark.createDataFrame(rows, "normal_ad array<int>, rna_ad array<int>")).collect()]
    assert got == [None, "NORMAL_DP", "NORMAL_ALT", "NORMAL_VAF", "RNA_VAF", "RNA_DP", "MISSING", "MISSING", "RNA_ALT", None]


def test_near_joins_equal_nested_loops(spark):
    rnd = random.Random(3)
    a = [(f"P{rnd.randrange(2)}", "chr1", rnd.randrange(900), i) for i in range(300)]
    b = [(f"P{rnd.randrange(2)}", "chr1", rnd.randrange(900), i) for i in range(40)]
    da, db = (spark.createDataFrame(x, "patient string, chrom string, pos bigint, n int") for x in (a, b))
    got = sorted(r.n for r in ranges.near_any(da, db, ["patient", "chrom"], 7).collect())
    assert got == sorted(n for p, c, x, n in a if any(p == q and abs(x - y) <= 7 for q, _, y, _ in b))
    iv = [("1", s := rnd.randrange(900), s + rnd.randrange(1, 60)) for _ in range(40)]
    di = spark.createDataFrame(iv, "k string, s bigint, e bigint")
    pts = spark.createDataFrame([("1", x, n) for _, _, x, n in a], "k string, p bigint, n int")
    got = sorted((r.n, r.s, r.e) for r in ranges.in_intervals(pts, di, ["k"], "p", "s", "e", 50).collect())
    assert got == sorted((n, s, e) for _, _, x, n in a for _, s, e in iv if s <= x < e)


def test_dense_calls(spark):
    rows = [("P", "1", p, f"{p:05d}", 30, 9.0) for p in (100, 107, 114, 129, 300)] + [("P", "1", 400, "x", 5, None)]
    got = {r.pos: r["filter"] for r in germline.filter_labels(spark.createDataFrame(rows, "patient string, chrom string, pos bigint, rid string, dp int, qd double")).collect()}
    assert got == {100: "SnpCluster", 107: "SnpCluster", 114: "SnpCluster", 129: "PASS", 300: "PASS", 400: "LowDepth"}


def test_composition_ladder(spark):
    """Every step for edits and others, by the names of the columns that a row has."""
    names = ("gt_dna", "gt_rna", "gt_dna_merged", "gt_rna_merged", "gt_normal", "gt_normal_merged")
    # (is_edit, columns that hold a genotype) -> the one that wins
    cases = [
        (True, names, "gt_rna", "rna"), (True, ("gt_dna", "gt_rna_merged"), "gt_dna", "dna"), (True, ("gt_dna_merged", "gt_rna_merged", "gt_normal"), "gt_rna_merged", "backup"), (True, ("gt_dna_merged", "gt_normal"), "gt_dna_merged", "backup"),
        (False, names, "gt_dna", "dna"), (False, ("gt_rna", "gt_dna_merged"), "gt_rna", "rna"), (False, ("gt_dna_merged", "gt_rna_merged"), "gt_dna_merged", "backup"), (False, ("gt_rna_merged", "gt_normal"), "gt_rna_merged", "backup"),
        (False, ("gt_normal", "gt_normal_merged"), "gt_normal", "normal"), (True, ("gt_normal_merged",), "gt_normal_merged", "normal"), (True, (), None, "hom_ref"),
    ]
    value = {n: f"0/{i + 1}" for i, n in enumerate(names)}
    rows = [(e, *(value[n] if n in have else ("./.", ".", "", None)[i % 4] for i, n in enumerate(names))) for e, have, _, _ in cases]
    df = spark.createDataFrame(rows, "is_edit boolean, " + ", ".join(f"{n} string" for n in names))
    got = [(r.tumour_gt, r.tumour_from) for r in merge.compose(df).collect()]
    assert got == [(value.get(win, "0/0"), step) for _, _, win, step in cases]
    got = [(r.tumour_gt, r.normal_gt) for r in merge.compose(df, dna_only=True).collect()]
    assert got[0] == (value["gt_dna"], value["gt_normal"]) and got[2] == (value["gt_dna_merged"], value["gt_normal"]) and got[7] == (value["gt_normal"], value["gt_normal"]) and got[10] == ("0/0", "0/0")


def test_clusters_chain_at_distance(spark):
    rows = [("P", "1", p, f"{i}") for i, p in enumerate((10, 43, 77, 77, 200))]
    got = sorted((r.pos, r.cluster_id) for r in clusters.clusters(spark.createDataFrame(rows, "patient string, chrom string, pos bigint, rid string")).collect())
    assert got == [(10, "CL000001"), (43, "CL000001"), (77, "CL000002"), (77, "CL000002")]


def test_clusters_are_numbered_in_reading_order(spark):
    """Patients as their files are read, chromosomes as they come first in a file, then positions; chromosomes without clusters take no number."""
    at = {"Q": [("X", 5), ("2", 9), ("2", 12), ("2", 90), ("2", 91), ("10", 1), ("10", 3)], "A": [("1", 1), ("7", 4), ("7", 5), ("1", 2)], "B": [("1", 3)], "C": [("1", 8), ("1", 9), ("1", 10)]}
    rows = [(p, c, pos, f"{i:02d}{j:02d}") for i, (p, calls) in enumerate(at.items()) for j, (c, pos) in enumerate(calls)]
    df = spark.createDataFrame(rows, "patient string, chrom string, pos bigint, rid string").repartition(5)
    got = {(r.patient, r.chrom, r.pos): r.cluster_id for r in clusters.clusters(df).collect()}
    want = {("Q", "2", 9): 1, ("Q", "2", 12): 1, ("Q", "2", 90): 2, ("Q", "2", 91): 2, ("Q", "10", 1): 3, ("Q", "10", 3): 3, ("A", "1", 1): 4, ("A", "1", 2): 4, ("A", "7", 4): 5, ("A", "7", 5): 5, ("C", "1", 8): 6, ("C", "1", 9): 6, ("C", "1", 10): 6}
    assert got == {k: f"CL{n:06d}" for k, n in want.items()} and clusters.clusters(df.limit(0)).count() == 0


def test_merge_of_unequal_references(spark):
    """An SNV and a deletion, an insertion, phased calls of one block, a symbolic alternate, calls without genotype."""
    calls = [
        ("P", "1", 5, "A", "G", "SOMATIC", "0/1", 1, "a"), ("P", "1", 5, "AT", "A", "RNA_EDIT", "0|1", 1, "b"),
        ("P", "1", 6, "A", "G", "SOMATIC", "0|1", 1, "c"), ("P", "1", 6, "A", "T", "SOMATIC", "1|0", 1, "d"), ("P", "1", 7, "A", "G", "SOMATIC", "0|1", 1, "e"), ("P", "1", 7, "A", "T", "SOMATIC", "1|0", 2, "f"),
        ("P", "1", 8, "AC", "GC", "GERMLINE", "1/1", None, "g"), ("P", "1", 8, "A", "G", "RNA_EDIT", "0/1", None, "h"), ("P", "1", 8, "A", "<DEL>", "RNA_EDIT", None, None, "i"), ("P", "1", 9, "C", ".", "GERMLINE", "0/0", None, "j"),
        ("P", "1", 10, "A", "G", "SOMATIC", "0/1", None, "k"), ("P", "1", 10, "A", "T", "SOMATIC", "0/1", None, "l"), ("P", "1", 10, "A", "C", "SOMATIC", "./.", None, "m"),
    ]
    df = spark.createDataFrame(calls, "patient string, chrom string, pos bigint, ref string, alt string, source_set string, gt string, ps bigint, rid string").repartition(3)
    got = {r.pos: (r.ref, r.alts, r.gt_germline, r.gt_somatic, r.gt_rna_edit) for r in merge.merge_sources(df).collect()}
    assert got == {
        5: ("AT", "GT,A", "./.", "0/1", "0|2"), 6: ("A", "G,T", "./.", "2|1", "./."), 7: ("A", "G,T", "./.", "1/2", "./."), 8: ("AC", "GC,<DEL>", "1/1", "./.", "0/1"),
        9: ("C", "", "0/0", "./.", "./."), 10: ("A", "G,T,C", "./.", "1/2", "./."),
    }
    assert merge.merge_sources(df.limit(0)).count() == 0


def test_counts_without_called_alleles_and_of_backups(spark):
    df = spark.createDataFrame([("a", "./."), ("a", None), ("b", "0|1"), ("b", "."), ("b", "1/2/0")], "k string, gt string")
    assert sorted(tuple(r) for r in merge.allele_counts(df, ["k"]).collect()) == [("a", 0, 0, None), ("b", 5, 3, 0.6)]
    steps = [("dna", False), ("rna", True), ("backup", True), ("normal", True), ("normal", False), ("hom_ref", True), ("hom_ref", False), ("normal", None)]
    composed = spark.createDataFrame([("P", *s) for s in steps], "patient string, tumour_from string, is_edit boolean")
    assert tuple(merge.compose_counts(composed).first()) == ("P", 1, 1, 3)


def test_germline_with_somatic(spark):
    rows = [("P", "1", 100, "1|1", 1, "GERMLINE", "a"), ("P", "1", 110, "0|1", 1, "SOMATIC", "b"), ("P", "1", 120, "0|1", 1, "GERMLINE", "c"), ("P", "1", 120, "0|1", 2, "GERMLINE", "d"), ("P", "1", 121, "1/1", None, "GERMLINE", "e"), ("P", "1", 900, "1/1", 1, "GERMLINE", "f"), ("P", "1", 99, "0/1", 1, "RNA_EDIT", "g"), ("Q", "1", 100, "1/1", 1, "GERMLINE", "h")]
    df = spark.createDataFrame(rows, "patient string, chrom string, pos bigint, gt string, ps bigint, source_set string, rid string")
    assert sorted(r.rid for r in germline.with_somatic(df).collect()) == ["a", "b", "c", "e"]


def test_source_class_numbers_and_samples(spark):
    got = values(spark, [("GERMLINE, GERMLINE",), ("SOMATIC",), ("RNA_EDIT,",), ("GERMLINE,SOMATIC",), (" other ",), ("",), (None,)], "s string", v.source_exact(F.col("s")))
    assert [g for g, in got] == ["GERMLINE", "SOMATIC", "RNA_EDIT", "GERMLINE,SOMATIC", "other", "NA", "NA"]
    assert values(spark, [(None,), (0.5,)], "x double", v.number_text(F.col("x"), missing=".")) == [(".",), ("0.5",)]
    maps = "a map<string,string>, b map<string,string>"
    got = values(spark, [({"GT": "./."}, {"GT": "0/1"}), ({"GT": "0/1"}, {"GT": "1/1"}), ({"GT": "."}, {"GT": "./."}), (None, {"GT": "0/1"}), ({"GT": "."}, None)], maps, records.signal_sample(F.col("a"), F.col("b"), F.lit("rna"), F.lit("dna"))["sample"])
    assert [g for g, in got] == ["dna", "rna", "rna", "dna", "rna"]
    kinds = spark.createDataFrame([("GT:AD:S:PS", "0/1:3:GERMLINE:9", "X=1;AF=0.5"), ("GT:S:PS", "0/1:SOMATIC:.", "AF=0.1"), ("GT:S:PS", "0/1:OTHER:.", "AF=0.1"), ("GT", "0/1", "AF=1")], "format string, sample string, i string")
    got = records.af_to_format(kinds.withColumn("info", v.info_map(F.col("i")))).select("format", "sample").collect()
    assert [tuple(r) for r in got] == [("GT:AD:AF:S:PS", "0/1:3:0.5:GERMLINE:9"), ("GT:S:PS", "0/1:SOMATIC:.")]
    ref = spark.createDataFrame([("G,T", "3,4,5", None, None, None), ("G", ".,1", "7,2", None, None), ("G", None, None, None, None)], "alts string, ad string, fad string, dp string, af string")
    assert [r.ref_count for r in alternates.per_alternate(ref).collect()] == [3.0, 3.0, 7.0, None]


def test_read_blocks_and_strand(spark):
    reads = spark.createDataFrame([("P", "1", 100, 99, 60, "5S10M2I3D4N5M", "A" * 22, 30)], "patient string, contig string, pos0 bigint, flag int, mapq int, cigar string, seq string, qual int")
    assert [(r.block_start, r.block_end, r.q0) for r in strand.aligned_blocks(reads).collect()] == [(100, 110, 5), (117, 122, 17)]
    flags = [(0, "-"), (16, "+"), (99, "-"), (147, "-"), (83, "+"), (163, "+")]
    assert values(spark, flags, "f int, s string", v.transcript_strand_of_read(F.col("f"), "fr-firststrand") == F.col("s")) == [(True,)] * 6


def test_chunks_of_sequences_and_pieces(spark):
    rnd = random.Random(9)
    pieces = [(f"chr{rnd.randrange(3)}", f"{i:05d}", "".join(rnd.choice("ACGT") for _ in range(rnd.choice([0, 1, 1, 1, 7, 30])))) for i in range(200)] + [("chr1", None, "AC"), (None, "3", "G"), ("chr2", "4", None)]
    whole = {}
    for c, _, s in sorted((p for p in pieces if p[0] and p[2]), key=lambda p: p[1] or ""):
        whole[c] = whole.get(c, "") + s
    want = sorted((c, k, k * 10 + 1, s[k * 10 : k * 10 + 13]) for c, s in whole.items() for k in range(-(-len(s) // 10)))
    df = spark.createDataFrame(pieces, "contig string, o string, seq string")
    for prefix in (1, 3, 9):
        got = rna_edit.piece_chunks(df, "o", 10, 3, prefix)
        assert sorted(map(tuple, got.collect())) == want
    lines = [(c, i, s[i:j]) for c, s in whole.items() for cuts in [[0, *sorted(rnd.sample(range(1, len(s)), 9)), len(s)]] for i, j in zip(cuts, cuts[1:])]
    got = sequence.chunks(spark.createDataFrame([*lines, ("e", 0, ""), ("n", 0, None)], "contig string, start bigint, bases string").repartition(3), 10, 3)
    assert sorted(map(tuple, got.collect())) == want


def test_motif_gathers_chunks_only(spark):
    """No list of all calls of a chromosome: what is gathered into one value is a chunk."""
    from helixframe.plans import catalog

    plan = catalog.QUERIES["motif"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    gathers = [x for x in plan.split("\n") if "collect_list" in x]
    assert gathers and all("chunk_id" in x.split("Aggregate [")[1].split("]")[0] for x in gathers)


def test_flags_and_lists_of_info(spark):
    """Each rule on maps with a flag, a list, both, none, repeats, and without sources."""
    rows = [("ADAR_SIG;EDIT_SIG=APOBEC3,ADAR",), ("APOBEC3_SIG",), ("EDIT_SIG= x , ,x",), ("DP=3;AS_SB=1;SOURCE_SET=GERMLINE,RNA_EDIT",), ("SOURCE_SET=SOMATIC;SOMATIC;EDIT_SIG=APOBEC3",), (".",)]
    info = v.info_map(F.col("s"))
    got = values(spark, rows, "s string", v.edit_label(info), v.flagged_signature(info), v.with_edit_list(info)["EDIT_SIG"], v.apobec3_candidate(info))
    assert got == [("ADAR|APOBEC3", "ADAR", "APOBEC3,ADAR", True), ("APOBEC3", "APOBEC3", "APOBEC3", True), ("x", "OTHER", " x , ,x", False), ("NA", "OTHER", None, False), ("APOBEC3", "OTHER", "APOBEC3", True), ("NA", "OTHER", None, False)]
    got = [r[0] for r in values(spark, rows, "s string", v.with_flags_restored(v.without_allele_keys(info)))]
    assert got[0] == {"ADAR_SIG": "1", "EDIT_SIG": "APOBEC3,ADAR", "APOBEC3_SIG": "1"} and got[3] == {"DP": "3", "SOURCE_SET": "GERMLINE,RNA_EDIT", "GERMLINE": "1"}
    assert got[4] == {"SOURCE_SET": "SOMATIC", "SOMATIC": "1", "EDIT_SIG": "APOBEC3", "APOBEC3_SIG": "1"} and got[5] == {}


def test_locations_amino_acids_and_protocols(spark):
    rows = [("chr1:100-102", "K/R"), ("X:7", "K"), ("1_100", "-"), ("1:x", "K/R/S"), (None, None)]
    got = values(spark, rows, "l string, a string", v.location_parts(F.col("l")), v.amino_acid_pair(F.col("a")))
    assert got == [(("1", 100), ("K", "R")), (("X", 7), ("K", "")), (None, ("", "")), (None, ("K", "R/S")), (None, ("", ""))]
    assert [v.protocol(n) for n in ("Reverse", "1++,1--,2+-,2-+", " firststrand ")] == ["fr-firststrand", "fr-secondstrand", "fr-firststrand"]
    import pytest

    for name in ("rf", "fr", "unstranded"):
        with pytest.raises(ValueError):
            v.protocol(name)
    assert values(spark, [("a_L.1x0001",), ("a_L.10001",), ("a_L.1.0001",)], "s string", v.renamed_read_group(F.col("s"), "L.1", "N")) == [("a_L.1x0001",), ("a_L.10001",), ("N",)]


def test_counts_genes_and_formats(spark):
    rows = [("9,4", None, None, None, "DP=8;AF=0.5"), (".", "1,6", None, None, "."), (None, None, "0.5", "12", "."), (None, None, None, None, "DP=8;MLEAF=0.25"), (None, None, None, None, "DP=8")]
    got = values(spark, rows, "ad string, fad string, af string, dp string, i string", v.first_alt_count(*(F.col(c) for c in ("ad", "fad", "af", "dp")), v.info_map(F.col("i"))))
    assert got == [(4.0,), (6.0,), (6.0,), (2.0,), (None,)]
    rows = [("ANN=T|m|H|GENE|id|x|TX1|y,U|z",), ("ANN=T|m",), ("CSQ=T|ENST001|B|GENE2|ENST9",), ("CSQ=x|ENST1",), ("DP=1",)]
    assert [tuple(r[0]) for r in values(spark, rows, "s string", v.gene_and_transcript(v.info_map(F.col("s"))))] == [("GENE", "TX1"), ("", ""), ("GENE2", "ENST001"), ("", "ENST1"), ("", "")]
    rows = [("GT:AD:PS", "0/1:3,4:9", "DP=2;AF=0.5"), ("GT", "0/1", "AF=0.25"), ("GT:AD", "0/1:1,1", "DP=2")]
    assert [tuple(r[0]) for r in values(spark, rows, "k string, s string, i string", v.af_into_format(F.col("k"), F.col("s"), v.info_map(F.col("i"))))] == [("GT:AD:AF:PS", "0/1:3,4:0.5:9"), ("GT:AF", "0/1:0.25"), ("GT:AD", "0/1:1,1")]
    got = values(spark, [("AD:GT:XX:DP", "3,4:0/1:z:.")], "k string, s string", v.format_subset(v.format_map(F.col("k"), F.col("s"))))
    assert tuple(got[0][0]) == ("0/1", "3,4", None, None, None, None, None, None)
    assert values(spark, [([1] * 1500,), ([7],)], "a array<int>", v.alt_total(F.col("a"))) == [(1499,), (None,)]
    assert values(spark, [("./.",), ("0|1",), (None,)], "g string", v.set_gt(F.col("g"))) == [("0/0",), ("0|1",), ("0/0",)]


def test_depth_field_comes_first(spark):
    rows = [([10, 0], 9, [10, 3], None), ([5, 0], 12, [6, 3], 10), ([10, 0], None, [10, 3], None)]
    got = [r.drop_reason for r in rna_edit.paired_qc(spark.createDataFrame(rows, "normal_ad array<int>, normal_dp int, rna_ad array<int>, rna_dp int")).collect()]
    assert got == ["NORMAL_DP", None, None]


def test_best_transcript_prefers_known_changes(spark):
    """Missing changes are no common change; rows without an id go by place and alternate."""
    extra = "SYMBOL=A"
    rows = [("P", "u1", "-", "-", "T1", "r1"), ("P", "u1", "-", "-", "T2", "r2"), ("P", "u1", "-", "K/R", "T3", "r3"), ("P", "", "5", "K/R", "T4", "r4"), ("P", None, "5", "K/R", "T5", "r5"), ("P", "", "6", "K/S", "T1", "r6")]
    df = spark.createDataFrame([(*r, "Transcript", "missense_variant", extra, 0, "1:7" if r[5] != "r6" else "1:8", "G") for r in rows], "patient string, uploaded string, protein_position string, amino_acids string, feature string, rid string, feature_type string, consequence string, extra string, t int, location string, alt string")
    got = {(r.feature, r.aa_count, r.aa_options, r.rows) for r in annotate.best_transcript(df).collect()}
    assert got == {("T3", 1, 1, 3), ("T4", 2, 1, 2), ("T1", 1, 1, 1)}


def test_position_conflict_branches(spark):
    calls = [("P", "chr1", 1, "A", "G", "RNA_EDIT", "a"), ("P", "chr1", 2, "A", "G", "RNA_EDIT", "b"), ("P", "chr1", 2, "A", "C", "RNA_EDIT", "c"), ("P", "chr1", 3, "A", "G", "RNA_EDIT", "d"), ("P", "chr1", 3, "A", "C", "RNA_EDIT", "e"), ("P", "chr1", 2, "A", "T", "GERMLINE", "f")]
    unique, other = "UNIQUE_TRANSCRIPT_STRAND", "AMBIGUOUS_TRANSCRIPT_STRAND"
    summary = [("P", "1_2_A/G", unique), ("P", "chr1_2_A/C", other), ("P", "chr1_3_A/G", unique), ("P", "chr1_3_A/C", unique)]
    out = annotate.position_conflicts(spark.createDataFrame(calls, "patient string, chrom string, pos bigint, ref string, alt string, source_set string, rid string"), spark.createDataFrame(summary, "patient string, uploaded string, status string"))
    got = {r.rid: (r.decision, r.strand_status) for r in out.collect()}
    assert got == {
        "a": ("SINGLETON_KEEP", "MISSING_VEP_ANNOTATION"), "b": ("UNIQUE_STRAND_KEEP_IN_POSITION_CONFLICT", unique), "c": ("POSITION_CONFLICT_NONUNIQUE_STRAND", other), "d": ("UNRESOLVED_POSITION_CONFLICT_KEEP_ALL", unique),
        "e": ("UNRESOLVED_POSITION_CONFLICT_KEEP_ALL", unique), "f": ("NON_RNA_EDIT", "MISSING_VEP_ANNOTATION"),
    }


def test_same_copy_flags(spark):
    """Homozygous A with a neighbour that has no alternate; het A with a homozygous B before a cis B; unequal blocks; no neighbour."""
    a = [("P", "1", 100, "1/1", 5, "a1"), ("P", "1", 300, "0|1", 5, "a2"), ("P", "1", 500, "0|1", 5, "a3"), ("P", "1", 700, "0|1", 5, "a4"), ("P", "1", 900, "0/0", 5, "a5")]
    b = [("P", "1", 110, "0/0", 5, "b1"), ("P", "1", 290, "1/1", 5, "b2"), ("P", "1", 310, "0|1", 5, "b3"), ("P", "1", 533, "0|1", 5, "b4"), ("P", "1", 534, "1/1", 5, "b5"), ("P", "1", 701, "0|1", 6, "b6"), ("P", "1", 901, "1/1", 5, "b7")]
    schema = "patient string, chrom string, pos bigint, gt string, ps bigint, rid string"
    got = {r.rid: (r.hom_any, r.het_same, r.het_cis) for r in clusters.first_same_copy(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    assert got == {"a1": (True, False, False), "a2": (False, True, False), "a3": (False, True, True), "a4": (False, False, False)}


def test_base_quality_and_case(spark):
    calls = spark.createDataFrame([("c", "P", "1", "G", 11, ["+"])], "rid string, patient string, chrom string, alt string, pos bigint, strands array<string>")
    reads = [(10, "g", [19]), (10, "g", [20]), (10, "G", None), (10, "A", [40]), (10, "G", [])]
    df = spark.createDataFrame([("P", "1", p, 16, 60, "1M", s, q) for p, s, q in reads], "patient string, contig string, pos0 bigint, flag int, mapq int, cigar string, seq string, quals array<int>")
    assert [(r.expected, r.alt_reads) for r in strand.alt_support(calls, df).collect()] == [(3, 3)]


def test_record_filters_and_columns(spark):
    lines = [("a", "##x"), ("a", "#CHROM\tPOS"), ("a", "1\t2"), ("b", "1\t2"), ("c", "#CHROM POS"), ("c", "")]
    assert {(r.file, r.status, r.records) for r in records.input_validity(spark.createDataFrame(lines, "file string, line string")).collect()} == {("a", "OK", 1), ("b", "NO_HEADER", 1), ("c", "EMPTY", 0)}
    names = {"1": ["x", "DNA_TUMOR"], "2": ["x_N", "y"], "3": ["a", "b", "my_tumour"], "4": ["n", "TUMOUR"], "5": ["a", "b", "c"], "6": ["p_DNA_NORMAL", "some_rna", "z"]}
    df = spark.createDataFrame([(p, s, i) for p, x in names.items() for i, s in enumerate(x)], "patient string, sample string, idx int")
    pick = lambda way: {r.patient: r["sample"] for r in records.tumour_column(df, way).collect()}
    assert pick("report") == {"1": "DNA_TUMOR", "2": "y", "3": "my_tumour", "4": "TUMOUR", "5": "a", "6": "p_DNA_NORMAL"}
    assert pick("merge") == {"1": "DNA_TUMOR", "2": "y", "3": "my_tumour", "4": "TUMOUR", "5": "c", "6": "some_rna"}
    assert pick("dna_only") == {"1": "DNA_TUMOR", "2": "y", "3": "a", "4": "n", "5": "a", "6": "some_rna"}
    rows = spark.createDataFrame([("P", "x", "GERMLINE,RNA_EDIT"), ("Q", None, None)], "patient string, known_db string, source_set string")
    assert [r.patient for r in records.empty_patients(rows, records.known_sites_only(rows, "x")).collect()] == ["Q"]
    assert [(r.reason, r.blacklisted) for r in records.limited_to(rows, "RNA_EDIT", F.lit("BAD")).collect()] == [("BAD", True), ("PRESERVED", False)]
    got = values(spark, [([9, 1, 2], ["G", "T"], ["C", "T", "G"])], "ad array<int>, own array<string>, joint array<string>", records.reindexed_counts(F.col("ad"), F.col("own"), F.col("joint")))
    assert got == [([9, None, 2, 1],)]
