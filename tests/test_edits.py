"""The table of RNA edits from whole records."""

from pyspark.sql import functions as F

from helixframe.operators import edits
from helixframe.sources import text

HEAD = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"


def test_who_speaks_for_a_record(spark):
    cases = [
        (["a_DNA_NORMAL", "a_DNA_TUMOR", "a_RNA_TUMOUR.0001"], "a_RNA_TUMOUR.0001", "a_DNA_TUMOR"), (["DNA_NORMAL", "TUMOR"], "TUMOR", None), (["x_dna_normal", "y"], "y", None), (["x_DNA_NORMAL"], None, None),
        (["x_DNA_NORMAL.0001", "z"], "x_DNA_NORMAL.0001", None), (["RNA_TUMOR", "p"], "RNA_TUMOR", "p"), (["RNA_TUMORS", "mine"], "mine", "RNA_TUMORS"), ([], None, None), (None, None, None),
    ]
    df = spark.createDataFrame([(i, n) for i, (n, _, _) in enumerate(cases)], "i int, names array<string>")
    got = {r.i: (r.a, r.b) for r in df.select("i", *(c.alias(n) for c, n in zip(edits.signal_names(F.col("names"), "mine"), "ab"))).collect()}
    # an RNA label has its suffix; TUMOR at the end of RNA_TUMOR answers to the tumour label as well
    want = {i: (a, b) for i, (_, a, b) in enumerate(cases)}
    want[0] = ("a_RNA_TUMOUR.0001", "a_DNA_TUMOR")
    want[5] = ("RNA_TUMOR", None)
    assert got == want


def test_edits_of_records(spark):
    line = lambda pos, info, form, *samples: "\t".join(["chr1", str(pos), ".", "A", "G", ".", "PASS", info, form, *samples])
    lines = [
        HEAD + "N_DNA_NORMAL\tT_DNA_TUMOR\tT_RNA_TUMOR",
        line(1, "SOURCE_SET=GERMLINE,RNA_EDIT", "GT:AD:DP:PS:PID", "0/0", "0/1:9,30:39", "0|1:5,15:20:7:q"), line(2, "ADAR_SIG", "GT:AD", "0/0", "0/1:1,12", "./.:9,99"), line(3, "KNOWN_RNAEDIT_DB=.;SOURCE_SET=SOMATIC", "GT", "0/0", "0/1", "0/1"),
        line(4, "APOBEC3_SIG", "GT:AD", "0/0", "0/1:1,12", "0/1:3,9"), line(5, "KNOWN_RNAEDIT_DB=x", "GT", "0/0", "0/1", "0/1"), line(6, "ADAR_SIG;DP=100;MLEAF=0.5", "GT:AD", "0/0", ".", "./.:."), line(7, "ADAR_SIG", "GT:AF:DP:FAD", "0/0", ".", "0/1:0.5:30:.,11"),
    ]
    records = text.records_of(spark.createDataFrame([("/in/P.vcf", x) for x in lines], "file string, value string")).withColumn("more", F.lit("kept"))
    places = spark.createDataFrame([("P", "1:1", "G", "b"), ("P", "chr1:1-2", " G", "a"), ("P", "1:1", "G", "b"), ("P", "1:2", "G", "."), ("P", "1:2", "", "z"), ("P", "x", "G", "z"), ("Q", "1:5", "G", "z")], "patient string, Location string, Allele string, Consequence string")
    out = edits.edit_calls(records, places)
    assert out.columns == [*edits.COLUMNS, "more"]
    got = {r.pos: (r.Consequence, r.signature, r.rna_sample, r.rna_gt, r.rna_ad, r.rna_alt_count, r.rna_af, r.rna_dp, r.ps, r.pid, r.source_set, r.known_db) for r in out.collect()}
    assert got == {
        1: ("a|b", "OTHER", "T_RNA_TUMOR", "0|1", "5,15", 15.0, 0.75, 20.0, "7", "q", "GERMLINE,RNA_EDIT", ""), 2: ("", "ADAR", "T_DNA_TUMOR", "0/1", "1,12", 12.0, 0.923077, None, "", "", "", ""),
        5: ("", "OTHER", "T_RNA_TUMOR", "0/1", "", None, None, None, "", "", "", "x"), 6: ("", "ADAR", "T_RNA_TUMOR", "./.", "", 50.0, None, None, "", "", "", ""), 7: ("", "ADAR", "T_RNA_TUMOR", "0/1", "", 11.0, 0.5, 30.0, "", "", "", ""),
    }
    assert edits.edit_calls(records.limit(0)).count() == 0
