import gzip
import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import variant as v
from helixframe.operators import alternates, merge, strand
from helixframe.sources import lists, sequence, sinks, text


def put(path, content):
    (gzip.open if path.suffix == ".gz" else open)(path, "wt", encoding="utf-8").write(content)
    return str(path)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_records(spark, tmp_path):
    put(tmp_path / "P1.a.vcf", "##meta\n﻿ #CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tP1_DN\tP1_RT\nchr1\t10\t.\tA\tG\t9\tPASS\tX=1\tGT:AD:DP\t0/1:1,2\t./.\nchr1\tten\t.\tC\tT\t.\t.\t.\nshort\t1\n")
    put(tmp_path / "P2.b.vcf.gz", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\r\nchr2\t7\tr\tC\tT\t.\t.\tF\r\n")
    got = text.read_records(spark, str(tmp_path))
    assert rows(got, "patient", "chrom", "pos", "alt", "info") == [("P1", "chr1", 10, "G", "X=1"), ("P1", "chr1", None, "T", "."), ("P2", "chr2", 7, "T", "F")]
    long = text.long_calls(got)
    assert rows(long, "patient", "sample_idx", "sample", F.map_entries("values").cast("string")) == [("P1", 0, "P1_DN", "[{GT, 0/1}, {AD, 1,2}]"), ("P1", 1, "P1_RT", "[{GT, ./.}]")]
    lost = put(tmp_path / "none.vcf", "chr1\t1\t.\tA\tG\t.\t.\t.\n")
    with pytest.raises(Exception, match="no #CHROM line"):
        text.read_records(spark, lost).collect()


def test_records_go_back_to_text(spark, tmp_path):
    lines = ["##meta", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS", "chr1\t9\t.\tA\tG\t.\tPASS\tX\tGT\t0/1", "chr1\t10\t.\tA\tG\t.\tPASS\tX\tGT\t1/1"]
    path = put(tmp_path / "P1.vcf", "\n".join(lines) + "\n")
    records = text.read_records(spark, path)
    file = records.first().file
    header = spark.createDataFrame([(file, i, x) for i, x in enumerate(lines[:2])], "file string, line_no int, line string")
    new = ["##meta", "##added"]
    assert [r.line for r in sinks.record_lines(records, header, new).collect()] == [lines[0], "##added", *lines[1:]]


def test_annotation_features_coverage(spark, tmp_path):
    put(tmp_path / "P1.vep", "## note\n#Uploaded_variation\tGene\tLocation\nchr1_5_A/G\tG1\t1:5\nchr1_6_A/G\tG2\n")
    put(tmp_path / "P2.vep", "chr1_7_A/G\t1:7\tG\n")
    got = text.read_annotation(spark, str(tmp_path / "*.vep"))
    assert rows(got, "patient", "Uploaded_variation", "Location", "Gene", "Extra") == [("P1", "chr1_5_A/G", "1:5", "G1", ""), ("P1", "chr1_6_A/G", "", "G2", ""), ("P2", "chr1_7_A/G", "1:7", "", "")]
    keep = got.where("Gene = 'G2'")
    assert rows(sinks.kept_rows(got, keep.union(keep)), "Uploaded_variation") == [("chr1_6_A/G",)]
    gtf = put(tmp_path / "a.gtf", '#x\nchr1\ts\texon\t11\t20\t.\t+\t.\tgene_id "a"\nchr1\ts\ttranscript\t1\t90\t.\t-\t.\tx\nchr1\ts\tgene\t1\t9\t.\t+\t.\tx\nchr1\ts\tCDS\t1\t9\t.\t.\t.\tx\n')
    assert rows(text.read_features(spark, gtf), "start0", "end0", "tier", "strand") == [(0, 90, "transcript", "-"), (10, 20, "exonic", "+")]
    dn, rt = put(tmp_path / "P1.dn.gz", "chr1\t0\t500\t2.5\textra\n"), put(tmp_path / "P1.rt.bed", "chr1\t0\t500\t4\nchr1\t500\t600\tbad\n")
    assert rows(text.read_coverage(spark, {"DN": dn, "RT": rt}), "patient", "chrom", "end_pos", "label", "cov") == [("P1", "chr1", 500, "DN", 2.5), ("P1", "chr1", 500, "RT", 4.0)]
    sites = put(tmp_path / "known.tsv", "#CHROM\tPOS\nchr1\t5\tA\tG\tdb1\nchr1\tx\tA\tG\tdb\n")
    assert rows(text.read_known_sites(spark, sites), "pos", "known_db") == [(5, "db1")]


def test_annotation_by_place(spark, tmp_path):
    long = "\t".join(["id", " 1:5 ", "G ", "g", "f", "t", "missense_variant", *"1234567"[1:], "BIOTYPE=x"])
    path = put(tmp_path / "P1.vep", f"#Uploaded_variation\tLocation\n{long}\nid\t1:6\tA\tg\tf\tt\tx\nid\t1:7\tA\n")
    got = text.read_annotation_fields(spark, path)
    assert rows(got, "patient", "Location", "Allele", "Consequence", "Extra") == [("P1", "1:5", "G", "missense_variant", "BIOTYPE=x"), ("P1", "1:6", "A", "x", "")]


def test_alignments(spark, tmp_path):
    read = lambda flag, at, cigar="4M", seq="ACGT", quals="I5!I", mapq=60, contig="chr1": f"r\t{flag}\t{contig}\t{at}\t{mapq}\t{cigar}\t*\t0\t0\t{seq}\t{quals}"
    lines = ["@SQ\tSN:chr1", read(0, 9), read(16, 9, quals="*"), read(4, 0, contig="*"), read(0, 9, mapq="x"), read(1024, 9), "short\t0"]
    got = text.read_alignments(spark, put(tmp_path / "P1.sam", "\n".join(lines) + "\n"))
    assert rows(got, "patient", "contig", "pos0", "flag", "quals") == [("P1", "chr1", 8, 0, [40, 20, 0, 40]), ("P1", "chr1", 8, 1024, [40, 20, 0, 40]), ("P1", "chr1", 8, 16, None)]
    calls = spark.createDataFrame([("a", "P1", "chr1", 10, "c", ["+"]), ("b", "P1", "chr1", 11, "G", ["+"])], "rid string, patient string, chrom string, pos bigint, alt string, strands array<string>")
    assert rows(strand.alt_support(calls, got), "rid", "expected", "opposite", "alt_reads") == [("a", 1, 1, 2), ("b", 1, 0, 1)]


def test_presence_and_stage_outputs(spark, tmp_path):
    for name in ("P1.s5.vcf.gz", "P1.s4.vcf", "P2.s4.vcf"):
        put(tmp_path / name, "x")
    files = lists.listed_files(spark, str(tmp_path))
    assert files.count() == 3
    items = spark.createDataFrame([(f"P1={tmp_path}/P1.s4.vcf=r",), (f"P2=file://{tmp_path}/P2.s4.vcf",), (f"P3={tmp_path}/no.vcf",), (None,)], "item string")
    marked = lists.with_presence(lists.manifest(items), files.union(files))
    assert rows(marked, "patient", "reads", "status") == [("P1", "r", "OK"), ("P2", None, "OK"), ("P3", None, "MISSING")]
    patients = spark.createDataFrame([("P1",), ("P1",), ("P2",), ("P3",), (None,)], "patient string")
    outputs = lists.stage_outputs(patients, files, {"5": f"{tmp_path}/{{patient}}.s5", "4": f"{tmp_path}/{{patient}}.s4.vcf", "3": ""})
    assert rows(outputs, "patient", "stage") == [("P1", "4"), ("P1", "5"), ("P2", "4")]
    chosen = alternates.proximity_source(patients, outputs, ["5", "4", "3"])
    assert rows(chosen.where("patient is not null"), "patient", "stage", "status") == [("P1", "5", "USED"), ("P2", "4", "USED"), ("P3", None, "NONE_FOUND")]
    assert lists.stage_outputs(patients, files, {"3": ""}).count() == 0


def test_rewritten_fields_go_back_to_text(spark):
    texts = ["B=2;DB;A=1", ".", "", None, "GERMLINE=x;B=1;B=2", "FLAG=1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    info = v.info_map(F.coalesce("t", F.lit(".")))
    assert [r.x for r in df.select("i", v.info_text(info, F.col("t")).alias("x")).orderBy("i").collect()] == ["B=2;DB;A=1", ".", ".", ".", "GERMLINE=x;B=2", "FLAG=1"]
    more = v.with_flag(v.with_listed(info, "SOURCE_SET", F.array(F.lit("GERMLINE"))), "GERMLINE")
    assert [r.x for r in df.select("i", v.info_text(more, F.col("t")).alias("x")).orderBy("i").collect()] == [
        "B=2;DB;A=1;GERMLINE;SOURCE_SET=GERMLINE", *["GERMLINE;SOURCE_SET=GERMLINE"] * 3, "GERMLINE=x;B=2;SOURCE_SET=GERMLINE", "FLAG=1;GERMLINE;SOURCE_SET=GERMLINE",
    ]
    assert df.select(v.info_text(F.lit(None).cast("map<string,string>"), F.col("t")).alias("x")).first().x is None
    fields = v.format_map(F.lit("GT:DP"), F.lit("0/1:7"))
    assert df.select(v.sample_text(F.lit("DP:GT:AD"), fields).alias("x")).first().x == "7:0/1:."


def test_merge_of_several_alternates(spark):
    calls = spark.createDataFrame(
        [
            ("P", "chr1", 5, "A", "G", "GERMLINE", "0|1", [9, 3], "1"), ("P", "chr1", 5, "A", "T,G", "SOMATIC", "1/2", [8, 1, 2], "2"),
            ("P", "chr1", 5, "A", "C", "SOMATIC", "1/1", [0, 9], "3"), ("P", "chr1", 6, "A", "C", "RNA_EDIT", "1/2", [1], "4"), ("P", "chr1", 7, "A", None, "RNA_EDIT", None, None, "5"),
        ],
        "patient string, chrom string, pos bigint, ref string, alt string, source_set string, gt string, ad array<int>, rid string",
    )
    got = merge.merge_sources(calls)
    assert rows(got, "pos", "alts", "gt_germline", "gt_somatic", "gt_rna_edit") == [(5, "G,T,C", "0|1", "1/2/3/3", "./."), (6, "C", "./.", "./.", "1/."), (7, "", "./.", "./.", "./.")]
    assert rows(got, "pos", "ad_germline", "ad_somatic", "ad_rna_edit") == [(5, [9, 3, None, None], [8, 2, 1, 9], None), (6, None, None, [1, None]), (7, None, None, None)]


def test_sample_sheet(spark, tmp_path):
    sheet = put(tmp_path / "samples.txt", "# note\nB_DN,x\n\nA_RT other\nB_RT\nC_DT\ty\n")
    labels = ["DN", "DT", "RT"]
    order = lambda *a: [r.patient for r in text.read_patients(spark, sheet, labels, *a).orderBy("place").collect()]
    assert order() == ["B", "A", "C"] and order(["A", "B_RT"]) == ["A", "B"] and order([""]) == []


def test_context_equals_slices(spark, tmp_path):
    rnd = random.Random(3)
    seqs = {c: "".join(rnd.choice("acgtACGT") for _ in range(n)) for c, n in (("chr1", 203), ("2", 20), ("chrX", 61))}
    widths = lambda n: [0, *sorted(rnd.sample(range(1, n), n // 20)), n]
    cut = {c: [s[i:j] for w in [widths(len(s))] for i, j in zip(w, w[1:])] for c, s in seqs.items()}
    fasta = put(tmp_path / "r.fa", "ACGT\n" + "".join(f">{c} note\n" + "\n\n".join(lines) + "\r\n" for c, lines in cut.items()) + ">empty\n")
    asks = [(i, rnd.choice(["chr1", "1", "chr2", "X", "9", None]), rnd.randint(-2, 205), rnd.choice([0, 4, 45])) for i in range(150)]
    df = spark.createDataFrame(asks, "i int, chrom string, s int, more int")
    lines = sequence.read_sequence(spark, fasta)
    placed = {(r.contig, r.start, r.bases) for r in lines.collect()}
    assert placed == {(c, sum(map(len, part[:i])), part[i].upper()) for c, part in cut.items() for i in range(len(part))}
    blocks = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(blocks)
    spark.conf.set(blocks, "37")
    try:
        assert {(r.contig, r.start, r.bases) for r in sequence.read_sequence(spark, fasta).collect()} == placed
    finally:
        spark.conf.set(blocks, before)
    got = sequence.with_context(df, lines, "chrom", F.col("s"), F.col("s") + F.col("more"), "ctx", 16)
    plain = {c.removeprefix("chr"): s.upper() for c, s in seqs.items()}
    want = {}
    for i, c, s, more in asks:
        whole = plain.get((c or "").removeprefix("chr"), "")
        cut = whole[s - 1 : s + more] if s >= 1 else ""
        want[i] = cut if len(cut) == more + 1 else None
    assert {r.i: r.ctx for r in got.collect()} == want and sum(x is not None for x in want.values()) > 20


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("P1", 2, "PASS"), ("P2", 1, "LOW"), ("P1", 1, None), ("P1", 10, "LOW")], "patient string, pos int, reason string")
    sinks.write_per_patient(df, str(tmp_path / "per"), ["pos"])
    assert [p.name for p in sorted((tmp_path / "per").glob("patient=*"))] == ["patient=P1", "patient=P2"]
    body = [x for f in sorted((tmp_path / "per" / "patient=P1").glob("*.csv")) for x in f.read_text().splitlines() if not x.startswith("pos")]
    assert body == ["1\tNA", "2\tPASS", "10\tLOW"]
    sinks.write_cohort(df, str(tmp_path / "all"), ["patient", "pos"])
    assert spark.read.csv(str(tmp_path / "all"), sep="\t", header=True).count() == 4
    sinks.write_list(df, "reason", str(tmp_path / "list"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "list")).collect()) == ["LOW", "PASS"]
    sinks.write_split(df, str(tmp_path / "split"))
    assert rows(spark.read.csv(str(tmp_path / "split"), sep="\t", header=True).groupBy("kept").count(), "kept", "count") == [("false", 2), ("true", 2)]
    assert rows(sinks.metrics(df, n=F.count("*"), most=F.max("pos")), "metric", "value") == [("most", "10"), ("n", "4")]


def test_completeness(spark):
    patients = spark.createDataFrame([("P1",), ("P2",), ("P1",)], "patient string")
    outputs = spark.createDataFrame([("P1", "a", 5), ("P1", "b", 0), ("P2", "b", 3), ("P9", "a", 1)], "patient string, stage string, n int")
    got = sinks.completeness(patients, ["a", "b"], outputs)
    assert rows(got, "patient", "stage", "status", "input") == [("P1", "a", "OK", None), ("P1", "b", "EMPTY", "OK"), ("P2", "a", "MISSING", None), ("P2", "b", "OK", "MISSING")]
