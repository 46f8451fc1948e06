"""Queries over text: the lines that files would hold are spelt from the projections and parsed again; and gates, reports and field forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import variant as v
from ..operators import annotate, clusters, edits, gates, records
from ..sources import lists, sinks, text
from .registry import query

def _line(*parts):
    return F.concat_ws("\t", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _record_lines(calls):
    """Records of two samples, one without counts; blanks in place of tabs in one lane, and a byte order mark before some headers."""
    dp = F.concat(F.lit("DP="), (F.col("ad_ref") + F.col("ad_alt")).cast("string"))
    ad = F.concat_ws(",", F.col("ad_ref").cast("string"), F.col("ad_alt").cast("string"))
    line = _line(F.col("chrom"), F.col("pos"), F.col("rid"), F.col("ref"), F.col("alt"), ".", "PASS", dp, "GT:AD", F.concat("gt", F.lit(":"), ad), "0/0")
    file = F.concat(F.lit("/in/"), "patient", F.lit(".vcf"))
    rows = calls.select(file.alias("file"), F.when(F.col("lane") == 3, F.replace(line, F.lit("\t"), F.lit("  "))).otherwise(line).alias("value"))
    names = F.concat(F.when(F.col("patient") < "P10", "﻿").otherwise(""), _line("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"), F.lit("\t"), "patient", F.lit("_T\t"), "patient", F.lit("_N"))
    heads = calls.select("patient").distinct().select(file.alias("file"), F.explode(F.array(F.lit("##fileformat=VCFv4.2"), names, F.lit(""))).alias("value"))
    return rows.unionByName(heads)


@query("record_samples", "calls", """ SELECT patient, rid, chrom, pos, ref, alt, k.i AS sample_idx, patient || k.s AS sample, CASE k.i WHEN 0 THEN gt ELSE '0/0' END AS gt, CASE k.i WHEN 0 THEN ad_ref || ',' || ad_alt END AS ad, (ad_ref + ad_alt)::VARCHAR AS dp
FROM calls, (VALUES (0, '_T'), (1, '_N')) k(i, s)""")
def record_samples(calls):
    """Records parsed, one row a sample."""
    parsed = text.records_of(_record_lines(calls))
    out = text.long_calls(parsed.withColumn("dp", v.info_map(F.col("info"))["DP"]))
    return out.select("patient", F.col("id").alias("rid"), "chrom", "pos", "ref", "alt", "sample_idx", "sample", F.col("values")["GT"].alias("gt"), F.col("values")["AD"].alias("ad"), "dp")


@query("record_text", "calls", r""", h AS (SELECT DISTINCT patient FROM calls), n AS (SELECT patient, unnest(['##fileformat=VCFv4.2', '##INFO=<ID=EDIT_SIG>', '#CHROM' || chr(9) || 'POS']) AS line FROM h)
SELECT '/in/' || patient || '.vcf' AS file, line FROM n UNION ALL SELECT '/in/' || patient || '.vcf', concat_ws(chr(9), chrom, pos, rid, ref, alt, '.', 'PASS', 'DP=' || (ad_ref + ad_alt), 'GT:AD', gt || ':' || ad_ref || ',' || ad_alt, '0/0') FROM calls""")
def record_text(calls):
    """Records parsed and written as text again, behind their header with one line more."""
    file = F.concat(F.lit("/in/"), "patient", F.lit(".vcf"))
    header = calls.select("patient").distinct().select(file.alias("file"), F.posexplode(F.array(F.lit("##fileformat=VCFv4.2"), _line("#CHROM", "POS"))).alias("line_no", "line"))
    return sinks.record_lines(text.records_of(_record_lines(calls)), header, ["##INFO=<ID=EDIT_SIG>"])


_FIELDS = ("uploaded", "location", "allele", "gene", "feature", "feature_type", "consequence", "-", "-", "protein_position", "amino_acids", "codons", "existing_variation", "extra")


def _annotation_lines(vep):
    """Half of the patients have the columns behind the id in reverse order, as their header says; others have the standard order and no header."""
    own = [F.lit("-") if c == "-" else F.col(c) for c in _FIELDS]
    file, late = F.concat(F.lit("/in/"), "patient", F.lit("_vep.txt")), F.col("patient") >= "P20"
    rows = vep.select(file.alias("file"), F.when(late, _line(own[0], *own[:0:-1])).otherwise(_line(*own)).alias("value"))
    heads = vep.where(late).select("patient").distinct().select(file.alias("file"), F.lit("#" + "\t".join(["Uploaded_variation", *text.VEP_COLUMNS[:0:-1]])).alias("value"))
    return rows.unionByName(heads)


@query("annotation_lines", "vep", """ SELECT patient || '' AS patient, uploaded AS "Uploaded_variation", location AS "Location", allele AS "Allele", gene AS "Gene", feature AS "Feature", feature_type AS "Feature_type", consequence AS "Consequence", '-' AS "cDNA_position", '-' AS "CDS_position",
  protein_position AS "Protein_position", amino_acids AS "Amino_acids", codons AS "Codons", existing_variation AS "Existing_variation", extra AS "Extra" FROM vep""")
def annotation_lines(vep):
    return text.annotation_of(_annotation_lines(vep), r"([^/_]+)_vep[^/]*$").drop("file")


@query("annotation_fields", "vep", """ SELECT patient, location AS "Location", allele AS "Allele", consequence AS "Consequence", CASE WHEN t = 1 THEN '' ELSE extra END AS "Extra" FROM vep""")
def annotation_fields(vep):
    """By place; some lines end after seven fields, and lines of fewer are none."""
    own = [F.lit("-") if c == "-" else F.col(c) for c in _FIELDS]
    full = F.when(F.col("t") == 1, _line(*own[:1], F.concat(F.lit(" "), "location"), *own[2:7])).otherwise(_line(*own))
    rows = vep.select(F.concat(F.lit("/in/"), "patient").alias("file"), F.explode(F.array(full, _line(*own[:6]), F.lit("#x"))).alias("value"))
    return text.annotation_fields_of(rows).drop("file")


@query("feature_lines", "gtf", """ SELECT chrom, start0, end0, feature, CASE feature WHEN 'exon' THEN 'exonic' ELSE 'transcript' END AS tier, strand FROM gtf WHERE start0 % 7 <> 0 AND start0 % 5 <> 0""")
def feature_lines(gtf):
    """Other features, and those without a strand, are left out."""
    kind, strand = F.when(F.col("start0") % 5 == 0, "gene").otherwise(F.col("feature")), F.when(F.col("start0") % 7 == 0, ".").otherwise(F.col("strand"))
    line = _line(F.col("chrom"), "made", kind, F.col("start0") + 1, F.col("end0"), ".", strand, ".", 'gene_id "x"')
    return text.features_of(gtf.select(F.explode(F.array(F.lit("#!genome"), line)).alias("value")))


@query("coverage_lines", "coverage", " SELECT patient, chrom, start_pos, end_pos, label, cov FROM coverage WHERE start_pos % 3 <> 0")
def coverage_lines(cov):
    """Lines without numbers are left out."""
    value = F.when(F.col("start_pos") % 3 == 0, _line(F.col("chrom"), F.col("start_pos"), F.col("end_pos"), "x")).otherwise(_line(F.col("chrom"), F.col("start_pos"), F.col("end_pos"), F.col("cov"), "more"))
    return text.coverage_of(cov.select(F.concat(F.lit("/in/"), "patient", F.lit("."), "label", F.lit(".bed")).alias("file"), "label", value.alias("value")))


@query("known_site_lines", "calls", " SELECT chrom, pos, ref, alt, known_db FROM calls WHERE known_db IS NOT NULL AND lane <> 2")
def known_site_lines(calls):
    value = _line(F.col("chrom"), F.when(F.col("lane") == 2, "?").otherwise(F.col("pos").cast("string")), F.col("ref"), F.col("alt"), F.col("known_db"))
    return text.known_sites_of(calls.where("known_db is not null").select(F.explode(F.array(F.lit("#chrom"), value)).alias("value")))


@query("read_lines", "reads", """ SELECT patient, contig, pos0, flag, mapq, cigar, seq, CASE WHEN pos0 % 11 <> 0 THEN qual END AS first_qual, CASE WHEN pos0 % 11 <> 0 THEN 50 END AS n_quals FROM reads WHERE pos0 % 13 <> 0""")
def read_lines(reads):
    """Some reads have no qualities, others no place."""
    quals = F.when(F.col("pos0") % 11 == 0, "*").otherwise(F.repeat(F.chr(F.col("qual") + 33), F.lit(50)))
    contig = F.when(F.col("pos0") % 13 == 0, "*").otherwise(F.col("contig"))
    value = _line("r", F.col("flag"), contig, F.col("pos0") + 1, F.col("mapq"), F.col("cigar"), "*", "0", "0", F.col("seq"), quals)
    out = text.alignments_of(reads.select(F.concat(F.lit("/in/"), "patient", F.lit(".sam")).alias("file"), F.explode(F.array(F.lit("@SQ\tSN:chr1"), value, F.lit("short"))).alias("value")))
    return out.select("patient", "contig", "pos0", "flag", "mapq", "cigar", "seq", F.get("quals", F.lit(0)).alias("first_qual"), F.nullif(F.size("quals"), F.lit(-1)).alias("n_quals"))


@query("sample_sheet", "calls", """, l AS (SELECT rid AS place, patient || CASE lane WHEN 0 THEN '_DN' WHEN 1 THEN '_DT' ELSE '_RT' END AS sample FROM calls WHERE lane <> 3)
SELECT regexp_replace(sample, '_[A-Z]+$', '') AS patient, min(place) AS place FROM l WHERE sample IN ('P03_DN', 'P04_RT') OR substr(sample, 1, 3) IN ('P11', 'P12') GROUP BY 1""")
def sample_sheet(calls):
    """A sheet of samples in order of rid, comments and blank lines between; asked for by sample or patient."""
    name = F.concat("patient", F.when(F.col("lane") == 0, "_DN").when(F.col("lane") == 1, "_DT").otherwise("_RT"))
    value = F.when(F.col("lane") == 3, F.concat(F.lit("# "), name)).otherwise(F.concat(F.lit("  "), name, F.when(F.col("ad_alt") > 8, ",x y").otherwise("\tz")))
    return text.patients_of(calls.select(F.explode(F.array(value, F.lit(" "))).alias("value"), F.col("rid").alias("place")), ["DN", "DT", "RT"], ["P03_DN", "P04_RT", "P11", "P12"])


@query("names_of_samples", "calls", r""", s AS (SELECT DISTINCT patient || CASE lane WHEN 0 THEN '_DNA_TUMOR' WHEN 1 THEN '_dna_tumour' WHEN 2 THEN '_DNA_TUMOUR.0003' ELSE '' END || CASE WHEN ad_alt > 10 THEN '_RT' ELSE '' END AS sample FROM calls UNION ALL SELECT 'DNA_TUMOR')
SELECT sample, CASE WHEN upper(sample) IN ('DNA_TUMOR', 'DNA_TUMOUR') THEN 0 WHEN regexp_matches(upper(sample), '_DNA_TUMOU?R$') THEN 1 WHEN regexp_matches(upper(sample), '_DNA_TUMOU?R[.][0-9]+$') THEN 2 END AS tier, regexp_replace(regexp_replace(sample, '_RT$', ''), '_DNA_TUMOR$', '') AS patient,
  CASE WHEN regexp_matches(sample, 'DNA_TUMOUR([.][0-9]{4})?$') THEN 'one' ELSE sample END AS renamed FROM s""")
def names_of_samples(calls):
    """How samples answer to a label, whose they are, and what their read groups are called."""
    suffix = F.when(F.col("lane") == 0, "_DNA_TUMOR").when(F.col("lane") == 1, "_dna_tumour").when(F.col("lane") == 2, "_DNA_TUMOUR.0003").otherwise("")
    names = calls.select(F.concat("patient", suffix, F.when(F.col("ad_alt") > 10, "_RT").otherwise("")).alias("sample")).distinct()
    names = names.unionByName(calls.agg(F.max(F.lit("DNA_TUMOR")).alias("sample")))
    sample = F.col("sample")
    return names.select("sample", v.label_tier(sample, "DNA_TUMOR").alias("tier"), v.patient_name(sample, ["RT", "DNA_TUMOR"]).alias("patient"), v.renamed_read_group(sample, "DNA_TUMOUR", "one").alias("renamed"))


@query("field_forms", "calls", r""", x AS (SELECT rid, CASE lane WHEN 0 THEN ad_ref || ',' || ad_alt WHEN 1 THEN ad_ref || ',x' WHEN 2 THEN ad_ref::VARCHAR END AS l, CASE WHEN ad_ref > 0 THEN ad_alt / ad_ref::DOUBLE END AS q, ad_alt, ad_ref,
  CASE lane WHEN 0 THEN source_set WHEN 1 THEN source_set || ', ' || source_set WHEN 2 THEN 'SOMATIC,RNA_EDIT' WHEN 3 THEN ' ' END AS s, gt, lane FROM calls)
SELECT rid, CASE WHEN lane IN (0, 2) THEN l END AS counts, coalesce(regexp_replace(regexp_replace(printf('%.6f', q), '0+$', ''), '[.]$', ''), '.') AS share, CASE s WHEN ' ' THEN 'NA' ELSE split_part(s, ', ', 1) END AS source,
  CASE WHEN gt <> './.' THEN gt END AS "GT", ad_ref || ',' || ad_alt AS "AD", CASE lane WHEN 0 THEN (ad_ref + ad_alt)::VARCHAR END AS "DP" FROM x""")
def field_forms(calls):
    """Integer lists, numbers as records show them, the source as an exact set, and the wanted fields of a sample."""
    counts = F.when(F.col("lane") == 0, F.concat_ws(",", F.col("ad_ref").cast("string"), F.col("ad_alt").cast("string"))).when(F.col("lane") == 1, F.concat(F.col("ad_ref").cast("string"), F.lit(",x"))).when(F.col("lane") == 2, F.col("ad_ref").cast("string"))
    source = F.when(F.col("lane") == 0, F.col("source_set")).when(F.col("lane") == 1, F.concat("source_set", F.lit(", "), "source_set")).when(F.col("lane") == 2, "SOMATIC,RNA_EDIT").otherwise(" ")
    fields = v.format_map(F.lit("GT:AD:XX:DP"), F.concat("gt", F.lit(":"), F.concat_ws(",", F.col("ad_ref").cast("string"), F.col("ad_alt").cast("string")), F.lit(":9:"), F.when(F.col("lane") == 0, (F.col("ad_ref") + F.col("ad_alt")).cast("string")).otherwise(".")))
    own = v.format_subset(fields)
    share = v.number_text(F.try_divide(F.col("ad_alt").cast("double"), F.col("ad_ref")), missing=".")
    return calls.select("rid", F.array_join(v.int_list(counts).cast("array<string>"), ",").alias("counts"), share.alias("share"), v.source_exact(source).alias("source"), *(own[k].alias(k) for k in ("GT", "AD", "DP")))


@query("af_to_format", "calls", """ SELECT rid, CASE source_set WHEN 'GERMLINE' THEN 'GT:AD:AF:SRC:PS' ELSE 'GT:AD:SRC:PS' END AS format, gt || ':' || ad_ref || CASE source_set WHEN 'GERMLINE' THEN ':0.25:' ELSE ':' END || source_set || ':' || ps AS sample FROM calls WHERE source_set <> 'RNA_EDIT'""")
def af_to_format(calls):
    """AF goes to the samples of germline records; records of neither origin go."""
    sample = F.concat_ws(":", F.col("gt"), F.col("ad_ref").cast("string"), F.col("source_set"), F.col("ps").cast("string"))
    rows = calls.select("rid", F.lit("GT:AD:SRC:PS").alias("format"), sample.alias("sample"), v.info_map(F.lit("X=1;AF=0.250")).alias("info"))
    return records.af_to_format(rows).select("rid", "format", "sample")


# --- gates and reports ----------------------------------------------------------------------------------


@query("genotype_rejects", "calls", " SELECT patient, 'MISSING_TUMOR_GT' AS reason, count(*) AS n FROM calls WHERE gt = './.' AND (lane > 0 OR patient < 'P20') GROUP BY patient")
def genotype_rejects(calls):
    """Which patients the gate after composition rejects."""
    return gates.missing_genotypes(calls.where("lane > 0 or patient < 'P20'").withColumn("tumour_gt", F.col("gt")))


@query("known_site_rejects", "calls", """, k AS (SELECT patient, CASE WHEN patient < 'P20' THEN known_db WHEN patient < 'P30' AND lane = 0 THEN '.' END AS d FROM calls WHERE source_set = 'RNA_EDIT')
SELECT patient, CASE WHEN count(d) = 0 THEN 'NO_KNOWN_RNAEDIT_DB' ELSE 'NO_KNOWN_SITES' END AS reason, count(*) AS n FROM k GROUP BY patient HAVING count(*) FILTER (WHERE regexp_matches(coalesce(d, ''), 'KNOWN')) = 0""")
def known_site_rejects(calls):
    """Some patients have no known site, some not even the field."""
    field = F.when(F.col("patient") < "P20", F.col("known_db")).when((F.col("patient") < "P30") & (F.col("lane") == 0), ".")
    return gates.known_site_rejects(calls.where("source_set = 'RNA_EDIT'").withColumn("known_db", field), "KNOWN")


@query("passed_calls", "calls", """, bad AS (SELECT DISTINCT patient FROM calls WHERE gt = './.' AND gene_no % 60 = 0) SELECT rid FROM calls WHERE patient NOT IN (SELECT patient FROM bad)""")
def passed_calls(calls):
    """Patients with a missing genotype among some of their calls are rejected; the others go on."""
    return gates.passed(calls, gates.missing_genotypes(calls.where("gene_no % 60 = 0").withColumn("tumour_gt", F.col("gt")))).select("rid")


@query("file_rejects", "calls", """ SELECT 'f' || patient AS file, CASE WHEN max(CASE WHEN lane = 0 AND ad_alt = 16 THEN 1 ELSE 0 END) = 0 THEN 'NO_HEADER' ELSE 'EMPTY' END AS reason, count(*) FILTER (WHERE gene_no % 500 = 0) AS n FROM calls GROUP BY patient
HAVING max(CASE WHEN lane = 0 AND ad_alt = 16 THEN 1 ELSE 0 END) = 0 OR count(*) FILTER (WHERE gene_no % 500 = 0) = 0""")
def file_rejects(calls):
    """Files whose lines are a header, records or neither."""
    line = F.when((F.col("lane") == 0) & (F.col("ad_alt") == 16), F.lit("#CHROM\tPOS")).otherwise("##note")
    lines = calls.select(F.concat(F.lit("f"), "patient").alias("file"), F.explode(F.array(line, F.when(F.col("gene_no") % 500 == 0, "1\t5").otherwise(" "))).alias("line"))
    return gates.file_rejects(lines)


_FUNNEL = (("input", "true"), ("snv", "length(ref) = 1 AND length(alt) = 1 AND ref <> alt"), ("depth", "ad_ref + ad_alt >= 10"), ("support", "ad_alt >= 4"), ("known", "coalesce(known_db = 'KNOWN', false)"))


@query("funnel", "calls", ", c AS (SELECT patient, unnest([" + ", ".join("{'stage': '%s', 'ok': %s}" % (s, " AND ".join(f"({c})" for _, c in _FUNNEL[: i + 1])) for i, (s, _) in enumerate(_FUNNEL)) + """]) AS x, source_set, gt FROM calls)
SELECT patient, x.stage AS stage, m AS metric, count(*) FILTER (WHERE x.ok AND (m = 'records' OR (m = 'edits' AND source_set = 'RNA_EDIT') OR (m = 'phased' AND gt LIKE '%|%'))) AS value FROM c, (VALUES ('records'), ('edits'), ('phased')) k(m) GROUP BY ALL""")
def funnel(calls):
    """Counts of each stage of a chain of filters, from one scan."""
    return gates.funnel(calls, {s: F.expr(c) for s, c in _FUNNEL[1:]}, more={"edits": F.col("source_set") == "RNA_EDIT", "phased": F.col("gt").contains("|")})


@query("completeness", "calls", """, o AS (SELECT patient, 's' || lane AS stage, max(CASE WHEN gene_no % 9 = 0 THEN 0 ELSE ad_alt END) AS n FROM calls WHERE patient > 'P05' OR lane < 2 GROUP BY ALL), e AS (SELECT DISTINCT patient, p, 's' || p AS stage FROM calls, range(5) r(p)),
s AS (SELECT e.patient, e.p, e.stage, CASE WHEN n IS NULL THEN 'MISSING' WHEN n = 0 THEN 'EMPTY' ELSE 'OK' END AS status FROM e LEFT JOIN o ON o.patient = e.patient AND o.stage = e.stage) SELECT patient, stage, status, lag(status) OVER (PARTITION BY patient ORDER BY p) AS input FROM s""")
def completeness(calls):
    """Which stages each patient has outputs of."""
    outputs = calls.where("patient > 'P05' or lane < 2").select("patient", F.concat(F.lit("s"), F.col("lane").cast("string")).alias("stage"), F.when(F.col("gene_no") % 9 == 0, 0).otherwise(F.col("ad_alt")).alias("n"))
    return sinks.completeness(calls, [f"s{i}" for i in range(5)], outputs)


@query("kept_annotation", "calls vep", " SELECT rid, t, uploaded FROM vep WHERE uploaded IN (SELECT uploaded FROM vep WHERE t = 2 AND gene_no % 2 = 0)".replace("gene_no % 2 = 0", "feature LIKE '%1'"))
def kept_annotation(calls, vep):
    """All annotation rows of the variants that any kept row names."""
    return sinks.kept_rows(vep.select("rid", "t", "uploaded"), vep.where("t = 2 and feature like '%1'"), "uploaded")


@query("metric_rows", "calls", """ SELECT m AS metric, CASE m WHEN 'records' THEN count(*)::VARCHAR WHEN 'patients' THEN count(DISTINCT patient)::VARCHAR ELSE max(pos)::VARCHAR END AS value FROM calls, (VALUES ('records'), ('patients'), ('last')) k(m) GROUP BY m""")
def metric_rows(calls):
    return sinks.metrics(calls, records=F.count("*"), patients=F.count_distinct("patient"), last=F.max("pos"))


@query("manifest_items", "calls", """, i AS (SELECT patient, '/d/' || rid || '.vcf' AS path, CASE WHEN lane < 2 THEN '/d/' || gene_no || '.bam' END AS reads, source_set FROM calls), f AS (SELECT path FROM i WHERE path LIKE '%1.vcf' OR path LIKE '%2.vcf')
SELECT patient, path, reads, CASE WHEN path IN (SELECT path FROM f) THEN 'OK' ELSE 'MISSING' END AS status FROM i WHERE patient IN (SELECT patient FROM i WHERE source_set = 'SOMATIC')""")
def manifest_items(calls):
    """Items of a manifest, which of their files are there, and only patients of both inputs."""
    path = F.concat(F.lit("/d/"), "rid", F.lit(".vcf"))
    item = F.concat("patient", F.lit("="), path, F.when(F.col("lane") < 2, F.concat(F.lit("=/d/"), F.col("gene_no").cast("string"), F.lit(".bam"))).otherwise(""))
    items = lists.manifest(calls.select(item.alias("item")))
    files = calls.select(F.concat(F.lit("file://"), path).alias("path")).where("path like '%1.vcf' or path like '%2.vcf'")
    both = lists.common_patients(items, calls.where("source_set = 'SOMATIC'"))
    return lists.with_presence(items, files).join(both, "patient", "left_semi").select("patient", "path", "reads", "status")


@query("decided_ids", "vep", """, s AS (SELECT patient, uploaded, CASE regexp_extract(extra, '(?:^|;)STRAND=([^;]*)', 1) WHEN '1' THEN '+' WHEN '-1' THEN '-' END AS strand, ref, alt FROM vep),
k AS (SELECT patient, uploaded, count(DISTINCT strand) = 1 AND (any_value(CASE strand WHEN '+' THEN ref || '>' || alt ELSE translate(ref, 'ACGT', 'TGCA') || '>' || translate(alt, 'ACGT', 'TGCA') END)) IN ('A>G', 'C>T') AS ok FROM s GROUP BY patient, uploaded),
l AS (SELECT patient, CASE WHEN ok THEN 'keep' ELSE 'blacklist' END AS list, uploaded FROM k) SELECT * FROM l UNION SELECT NULL, list, uploaded FROM l""")
def decided_ids(vep):
    """Ids that the strand filter keeps and those it does not, by patient and over the cohort."""
    return annotate.decided_ids(annotate.strand_filter(annotate.strand_summary(vep)))


@query("tumour_ladders", "calls", r""", s AS (SELECT DISTINCT patient, lane AS idx, CASE WHEN lane = 0 THEN CASE WHEN patient < 'P12' THEN patient || '_N' ELSE 'x_DNA_NORMAL' END WHEN lane = 1 THEN CASE WHEN patient < 'P08' THEN 'a_DNA_TUMOUR' ELSE 'x_RNA' END
  WHEN lane = 2 THEN CASE WHEN patient < 'P04' THEN 'DNA_TUMOR' WHEN patient < 'P20' THEN 'tumour' ELSE 'b' END ELSE 'c' END AS sample FROM calls WHERE patient < 'P30' OR lane < 2),
z AS (SELECT patient, count(*) AS n, count(*) FILTER (WHERE contains(upper(sample), 'NORMAL') OR upper(sample) LIKE '%\_N' ESCAPE '\') AS k, max(idx) AS l FROM s GROUP BY patient),
t AS (SELECT s.*, contains(upper(sample), 'NORMAL') OR upper(sample) LIKE '%\_N' ESCAPE '\' AS nm, n, k, l, regexp_matches(upper(sample), 'TUMOU?R') AS tm FROM s JOIN z USING (patient)),
w AS (SELECT patient, idx, sample, CASE WHEN sample = 'DNA_TUMOR' THEN 0 WHEN upper(sample) IN ('TUMOR', 'TUMOUR') THEN 1 WHEN tm THEN 2 WHEN n = 2 AND k = 1 AND NOT nm THEN 3 ELSE 4 END AS r, CASE WHEN tm THEN 0 WHEN contains(upper(sample), 'RNA') THEN 1 WHEN idx = l THEN 2 ELSE 3 END AS m,
  CASE WHEN upper(sample) IN ('DNA_TUMOR', 'DNA_TUMOUR') THEN 0 WHEN regexp_matches(upper(sample), '_DNA_TUMOU?R$') THEN 1 WHEN NOT regexp_matches(upper(sample), 'DNA_NORMAL$|_N$') THEN 3 WHEN idx = l THEN 4 ELSE 5 END AS d FROM t)
SELECT 'report' AS way, patient, arg_min(sample, (r, idx)) AS sample FROM w GROUP BY patient UNION ALL SELECT 'merge', patient, arg_min(sample, (m, idx)) FROM w GROUP BY patient UNION ALL SELECT 'dna_only', patient, arg_min(sample, (d, idx)) FROM w GROUP BY patient""")
def tumour_ladders(calls):
    """The tumour column of each patient in all three ways."""
    p = F.col("patient")
    name = (
        F.when(F.col("lane") == 0, F.when(p < "P12", F.concat(p, F.lit("_N"))).otherwise("x_DNA_NORMAL")).when(F.col("lane") == 1, F.when(p < "P08", "a_DNA_TUMOUR").otherwise("x_RNA"))
        .when(F.col("lane") == 2, F.when(p < "P04", "DNA_TUMOR").when(p < "P20", "tumour").otherwise("b")).otherwise("c")
    )
    samples = calls.where("patient < 'P30' or lane < 2").select("patient", name.alias("sample"), F.col("lane").alias("idx")).distinct()
    ways = [records.tumour_column(samples, way).select(F.lit(way).alias("way"), "patient", "sample") for way in ("report", "merge", "dna_only")]
    return reduce(DataFrame.unionByName, ways)


@query("signal_samples", "calls", """ SELECT rid, CASE WHEN lane = 0 AND gt <> './.' THEN 'tumour' WHEN lane = 1 AND gt = './.' THEN 'tumour' ELSE 'rna' END AS sample, CASE WHEN lane = 0 THEN gt WHEN lane = 1 AND gt = './.' THEN '0/1' ELSE gt END AS gt FROM calls""")
def signal_samples(calls):
    """The first sample of a record, or the second where only that has a genotype."""
    sample = lambda gt: F.create_map(F.lit("GT"), gt)
    first = sample(F.when(F.col("lane") == 0, ".").otherwise(F.col("gt")))
    second = sample(F.when(F.col("lane") == 0, F.col("gt")).otherwise("0/1"))
    second = F.when(F.col("lane") < 2, second).otherwise(sample(F.lit("./.")))
    chosen = records.signal_sample(first, second, F.lit("rna"), F.lit("tumour"))
    gt = F.when((F.col("lane") == 0) & (chosen["sample"] == "rna"), F.col("gt")).otherwise(chosen["fields"]["GT"])
    return calls.select("rid", chosen["sample"].alias("sample"), gt.alias("gt"))


# --- RNA edits ------------------------------------------------------------------------------------------


def _phased_lines(calls):
    """Phased records with two samples; what they lack differs by lane, what their samples are called by patient."""
    lane, text = F.col("lane"), lambda c: F.col(c).cast("string")
    p = F.col("patient")
    ad = F.concat_ws(",", text("ad_ref"), text("ad_alt"))
    own = F.concat_ws(":", F.when(lane == 3, "./.").otherwise(F.col("gt")), F.when(lane == 0, ad).otherwise("."), F.when(lane == 1, F.concat_ws(",", text("ad_ref"), text("normal_ref"))).otherwise("."), F.when(lane == 2, "0.25").otherwise("."), F.when(lane == 1, ".").otherwise(text("ad_ref")), text("ps"))
    other = F.concat_ws(":", F.lit("0|1"), F.concat(F.lit("9,"), text("ad_alt")))
    flag = F.when((v.signature(F.col("ref"), F.col("alt")) != "OTHER") & (lane < 2), F.concat(v.signature(F.col("ref"), F.col("alt")), F.lit("_SIG")))
    info = F.concat_ws(";", flag, F.concat(F.lit("SOURCE_SET="), "source_set"), F.concat(F.lit("KNOWN_RNAEDIT_DB="), F.coalesce("known_db", F.lit("."))), F.when(lane == 0, F.concat(F.lit("ANN=T|x|HIGH|G"), (F.col("gene_no") % 9).cast("string"), F.lit("|g|t|T1|"))))
    file = F.concat(F.lit("/in/"), p, F.lit(".vcf"))
    names = F.when(p < "P10", "x_TUMOUR\tx_rna_tumor.0001").when(p < "P20", "DNA_NORMAL\tx_DNA_TUMOR").when(p < "P30", "x_DNA_NORMAL\tb").otherwise("DNA_NORMAL\tc_DNA_NORMAL")
    # the sample with the record's own numbers is the second column; where both may speak the other one stands in
    values = F.concat(F.when(p < "P10", other).otherwise("0/0"), F.lit("\t"), own)
    rows = calls.select(file.alias("file"), _line(F.col("chrom"), F.col("pos"), F.col("rid"), F.col("ref"), F.col("alt"), ".", "PASS", info, "GT:AD:FAD:AF:DP:PS", values).alias("value")).select("file", F.explode(F.array("value")).alias("value"))
    heads = calls.select("patient").distinct().select(file.alias("file"), F.concat(_line("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"), F.lit("\t"), names).alias("value"))
    return rows.unionByName(heads)


_EDITS = """, e AS (SELECT *, CASE WHEN ref || '>' || alt IN ('A>G', 'T>C') AND lane < 2 THEN 'ADAR' WHEN ref || '>' || alt IN ('C>T', 'G>A') AND lane < 2 THEN 'APOBEC3' ELSE 'OTHER' END AS sg, (lane = 3 OR gt = './.') AND patient < 'P10' AS sw FROM calls WHERE patient < 'P30'),
f AS (SELECT *, CASE WHEN sw THEN '0|1' WHEN lane = 3 THEN './.' ELSE gt END AS rna_gt, CASE WHEN sw THEN '9,' || ad_alt WHEN lane = 0 THEN ad_ref || ',' || ad_alt ELSE '' END AS rna_ad,
  CASE WHEN sw THEN ad_alt WHEN lane = 0 THEN ad_alt WHEN lane = 1 THEN normal_ref WHEN lane = 2 THEN 0.25 * ad_ref END::DOUBLE AS n,
  CASE WHEN sw THEN ad_alt / (9.0 + ad_alt) WHEN lane = 0 AND ad_ref + ad_alt > 0 THEN ad_alt::DOUBLE / (ad_ref + ad_alt) WHEN lane = 2 THEN 0.25 END AS af, CASE WHEN sw OR lane = 1 THEN NULL ELSE ad_ref END::DOUBLE AS rna_dp
  FROM e WHERE source_set = 'RNA_EDIT' OR sg <> 'OTHER' OR known_db IS NOT NULL),
cq AS (SELECT patient, chrom, pos, alt, string_agg(DISTINCT consequence, '|' ORDER BY consequence) AS c FROM vep GROUP BY ALL),
ec AS (SELECT patient, chrom, pos, ref, alt, coalesce(c, '') AS "Consequence", sg AS signature, CASE WHEN sw THEN 'x_TUMOUR' WHEN patient < 'P10' THEN 'x_rna_tumor.0001' WHEN patient < 'P20' THEN 'x_DNA_TUMOR' ELSE 'b' END AS rna_sample, rna_gt, rna_ad, round(n, 3) AS rna_alt_count, round(af, 6) AS rna_af, rna_dp,
  CASE WHEN sw THEN '' ELSE ps::VARCHAR END AS ps, '' AS pid, CASE WHEN lane = 0 THEN 'G' || (gene_no % 9) ELSE '' END AS gene, CASE WHEN lane = 0 THEN 'T1' ELSE '' END AS transcript, source_set, coalesce(known_db, '.') AS known_db, rid
  FROM f LEFT JOIN cq USING (patient, chrom, pos, alt) WHERE n IS NULL OR n >= 10)"""


def _edit_calls(calls, vep):
    places = vep.select("patient", F.col("location").alias("Location"), F.col("allele").alias("Allele"), F.col("consequence").alias("Consequence"))
    records = text.records_of(_phased_lines(calls))
    return edits.edit_calls(records.withColumn("rid", F.col("id")), places)


@query("edit_calls", "calls vep", _EDITS + " SELECT * FROM ec")
def edit_calls(calls, vep):
    """From lines of records to the table of edits, annotation included."""
    return _edit_calls(calls, vep)


@query("edit_call_clusters", "calls vep", _EDITS + """, s AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY patient, chrom ORDER BY pos, rid) <= 33 THEN 0 ELSE 1 END AS nw FROM ec),
n AS (SELECT *, sum(nw) OVER (PARTITION BY patient, chrom ORDER BY pos, rid ROWS UNBOUNDED PRECEDING) AS no FROM s), mm AS (SELECT * FROM n QUALIFY count(*) OVER (PARTITION BY patient, chrom, no) >= 2),
fi AS (SELECT patient, chrom, min(rid) AS f FROM s GROUP BY ALL), pf AS (SELECT patient, min(f) AS f FROM fi GROUP BY ALL),
nr AS (SELECT patient, chrom, no, format('CL{:06d}', row_number() OVER (ORDER BY pf.f, fi.f, no)) AS cluster_id FROM (SELECT DISTINCT patient, chrom, no FROM mm) JOIN fi USING (patient, chrom) JOIN pf USING (patient)),
gn AS (SELECT patient, chrom, no, gene, count(*) AS c, min((pos, rid)) AS first FROM mm WHERE gene <> '' GROUP BY ALL), tg AS (SELECT patient, chrom, no, gene AS top_gene FROM gn QUALIFY row_number() OVER (PARTITION BY patient, chrom, no ORDER BY c DESC, first) = 1)
SELECT cluster_id, mm.patient, mm.chrom, min(pos) AS start, max(pos) AS "end", count(*) AS n_variants, count(*) FILTER (WHERE signature = 'ADAR') AS adar_count, count(*) FILTER (WHERE signature = 'APOBEC3') AS apobec_count, count(*) FILTER (WHERE signature = 'OTHER') AS other_count,
  round(coalesce(avg(rna_dp), 0), 3) AS mean_rna_dp, (count(DISTINCT ps) FILTER (WHERE ps <> '') = 1)::INT AS single_ps_block, coalesce(any_value(top_gene), '') AS top_gene, CASE WHEN count(*) FILTER (WHERE transcript <> '') > 0 THEN 'T1' ELSE '' END AS top_transcript
FROM mm JOIN nr USING (patient, chrom, no) LEFT JOIN tg USING (patient, chrom, no) GROUP BY cluster_id, mm.patient, mm.chrom""")
def edit_call_clusters(calls, vep):
    """The clusters of that table."""
    return clusters.summarised_clusters(_edit_calls(calls, vep).withColumn("dp", F.col("rna_dp")))
