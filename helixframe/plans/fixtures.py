"""Variant tables as projections of the given star-schema tables, in SQL text that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_POS = "CAST(1 + (l_partkey*61 + l_linenumber*7919 + l_orderkey*13) % 8000 AS BIGINT)"

#: One row per call: position, alleles, counts, genotype; rid orders rows that repeat a key.
CALLS = f"""
SELECT 'P' || lpad(CAST(l_orderkey % 40 AS STRING), 2, '0') AS patient,
  'chr' || CAST(1 + l_suppkey % 22 AS STRING) AS chrom,
  {_POS} AS pos,
  substr('ACGT', CAST(1 + l_linenumber % 4 AS INT), 1) AS ref,
  substr('ACGT', CAST(1 + (l_linenumber + 1 + CAST(l_quantity AS INT) % 3) % 4 AS INT), 1) AS alt,
  CASE l_returnflag WHEN 'A' THEN 'GERMLINE' WHEN 'N' THEN 'SOMATIC' ELSE 'RNA_EDIT' END AS source_set,
  CAST(l_quantity AS INT) AS ad_ref, CAST(round(l_tax*100) AS INT) * 2 AS ad_alt,
  CASE CAST(round(l_discount*100) AS INT) % 5 WHEN 0 THEN '1/1' WHEN 1 THEN '0/1' WHEN 2 THEN '0|1' WHEN 3 THEN '1|0' ELSE './.' END AS gt,
  {_POS} - {_POS} % 500 AS ps,
  CASE WHEN l_partkey % 3 = 0 THEN 'KNOWN' END AS known_db,
  CAST(l_partkey % 9 AS INT) AS normal_ref, CAST(l_suppkey % 3 AS INT) AS normal_alt,
  CAST(l_linenumber % 4 AS INT) AS lane,
  l_partkey AS gene_no,
  lpad(CAST(l_orderkey AS STRING), 12, '0') || '-' || CAST(l_linenumber AS STRING) || '-' || lpad(CAST(l_partkey AS STRING), 10, '0') || '-' || lpad(CAST(l_suppkey AS STRING), 9, '0') || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) AS rid
FROM lineitem"""

_SITE = "CAST(1 + (l_partkey*61 + l_linenumber*7919 + l_orderkey*13) % 500 AS BIGINT)"
_BASES = "repeat('ACGTTGCAGATC', 43)"

#: Records of few positions, many to one: the bases of a position are the same for all, references are one to three bases long, and a fifth have two alternates.
SITES = f"""
SELECT patient, chrom, pos, ref, CASE WHEN kind = 0 THEN substr(ref, 1, 1) WHEN kind = 1 THEN ref || 'TT' WHEN kind = 2 THEN ref || ',' || substr(ref, 1, 1) WHEN kind = 3 THEN substr(replace('ACGT', substr(ref, 1, 1), ''), pick, 1) || substr(ref, 2)
    ELSE substr(replace('ACGT', ref, ''), pick, 1) END AS alt,
  source_set, CASE WHEN kind = 2 AND g = 1 THEN '1/2' WHEN kind = 2 AND g = 2 THEN '2|0' ELSE split_part('1/1,0/1,0|1,1|0,./.,0|.', ',', g + 1) END AS gt, ps, ad_ref, ad_alt, ad_alt + 1 AS ad_more, kind, rid
FROM (
  SELECT 'P' || CAST(l_orderkey % 8 AS STRING) AS patient, 'chr' || CAST(1 + l_suppkey % 4 AS STRING) AS chrom, {_SITE} AS pos, CAST(l_partkey % 5 AS INT) AS kind,
    substr({_BASES}, CAST({_SITE} AS INT), CASE CAST(l_partkey % 5 AS INT) WHEN 0 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END) AS ref, CAST(1 + l_linenumber % 3 AS INT) AS pick,
    CASE l_returnflag WHEN 'A' THEN 'GERMLINE' WHEN 'N' THEN 'SOMATIC' ELSE 'RNA_EDIT' END AS source_set, CAST(round(l_discount*100) AS INT) % 6 AS g, {_SITE} - {_SITE} % 100 AS ps,
    CAST(l_quantity AS INT) AS ad_ref, CAST(round(l_tax*100) AS INT) * 2 AS ad_alt,
    lpad(CAST(l_orderkey AS STRING), 12, '0') || '-' || CAST(l_linenumber AS STRING) || '-' || lpad(CAST(l_partkey AS STRING), 10, '0') || '-' || lpad(CAST(l_suppkey AS STRING), 9, '0') || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) AS rid
  FROM lineitem) x"""

#: Lines of sequence files in blocks: names, lines of 1 to 50 bases, and some that are empty.
LINES = """
SELECT 'f' || CAST(l_suppkey % 3 AS STRING) AS file, CAST(l_orderkey - l_orderkey % 500 AS BIGINT) AS block,
  lpad(CAST(l_orderkey AS STRING), 12, '0') || '-' || CAST(l_linenumber AS STRING) || '-' || lpad(CAST(l_partkey AS STRING), 10, '0') || '-' || lpad(CAST(l_suppkey AS STRING), 9, '0') || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) AS line,
  CASE WHEN l_partkey % 97 = 0 THEN '>chr' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) || ' of ' || CAST(l_suppkey AS STRING) WHEN l_partkey % 31 = 0 THEN ''
    ELSE substr(repeat('acgtTGCAGATC', 6), CAST(1 + l_partkey % 12 AS INT), CAST(l_quantity AS INT)) END AS value
FROM lineitem"""

#: Coverage intervals of three labels, one row per patient, interval and label.
COVERAGE = """
SELECT patient, chrom, st AS start_pos, st + 500 AS end_pos, label, CAST(avg(q) AS DOUBLE) AS cov FROM (
  SELECT 'P' || lpad(CAST(l_orderkey % 8 AS STRING), 2, '0') AS patient, 'chr' || CASE WHEN l_suppkey % 24 = 23 THEN 'Un_1' ELSE CAST(1 + l_suppkey % 24 AS STRING) END AS chrom,
    CAST((l_partkey % 40) * 500 AS BIGINT) AS st, CASE CAST(l_linenumber % 3 AS INT) WHEN 0 THEN 'DN' WHEN 1 THEN 'DT' ELSE 'RT' END AS label, CAST(l_quantity AS DOUBLE) AS q FROM lineitem) x
GROUP BY patient, chrom, st, label"""

#: Gene features: 0-based half-open intervals with a strand, in two tiers.
GTF = """
SELECT 'chr' || CAST(1 + s_suppkey % 22 AS STRING) AS chrom, CAST((s_suppkey * 37) % 8000 AS BIGINT) AS start0, CAST((s_suppkey * 37) % 8000 + 150 + s_suppkey % 400 AS BIGINT) AS end0,
  CASE WHEN s_suppkey % 3 = 0 THEN 'transcript' ELSE 'exon' END AS feature, CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM supplier"""

#: Aligned reads of 50 bases.
READS = """
SELECT 'P' || lpad(CAST(o_orderkey % 40 AS STRING), 2, '0') AS patient, 'chr' || CAST(1 + o_custkey % 22 AS STRING) AS contig, CAST((o_orderkey * 29) % 8000 AS BIGINT) AS pos0,
  CAST(CASE o_orderkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 16 WHEN 2 THEN 83 WHEN 3 THEN 99 WHEN 4 THEN 147 WHEN 5 THEN 163 ELSE 1024 END AS INT) AS flag, CAST(o_custkey % 61 AS INT) AS mapq,
  CASE o_orderkey % 4 WHEN 0 THEN '50M' WHEN 1 THEN '10S40M' WHEN 2 THEN '20M2D30M' ELSE '30M100N15M5S' END AS cigar,
  repeat(substr('ACGTTGCAAC', CAST(1 + o_custkey % 6 AS INT), 5), 10) AS seq, CAST(15 + o_orderkey % 20 AS INT) AS qual
FROM orders"""

#: Annotation rows: one to three transcripts of each call that is not germline.
VEP = """
SELECT patient, chrom, pos, ref, alt, chrom || '_' || CAST(pos AS STRING) || '_' || ref || '/' || alt AS uploaded, t,
  'G' || CAST(gene_no % 50 AS STRING) AS gene, 'T' || CAST((gene_no * 3 + t) % 997 AS STRING) AS feature,
  CASE WHEN (gene_no + t) % 7 = 0 THEN 'RegulatoryFeature' ELSE 'Transcript' END AS feature_type,
  CASE CAST((gene_no + t) % 5 AS INT) WHEN 0 THEN 'frameshift_variant' WHEN 1 THEN 'splice_region_variant,inframe_deletion' WHEN 2 THEN 'missense_variant' WHEN 3 THEN 'synonymous_variant' ELSE 'intron_variant,NMD_transcript_variant' END AS consequence,
  CASE WHEN (gene_no + t) % 4 = 0 THEN '-' ELSE CAST(gene_no % 300 AS STRING) END AS protein_position,
  CASE WHEN (gene_no + t) % 4 = 0 THEN '-' ELSE substr('KRHDE', CAST(1 + gene_no % 5 AS INT), 1) || '/' || substr('AVLIM', CAST(1 + (gene_no + t) % 5 AS INT), 1) END AS amino_acids,
  'STRAND=' || CASE WHEN (gene_no + t * (gene_no % 2)) % 2 = 0 THEN '1' ELSE '-1' END || ';SYMBOL=S' || CAST(gene_no % 50 AS STRING) || CASE WHEN t = 0 THEN ';CANONICAL=YES' ELSE '' END || CASE WHEN t = 2 THEN ';FLAGS=cds_start_NF' ELSE '' END || ';BIOTYPE=' || CASE WHEN gene_no % 6 = 0 THEN 'lncRNA' ELSE 'protein_coding' END AS extra, rid,
  chrom || '_' || CAST(pos AS STRING) || '_' || ref || '/' || alt AS uploaded_variation, chrom || ':' || CAST(pos AS STRING) || CASE WHEN gene_no % 5 = 0 THEN '-' || CAST(pos + 1 AS STRING) ELSE '' END AS location, alt AS allele,
  CASE WHEN gene_no % 4 = 1 THEN '.' ELSE 'a' || ref || 'g/a' || alt || 'g' END AS codons, CASE WHEN gene_no % 3 = 0 THEN '-' ELSE 'rs' || CAST(gene_no % 77 AS STRING) END AS existing_variation
FROM ({calls}) c JOIN (SELECT 0 AS m, 0 AS t UNION ALL SELECT 1, 0 UNION ALL SELECT 1, 1 UNION ALL SELECT 2, 0 UNION ALL SELECT 2, 1 UNION ALL SELECT 2, 2) k ON c.gene_no % 3 = k.m
WHERE source_set <> 'GERMLINE'"""

TABLES = {"calls": (CALLS, "lineitem"), "sites": (SITES, "lineitem"), "lines": (LINES, "lineitem"), "coverage": (COVERAGE, "lineitem"), "gtf": (GTF, "supplier"), "reads": (READS, "orders"), "vep": (VEP.format(calls=CALLS), "lineitem")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The projection ``name`` over the Parquet tables of ``sf_dir``."""
    text, base = TABLES[name]
    return spark.sql(text.replace(f"FROM {base}", "FROM {base}"), base=spark.read.parquet(f"{sf_dir}/{base}.parquet"))


def with_tables(sql: str, *names: str) -> str:
    """DuckDB SQL with the projections as common table expressions."""
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n][0]})" for n in names) + ("," if sql.lstrip()[:1] == "," else "") + sql.lstrip().lstrip(",")
