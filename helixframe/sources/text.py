"""Readers of the text tables: variant records, annotation tables, gene features, coverage, sample sheets, sequences.

Paths and globs go to Spark's own text reader, plain or gzip. A gzip file is one split, so
large ones are best read once and kept as Parquet. Every reader keeps the file name, from
which ``patient_of`` takes the patient.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.variant import EXONIC, VEP_COLUMNS, chrom_norm, format_map, patient_name

RECORD = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format")


def patient_of(file: Column, pattern: str = r"([^/.]+)[^/]*$") -> Column:
    """The patient in a file's name: the first group of ``pattern``."""
    return F.regexp_extract(file, pattern, 1)


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of text files: ``value`` without carriage return, ``file``, and ``place``, which orders the lines of a file."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select(F.regexp_replace("value", r"\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"), place.alias("place"))


def _fields(line: Column, least: int) -> Column:
    """Tab-split fields; split at any white space where tabs give too few."""
    tabs = F.split(line, "\t")
    return F.when(F.size(tabs) >= least, tabs).otherwise(F.split(F.trim(line), r"\s+"))


def _split(lines: DataFrame, fields: Column, least: int = 0) -> DataFrame:
    """``file`` and ``f``: the fields of each line, split once (a generated row: filters are not pushed through it and do not split again), of lines with at least ``least``."""
    return lines.select("file", fields.alias("f")).select("file", F.explode(F.array("f")).alias("f")).where(F.size("f") >= least)


def records_of(lines: DataFrame, least: int = 8, patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """Variant records: ``patient``, ``file``, the nine fixed fields and ``samples``, an array of (sample, value) in column order.

    Lines with ## are skipped; the #CHROM line of each file names its samples, also behind a byte
    order mark, NULs or blanks. Rows with fewer than ``least`` fields are left out; a position
    that is no number becomes null. A file without #CHROM line fails where ``samples`` is read.
    """
    clean = F.regexp_replace("value", r"^[\uFEFF\x00\s]+", "")
    named = lines.where(F.contains("value", F.lit("#CHROM")) & F.col("value").rlike(r"^[\uFEFF\x00\s]*#CHROM(\s|$)"))
    header = named.groupBy("file").agg(F.min(clean).alias("header")).select("file", _fields(F.col("header"), 10).alias("names"))
    rows = _split(lines.where(F.col("value").rlike(r"^[\uFEFF\x00\s]*[^#\uFEFF\x00\s]")), _fields(F.col("value"), least), least)
    # one short row a file
    rows = rows.join(F.broadcast(header), "file", "left")
    known = F.coalesce("names", F.raise_error(F.concat(F.lit("no #CHROM line in "), "file")).cast("array<string>"))
    n = F.greatest(F.least(F.size(known), F.size("f")) - 9, F.lit(0))
    samples = F.zip_with(F.slice(known, F.lit(10), n), F.slice("f", F.lit(10), n), lambda s, v: F.struct(s.alias("sample"), v.alias("value")))
    part = {name: F.get("f", F.lit(i)) for i, name in enumerate(RECORD)}
    part["pos"] = part["pos"].try_cast("long")
    return rows.select(patient_of(F.col("file"), patient).alias("patient"), "file", *(c.alias(name) for name, c in part.items()), samples.alias("samples"))


def read_records(spark: SparkSession, path: str | list[str], least: int = 8, patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """``records_of`` of text files."""
    return records_of(lines_of(spark, path), least, patient)


def long_calls(records: DataFrame) -> DataFrame:
    """One row per record and sample: ``sample``, ``sample_idx`` and ``values`` (FORMAT key to value; keys without a value are dropped)."""
    keep = [c for c in records.columns if c != "samples"]
    out = records.select(*keep, F.posexplode("samples").alias("sample_idx", "s"))
    return out.select(*keep, "sample_idx", F.col("s.sample").alias("sample"), format_map(F.col("format"), F.col("s.value")).alias("values"))


def annotation_of(lines: DataFrame, patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """Annotation rows: ``patient``, ``file`` and the fourteen standard columns.

    Columns are found by the names in each file's #Uploaded_variation line, or by their
    standard order where a file has none. Short rows are filled with empty strings.
    """
    header = lines.where(F.col("value").startswith("#Uploaded_variation")).groupBy("file").agg(F.split(F.substr(F.min("value"), F.lit(2)), "\t").alias("names"))
    # names are looked up once a file, which has one short row
    places = header.select("file", F.array(*(F.array_position("names", c).cast("int") - 1 for c in VEP_COLUMNS)).alias("at"))
    rows = _split(lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")), F.split("value", "\t")).join(F.broadcast(places), "file", "left")
    rows = rows.withColumn("at", F.coalesce("at", F.lit(list(range(len(VEP_COLUMNS))))))
    field = lambda i, c: F.coalesce(F.get("f", F.get("at", F.lit(i))), F.lit("")).alias(c)
    return rows.select(patient_of(F.col("file"), patient).alias("patient"), "file", *(field(i, c) for i, c in enumerate(VEP_COLUMNS)))


def read_annotation(spark: SparkSession, path: str | list[str], patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """``annotation_of`` of text files."""
    return annotation_of(lines_of(spark, path), patient)


def annotation_fields_of(lines: DataFrame, patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """Annotation rows by place, whatever the header says: ``patient``, ``file``, ``Location``, ``Allele``, ``Consequence`` and ``Extra``.

    These are fields 2, 3, 7 and 14. Lines with # and lines of fewer than seven fields are left out; of
    shorter ones than fourteen ``Extra`` is empty. Locations and alleles are trimmed.
    """
    rows = _split(lines.where(~F.col("value").startswith("#")), F.split("value", "\t"), 7)
    at = lambda i, name: F.coalesce(F.get("f", F.lit(i)), F.lit("")).alias(name)
    out = rows.select(patient_of(F.col("file"), patient).alias("patient"), "file", at(1, "Location"), at(2, "Allele"), at(6, "Consequence"), at(13, "Extra"))
    return out.withColumns({c: F.trim(c) for c in ("Location", "Allele", "Consequence")})


def read_annotation_fields(spark: SparkSession, path: str | list[str], patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """``annotation_fields_of`` of text files."""
    return annotation_fields_of(lines_of(spark, path), patient)


def alignments_of(lines: DataFrame, patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """Aligned reads from their text form: ``patient``, ``file``, ``contig``, ``pos0``, ``flag``, ``mapq``, ``cigar``, ``seq`` and ``quals``.

    Header lines (@), lines of fewer than eleven fields and reads without a place are left out. ``quals`` is null where
    the field is ``*``. Which reads count is for ``strand.alt_support`` to say.
    """
    rows = lines.where(~F.col("value").startswith("@")).select("file", F.split("value", "\t").alias("f")).where(F.size("f") >= 11)
    at = lambda i: F.get("f", F.lit(i))
    quals = F.when(at(10) != "*", F.transform(F.filter(F.split(at(10), ""), lambda c: c != ""), lambda c: F.ascii(c) - 33))
    number = lambda i, kind: at(i).try_cast(kind)
    out = rows.select(
        patient_of(F.col("file"), patient).alias("patient"), "file", at(2).alias("contig"), (number(3, "long") - 1).alias("pos0"), number(1, "int").alias("flag"),
        number(4, "int").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"), quals.alias("quals"),
    )
    return out.where("contig <> '*' and pos0 >= 0 and flag is not null and mapq is not null")


def read_alignments(spark: SparkSession, path: str | list[str], patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """``alignments_of`` of text files."""
    return alignments_of(lines_of(spark, path), patient)


def features_of(lines: DataFrame) -> DataFrame:
    """Gene features as half-open intervals: ``chrom``, ``start0``, ``end0``, ``feature``, ``tier`` (exonic, transcript), ``strand``.

    Other features, and those whose strand is neither + nor -, are left out.
    """
    f = lines.where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    tier = F.when(at(2).isin(*EXONIC), "exonic").when(at(2) == "transcript", "transcript")
    out = f.select(at(0).alias("chrom"), (at(3).try_cast("long") - 1).alias("start0"), at(4).try_cast("long").alias("end0"), at(2).alias("feature"), tier.alias("tier"), at(6).alias("strand"))
    return out.where("tier is not null and strand in ('+', '-') and start0 is not null and end0 is not null")


def read_features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``features_of`` of text files."""
    return features_of(lines_of(spark, path))


def coverage_of(lines: DataFrame, patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """Coverage intervals: ``patient``, ``chrom``, ``start_pos``, ``end_pos``, ``label``, ``cov``; ``lines`` have their ``label``. Further fields are not kept; lines with # and those without numbers are left out."""
    f = lines.where(~F.col("value").startswith("#")).select("file", "label", F.split("value", "\t").alias("f"))
    number = lambda i, kind: F.get("f", F.lit(i)).try_cast(kind)
    out = f.select(patient_of(F.col("file"), patient).alias("patient"), F.get("f", F.lit(0)).alias("chrom"), number(1, "long").alias("start_pos"), number(2, "long").alias("end_pos"), "label", number(3, "double").alias("cov"))
    return out.where("start_pos is not null and end_pos is not null and cov is not null")


def read_coverage(spark: SparkSession, paths: dict[str, str | list[str]], patient: str = r"([^/.]+)[^/]*$") -> DataFrame:
    """``coverage_of`` the text files of each label."""
    labelled = [lines_of(spark, path).withColumn("label", F.lit(label)) for label, path in paths.items()]
    return coverage_of(reduce(DataFrame.unionByName, labelled), patient)


def known_sites_of(lines: DataFrame) -> DataFrame:
    """Known sites: ``chrom``, ``pos``, ``ref``, ``alt``, ``known_db``; lines with # and those without a position are left out."""
    f = lines.where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    return f.select(at(0).alias("chrom"), at(1).try_cast("long").alias("pos"), at(2).alias("ref"), at(3).alias("alt"), at(4).alias("known_db")).where("pos is not null")


def read_known_sites(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``known_sites_of`` of text files."""
    return known_sites_of(lines_of(spark, path))


def patients_of(lines: DataFrame, labels: list[str], selected: list[str] | None = None) -> DataFrame:
    """``patient`` and ``place`` (that of the first mention) of a sample sheet, whose ``lines`` have a ``place`` that orders them.

    The first field of a line is a sample; lines that are blank or start with # are skipped. ``selected``
    may name samples or patients.
    """
    rows = lines.select(F.get(F.split(F.trim("value"), r"[,\t ]+"), F.lit(0)).alias("sample"), "place")
    rows = rows.where((F.col("sample") != "") & ~F.col("sample").startswith("#")).withColumn("patient", patient_name(F.col("sample"), labels))
    rows = rows.where("patient <> ''")
    if selected is not None:
        rows = rows.where(F.col("sample").isin(*selected) | F.col("patient").isin(*selected))
    return rows.groupBy("patient").agg(F.min("place").alias("place"))


def read_patients(spark: SparkSession, path: str, labels: list[str], selected: list[str] | None = None) -> DataFrame:
    """``patients_of`` a sample sheet."""
    return patients_of(lines_of(spark, path), labels, selected)
