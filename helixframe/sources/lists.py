"""Small text inputs as tables: input manifests, key-value maps, typing reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings of a typing allele, in the order in which a line is searched for them.
STAR, TRIPLE, PAIR = r"HLA-[A-Za-z0-9]+\*[0-9]+:[0-9]+", r"HLA-[A-Za-z0-9]+:[0-9]+:[0-9]+", r"HLA-[A-Za-z0-9]+:[0-9]+"


def manifest(items: DataFrame, item: str = "item") -> DataFrame:
    """``patient``, ``path``, ``reads`` of ``PATIENT=PATH`` or ``PATIENT=PATH=READS``; an item without = is an error, a null item gives no row."""
    parts = F.split(F.col(item), "=", 3)
    rows = items.where(F.col(item).isNotNull()).select(F.when(F.size(parts) > 1, parts).otherwise(F.raise_error(F.concat(F.lit("not PATIENT=PATH: "), F.col(item)))).alias("p"))
    return rows.select(F.get("p", F.lit(0)).alias("patient"), F.get("p", F.lit(1)).alias("path"), F.get("p", F.lit(2)).alias("reads"))


def _bare(path: Column) -> Column:
    """A path without scheme and host."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def listed_files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """``path`` and ``bytes`` of every file in or below ``folder``; the files themselves are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def with_presence(items: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """``items`` with ``status``: OK, or MISSING if no file of ``files`` (see ``listed_files``) has its path, which is to be reported and skipped.

    Paths are compared without scheme and host, so they should be absolute. Repeated files repeat no item; a null path is MISSING.
    """
    there = files.select(_bare(F.col("path")).alias("__p"), F.lit(True).alias("__there")).distinct()
    rows = items.withColumn("__p", _bare(F.col(path))).join(there, "__p", "left")
    return rows.withColumn("status", F.when(F.col("__there"), "OK").otherwise("MISSING")).drop("__p", "__there")


def stage_outputs(patients: DataFrame, files: DataFrame, templates: dict[str, str], ending: str = ".vcf.gz") -> DataFrame:
    """``patient``, ``stage``, ``path`` of the stage outputs that exist, for ``alternates.first_stage`` and ``proximity_source``.

    A template is an absolute path in which ``{patient}`` stands for the patient; one that ends in neither .vcf nor
    .vcf.gz gets ``ending``. Empty templates name nothing.
    """
    full = {k: t if t.endswith((".vcf", ".vcf.gz")) else t + ending for k, t in templates.items() if t}
    if not full:
        return patients.select("patient", F.lit("").alias("stage"), F.lit("").alias("path")).limit(0)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("stage"), F.replace(F.lit(t), F.lit("{patient}"), F.col("patient")).alias("path")) for k, t in full.items())))
    asked = patients.select("patient").where("patient is not null").distinct().select("patient", each.alias("s")).select("patient", "s.*")
    return with_presence(asked, files).where("status = 'OK'").drop("status")


def common_patients(a: DataFrame, b: DataFrame) -> DataFrame:
    """Patients that both tables name."""
    return a.select("patient").intersect(b.select("patient"))


def skipped_patients(a: DataFrame, b: DataFrame) -> DataFrame:
    """Patients that only ``a`` names."""
    return a.select("patient").distinct().join(b.select("patient"), "patient", "left_anti")


def first_values(lines: DataFrame, key: str = "key", value: str = "value", line_no: str = "line_no") -> DataFrame:
    """The value of each key's first line."""
    return lines.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, line_no).alias(value))


def _found(line: Column) -> Column:
    after = lambda text, pattern: F.regexp_replace(text, f"^.*{pattern}", "")
    every = lambda text, pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    second = after(line, STAR)
    return F.concat(F.transform(every(line, STAR), lambda h: F.replace(h, F.lit("*"), F.lit(":"))), every(second, TRIPLE), every(after(second, TRIPLE), PAIR))


def typing_alleles(lines: DataFrame) -> DataFrame:
    """``patient``, ``alleles``: different alleles joined by commas, in order of first mention.

    ``lines`` has ``patient``, ``line_no`` and ``line``. A line is searched for starred alleles, what follows
    the last of them for triples, what follows those for pairs; a star is written as a colon. Null lines
    hold none; patients without an allele get an empty text.
    """
    found = lines.select("patient", "line_no", F.posexplode_outer(_found(F.col("line"))).alias("place", "allele"))
    first = found.groupBy("patient", "allele").agg(F.min(F.struct("line_no", "place")).alias("first"))
    named = F.collect_list(F.when(F.col("allele").isNotNull(), F.struct("first", "allele")))
    return first.groupBy("patient").agg(F.array_join(F.transform(F.array_sort(named), lambda x: x["allele"]), ",").alias("alleles"))
