"""Records with several alternates: one row per alternate with its own metrics; back-filled frequencies; choice of a stage per patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at(text: Column, i: Column) -> Column:
    """Element ``i`` of a comma list as a number; null if it has none."""
    return F.get(F.split(text, ","), i).try_cast("double")


def _total(text: Column) -> Column:
    """Sum of a comma list; empty and ``.`` elements do not count, any other text voids the sum."""
    parts = F.transform(F.filter(F.split(text, ","), lambda x: ~x.isin("", ".")), lambda x: x.try_cast("double"))
    return F.when((F.size(parts) > 0) & ~F.exists(parts, lambda x: x.isNull()), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))


def alternate_metrics(i: Column, ad: Column, fad: Column, dp: Column, af: Column) -> dict[str, Column]:
    """Depth, allele frequency and alternate count of alternate ``i`` (from 0), from the text fields of a sample.

    Depth: the field, else the sum of AD, else of FAD. Frequency: its own element of AF (one value
    serves all), else AD over reference plus alternate. Count: AD, else FAD, else frequency times depth. Count of the reference: AD, else FAD.
    """
    depth = F.coalesce(dp.try_cast("double"), _total(ad), _total(fad))
    ref, alt = _at(ad, F.lit(0)), _at(ad, i + 1)
    given = F.when(F.size(F.split(af, ",")) == 1, af.try_cast("double")).otherwise(_at(af, i))
    share = F.coalesce(given, F.when(ref + alt > 0, alt / (ref + alt)))
    return {"depth": depth, "share": share, "alt_count": F.coalesce(alt, _at(fad, i + 1), share * depth), "ref_count": F.coalesce(ref, _at(fad, F.lit(0)))}


def per_alternate(records: DataFrame, alts: str = "alts") -> DataFrame:
    """One row per alternate of the comma list ``alts``: ``alt``, ``alt_index``, and ``depth``, ``share``, ``alt_count``, ``ref_count`` of ``ad``, ``fad``, ``dp``, ``af``.

    A record without alternates keeps one row with null alternate. Further columns stay.
    """
    rows = records.select("*", F.posexplode_outer(F.split(alts, ",")).alias("alt_index", "alt"))
    return rows.withColumns(alternate_metrics(*(F.col(c) for c in ("alt_index", "ad", "fad", "dp", "af"))))


def enough_alternates(alt_count: Column, least: int = 10) -> Column:
    """Whether the count reaches ``least``; an unknown count passes."""
    return F.coalesce(alt_count >= least, F.lit(True))


def edit_record(source_set: Column, signature: Column, known_db: Column) -> Column:
    """Whether a record counts as RNA edit: by its sources, a signature (not OTHER), or a known site."""
    return F.coalesce(F.contains(source_set, F.lit("RNA_EDIT")), F.lit(False)) | F.coalesce(signature != "OTHER", F.lit(False)) | F.coalesce(~known_db.isin("", "."), F.lit(False))


def backfill_af(phased: DataFrame, before: DataFrame) -> DataFrame:
    """Phased rows with ``af`` of the last row (by rid) of ``before`` at their patient, chromosome and position; null where there is none."""
    last = before.groupBy("patient", "chrom", "pos").agg(F.max_by("af", "rid").alias("af"))
    return phased.where(F.contains("gt", F.lit("|"))).drop("af").join(last, ["patient", "chrom", "pos"], "left")


def first_stage(outputs: DataFrame, order: list[str]) -> DataFrame:
    """``patient``, ``stage``, ``path`` of the first stage in ``order`` that a patient has an output of; other stages do not count."""
    rank = F.array_position(F.lit(order), F.col("stage"))
    there = outputs.where("path is not null").withColumn("rank", rank).where("rank > 0")
    return there.groupBy("patient").agg(F.min(F.struct("rank", "stage", "path")).alias("m")).select("patient", "m.stage", "m.path")


def proximity_source(patients: DataFrame, outputs: DataFrame, order: list[str], mode: str = "auto") -> DataFrame:
    """Each patient's ``stage`` and ``path`` of ``first_stage``, and ``status``: USED, NONE_FOUND (auto), REQUESTED_NOT_FOUND (1) or DISABLED (0).

    ``mode`` is auto, or 1 (true, yes, on), or 0 (false, no, off), in either case; only USED goes beyond DNA. Any other mode is an error.
    """
    word = mode.lower()
    if word not in ("auto", "1", "true", "yes", "on", "0", "false", "no", "off"):
        raise ValueError(f"mode {mode!r} is none of auto, 1, 0")
    off = word in ("0", "false", "no", "off")
    found = first_stage(outputs.limit(0) if off else outputs, order)
    none = "DISABLED" if off else "NONE_FOUND" if word == "auto" else "REQUESTED_NOT_FOUND"
    every = patients.select("patient").distinct().join(found, "patient", "left")
    return every.withColumn("status", F.when(F.col("stage").isNotNull(), "USED").otherwise(none))


def routes(patients: DataFrame, with_rna: DataFrame, allow_with_rna: bool = False) -> DataFrame:
    """``route`` of each patient: three_way with RNA calls, else dna_only (or dna_only for all, if allowed)."""
    has = with_rna.select("patient", F.lit(True).alias("__has")).distinct()
    route = F.when(F.col("__has") & F.lit(not allow_with_rna), "three_way").otherwise("dna_only")
    return patients.select("patient").distinct().join(has, "patient", "left").select("patient", route.alias("route"))
