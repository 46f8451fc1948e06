"""RNA edits of phased records: from whole records to the table that clusters are built of."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as v
from .alternates import edit_record, enough_alternates

#: The columns of the table, in order.
COLUMNS = ("patient", "chrom", "pos", "ref", "alt", "Consequence", "signature", "rna_sample", "rna_gt", "rna_ad", "rna_alt_count", "rna_af", "rna_dp", "ps", "pid", "gene", "transcript", "source_set", "known_db")
RNA, TUMOUR, NORMAL = ("RNA_TUMOR",), ("TUMOR", "DNA_TUMOR", "DNA_TUMOUR"), ("DNA_NORMAL",)


def _answers(name: Column, labels: tuple[str, ...], ending: str = r"(\.|$)") -> Column:
    """Whether a sample name is a label, ends with ``_label``, or has a lane behind it; TUMOR and TUMOUR are one, case does not matter."""
    spelt = "|".join(re.escape(x).replace("TUMOUR", "TUMOR").replace("TUMOR", "TUMOU?R") for x in labels)
    return name.rlike(f"(?i)(_|^)({spelt}){ending}")


def signal_names(names: Column, requested: str = "", rna: tuple[str, ...] = RNA, tumour: tuple[str, ...] = TUMOUR, normal: tuple[str, ...] = NORMAL) -> tuple[Column, Column]:
    """The sample of an array of ``names`` that speaks for its records, and the one that stands in for it (null if there is no other).

    The first: that requested, else one that answers to an RNA label, to a tumour label, or else is no normal. The second: one that answers to
    a tumour label, or is no normal. Of several the first in order counts; null where none fits.
    """
    first = lambda ok: F.get(F.filter(names, ok), F.lit(0))
    of_tumour = F.coalesce(first(lambda s: _answers(s, tumour)), first(lambda s: ~_answers(s, normal, "$")))
    asked = first(lambda s: s == requested) if requested else F.lit(None).cast("string")
    chosen = F.coalesce(asked, first(lambda s: _answers(s, rna)), of_tumour)
    return chosen, F.when(of_tumour != chosen, of_tumour)


def _bound(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with each column as ``__name``, worked out once: a generated row, which later filters are not pushed through, so that they do not repeat the expressions.

    They are worked out beneath it, in compiled code; the generator itself may be interpreted.
    """
    own, known = rows.columns, rows.withColumns({f"__bound_{n}": c for n, c in columns.items()})
    one = F.explode(F.array(F.struct(*(F.col(f"__bound_{n}").alias(f"__{n}") for n in columns))))
    return known.select(*own, one.alias("__x")).select(*own, "__x.*")


def consequence_sets(annotation: DataFrame) -> DataFrame:
    """``Consequence`` (different ones, sorted, joined by ``|``) of each patient, ``__c`` (chromosome), ``pos`` and ``alt`` of annotation rows by place.

    ``annotation`` is that of ``text.annotation_fields_of``. Rows without a place, an allele or a consequence (empty or ``.``) do not count.
    """
    at = v.location_parts(F.col("Location"))
    rows = annotation.select("patient", at["chrom"].alias("__c"), at["pos"].alias("pos"), F.trim("Allele").alias("alt"), F.trim("Consequence").alias("x"))
    rows = rows.where("pos is not null and alt <> '' and x <> '' and x <> '.'").repartition("patient", "__c", "pos", "alt").distinct()
    return rows.groupBy("patient", "__c", "pos", "alt").agg(F.array_join(F.sort_array(F.collect_list("x")), "|").alias("Consequence"))


def edit_calls(records: DataFrame, annotation: DataFrame | None = None, least: float = 10, requested: str = "", rna: tuple[str, ...] = RNA, tumour: tuple[str, ...] = TUMOUR, normal: tuple[str, ...] = NORMAL) -> DataFrame:
    """The table of RNA edits: ``COLUMNS``, then whatever else ``records`` has beyond those of ``text.records_of``.

    A record counts as edit by its sources, a signature flag or a known site. Its numbers are those of its signal sample (see ``signal_names``), or of the
    one that stands in where the first has no genotype and that has one. The frequency is AF, else from AD; the count of the alternate comes from AD, FAD, frequency times depth, or INFO.
    A count below ``least`` leaves the record out, an unknown one does not. Texts that are missing are empty, numbers null; records without a signal sample are left out.
    ``annotation`` (see ``consequence_sets``) fills ``Consequence``; without it that is empty. Nothing but that join shuffles.
    """
    own = [c for c in records.columns if c not in ("patient", "file", "chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "samples")]
    text = lambda c: F.coalesce(c, F.lit(""))
    rows = _bound(records, info=v.info_map(F.col("info")), names=F.transform("samples", lambda s: s["sample"]))
    info = F.col("__info")
    signature, source, known = v.flagged_signature(info), text(info["SOURCE_SET"]), text(info["KNOWN_RNAEDIT_DB"])
    first, second = signal_names(F.col("__names"), requested, rna, tumour, normal)
    rows = _bound(rows.where(edit_record(source, signature, known)), first=first, second=second).where("__first is not null")
    of = lambda name: v.format_map(F.col("format"), F.get(F.filter("samples", lambda s: s["sample"] == F.col(name)), F.lit(0))["value"])
    rows = _bound(rows, a=of("__first"), b=of("__second"))
    swap = v.gt_missing(F.col("__a")["GT"]) & F.col("__second").isNotNull() & ~v.gt_missing(F.col("__b")["GT"])
    rows = _bound(rows, f=F.when(swap, F.col("__b")).otherwise(F.col("__a")), sample=F.when(swap, F.col("__second")).otherwise(F.col("__first")))
    field = lambda k: F.when(~F.col("__f")[k].isin(".", ""), F.col("__f")[k])
    rows = _bound(rows, **{k.lower(): field(k) for k in ("GT", "AD", "FAD", "AF", "DP", "PS", "PID")}, named=v.gene_and_transcript(info))
    part = lambda i: F.get(F.split("__ad", ","), F.lit(i)).try_cast("double")
    share = F.coalesce(F.col("__af").try_cast("double"), F.when(part(0) + part(1) > 0, part(1) / (part(0) + part(1))))
    rows = _bound(rows, share=share)
    rows = _bound(rows, count=v.first_alt_count(F.col("__ad"), F.col("__fad"), F.col("__share"), F.col("__dp"), info)).where(enough_alternates(F.col("__count"), least))
    out = rows.select(
        "patient", "chrom", "pos", "ref", "alt", signature.alias("signature"), F.col("__sample").alias("rna_sample"), text(F.col("__gt")).alias("rna_gt"), text(F.col("__ad")).alias("rna_ad"), F.round("__count", 3).alias("rna_alt_count"),
        F.round("__share", 6).alias("rna_af"), F.col("__dp").try_cast("double").alias("rna_dp"), text(F.col("__ps")).alias("ps"), text(F.col("__pid")).alias("pid"), F.col("__named.gene").alias("gene"), F.col("__named.transcript").alias("transcript"),
        source.alias("source_set"), known.alias("known_db"), *own,
    )
    if annotation is None:
        out = out.withColumn("Consequence", F.lit(""))
    else:
        key = ["patient", "__c", "pos", "alt"]
        out = out.withColumn("__c", v.chrom_norm(F.col("chrom"))).join(consequence_sets(annotation), key, "left").withColumn("Consequence", text(F.col("Consequence")))
    return out.select(*COLUMNS, *own)
