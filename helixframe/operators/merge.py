"""Merging call sets by position, composing genotypes, allele counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as v
from .records import reindexed_counts


SOURCES = ("GERMLINE", "SOMATIC", "RNA_EDIT")


def _padded(alts: Column, ref: Column, longest: Column) -> Column:
    """Alternates of a record with reference ``ref``, as they read from the ``longest`` reference of the position; symbolic ones stay."""
    rest = F.substr(longest, F.length(ref) + 1)
    return F.transform(alts, lambda a: F.when(a.rlike("^[ACGTNacgtn]+$"), F.concat(a, rest)).otherwise(a))


def _folded(calls: Column, joint: Column) -> Column:
    """One genotype of all ``calls`` of a source, each a struct of ``alleles`` (in terms of ``joint``), ``phased``, ``ps`` and ``n``, how many calls are like it.

    A single call stays as it is. Calls that are all phased on two copies in one block, and name at most one alternate for each copy, are
    joined copy by copy. Otherwise each alternate is there as often as in the call that has most of it, in order of ``joint``, and reference
    copies (missing ones, if no call has a reference) fill up what is left of the copies; more alternates than copies add copies.
    """
    called = lambda a: ~a.isin("0", ".")
    all_alleles = F.flatten(calls["alleles"])
    fill = F.when(F.array_contains(all_alleles, "0"), "0").otherwise(".")

    def copy(k: int) -> Column:
        return F.array_distinct(F.filter(F.transform(calls, lambda c: F.get(c["alleles"], F.lit(k))), called))

    def copy_text(k: int) -> Column:
        held = F.exists(calls, lambda c: F.get(c["alleles"], F.lit(k)) == "0")
        return F.coalesce(F.get(copy(k), F.lit(0)), F.when(held, "0").otherwise("."))

    alike = F.forall(calls, lambda c: c["phased"] & (F.size(c["alleles"]) == 2)) & (F.size(F.array_distinct(calls["ps"])) == 1) & (F.size(copy(0)) <= 1) & (F.size(copy(1)) <= 1)
    most = lambda n: F.array_repeat(n, F.array_max(F.transform(calls, lambda c: F.size(F.filter(c["alleles"], lambda a: a == n)))))
    alts = F.flatten(F.transform(joint, lambda a: most(F.array_position(joint, a).cast("string"))))
    copies = F.array_max(F.transform(calls, lambda c: F.size(c["alleles"])))
    unphased = F.array_join(F.concat(F.array_repeat(fill, F.greatest(copies - F.size(alts), F.lit(0))), alts), "/")
    single = F.get(calls, F.lit(0))
    one = F.array_join(single["alleles"], "/")
    return F.when(F.size(calls) == 0, "./.").when((F.size(calls) == 1) & (single["n"] == 1), F.when(single["phased"], F.array_join(single["alleles"], "|")).otherwise(one)).when(alike, F.concat(copy_text(0), F.lit("|"), copy_text(1))).otherwise(unphased)


def merge_sources(calls: DataFrame) -> DataFrame:
    """One row per position: the longest reference, all alternates, sources, and one genotype of each source in terms of the joint alternates.

    ``alt`` may be a comma list; ``.`` and null name no alternate. Alternates are padded to the longest reference of the position (of equal
    ones the first by rid), so that ``AT>GT`` and ``A>G`` are one, and come in order of first rid. All calls of a source count
    (see ``_folded``; ``ps`` is used where ``calls`` has it); a source without a call has ``./.``, and an allele that its call does not name is missing.
    Where ``calls`` has ``ad`` (an array), each source's counts come with it, one for the reference and one for each joint alternate: that of the
    source's first call by rid which has it, else null. Calls alike in all but rid and counts are one with their number and first rid; the different ones
    of a position are held together, nothing else is.
    """
    key = ["patient", "chrom", "pos"]
    counted = "ad" in calls.columns
    ps = F.col("ps") if "ps" in calls.columns else F.lit(None).cast("long")
    own = F.filter(F.coalesce(F.split("alt", ","), F.array().cast("array<string>")), lambda a: a != ".")
    like = {"ref": F.coalesce("ref", F.lit("")), "alts": own, "source_set": F.col("source_set"), "gt": F.col("gt"), "ps": ps}
    # the first counts stand for all that are known at the same places
    first = {"places": F.transform("ad", lambda x: x.isNull())} if counted else {}
    each = calls.repartition(*key).groupBy(*key, *(c.alias(f"__{n}") for n, c in (like | first).items())).agg(F.min("rid").alias("rid"), F.count("*").alias("n"), *([F.min_by("ad", "rid").alias("ad")] if counted else []))
    call = F.struct("rid", *(F.col(f"__{n}").alias(n) for n in like), "n", *(["ad"] if counted else []))
    rows = each.groupBy(*key).agg(F.array_sort(F.collect_list(call)).alias("c"))
    longest = F.aggregate("c", F.lit(""), lambda best, x: F.when(F.length(x["ref"]) > F.length(best), x["ref"]).otherwise(best))
    rows = rows.withColumn("ref", longest)
    rows = rows.withColumn("c", F.transform("c", lambda x: x.withField("alts", _padded(x["alts"], x["ref"], F.col("ref")))))
    rows = rows.withColumns({"joint": F.array_distinct(F.flatten(F.transform("c", lambda x: x["alts"]))), "sources": F.array_sort(F.array_distinct(F.col("c.source_set")))})

    def mapped(x: Column) -> Column:
        place = lambda a: F.array_position("joint", F.get(x["alts"], a.try_cast("int") - 1))
        alleles = F.transform(F.split(x["gt"], r"[|/]"), lambda a: F.when(a.isin("0", "."), a).when(place(a) > 0, place(a).cast("string")).otherwise("."))
        return F.struct(alleles.alias("alleles"), F.contains(x["gt"], F.lit("|")).alias("phased"), x["ps"].alias("ps"), x["n"].alias("n"))

    of = lambda s, keep=lambda x: F.lit(True): F.filter("c", lambda x: (x["source_set"] == s) & keep(x))
    genotype = {f"gt_{s.lower()}": F.transform(of(s, lambda x: x["gt"].isNotNull()), mapped) for s in SOURCES}
    rows = rows.withColumns(genotype)
    counts = [_first_counts(F.transform(of(s, lambda x: x["ad"].isNotNull()), lambda x: reindexed_counts(x["ad"], x["alts"], F.col("joint")))).alias(f"ad_{s.lower()}") for s in SOURCES if counted]
    return rows.select(*key, "ref", F.array_join("joint", ",").alias("alts"), F.array_join("sources", ",").alias("source_set"), *(_folded(F.col(c), F.col("joint")).alias(c) for c in genotype), *counts)


def _first_counts(lists: Column) -> Column:
    """The first known number at each place of ``lists``; null without lists."""
    first = lambda all_of: F.aggregate(F.slice(all_of, 2, 1_000_000), F.get(all_of, F.lit(0)), lambda best, x: F.zip_with(best, x, lambda a, b: F.coalesce(a, b)))
    return v.once(lists, first)


def compose(merged: DataFrame, dna_only: bool = False) -> DataFrame:
    """``tumour_gt`` and ``normal_gt``, never missing, and which step of the ladder the tumour came from: dna, rna, backup, normal or hom_ref.

    Edits (``is_edit``) try genotyped RNA, genotyped DNA, merged RNA, merged DNA; others genotyped DNA, genotyped RNA, merged DNA, merged
    RNA; then both the genotyped and the merged normal. Without RNA: genotyped and merged tumour, then the normals. Columns that
    ``merged`` lacks of ``gt_dna``, ``gt_rna``, ``gt_dna_merged``, ``gt_rna_merged``, ``gt_normal``, ``gt_normal_merged`` count as missing.
    """
    ok = lambda c: F.when(~v.gt_missing(F.col(c)), F.col(c)) if c in merged.columns else F.lit(None).cast("string")
    dna, rna = (ok("gt_dna"), "dna"), (ok("gt_rna"), "rna")
    dna_back, rna_back = (ok("gt_dna_merged"), "backup"), (ok("gt_rna_merged"), "backup")
    normals = [(ok("gt_normal"), "normal"), (ok("gt_normal_merged"), "normal")]

    def pick(steps):
        value = F.coalesce(*(c for c, _ in steps), F.lit("0/0"))
        name = F.lit("hom_ref")
        for c, n in reversed(steps):
            name = F.when(c.isNotNull(), n).otherwise(name)
        return F.struct(value.alias("gt"), name.alias("step"))

    if dna_only:
        chosen = pick([dna, dna_back, *normals])
    else:
        chosen = F.when(F.col("is_edit"), pick([rna, dna, rna_back, dna_back, *normals])).otherwise(pick([dna, rna, dna_back, rna_back, *normals]))
    normal = F.coalesce(*(c for c, _ in normals), F.lit("0/0"))
    return merged.withColumn("__c", chosen).withColumns({"tumour_gt": F.col("__c.gt"), "tumour_from": F.col("__c.step"), "normal_gt": normal}).drop("__c")


def compose_counts(composed: DataFrame) -> DataFrame:
    """Per patient: how many tumour genotypes came from DNA, from RNA, and from merged ones.

    A normal counts with the merged ones only where the record is no edit; hom-ref counts nowhere.
    """
    n = lambda c, name: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    step, edit = F.col("tumour_from"), F.coalesce("is_edit", F.lit(False)) if "is_edit" in composed.columns else F.lit(False)
    return composed.groupBy("patient").agg(n(step == "dna", "from_dna"), n(step == "rna", "from_rna"), n((step == "backup") | ((step == "normal") & ~edit), "from_backup"))


def _called(gt: Column) -> Column:
    """The called alleles of a genotype of any number of copies."""
    return F.filter(F.split(gt, r"[|/]"), lambda x: ~x.isin(".", ""))


def allele_counts(genotypes: DataFrame, key: list[str]) -> DataFrame:
    """AN, AC and AF of each key from genotypes of one alternate; a key without a called allele has AN and AC 0 and no AF."""
    called = _called(F.col("gt"))
    size = lambda c: F.coalesce(F.sum(F.when(c.isNotNull(), F.size(c))), F.lit(0)).cast("long")
    return genotypes.groupBy(*key).agg(size(called).alias("an"), size(F.filter(called, lambda x: x != "0")).alias("ac")).withColumn("af", F.try_divide("ac", "an"))


def joint_allele_counts(merged: DataFrame, samples: list[str], alts: str = "alts") -> DataFrame:
    """One row per record and alternate of the comma list ``alts``: ``alt``, ``an`` (alleles called in any sample), ``ac`` and ``af`` of that alternate, null where nothing is called.

    ``samples`` names the genotype columns. Nothing is shuffled.
    """
    alleles = F.flatten(F.array(*(F.coalesce(_called(F.col(c)), F.array().cast("array<string>")) for c in samples)))
    rows = merged.withColumn("__a", alleles).select("*", F.posexplode(F.split(alts, ",")).alias("__i", "alt"))
    own = F.filter("__a", lambda x: x == (F.col("__i") + 1).cast("string"))
    return rows.withColumns({"an": F.size("__a").cast("long"), "ac": F.size(own).cast("long")}).withColumn("af", F.try_divide("ac", "an")).drop("__a", "__i")


def missing_gate(composed: DataFrame) -> DataFrame:
    """Patients with a missing tumour genotype and how many they have."""
    return composed.groupBy("patient").agg(F.count_if(v.gt_missing(F.col("tumour_gt"))).alias("missing"), F.count("*").alias("records"))
