"""Whole records: sample columns and source tags before a merge, filters by source and known site, split alternates, stage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as v


def _label(sample: Column) -> dict[str, Column]:
    u = F.upper(sample)
    return {"tumour": u.rlike("TUMOU?R"), "named": u.isin("TUMOR", "TUMOUR"), "rna": u.contains("RNA"), "normal": u.contains("NORMAL") | u.endswith("_N"), "dna_normal": u.rlike("DNA_NORMAL$|_N$")}


def tumour_column(samples: DataFrame, way: str = "report", label: str = "DNA_TUMOR") -> DataFrame:
    """``patient``, ``sample``, ``idx`` of the tumour column of each patient, from ``samples`` (``patient``, ``sample``, ``idx`` in file order).

    Ways: report (the label itself, TUMOR or TUMOUR, a name that holds either, the one of two that is not normal, the first), merge (a name
    that holds TUMOR or TUMOUR, one that holds RNA, the last) and dna_only (an answer to the label, the first that is not a normal, the last).
    Of equals the first column wins; a null sample name answers to nothing but place.
    """
    s = _label(F.coalesce("sample", F.lit("")))
    size = samples.groupBy("patient").agg(F.count("*").alias("n"), F.count_if(s["normal"]).alias("normals"), F.max("idx").alias("last"))
    rows = samples.join(size, "patient")
    other = (F.col("n") == 2) & (F.col("normals") == 1) & ~s["normal"]
    tiers = {
        "report": F.when(F.col("sample") == label, 0).when(s["named"], 1).when(s["tumour"], 2).when(other, 3).otherwise(4),
        "merge": F.when(s["tumour"], 0).when(s["rna"], 1).when(F.col("idx") == F.col("last"), 2).otherwise(3),
        "dna_only": F.when(v.label_tier(F.col("sample"), label).isNotNull(), v.label_tier(F.col("sample"), label)).when(~s["dna_normal"], 3).when(F.col("idx") == F.col("last"), 4).otherwise(5),
    }
    if way not in tiers:
        raise ValueError(f"unknown way {way!r}")
    best = rows.withColumn("tier", tiers[way]).groupBy("patient").agg(F.min(F.struct("tier", "idx", "sample")).alias("m"))
    return best.select("patient", "m.sample", "m.idx")


def tagged(records: DataFrame, source: str, sample: str) -> DataFrame:
    """``records`` as one source of a merge: ``source_set`` is added to INFO, and to its flag, the sample has its standard name, allele-specific keys go."""
    info = v.with_listed(v.without_allele_keys(F.col("info")), "SOURCE_SET", F.array(F.lit(source)))
    if source in ("GERMLINE", "SOMATIC"):
        info = v.with_flag(info, source)
    return records.withColumns({"info": v.with_edit_list(info), "sample": F.lit(sample)})


def merged_info(records: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One INFO map for each position: SOURCE_SET, EDIT_SIG and KNOWN_RNAEDIT_DB join the values of all records, of other keys the first counts; flags are restored.

    The records of a position meet by one shuffle, before their maps are taken apart; what follows keeps that partitioning, and no position is held as one row.
    """
    joined = F.col("k").isin("SOURCE_SET", "EDIT_SIG", "KNOWN_RNAEDIT_DB")
    # a list of entries, not the map itself: Spark would test that for null and size first, and work out its expression each time
    met = records.select(*key, F.struct(*order).alias("o"), F.map_entries("info").alias("info")).repartition(*key)
    entries = met.select(*key, "o", F.explode_outer("info").alias("e")).select(*key, "o", F.col("e.key").alias("k"), F.col("e.value").alias("x"))
    parts = entries.select(*key, "k", "o", F.posexplode(F.when(joined, F.split(F.coalesce("x", F.lit("")), ",")).otherwise(F.array("x"))).alias("i", "x"))
    # records without any entry, and empty parts, keep their position by a null key
    parts = parts.withColumn("k", F.when(~joined | (F.col("x") != ""), F.col("k")))
    each = parts.groupBy(*key, "k", F.when(joined, F.col("x")).alias("p")).agg(F.min(F.struct("o", "i", "x")).alias("first"))
    # any other key has one part
    in_order = F.array_sort(F.collect_list("first"))
    values = each.groupBy(*key, "k").agg(in_order.alias("all"))
    values = values.select(*key, "k", F.when(joined, F.array_join(F.col("all.x"), ",")).otherwise(F.get("all.x", F.lit(0))).alias("x"))
    maps = values.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "x"))))).alias("info"))
    return maps.withColumn("info", v.with_flags_restored(F.col("info")))


def with_normals(tumours: DataFrame, normals: DataFrame) -> DataFrame:
    """Separately genotyped tumours with the normal's genotype at their patient, position and alleles; ``./.`` where there is none, of repeated normals the last by rid."""
    key = ["patient", "chrom", "pos", "ref", "alt"]
    last = normals.groupBy(*key).agg(F.max_by("gt", "rid").alias("normal_gt"))
    return tumours.join(last, key, "left").withColumn("normal_gt", v.set_gt(F.col("normal_gt"), "./."))


def has_allowed(records: DataFrame, allowed: DataFrame, alts: str = "alt") -> DataFrame:
    """``records`` with ``allowed``: whether any alternate of the comma list ``alts`` is named at its patient and position by the table ``allowed``.

    ``allowed`` has ``patient``, ``chrom``, ``pos``, ``alt``; chromosomes match with or without chr. Rows are neither lost nor repeated.
    """
    there = allowed.groupBy("patient", v.chrom_norm(F.col("chrom")).alias("__c"), "pos").agg(F.collect_set("alt").alias("__a"))
    rows = records.withColumn("__c", v.chrom_norm(F.col("chrom"))).join(there, ["patient", "__c", "pos"], "left")
    return rows.withColumn("allowed", F.coalesce(F.arrays_overlap(F.split(alts, ","), F.col("__a")), F.lit(False))).drop("__c", "__a")


def unfiltered(records: DataFrame) -> DataFrame:
    """Records that passed, or that no filter has judged."""
    return records.where(F.col("filter").isin("PASS", "."))


def known_sites_only(records: DataFrame, pattern: str, keep_all: bool = False) -> DataFrame:
    """Records whose ``known_db`` matches ``pattern`` (null, empty and ``.`` match nothing); all of them with ``keep_all``. See ``gates.known_sites_gate``."""
    return records if keep_all else records.where(F.coalesce(F.col("known_db").rlike(pattern) & ~F.col("known_db").isin("", "."), F.lit(False)))


def empty_patients(before: DataFrame, after: DataFrame) -> DataFrame:
    """Patients that a filter has left without any record: an error for whoever needs them."""
    return before.select("patient").distinct().join(after.select("patient").distinct(), "patient", "left_anti")


def limited_to(records: DataFrame, source: str, reason: Column) -> DataFrame:
    """``reason`` for records of one source; all others are PRESERVED as they are. ``blacklisted`` says who goes."""
    mine = F.array_contains(F.split(F.coalesce("source_set", F.lit("")), ","), source)
    rows = records.withColumn("reason", F.when(mine, reason).otherwise("PRESERVED"))
    return rows.withColumn("blacklisted", ~F.col("reason").isin("PASS", "PRESERVED"))


def input_validity(lines: DataFrame) -> DataFrame:
    """Per file: whether it has a header line, its records, and ``status`` OK, NO_HEADER or EMPTY. ``lines`` has ``file`` and ``line``."""
    head = F.col("line").rlike(r"^#CHROM(\s|$)")
    record = ~F.col("line").startswith("#") & (F.trim("line") != "")
    rows = lines.groupBy("file").agg(F.count_if(head).alias("headers"), F.count_if(record).alias("records"))
    return rows.select("file", (F.col("headers") > 0).alias("has_header"), "records", F.when(F.col("headers") == 0, "NO_HEADER").when(F.col("records") == 0, "EMPTY").otherwise("OK").alias("status"))


def split_alternates(records: DataFrame) -> DataFrame:
    """One row per alternate of the comma list ``alts``, with ``alt``, ``alt_index`` (from 0) and genotype and counts as that alternate alone has them.

    Its own index becomes 1 and any other alternate 0; missing alleles stay; ``ad`` (an array) keeps the reference and its own count, null without it.
    """
    rows = records.select("*", F.posexplode(F.split("alts", ",")).alias("alt_index", "alt"))
    own = (F.col("alt_index") + 1).cast("string")
    alleles = F.transform(F.split("gt", r"[|/]"), lambda a: F.when(a.isin(".", "0"), a).when(a == own, "1").otherwise("0"))
    ad = F.when(F.size("ad") > F.col("alt_index") + 1, F.array(F.get("ad", F.lit(0)), F.get("ad", F.col("alt_index") + 1)))
    return rows.withColumns({"gt": F.when(F.instr("gt", "|") > 0, F.array_join(alleles, "|")).otherwise(F.array_join(alleles, "/")), "ad": ad})


def signal_sample(first: Column, second: Column, first_name: Column, second_name: Column) -> Column:
    """The sample that speaks for a record: the first, or the second where only that has a genotype; a struct of ``sample`` and ``fields`` (a map)."""
    swap = v.gt_missing(first["GT"]) & ~v.gt_missing(second["GT"])
    return F.when(F.coalesce(swap, F.lit(False)), F.struct(second_name.alias("sample"), second.alias("fields"))).otherwise(F.struct(first_name.alias("sample"), first.alias("fields")))


def af_to_format(records: DataFrame) -> DataFrame:
    """Records whose sample (``format``, ``sample``: texts) is of germline or somatic origin; germline ones get AF of ``info`` (a map) as third field.

    The origin is the last element but one of the sample's text (see ``variant.origin``); records of any other origin go.
    """
    kind, moved = v.origin(F.col("sample")), v.af_into_format(F.col("format"), F.col("sample"), F.col("info"))
    germline = kind == "GERMLINE"
    kept = records.where(kind.isin("GERMLINE", "SOMATIC"))
    return kept.withColumns({"format": F.when(germline, moved["keys"]).otherwise(F.col("format")), "sample": F.when(germline, moved["values"]).otherwise(F.col("sample"))})


def reindexed_counts(ad: Column, own: Column, joint: Column) -> Column:
    """Counts (reference first) of a record with the alternates ``own``, for the ``joint`` list of alternates; null for those it does not have."""
    count = lambda x: F.when(F.array_position(own, x) > 0, F.get(ad, F.array_position(own, x).cast("int")))
    return F.when(ad.isNotNull(), F.concat(F.slice(ad, 1, 1), F.transform(joint, count)))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """``stage``, ``patient``, ``metric``, ``value``: records, those of each source, with a known site, and filtered, one pass for each stage."""
    out = None
    for name, df in stages.items():
        tag = lambda c, ok: F.count_if(F.coalesce(ok, F.lit(False))).alias(c)
        source = F.coalesce("source_set", F.lit(""))
        one = df.groupBy("patient").agg(F.count("*").alias("records"), *(tag(s.lower(), source.contains(s)) for s in ("GERMLINE", "SOMATIC", "RNA_EDIT")), tag("known_site", F.col("known_db").isNotNull()))
        names = [c for c in one.columns if c != "patient"]
        long = one.select(F.lit(name).alias("stage"), "patient", F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names))).alias("m")).select("stage", "patient", "m.*")
        out = long if out is None else out.unionByName(long)
    return out
