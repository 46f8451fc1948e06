"""Annotation tables: set collapse, lookups, best transcript, strand decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import variant as v


def joined_set(c: Column) -> Column:
    """Different values, sorted, joined by ``|``; NA if there are none."""
    return _set_text(F.collect_set(c))


def _set_text(values: Column) -> Column:
    # sort_array compares the values as they are, array_sort by a lambda for each pair
    return F.coalesce(F.nullif(F.array_join(F.sort_array(values), "|"), F.lit("")), F.lit("NA"))


#: The sets of ``collapse``, in the order of the variant table.
SETS = ("uploaded_variation", "location", "protein_ref", "protein_alt", "protein_position", "amino_acids", "codons", "gene_id", "gene_symbol", "feature", "feature_type", "consequence", "existing_variation")


def collapse(vep: DataFrame, called: DataFrame | None = None) -> DataFrame:
    """One row per (patient, chromosome, position, alternate): sorted sets of what its annotation rows say.

    ``vep`` has ``patient`` and the annotation columns in lower case. Rows whose location does not read as one, or
    without allele, are left out; empty values, ``.``, ``-`` and NA are in no set. With ``called`` (``patient``, ``chrom``, ``pos``, ``alt``) only keys that
    it holds are collapsed. A key has one set, of the different rows of values; the sets of the fields are taken from it. Rows go to
    their key first, with their values worked out: an aggregate of sets works out its input one expression at a time.
    """
    at, aa = v.location_parts(F.col("location")), v.amino_acid_pair(F.col("amino_acids"))
    rows = vep.select(
        "patient", at["chrom"].alias("chrom_norm"), at["pos"].alias("pos"), F.trim("allele").alias("alt"), "uploaded_variation", "location", aa["ref"].alias("protein_ref"), aa["alt"].alias("protein_alt"), "protein_position", "amino_acids", "codons",
        F.col("gene").alias("gene_id"), v.extra_value(F.col("extra"), "SYMBOL").alias("gene_symbol"), "feature", "feature_type", "consequence", "existing_variation",
    )
    rows = rows.where("pos is not null and alt <> ''")
    key = ["patient", "chrom_norm", "pos", "alt"]
    if called is not None:
        rows = rows.join(called.select("patient", v.chrom_norm(F.col("chrom")).alias("chrom_norm"), "pos", "alt"), key, "left_semi")
    known = lambda c: F.when(~F.trim(c).isin("", ".", "-", "NA"), F.trim(c)).alias(c)
    placed = rows.select(*key, F.struct(*map(known, SETS)).alias("__row")).repartition(*key)
    sets = placed.groupBy(*key).agg(F.collect_set("__row").alias("__rows"))
    own = lambda c: F.array_except(F.col("__rows")[c], F.array(F.lit(None).cast("string")))
    return sets.select(*key, *(_set_text(own(c)).alias(c) for c in SETS))


def variant_table(calls: DataFrame, collapsed: DataFrame) -> DataFrame:
    """The variant table: 29 columns from SAMPLE to tumor_vaf, one row per call and alternate.

    ``calls`` has ``patient``, ``chrom``, ``pos``, ``ref``, ``alt``, ``source_set``, ``filter``, and ``gt``, ``dp``, ``alt_count``, ``vaf`` with the prefixes
    ``normal_`` and ``tumor_`` besides ``tumor_ps``. Germline rows keep genotype and phase of the tumour but no depth, count or frequency.
    Without annotation the id and location are made up and the other sets NA; numbers stay numbers, null where missing.
    """
    rows = calls.withColumn("__c", v.chrom_norm(F.col("chrom"))).join(collapsed.withColumnRenamed("chrom_norm", "__c"), ["patient", "__c", "pos", "alt"], "left")
    made = {"uploaded_variation": v.uploaded_of(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")), "location": v.location_of(F.col("chrom"), F.col("pos"))}
    sets = {c: F.coalesce(c, made.get(c, F.lit("NA"))).alias(c) for c in SETS}
    tumour = lambda c: F.when(F.col("source_set") != "GERMLINE", F.col(c)).alias(c)
    return rows.select(
        F.col("patient").alias("SAMPLE"), sets["uploaded_variation"], sets["location"], F.col("__c").alias("chrom"), "pos", "ref", "alt", *(sets[c] for c in SETS[2:]), "source_set", "filter",
        "normal_gt", "tumor_gt", "tumor_ps", "normal_dp", "normal_alt_count", "normal_vaf", tumour("tumor_dp"), tumour("tumor_alt_count"), tumour("tumor_vaf"),
    )


def two_tier(rows: DataFrame, calls: DataFrame, values: list[str]) -> DataFrame:
    """``values`` of the call with equal key including ref, else of that with equal alt; of repeated calls the last by rid. ``tier`` says which."""
    alt = ["patient", "chrom", "pos", "alt"]
    # both tiers from one row a key without ref, which holds the last call of each ref: rows are joined once
    of_ref = calls.repartition(*alt).groupBy(*alt, F.col("ref").alias("__r")).agg(F.max("rid").alias("__rid"), F.max_by(F.struct(*values), "rid").alias("__v"))
    last = of_ref.groupBy(*alt).agg(F.max_by("__v", "__rid").alias("by_alt"), F.map_from_entries(F.collect_list(F.when(F.col("__r").isNotNull(), F.struct("__r", "__v")))).alias("__full"))
    found = rows.join(last, alt, "left").withColumn("full", F.col("__full")[F.col("ref")])
    tier = F.when(F.col("full").isNotNull(), "full").when(F.col("by_alt").isNotNull(), "alt").otherwise("none")
    return found.select(*rows.columns, tier.alias("tier"), *(F.coalesce("full", "by_alt")[c].alias(c) for c in values))


def ranked_transcripts(vep: DataFrame) -> DataFrame:
    """Annotation rows with ``n``, their place among those of their uploaded variant; rows without an id go by ``location`` and ``alt``, if those columns are there.

    Transcripts first, then consequence rank, protein known, no decay, canonical, no
    flags, the commoner amino-acid change, feature name, place in the file. Missing changes (empty, ``.``, ``-``, NA) are
    not common. ``rows`` counts the variant's rows, ``aa_options`` its different changes (1 if none is known).
    """
    other = F.concat_ws("|", *(F.coalesce(c, F.lit("NA")) for c in ("location", "alt"))) if "location" in vep.columns else F.lit("")
    vep = vep.withColumn("__key", F.coalesce(F.nullif(F.trim("uploaded"), F.lit("")), other))
    key = ["patient", "__key"]
    own = W.partitionBy(*key)
    change = F.when(F.trim("amino_acids") != "NA", v.known_text(F.col("amino_acids")))
    protein = F.coalesce(v.known_text(F.col("protein_position")).isNotNull() & v.known_text(F.col("amino_acids")).isNotNull(), F.lit(False))
    # what rows are ordered by is worked out before they go to their variant, once for all windows
    told = {
        "__aa": change, "rank": v.consequence_rank(F.col("consequence")), "primary": v.primary_consequence(F.col("consequence")), "__type": F.when(F.col("feature_type") == "Transcript", 0).otherwise(1),
        "__protein": F.when(protein, 0).otherwise(1), "__decay": F.when(F.col("consequence").contains("NMD_transcript_variant"), 1).otherwise(0),
        "__canonical": F.when(v.extra_value(F.col("extra"), "CANONICAL") == "YES", 0).otherwise(1), "__flags": F.when(v.extra_value(F.col("extra"), "FLAGS").isNull(), 0).otherwise(1),
    }
    rows = vep.withColumns(told).repartition(*key).withColumns({
        "aa_count": F.count("__aa").over(W.partitionBy(*key, "__aa")),
        "aa_options": F.greatest(F.size(F.collect_set("__aa").over(own)), F.lit(1)),
        "rows": F.count("*").over(own),
    })
    order = ["__type", "rank", "__protein", "__decay", "__canonical", "__flags", F.desc("aa_count"), "feature", "rid", "t"]
    return rows.withColumn("n", F.row_number().over(own.orderBy(*order))).drop("__key", *(c for c in told if c.startswith("__")))


def best_transcript(vep: DataFrame) -> DataFrame:
    """The first annotation row of each uploaded variant; see ``ranked_transcripts``."""
    return ranked_transcripts(vep).where("n = 1").drop("n")


def dedup_counts(ranked: DataFrame) -> DataFrame:
    """``patient``, ``stage``, ``source_set``, ``primary_consequence``, ``known_db_hit`` and ``count`` of ``ranked_transcripts``; the cohort's counts have a null patient.

    ``ranked`` has ``source_set`` and ``known_db`` of its calls besides (null source: NA). Stages (fixed values) are raw_rows, dedup_kept_rows and filtered_transcript_rows.
    """
    key = {"source_set": F.coalesce("source_set", F.lit("NA")), "primary_consequence": F.col("primary"), "known_db_hit": F.when(v.known_site(F.col("known_db")), "1").otherwise("0")}
    n = ranked.groupBy("patient", *(c.alias(name) for name, c in key.items())).agg(F.count("*").alias("raw_rows"), F.count_if(F.col("n") == 1).alias("dedup_kept_rows"), F.count_if(F.col("n") > 1).alias("filtered_transcript_rows"))
    each = n.unpivot(["patient", *key], ["raw_rows", "dedup_kept_rows", "filtered_transcript_rows"], "stage", "count").where("count > 0")
    # each count goes to its patient and to the cohort, from one pass over the rows
    both = each.withColumn("__cohort", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("patient", F.when(~F.col("__cohort"), F.col("patient")))
    return both.where("__cohort or patient is not null").groupBy("__cohort", "patient", "stage", *key).agg(F.sum("count").alias("count")).drop("__cohort")


def dedup_metrics(ranked: DataFrame) -> DataFrame:
    """Per patient: rows, variants, those with several rows, rows kept and left out, and rows without a call (``tier`` none, see ``two_tier``)."""
    first = F.col("n") == 1
    n = lambda ok, name: F.count_if(ok).alias(name)
    return ranked.groupBy("patient").agg(
        F.count("*").alias("raw_vep_rows"), n(first, "raw_unique_variants"), n(first & (F.col("rows") > 1), "variants_with_multiple_transcript_rows"), n(first, "dedup_variants_kept"),
        n(~first, "filtered_transcript_rows"), n(F.col("tier") == "none", "rows_missing_vcf_annotation"),
    )


def cohort_metrics(metrics: DataFrame) -> DataFrame:
    """One row: ``patients``, and the sums of ``dedup_metrics`` over them."""
    return metrics.agg(F.count("*").alias("patients"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in metrics.columns if c != "patient"))


def strand_summary(vep: DataFrame) -> DataFrame:
    """Per uploaded variant: its strands, whether they are one, the change as the transcript reads it, and what its rows say.

    ``status`` (fixed values): UNPARSEABLE_UPLOADED_VARIATION, MISSING_TRANSCRIPT_STRAND, AMBIGUOUS_TRANSCRIPT_STRAND, NON_SNV or
    UNIQUE_TRANSCRIPT_STRAND. ``change`` and ``class`` are NA without a single strand or for anything but single bases.
    """
    sets = {"symbols": v.extra_value(F.col("extra"), "SYMBOL"), "consequences": F.col("consequence"), "features": F.col("feature"), "feature_types": F.col("feature_type")}
    if "location" in vep.columns:
        sets["locations"] = F.col("location")
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    rows = vep.withColumn("strand", v.extra_strand(F.col("extra"))).groupBy("patient", "uploaded").agg(F.array_sort(F.collect_set("strand")).alias("s"), *(joined_set(some(c)).alias(n) for n, c in sets.items()))
    rows = rows.withColumn("p", v.uploaded_parts(F.col("uploaded")))
    one = F.when(F.size("s") == 1, F.get("s", F.lit(0)))
    rows = rows.withColumn("c", v.transcript_change(F.col("p.ref"), F.col("p.alt"), one))
    status = (
        F.when(F.col("p").isNull(), "UNPARSEABLE_UPLOADED_VARIATION").when(F.size("s") == 0, "MISSING_TRANSCRIPT_STRAND").when(F.size("s") > 1, "AMBIGUOUS_TRANSCRIPT_STRAND")
        .when(F.col("c").isNull(), "NON_SNV").otherwise("UNIQUE_TRANSCRIPT_STRAND")
    )
    kind = F.when(F.col("c").isNull(), "NA").otherwise(v.transcript_class(F.col("c")))
    return rows.select("patient", "uploaded", F.array_join("s", "|").alias("strands"), status.alias("status"), F.coalesce("c", F.lit("NA")).alias("change"), kind.alias("class"), *sets)


def strand_filter(summary: DataFrame) -> DataFrame:
    """``keep``: a single strand on which the change is an edit; ``reason`` says why not: the status, or NOT_TRANSCRIPT_CANONICAL_RNA_EDIT (a fixed value); else PASS."""
    unique, edit = F.col("status") == "UNIQUE_TRANSCRIPT_STRAND", F.col("class").isin("ADAR", "APOBEC3")
    return summary.withColumns({"keep": unique & edit, "reason": F.when(~unique, F.col("status")).when(~edit, "NOT_TRANSCRIPT_CANONICAL_RNA_EDIT").otherwise("PASS")})


def decided_ids(filtered: DataFrame) -> DataFrame:
    """Different ``uploaded`` ids of ``strand_filter`` with ``list`` (keep or blacklist): per patient, and with a null patient those of the cohort."""
    each = filtered.select(F.when(F.col("keep"), "keep").otherwise("blacklist").alias("list"), F.explode(F.array(F.col("patient"), F.lit(None).cast("string"))).alias("patient"), "uploaded")
    return each.distinct().select("patient", "list", "uploaded")


def position_conflicts(calls: DataFrame, summary: DataFrame) -> DataFrame:
    """``decision`` (fixed values) for each one-alternate RNA-edit call at its position; other sources pass as NON_RNA_EDIT.

    Alone: SINGLETON_KEEP. Several, of which just one has a single strand: that one is kept
    (UNIQUE_STRAND_KEEP_IN_POSITION_CONFLICT) and the others go (POSITION_CONFLICT_NONUNIQUE_STRAND). Else all stay
    (UNRESOLVED_POSITION_CONFLICT_KEEP_ALL).
    """
    up = v.uploaded_of(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
    known = summary.select("patient", F.regexp_replace("uploaded", "(?i)^chr", "").alias("__up"), F.col("status").alias("strand_status"))
    rows = calls.withColumn("__up", up).join(known, ["patient", "__up"], "left").drop("__up").withColumn("strand_status", F.coalesce("strand_status", F.lit("MISSING_VEP_ANNOTATION")))
    here = W.partitionBy("patient", "chrom", "pos")
    edit, unique = F.col("source_set").contains("RNA_EDIT"), F.col("strand_status") == "UNIQUE_TRANSCRIPT_STRAND"
    n, u = F.count_if(edit).over(here), F.count_if(edit & unique).over(here)
    decision = (
        F.when(~edit, "NON_RNA_EDIT").when(n == 1, "SINGLETON_KEEP").when((u == 1) & unique, "UNIQUE_STRAND_KEEP_IN_POSITION_CONFLICT")
        .when(u == 1, "POSITION_CONFLICT_NONUNIQUE_STRAND").otherwise("UNRESOLVED_POSITION_CONFLICT_KEEP_ALL")
    )
    return rows.withColumn("decision", decision)


def annotation_strands(calls: DataFrame, vep: DataFrame) -> DataFrame:
    """``strands`` of each call from the annotation of its patient, chromosome, position and alternate, in place of gene intervals; empty without any."""
    at = v.location_parts(F.col("location"))
    rows = vep.select("patient", at["chrom"].alias("__c"), at["pos"].alias("pos"), F.trim("allele").alias("alt"), v.extra_strand(F.col("extra")).alias("s")).where("pos is not null")
    # of two strands two flags say which are there
    sets = rows.groupBy("patient", "__c", "pos", "alt").agg(F.max(F.col("s") == "+").alias("plus"), F.max(F.col("s") == "-").alias("minus"))
    both = F.when(F.col("plus") & F.col("minus"), F.array(F.lit("+"), F.lit("-"))).when(F.col("plus"), F.array(F.lit("+"))).when(F.col("minus"), F.array(F.lit("-")))
    sets = sets.select("patient", "__c", "pos", "alt", both.alias("strands"))
    out = calls.withColumn("__c", v.chrom_norm(F.col("chrom"))).join(sets, ["patient", "__c", "pos", "alt"], "left").drop("__c")
    return out.withColumn("strands", F.coalesce("strands", F.array().cast("array<string>")))
