"""Scalar expressions over variant fields. All are built-in Spark expressions that take and return columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms, column names and labels of the file formats that these tables are exchanged in.
ADAR, APOBEC3 = ("A>G", "T>C"), ("C>T", "G>A")
MISSING = (".", "", "./.", ".|.", "NA", "-")
CODING = ("frameshift_variant", "inframe_insertion", "inframe_deletion", "missense_variant")
VEP_COLUMNS = (
    "Uploaded_variation", "Location", "Allele", "Gene", "Feature", "Feature_type", "Consequence", "cDNA_position", "CDS_position", "Protein_position", "Amino_acids", "Codons",
    "Existing_variation", "Extra",
)
EXONIC = ("CDS", "UTR", "exon", "five_prime_utr", "three_prime_utr", "5UTR", "3UTR", "start_codon", "stop_codon")


def once(value: Column, of) -> Column:
    """``of`` of a value that is worked out once, however often ``of`` names it; chained steps would else repeat all before them, each several times."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def null_if_missing(c: Column) -> Column:
    return F.when(~c.isin(*MISSING), c)


def chrom_norm(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "(?i)^chr", "")


def is_canonical(c: Column, mito: bool = True) -> Column:
    names = [str(i) for i in range(1, 23)] + ["X", "Y"] + (["M", "MT"] if mito else [])
    return F.upper(chrom_norm(c)).isin(*names)


def chrom_order(c: Column) -> Column:
    """Sort key: 1 to 22, X, Y, M, then the rest by name."""
    n = F.upper(chrom_norm(c))
    number = n.try_cast("int")
    rank = F.when(number.between(1, 22), number).when(n == "X", 23).when(n == "Y", 24).when(n.isin("M", "MT"), 25).otherwise(26)
    return F.struct(rank.alias("rank"), F.when(rank == 26, n).otherwise("").alias("name"))


def label_tier(sample: Column, label: str) -> Column:
    """How well a sample name answers to a label: 0 exact, 1 ``_label`` suffix, 2 with a lane suffix; null if not. TUMOR and TUMOUR are one."""
    import re

    pattern = re.escape(label).replace("TUMOUR", "TUMOR").replace("TUMOR", "TUMOU?R")
    return F.when(sample.rlike(f"(?i)^{pattern}$"), 0).when(sample.rlike(f"(?i)_{pattern}$"), 1).when(sample.rlike(rf"(?i)(^|_){pattern}\.\d+$"), 2)


def patient_name(sample: Column, labels: list[str]) -> Column:
    """The sample name without ``_LABEL`` suffixes, taken off in list order."""
    import re

    for label in labels:
        sample = F.regexp_replace(sample, f"_{re.escape(label)}$", "")
    return sample


def renamed_read_group(sm: Column, label: str, name: str) -> Column:
    """One sample name for every lane of a label."""
    import re

    return F.when(sm.rlike(rf"_?{re.escape(label)}(\.\d{{4}})?$"), F.lit(name)).otherwise(sm)


def is_snv(ref: Column, alt: Column) -> Column:
    return (F.length(ref) == 1) & F.forall(F.split(alt, ","), lambda a: F.length(a) == 1)


def has_change(ref: Column, alt: Column, changes: tuple[str, ...]) -> Column:
    """Whether any alternate base makes one of the changes; case matters."""
    return F.exists(F.split(alt, ","), lambda a: F.concat(ref, F.lit(">"), a).isin(*changes))


def signature(ref: Column, alt: Column) -> Column:
    return F.when(has_change(ref, alt, ADAR), "ADAR").when(has_change(ref, alt, APOBEC3), "APOBEC3").otherwise("OTHER")


def transcript_change(ref: Column, alt: Column, strand: Column) -> Column:
    """``R>A`` as the transcript reads it; null for anything but single bases or without strand."""
    turn = lambda b: F.translate(F.upper(b), "ACGT", "TGCA")
    one = (F.length(ref) == 1) & (F.length(alt) == 1)
    return F.when(one & (strand == "+"), F.concat(F.upper(ref), F.lit(">"), F.upper(alt))).when(one & (strand == "-"), F.concat(turn(ref), F.lit(">"), turn(alt)))


def transcript_class(change: Column) -> Column:
    return F.when(change == "A>G", "ADAR").when(change == "C>T", "APOBEC3").otherwise("OTHER")


def motif_hit(ref: Column, alt: Column, before3: Column, after3: Column) -> Column:
    """APOBEC3 motif: C>T with CATCG over pos-3..pos+1, or G>A with CGATG over pos-1..pos+3; case does not matter."""
    r, a = F.upper(ref), F.upper(alt)
    return F.coalesce((r == "C") & (a == "T") & (F.upper(before3) == "CATCG") | (r == "G") & (a == "A") & (F.upper(after3) == "CGATG"), F.lit(False))


def int_list(c: Column) -> Column:
    """Comma list of integers; null if any element is none."""
    parts = F.transform(F.split(c, ","), lambda x: x.try_cast("int"))
    return F.when(~F.exists(parts, lambda x: x.isNull()), parts)


def alt_total(ad: Column) -> Column:
    return F.when(F.size(ad) >= 2, F.aggregate(F.slice(ad, F.lit(2), F.greatest(F.size(ad) - 1, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x))


def depth_of(ad: Column) -> Column:
    return F.aggregate(ad, F.lit(0).cast("long"), lambda a, x: a + x)


def vaf_of(ad: Column) -> Column:
    """ALT reads over REF plus ALT reads; null without reads or with fewer than two counts."""
    return F.when(F.size(ad) >= 2, F.try_divide(alt_total(ad), depth_of(ad)))


def recomputed_af(ad: Column, dp: Column) -> Column:
    """ALT reads over depth, or over all counted reads where the depth is unknown."""
    return F.try_divide(alt_total(ad), F.coalesce(dp.cast("long"), depth_of(ad)))


def add_lists(lists: Column) -> Column:
    """Element-wise sum of count lists, in order. A list of another length voids the sum; the next one starts it anew."""
    step = lambda acc, x: F.when(x.isNull(), acc).when(acc.isNull(), x).when(F.size(acc) == F.size(x), F.zip_with(acc, x, lambda p, q: p + q))
    return F.aggregate(lists, F.lit(None).cast("array<int>"), step)


def info_map(info: Column) -> Column:
    """Key to value of ``k=v;flag``; a flag has the value 1; of repeated keys the last counts."""
    parts = F.filter(F.split(info, ";"), lambda p: (p != "") & (p != "."))
    pairs = F.transform(parts, lambda p: once(F.instr(p, "="), lambda at: F.when(at > 0, F.struct(F.substring(p, F.lit(1), at - 1).alias("key"), F.substring(p, at + 1, F.length(p)).alias("value"))).otherwise(F.struct(p.alias("key"), F.lit("1").alias("value")))))
    # keys are sorted only where one repeats
    return once(pairs, lambda x: F.when(F.size(F.array_distinct(x["key"])) == F.size(x), F.map_from_entries(x)).otherwise(_last_of_keys(x)))


def _last_of_keys(pairs: Column) -> Column:
    placed = F.sort_array(F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), i.alias("i"), p["value"].alias("value"))))
    return once(placed, lambda s: F.map_from_entries(F.transform(F.filter(s, lambda x, i: ~F.coalesce(F.get(s, i + 1)["key"] == x["key"], F.lit(False))), lambda x: F.struct(x["key"], x["value"]))))


def format_map(keys: Column, values: Column) -> Column:
    """FORMAT keys with a sample's values; what has no partner is dropped."""
    k, v = F.split(keys, ":"), F.split(values, ":")
    n = F.least(F.size(k), F.size(v))
    return F.map_from_arrays(F.slice(k, F.lit(1), n), F.slice(v, F.lit(1), n))


def gt_missing(gt: Column) -> Column:
    return F.coalesce(gt, F.lit("")).isin("", ".", "./.", ".|.")


def gt_alleles(gt: Column) -> Column:
    """The two alleles of a genotype; null if there are not just two."""
    parts = F.split(gt, r"[|/]")
    return F.when(~gt_missing(gt) & (F.size(parts) == 2), parts)


def hom_alt(gt: Column) -> Column:
    a = gt_alleles(gt)
    return F.coalesce((F.get(a, F.lit(0)) == F.get(a, F.lit(1))) & ~F.get(a, F.lit(0)).isin("0", "."), F.lit(False))


def has_alt(gt: Column) -> Column:
    """Whether any copy carries an alternate; genotypes of one copy count as none, those of more than two do count."""
    parts = F.split(gt, r"[|/]")
    return F.coalesce((F.size(parts) > 1) & F.exists(parts, lambda x: ~x.isin("0", ".", "")), F.lit(False))


def alt_sides(gt: Column) -> Column:
    """Which copies (1, 2) carry an alternate allele in a phased genotype; empty otherwise."""
    a = gt_alleles(gt)
    side = lambda i: F.when(~F.get(a, F.lit(i)).isin("0", "."), i + 1)
    return F.when(F.instr(gt, "|") > 0, F.filter(F.array(side(0), side(1)), lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>"))


def same_copy(gt_a: Column, ps_a: Column, gt_b: Column, ps_b: Column) -> tuple[Column, Column]:
    """(same copy, phased in cis): homozygous on either side is the same copy; else both phased in one block on a shared side."""
    hom = hom_alt(gt_a) | hom_alt(gt_b)
    cis = F.coalesce((ps_a == ps_b) & F.arrays_overlap(alt_sides(gt_a), alt_sides(gt_b)), F.lit(False))
    return hom | cis, ~hom & cis


def source_exact(text: Column) -> Column:
    """The one source that a comma list names, however often; else the trimmed text itself, NA if it is empty or null."""
    names = F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))
    only = F.get(names, F.lit(0))
    return F.when((F.size(names) == 1) & only.isin("GERMLINE", "SOMATIC", "RNA_EDIT"), only).otherwise(F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("NA")))


def source_priority(text: Column) -> Column:
    return F.when(text.contains("GERMLINE"), "GERMLINE").when(text.contains("SOMATIC"), "SOMATIC").when(text.contains("RNA_EDIT"), "RNA_EDIT").otherwise("OTHER")


def known_site(known_db: Column) -> Column:
    """Whether a record names a known site; never null."""
    return F.coalesce(~known_db.isin("", ".", "NA"), F.lit(False))


def extra_value(extra: Column, key: str) -> Column:
    return F.nullif(F.regexp_extract(extra, rf"(?:^|;){key}=([^;]*)", 1), F.lit(""))


def extra_strand(extra: Column) -> Column:
    s = extra_value(extra, "STRAND")
    return F.when(s.isin("1", "+1"), "+").when(s == "-1", "-")


def uploaded_parts(uploaded: Column) -> Column:
    """``chrom_pos_ref/alt`` as a struct; the chromosome may hold underscores; null if it reads otherwise."""
    p = r"^(.+?)_(\d+)_([^/]+)/([^/]+)$"
    part = lambda i: F.regexp_extract(uploaded, p, i)
    return F.when(uploaded.rlike(p), F.struct(chrom_norm(part(1)).alias("chrom"), part(2).try_cast("long").alias("pos"), part(3).alias("ref"), part(4).alias("alt")))


def uploaded_of(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """A made-up id ``chrom_pos_ref/alt``; the chromosome goes without its prefix."""
    return F.concat(chrom_norm(chrom), F.lit("_"), pos.cast("string"), F.lit("_"), ref, F.lit("/"), alt)


def consequence_rank(c: Column) -> Column:
    term = lambda *names: c.rlike(f"(^|,)({'|'.join(names)})(,|$)")
    return F.when(term("frameshift_variant"), 1).when(term("inframe_insertion", "inframe_deletion"), 2).when(term("missense_variant"), 3).when(term("synonymous_variant"), 4).otherwise(9)


def primary_consequence(c: Column) -> Column:
    r = consequence_rank(c)
    first = F.get(F.split(c, ","), F.lit(0))
    indel = F.when(c.rlike("(^|,)inframe_insertion(,|$)"), "inframe_insertion").otherwise("inframe_deletion")
    return F.when(r == 1, "frameshift_variant").when(r == 2, indel).when(r == 3, "missense_variant").when(r == 4, "synonymous_variant").otherwise(first)


def coding(consequence: Column, biotype: Column) -> Column:
    return F.arrays_overlap(F.split(consequence, "[,&]"), F.lit(list(CODING))) & F.coalesce(biotype == "protein_coding", F.lit(True))


def number_text(v: Column, digits: int = 6, missing: str = "NA") -> Column:
    """A number for a sink: no trailing zeros, ``missing`` for null (``NA`` in tables, ``.`` in records)."""
    text = F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}f", v.cast("double")), "0+$", ""), r"\.$", "")
    return F.when(v.isNull(), missing).otherwise(text)


#: Names of library protocols and what they stand for.
PROTOCOLS = {
    "fr-firststrand": "fr-firststrand", "firststrand": "fr-firststrand", "reverse": "fr-firststrand", "reverse-stranded": "fr-firststrand", "1+-,1-+,2++,2--": "fr-firststrand",
    "fr-secondstrand": "fr-secondstrand", "secondstrand": "fr-secondstrand", "forward": "fr-secondstrand", "forward-stranded": "fr-secondstrand", "1++,1--,2+-,2-+": "fr-secondstrand",
}


def protocol(name: str) -> str:
    """The protocol that a name stands for, whatever its case; an unknown name is an error."""
    known = PROTOCOLS.get(str(name).strip().lower())
    if known is None:
        raise ValueError(f"unknown library protocol {name!r}")
    return known


def transcript_strand_of_read(flag: Column, library: str) -> Column:
    """Strand of the transcript a read comes from; a single read counts as read 1."""
    first_strand = protocol(library) == "fr-firststrand"
    bit = lambda b: flag.bitwiseAND(F.lit(b)) != 0
    second = bit(1) & bit(128)
    plus = bit(16) == second  # the fragment's first read lies forward
    return F.when(plus, "-" if first_strand else "+").otherwise("+" if first_strand else "-")


def known_text(c: Column) -> Column:
    """A trimmed annotation value; null where it is empty, ``.`` or ``-``."""
    return F.when(~F.trim(c).isin("", ".", "-"), F.trim(c))


def chrom_norm_lower(c: Column) -> Column:
    """As coverage tables have it: only a lower-case ``chr`` is taken off."""
    return F.regexp_replace(F.trim(c), "^chr", "")


# --- flags and lists of an INFO map ---------------------------------------------------------------------


def info_list(info: Column, key: str) -> Column:
    """The elements of a comma list in ``info``, without empty ones; an empty array if there is none."""
    items = F.transform(F.split(F.coalesce(info[key], F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def flagged_signature(info: Column) -> Column:
    """ADAR or APOBEC3 by flag, ADAR first; else OTHER."""
    return F.when(F.map_contains_key(info, "ADAR_SIG"), "ADAR").when(F.map_contains_key(info, "APOBEC3_SIG"), "APOBEC3").otherwise("OTHER")


def flag_names(info: Column) -> Column:
    """Which of ADAR and APOBEC3 have their flag."""
    return F.filter(F.array(*(F.when(F.map_contains_key(info, f"{n}_SIG"), n) for n in ("ADAR", "APOBEC3"))), lambda x: x.isNotNull())


def edit_label(info: Column) -> Column:
    """EDIT_SIG and flags as one label: different names, sorted, joined by ``|``; NA if there are none."""
    names = F.array_sort(F.array_distinct(F.concat(info_list(info, "EDIT_SIG"), flag_names(info))))
    return F.when(F.size(names) > 0, F.array_join(names, "|")).otherwise("NA")


def with_flag(info: Column, key: str, wanted: Column | None = None) -> Column:
    """``info`` with a flag, once, where ``wanted`` (default: everywhere)."""
    return once(info, lambda m: _flagged(m, key, F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))))


def _flagged(info: Column, key: str, wanted: Column) -> Column:
    added = F.map_concat(F.map_filter(info, lambda k, _: k != key), F.create_map(F.lit(key), F.coalesce(info[key], F.lit("1"))))
    return F.when(wanted, added).otherwise(info)


def with_listed(info: Column, key: str, values: Column) -> Column:
    """``info`` with the array ``values`` appended to the comma list ``key``, each once; unchanged if there are none."""
    return once(info, lambda m: _listed(m, key, values))


def _listed(info: Column, key: str, values: Column) -> Column:
    joined = F.array_join(F.array_union(info_list(info, key), values), ",")
    return F.when(F.size(values) > 0, F.map_concat(F.map_filter(info, lambda k, _: k != key), F.create_map(F.lit(key), joined))).otherwise(info)


def with_edit_list(info: Column) -> Column:
    """``info`` with the names of its signature flags in EDIT_SIG."""
    return once(info, lambda m: _listed(m, "EDIT_SIG", flag_names(m)))


def with_flags_restored(info: Column) -> Column:
    """``info`` with the flags that SOURCE_SET and EDIT_SIG stand for, as a merge drops them."""
    restored = lambda key, name, flag: lambda m: _flagged(m, flag, F.array_contains(info_list(m, key), name))
    for key, name, flag in (("SOURCE_SET", "GERMLINE", "GERMLINE"), ("SOURCE_SET", "SOMATIC", "SOMATIC"), ("EDIT_SIG", "ADAR", "ADAR_SIG"), ("EDIT_SIG", "APOBEC3", "APOBEC3_SIG")):
        info = once(info, restored(key, name, flag))
    return info


def info_text(info: Column, before: Column, flags: tuple[str, ...] = ("GERMLINE", "SOMATIC", "ADAR_SIG", "APOBEC3_SIG")) -> Column:
    """An INFO map as text: keys in the order of the text ``before``, each once, then new keys by name; ``.`` if there are none.

    A key without = in ``before`` stays a bare flag while its value is 1, as do new keys among ``flags``. A null map gives null.
    """
    parts = F.filter(F.split(F.coalesce(before, F.lit("")), ";"), lambda p: ~p.isin("", "."))
    old = F.array_distinct(F.transform(parts, lambda p: F.substring_index(p, "=", 1)))
    bare = F.array_union(F.filter(parts, lambda p: F.instr(p, "=") == 0), F.array_except(F.array(*map(F.lit, flags)), old))
    keys = F.concat(F.filter(old, lambda k: F.map_contains_key(info, k)), F.array_sort(F.array_except(F.map_keys(info), old)))
    text = F.transform(keys, lambda k: F.when(F.array_contains(bare, k) & (info[k] == "1"), k).otherwise(F.concat_ws("=", k, info[k])))
    return F.when(info.isNotNull(), F.when(F.size(keys) > 0, F.array_join(text, ";")).otherwise("."))


def sample_text(keys: Column, fields: Column) -> Column:
    """A sample's fields (a map) as text in the order of the FORMAT ``keys``; ``.`` for those it lacks."""
    return F.array_join(F.transform(F.split(keys, ":"), lambda k: F.coalesce(fields[k], F.lit("."))), ":")


def without_allele_keys(info: Column) -> Column:
    """``info`` without allele-specific keys, those that begin with ``AS_``."""
    return F.map_filter(info, lambda k, _: ~k.startswith("AS_"))


def apobec3_candidate(info: Column) -> Column:
    """Whether the APOBEC3 motif is worth looking up: by flag, or APOBEC anywhere in EDIT_SIG."""
    return F.map_contains_key(info, "APOBEC3_SIG") | F.upper(F.coalesce(info["EDIT_SIG"], F.lit(""))).contains("APOBEC")


# --- further fields -------------------------------------------------------------------------------------


def sample_depth(dp: Column, ad: Column) -> Column:
    """The depth field, else the sum of the counts."""
    return F.coalesce(dp.cast("long"), depth_of(ad))


def set_gt(gt: Column, value: str = "0/0") -> Column:
    """The genotype, or ``value`` where it is missing."""
    return F.when(gt_missing(gt), value).otherwise(gt)


def first_alt_count(ad: Column, fad: Column, af: Column, dp: Column, info: Column) -> Column:
    """Count of the first alternate: from AD, FAD, AF times DP of the sample, or DP times AF (else MLEAF) of INFO."""
    second = lambda c: F.get(F.split(c, ","), F.lit(1)).try_cast("double")
    number = lambda k: info[k].try_cast("double")
    return F.coalesce(second(ad), second(fad), af.try_cast("double") * dp.try_cast("double"), number("DP") * F.coalesce(number("AF"), number("MLEAF")))


def gene_and_transcript(info: Column) -> Column:
    """``gene`` and ``transcript`` of the first ANN entry (fields 4 and 7), else a guess from the first CSQ entry; empty where unknown.

    In CSQ the gene is the first field of two or more letters, digits or ``_.-`` that does not begin with ENST, the
    transcript the first ENST accession before it.
    """
    fields = lambda key: F.split(F.get(F.split(info[key], ","), F.lit(0)), r"\|")
    ann, csq = fields("ANN"), fields("CSQ")
    names = F.transform(csq, lambda f: f.rlike(r"^[A-Za-z0-9_.-]{2,}$") & ~f.startswith("ENST"))
    at = F.array_position(names, True)
    before = F.when(at > 0, F.slice(csq, F.lit(1), at.cast("int"))).otherwise(csq)
    guess = F.struct(F.when(at > 0, F.get(csq, (at - 1).cast("int"))).otherwise("").alias("gene"), F.coalesce(F.get(F.filter(before, lambda f: f.rlike(r"^ENST\d+")), F.lit(0)), F.lit("")).alias("transcript"))
    sure = F.struct(F.coalesce(F.get(ann, F.lit(3)), F.lit("")).alias("gene"), F.coalesce(F.get(ann, F.lit(6)), F.lit("")).alias("transcript"))
    none = F.struct(F.lit("").alias("gene"), F.lit("").alias("transcript"))
    return F.when(F.map_contains_key(info, "ANN"), sure).when(F.map_contains_key(info, "CSQ"), guess).otherwise(none)


def location_parts(location: Column) -> Column:
    """``chrom:start[-end]`` as a struct of normalised ``chrom`` and ``pos``; null if it reads otherwise."""
    s = F.trim(location)
    behind = F.when(F.instr(s, ":") > 0, F.substring(s, F.instr(s, ":") + 1, 1 << 30))
    pos = F.trim(F.substring_index(behind, "-", 1)).try_cast("long")
    return F.when(pos.isNotNull(), F.struct(chrom_norm(F.substring_index(s, ":", 1)).alias("chrom"), pos.alias("pos")))


def location_of(chrom: Column, pos: Column) -> Column:
    """A made-up location ``chrom:pos``; the chromosome goes without its prefix."""
    return F.concat(chrom_norm(chrom), F.lit(":"), pos.cast("string"))


def amino_acid_pair(value: Column) -> Column:
    """``R/A`` as a struct ``ref``, ``alt``; a value without slash is the reference alone; empty texts where it is missing."""
    t = F.coalesce(known_text(value), F.lit(""))
    return F.struct(F.substring_index(t, "/", 1).alias("ref"), F.when(F.instr(t, "/") > 0, F.substring(t, F.instr(t, "/") + 1, F.length(t))).otherwise("").alias("alt"))


def af_into_format(keys: Column, values: Column, info: Column) -> Column:
    """FORMAT keys and a sample's values with AF of INFO as third field, as a struct ``keys``, ``values``; unchanged where INFO has none."""
    put = lambda text, x: F.array_join(F.concat(F.slice(F.split(text, ":"), 1, 2), F.array(x), F.slice(F.split(text, ":"), F.lit(3), F.greatest(F.size(F.split(text, ":")) - 2, F.lit(0)))), ":")
    af = info["AF"].try_cast("double").cast("string")
    return F.when(af.isNotNull(), F.struct(put(keys, F.lit("AF")).alias("keys"), put(values, af).alias("values"))).otherwise(F.struct(keys.alias("keys"), values.alias("values")))


def origin(values: Column) -> Column:
    """The last but one element of a sample's text, which names its origin in records without SOURCE_SET."""
    return F.element_at(F.concat(F.array(F.lit(None).cast("string"), F.lit(None).cast("string")), F.split(values, ":")), -2)


def format_subset(fields: Column, wanted: tuple[str, ...] = ("GT", "AD", "AF", "DP", "F1R2", "F2R1", "FAD", "SB")) -> Column:
    """A sample's fields (a map) as a struct of just the wanted ones, in that order; missing ones are null."""
    return F.struct(*(null_if_missing(fields[k]).alias(k) for k in wanted))
