"""Steps that have to stay small or bounded as tables grow, and the odd rows they must not lose."""

from pyspark.sql import functions as F

from helixframe.functions import variant as v
from helixframe.operators import records


def test_info_steps_are_linear(spark):
    """Each step of an INFO map names the one before it once; four steps used to name the first 256 times."""
    info = v.with_flags_restored(v.with_edit_list(v.with_flag(v.without_allele_keys(F.col("info")), "SOMATIC")))
    plan = spark.createDataFrame([({"EDIT_SIG": "ADAR"},)], "info map<string,string>").select(info.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("AS_") == 1


def test_merged_info_keeps_empty_positions(spark):
    rows = [("P", 1, "a", {"SOURCE_SET": "", "DP": None}), ("P", 1, "b", {"SOURCE_SET": "X,Y", "DP": "2"}), ("P", 1, "c", {"SOURCE_SET": "Y,,Z"}), ("P", 2, "d", {}), ("P", 3, "e", None), ("P", 4, "f", {"EDIT_SIG": ""}), ("P", 5, "g", {"EDIT_SIG": "ADAR"})]
    out = records.merged_info(spark.createDataFrame(rows, "patient string, pos long, rid string, info map<string,string>"), ["patient", "pos"], ["rid"])
    assert {r.pos: r.info for r in out.collect()} == {1: {"DP": None, "SOURCE_SET": "X,Y,Z"}, 2: {}, 3: {}, 4: {}, 5: {"EDIT_SIG": "ADAR", "ADAR_SIG": "1"}}


def _brute(a, b, distance):
    """The flags by definition, over all pairs."""
    alleles = lambda gt: gt.replace("|", "/").split("/")
    hom = lambda gt: len(alleles(gt)) == 2 and alleles(gt)[0] == alleles(gt)[1] and alleles(gt)[0] not in "0."
    sides = lambda gt: {i for i, x in enumerate(alleles(gt)) if "|" in gt and len(alleles(gt)) == 2 and gt != ".|." and x not in "0."}
    out = {}
    for x in a:
        if not any(i not in "0." for i in alleles(x[3])):
            continue
        near = sorted((y[2], y[5], y) for y in b if y[:2] == x[:2] and abs(y[2] - x[2]) <= distance and y[5] != x[5])
        cis = lambda y, x=x: not hom(x[3]) and not hom(y[3]) and x[4] is not None and x[4] == y[4] and bool(sides(x[3]) & sides(y[3]))
        same = [y for _, _, y in near if hom(x[3]) or hom(y[3]) or cis(y)]
        if near:
            out[x[5]] = (hom(x[3]), not hom(x[3]) and bool(same), not hom(x[3]) and bool(same) and cis(same[0]))
    return out


def test_same_copy_equals_brute_force(spark):
    """Dense rows, ties of position, rows of both tables, null blocks; and no join, so that the cost does not grow with the neighbours."""
    import random

    from helixframe.operators import clusters

    r = random.Random(3)
    make = lambda tag, n: [(f"P{r.randrange(2)}", "chr1", r.randrange(60), r.choice(["0|1", "1|0", "1|2", "1/1", "0/1", "2|2", "./.", ".|1", "0|0"]), r.choice([None, 1, 2]), f"{tag}{i:03}") for i in range(n)]
    both = make("z", 40)
    a, b = make("a", 80) + both, make("b", 60) + both
    schema = "patient string, chrom string, pos long, gt string, ps long, rid string"
    out = clusters.first_same_copy(spark.createDataFrame(a + a[:5], schema), spark.createDataFrame(b, schema), 5)
    assert {x.rid: (x.hom_any, x.het_same, x.het_cis) for x in out.collect()} == _brute(a, b, 5)
    assert out.count() == len(_brute(a, b, 5))
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_like_calls_are_held_once(spark):
    """3,000 calls of one position are a few different ones; the counts are those of the first that knows them."""
    from helixframe.operators import merge
    from helixframe.plans import catalog

    rows = [("P", "chr1", 1, f"r{i:04}", "A", "G" if i % 2 else "GT,G", "SOMATIC", ("0/1", "0|1", "1|1")[i % 3], 7, None if i < 9 else [i, None if i % 5 else i, i]) for i in range(3000)] + [("P", "chr1", 1, "z", "AC", "A", "GERMLINE", "0/1", 7, [1, 2])]
    out = merge.merge_sources(spark.createDataFrame(rows, "patient string, chrom string, pos long, rid string, ref string, alt string, source_set string, gt string, ps long, ad array<int>"))
    r = out.collect()[0]
    assert (r.ref, r.alts, r.gt_somatic, r.gt_germline, r.gt_rna_edit) == ("AC", "GTC,GC,A", "1/1/2/2", "0/1" if r.alts.startswith("A") else "0/3", "./.")
    # place 1 of the lists with two alternates is known at multiples of five; GC from r0009, which names nothing else, is unknown there until r0010
    assert r.ad_somatic == [9, 10, 10, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ") == 2
    plan = catalog.QUERIES["compose_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_strand_support_without_pairs(spark):
    """200 calls by 300 reads that are alike, at one place, are one position by one read with its number."""
    from helixframe.operators import strand

    calls = spark.createDataFrame([(f"r{i}", "P", "chr1", 11, "a" if i % 2 else "C", ["-"] if i % 4 < 2 else ["+"]) for i in range(200)], "rid string, patient string, chrom string, pos long, alt string, strands array<string>")
    reads = spark.createDataFrame([("P", "chr1", 5, 0, 60, "10M", "AAAAAAAAAA", None)] * 300, "patient string, contig string, pos0 long, flag int, mapq int, cigar string, seq string, quals array<int>")
    out = strand.with_alt_support(calls, reads)
    # a forward single read counts for the other strand, as the default protocol has it
    assert {(r.alt, r.strands[0], r.expected, r.opposite, r.alt_reads) for r in out.collect()} == {("a", "-", 300, 0, 300), ("a", "+", 0, 300, 300), ("C", "-", 0, 0, 0), ("C", "+", 0, 0, 0)}
    assert out.count() == 200


def test_stages_stay_compilable(spark):
    """Queries have Spark take stages apart whose one method the JVM would not compile."""
    from helixframe.plans import catalog

    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    catalog.QUERIES["vep_collapse"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_lines_meet_their_header_without_shuffle(spark):
    """Lines are not shuffled by their few files; odd lines and columns in another order are read as before."""
    from helixframe.sources import text

    lines = [("a.vcf", "﻿#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts"), ("a.vcf", "1\t5\t.\tA\tG\t.\t.\t.\tGT\t0/1"), ("a.vcf", "\x00 #note"), ("a.vcf", " ﻿"), ("a.vcf", " 1 6 . A G . . . GT 1/1"), ("a.vcf", "1\t7\tx #CHROM"), ("a.vcf", "")]
    out = text.records_of(spark.createDataFrame(lines, "file string, value string"))
    assert sorted((r.pos, [tuple(s) for s in r.samples]) for r in out.collect()) == [(5, [("s", "0/1")]), (6, [("s", "1/1")])]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    notes = spark.createDataFrame([("a", "#Uploaded_variation\tGene\tLocation"), ("a", "u\tg"), ("a", " "), ("b", "u\tl\ta\tg")], "file string, value string")
    out = text.annotation_of(notes)
    assert sorted((r.file, r.Uploaded_variation, r.Location, r.Allele, r.Gene, r.Extra) for r in out.collect()) == [("a", "u", "", "", "g", ""), ("b", "u", "l", "a", "g", "")]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_tiers_join_once_and_ranks_shuffle_once(spark):
    from helixframe.operators import annotate
    from helixframe.plans import fixtures

    key = "patient string, chrom string, pos long, ref string, alt string"
    calls = spark.createDataFrame([("P", "1", 1, "A", "G", "a", 1), ("P", "1", 1, "A", "G", "c", 2), ("P", "1", 1, "T", "G", "d", 3), ("P", "1", 1, None, "G", "b", 4), ("P", "1", 2, None, "G", "a", 5)], key + ", rid string, x int")
    rows = spark.createDataFrame([("P", "1", 1, r, "G") for r in ("A", "T", "C", None)] + [("P", "1", 2, "A", "G"), ("P", "1", 3, "A", "G")], key)
    out = annotate.two_tier(rows, calls, ["x"])
    assert {(r.pos, r.ref): (r.tier, r.x) for r in out.collect()} == {(1, "A"): ("full", 2), (1, "T"): ("full", 3), (1, "C"): ("alt", 3), (1, None): ("alt", 3), (2, "A"): ("alt", 5), (3, "A"): ("none", None)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    ranked = annotate.ranked_transcripts(fixtures.table(spark, "/root/testdata/sf0.001", "vep"))
    assert ranked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_sets_take_ready_rows(spark):
    """What is collected into sets is worked out before the shuffle, and strands need no sets."""
    from helixframe.operators import annotate
    from helixframe.plans import fixtures

    vep, calls = (fixtures.table(spark, "/root/testdata/sf0.001", t) for t in ("vep", "calls"))
    plan = annotate.collapse(vep)._jdf.queryExecution().executedPlan().toString()
    assert "collect_set(__row" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "collect_set" not in annotate.annotation_strands(calls, vep)._jdf.queryExecution().executedPlan().toString()


def test_edit_values_are_compiled(spark):
    """The generator that binds values takes them from columns; it works out none itself."""
    from helixframe.operators import edits

    plan = edits._bound(spark.range(3), x=F.col("id") + 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(array(struct(__x, __bound_x" in plan
    places = spark.createDataFrame([("P", "1:1", "A", "x")], "patient string, Location string, Allele string, Consequence string")
    assert edits.consequence_sets(places)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_short_contexts_join_one_chunk(spark):
    """A place that ends within the reach of its chunk is cut from that one; longer ones, and what is no place, come out as before."""
    from helixframe.sources import sequence

    bases = "ACGTTGCAGATC" * 30
    lines = spark.createDataFrame([("chr1", i, bases[i : i + 7]) for i in range(0, len(bases), 7)], "contig string, start long, bases string")
    asked = [("1", s, s + n) for s in (-1, 0, 1, 9, 16, 17, 340) for n in (-1, 0, 15, 20, 21, 22, 60)] + [("2", 1, 2), (None, 1, 2), ("1", None, 2)]
    out = sequence.with_context(spark.createDataFrame(asked, "c string, s long, e long"), lines, "c", F.col("s"), F.col("e"), "ctx", 16, 20)
    whole = lambda c, s, e: bases[s - 1 : e] if c == "1" and s is not None and s >= 1 and s <= e <= len(bases) else None
    assert sorted(map(str, ((r.c, r.s, r.e, r.ctx) for r in out.collect()))) == sorted(map(str, ((c, s, e, whole(c, s, e)) for c, s, e in asked)))

def test_clusters_sort_calls_once(spark):
    """Calls are sorted once on the way to their summary, and counted without a sort; chains of any least length come out as by definition."""
    import random

    from helixframe.operators import clusters
    from helixframe.plans import catalog

    r = random.Random(5)
    names = lambda: (r.choice(["g1", "g2", "", None]), r.choice(["t1", "t2", "", None]), r.choice(["ADAR", "OTHER", None]), r.choice([None, 3.0, 4.0]), r.choice([None, ".", "", "1", "1", "2"]))
    data = [(r.choice(["P", "Q", None]), r.choice(["1", "2", None]), r.choice([None, *range(0, 600, 3)]), f"r{i:03}", *names()) for i in range(400)]
    calls = spark.createDataFrame(data, "patient string, chrom string, pos long, rid string, gene string, transcript string, signature string, dp double, ps string")
    for least in (1, 2, 4):
        chains: list[list] = []
        for x in sorted((x for x in data if x[0] and x[1]), key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0, x[3])):
            last = chains[-1][-1] if chains else None
            if last and last[:2] == x[:2] and last[2] is not None and x[2] - last[2] <= 5:
                chains[-1].append(x)
            else:
                chains.append([x])
        first = {}
        for x in data:
            if x[0]:
                first[x[0]], first[x[:2]] = min(first.get(x[0], "s"), x[3]), min(first.get(x[:2], "s"), x[3])
        kept = sorted((c for c in chains if len(c) >= least), key=lambda c: (first[c[0][0]], first[c[0][:2]], chains.index(c)))
        want = {x[3]: f"CL{i:06d}" for i, c in enumerate(kept, 1) for x in c}
        found = clusters.clusters(calls, 5, least)
        assert {x.rid: x.cluster_id for x in found.collect()} == want and found.count() == len(want)

        def top(c, i):
            seen = [x[i] for x in c if x[i]]
            return max(seen, key=lambda v: (seen.count(v), -seen.index(v))) if seen else ""

        def line(i, c):
            dps, blocks = [x[7] for x in c if x[7] is not None], {x[8] for x in c if x[8] not in (None, "", ".")}
            sig = [sum(x[6] == s for x in c) for s in ("ADAR", "APOBEC3", "OTHER")]
            return f"CL{i:06d}", c[0][0], c[0][1], c[0][2], c[-1][2], len(c), *sig, round(sum(dps) / len(dps), 3) if dps else 0.0, int(len(blocks) == 1 and len(c) > 1), top(c, 4), top(c, 5)

        lines = [line(i, c) for i, c in enumerate(kept, 1)]
        cols = ("cluster_id", "patient", "chrom", "start", "end", "n_variants", "adar_count", "apobec_count", "other_count", "mean_rna_dp", "single_ps_block", "top_gene", "top_transcript")
        for out in (clusters.summarised_clusters(calls, 5, least), clusters.cluster_summary(found)):
            assert sorted(map(tuple, out.select(*cols).collect())) == lines
    plan = catalog.QUERIES["cluster_summary"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    of_calls = [x for x in plan.splitlines() if "Sort [" in x and "pos#" in x]
    assert len(of_calls) == 3 and "__no" not in plan
    # names are counted in hash tables, by numbers of fixed width
    assert not [x for x in plan.splitlines() if "SortAggregate" in x and "count_if" in x] and "min(struct(pos" not in plan
    assert [x for x in plan.splitlines() if "HashAggregate" in x and "min(__at" in x]
    # counts are shuffled, so that no task holds them beside the calls
    assert "Exchange hashpartitioning(__key" in plan
