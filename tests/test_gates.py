"""Gates, counts along the plan, sweeps, counted medians and bucketed tables."""

import random
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import coverage, gates, ranges, records, rna_edit
from helixframe.sources import layout


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_missing_genotypes_reject_the_patient(spark):
    df = spark.createDataFrame([("P", "0/1"), ("P", "./."), ("P", None), ("Q", "0|1"), ("R", "."), (None, "0/1")], "patient string, tumour_gt string")
    rejects = gates.missing_genotypes(df)
    assert rows(rejects, "patient", "reason", "n") == [("P", "MISSING_TUMOR_GT", 2), ("R", "MISSING_TUMOR_GT", 1)]
    seen = Observation()
    kept = gates.passed(df, rejects, observation=seen).collect()
    assert sorted((r.patient or "", r.tumour_gt) for r in kept) == [("", "0/1"), ("Q", "0|1")]
    assert seen.get == {"rows": 6, "rejected": 4}
    lenient = Observation()
    assert gates.passed(df, rejects, strict=False, observation=lenient).count() == 6 and lenient.get["rejected"] == 4


def test_known_sites_gate(spark):
    df = spark.createDataFrame([("P", "REDI"), ("P", None), ("Q", "x"), ("R", None), ("S", "."), ("S", "")], "patient string, known_db string")
    kept, rejects = gates.known_sites_gate(df, "REDI|DARNED")
    assert rows(rejects, "patient", "reason", "n") == [("Q", "NO_KNOWN_SITES", 1), ("R", "NO_KNOWN_RNAEDIT_DB", 1), ("S", "NO_KNOWN_SITES", 2)]
    assert rows(kept, "patient", "known_db") == [("P", "REDI")]
    every, nobody = gates.known_sites_gate(df, "REDI", keep_all=True)
    assert every.count() == 6 and nobody.count() == 0
    lenient, reported = gates.known_sites_gate(df, ".", strict=False)
    assert reported.count() == 2 and {r.patient for r in lenient.collect()} == {"P", "Q"}


def test_files_are_rejected_with_reasons_that_can_be_written(spark, tmp_path):
    lines = spark.createDataFrame([("a", "#CHROM\tPOS"), ("a", "1\t5"), ("b", "1\t5"), ("c", "##x"), ("c", "#CHROM\tPOS")], "file string, line string")
    rejects = gates.file_rejects(lines)
    rejects.write.parquet(str(tmp_path / "rejects"))
    assert rows(spark.read.parquet(str(tmp_path / "rejects")), "file", "reason", "n") == [("b", "NO_HEADER", 1), ("c", "EMPTY", 0)]
    assert rows(gates.passed(lines, rejects, on="file"), "file", "line") == [("a", "#CHROM\tPOS"), ("a", "1\t5")]


def test_stages_are_counted_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(100).withColumn("patient", F.concat(F.lit("P"), F.col("id") % 3)).write.parquet(path)
    df = spark.read.parquet(path)
    stages = gates.Stages()
    a = stages.watch("input", df, even=F.count_if(F.col("id") % 2 == 0))
    b = stages.watch("small", a.where("id < 40"), biggest=F.max("id"))
    c = stages.watch("grouped", b.groupBy("patient").agg(F.count("*").alias("n")))
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and c.count() == 3
    assert rows(stages.table(spark), "stage", "metric", "value") == [("grouped", "records", 3), ("input", "even", 50), ("input", "records", 100), ("small", "biggest", 39), ("small", "records", 40)]
    with pytest.raises(ValueError, match="watched"):
        stages.watch("input", df)
    steps = gates.funnel(df, {"even": F.col("id") % 2 == 0, "small": F.when(F.col("id") != 4, F.col("id") < 10)}, more={"third": F.col("id") % 3 == 0})
    assert steps._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    want = {("P0", s, m): n for s, m, n in (("input", "records", 34), ("input", "third", 34), ("even", "records", 17), ("even", "third", 17), ("small", "records", 2), ("small", "third", 2))}
    assert {(r.patient, r.stage, r.metric): r.value for r in steps.where("patient = 'P0'").collect()} == want


def test_sweep_equals_bins_whatever_the_length(spark):
    rnd = random.Random(5)
    for longest in (3, 300, 30_000):
        points = [(rnd.choice("ab"), rnd.choice([rnd.randrange(0, 2000), rnd.randrange(-50, 40_000), None])) for _ in range(300)]
        spans = [(rnd.choice("abc"), s, s + rnd.randint(-2, longest), rnd.choice("xy")) for s in (rnd.randrange(0, 30_000) for _ in range(200))]
        p = spark.createDataFrame([*points, (None, 5)], "k string, at bigint")
        i = spark.createDataFrame([*spans, ("a", None, 5, "x"), ("a", 5, None, "x"), (None, 1, 9, "x")], "k string, s bigint, e bigint, kind string")
        kinds = {"x": F.col("kind") == "x", "every": F.lit(True)}
        for block in (7, 1000, 1_000_000):
            got = {(r.k, r["at"]): (r.x, r.every) for r in ranges.covering(p, i, ["k"], "at", "s", "e", kinds, block).collect()}
            held = lambda k, x: [kind for c, s, e, kind in spans if c == k and s <= x < e]
            assert got == {(k, x): (held(k, x).count("x"), len(held(k, x))) for k, x in set(points) if x is not None}
        for size in (2, 500):
            pairs = ranges.in_intervals(p.distinct(), i, ["k"], "at", "s", "e", size).groupBy("k", "at").count()
            assert {(r.k, r["at"]): r["count"] for r in pairs.collect()} == {at: n for at, (_, n) in got.items() if n}


def test_counted_medians(spark):
    rnd = random.Random(6)
    data = [(g, rnd.choice([None, float(rnd.randint(0, 4)), rnd.random()]), float(rnd.randint(0, 2))) for g in ("a", "b", "b", "c") for _ in range(rnd.randint(1, 30))] + [("d", None, 1.0), ("d", None, 2.0), ("e", 3.0, None)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    want = {r.g: (r.x, r.y) for r in df.groupBy("g").agg(F.median("x").alias("x"), F.median("y").alias("y")).collect()}
    assert {r.g: (r.median_x, r.median_y) for r in coverage.exact_medians(df, "g", ["x", "y"]).collect()} == want


def test_bucketed_calls_need_no_exchange(spark, tmp_path):
    rnd = random.Random(7)
    calls = [(f"P{rnd.randrange(4)}", f"chr{rnd.randrange(3)}", rnd.randrange(60), rnd.choice("ACGT"), rnd.choice("ACGT"), rnd.choice(["0/1", "1/1"]), str(i)) for i in range(400)]
    df = spark.createDataFrame(calls, "patient string, chrom string, pos bigint, ref string, alt string, gt string, rid string")
    names = ("layout_rna", "layout_dna")
    try:
        for name, part in zip(names, (df.where("cast(rid as int) % 2 = 0"), df.where("cast(rid as int) % 2 = 1"))):
            layout.write_calls(part, name, 4)
        join = "spark.sql.autoBroadcastJoinThreshold"
        before = spark.conf.get(join)
        spark.conf.set(join, "-1")
        try:
            with layout.by_bucket(spark):
                rna, dna = (spark.table(n) for n in names)
                anti = rna_edit.without_positions(rna, dna)
                near = rna.withColumn("gap", F.col("pos") - F.lag("pos").over(W.partitionBy("patient", "chrom").orderBy("pos", "rid")))
                for plan in (anti, near, records.with_normals(rna, dna)):
                    text = plan._jdf.queryExecution().executedPlan().toString()
                    assert not re.search(r"Exchange", text), text
                got = rows(anti, "rid")
                normals = rows(records.with_normals(rna, dna), "rid", "normal_gt")
            assert got == rows(rna_edit.without_positions(spark.table(names[0]), spark.table(names[1])), "rid") and normals == rows(records.with_normals(df.where("cast(rid as int) % 2 = 0"), df.where("cast(rid as int) % 2 = 1")), "rid", "normal_gt")
        finally:
            spark.conf.set(join, before)
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
