"""Hand-written cases of records with several alternates, and of stage choice."""

from pyspark.sql import functions as F

from helixframe.operators import alternates


def test_metrics_fall_back(spark):
    rows = [
        ("both", "A,C", "10,3,1", None, "20", "0.1,0.2"), ("one af", "A,C", "10,3,1", None, None, "0.5"), ("bad ad", "A", "10,x", "4,2", None, None), ("fad", "A", ".", "4,2", None, None),
        ("af dp", "A", None, None, "8", "0.25"), ("none", None, "1,2", None, None, None), ("short", "A,C", "5,5", None, "9", "0.1"), ("zero", "A", "0,0", None, ".", "."),
    ]
    df = spark.createDataFrame(rows, "id string, alts string, ad string, fad string, dp string, af string")
    got = {(r.id, r.alt): (r.depth, r.share, r.alt_count) for r in alternates.per_alternate(df).collect()}
    assert got == {
        ("both", "A"): (20, 0.1, 3), ("both", "C"): (20, 0.2, 1), ("one af", "A"): (14, 0.5, 3), ("one af", "C"): (14, 0.5, 1), ("bad ad", "A"): (6, None, 2), ("fad", "A"): (6, None, 2),
        ("af dp", "A"): (8, 0.25, 2), ("none", None): (3, None, None), ("short", "A"): (9, 0.1, 5), ("short", "C"): (9, 0.1, 0.9), ("zero", "A"): (0, None, 0),
    }
    assert alternates.per_alternate(df.limit(0)).count() == 0


def test_stage_and_route(spark):
    made = spark.createDataFrame([("P", "b", "pb"), ("P", "a", None), ("Q", "c", "qc"), ("Q", "a", "qa"), ("R", "other", "r")], "patient string, stage string, path string")
    assert sorted(map(tuple, alternates.first_stage(made, ["a", "b", "c"]).collect())) == [("P", "b", "pb"), ("Q", "a", "qa")]
    rna = made.where("patient = 'P'")
    assert sorted(map(tuple, alternates.routes(made, rna).collect())) == [("P", "three_way"), ("Q", "dna_only"), ("R", "dna_only")]
    assert {r.route for r in alternates.routes(made, rna, allow_with_rna=True).collect()} == {"dna_only"}


def test_backfill_takes_the_last_row(spark):
    phased = spark.createDataFrame([("P", "1", 5, "0|1"), ("P", "1", 6, "1|0"), ("P", "1", 5, "0/1")], "patient string, chrom string, pos bigint, gt string").withColumn("af", F.lit(None))
    before = spark.createDataFrame([("P", "1", 5, "r1", 0.1), ("P", "1", 5, "r2", 0.2)], "patient string, chrom string, pos bigint, rid string, af double")
    assert sorted((r.pos, r.af) for r in alternates.backfill_af(phased, before).collect()) == [(5, 0.2), (6, None)]
