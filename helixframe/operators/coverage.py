"""Coverage overlap of a normal, a tumour and an RNA sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import variant as v

#: The category of each mask.
LABELS = ("NONE", "DNA_NORMAL_only", "DNA_TUMOR_only", "DNA_NORMAL_DNA_TUMOR", "RNA_TUMOR_only", "DNA_NORMAL_RNA_TUMOR", "DNA_TUMOR_RNA_TUMOR", "ALL_THREE")


def joined(coverage: DataFrame, depth: float = 20.0) -> DataFrame:
    """Canonical intervals that all three labels have, with a mask of those at or over ``depth``; one scan and one shuffle.

    A label has a row for each interval; of repeated ones the greatest coverage counts. Null coverage is none.
    """
    key = ["patient", "chrom", "start_pos", "end_pos"]
    labels = ("DN", "DT", "RT")
    one = lambda label: F.max(F.when(F.col("label") == label, F.col("cov"))).alias(f"cov_{label.lower()}")
    rows = coverage.where(F.col("label").isin(*labels) & v.is_canonical(F.col("chrom"))).groupBy(*key).agg(*map(one, labels)).dropna(subset=[f"cov_{x.lower()}" for x in labels])
    bit = lambda c, n: F.when(F.col(c) >= depth, n).otherwise(0)
    mask = bit("cov_dn", 1) + bit("cov_dt", 2) + bit("cov_rt", 4)
    return rows.withColumns({"mask": mask, "category": F.get(F.lit(list(LABELS)), mask), "width": F.col("end_pos") - F.col("start_pos")})


def categories(rows: DataFrame) -> DataFrame:
    """Intervals and bases per category, as shares of all and of the covered ones."""
    total = rows.groupBy("patient").agg(F.count("*").alias("all_n"), F.count_if(F.col("mask") > 0).alias("cov_n"))
    out = rows.groupBy("patient", "category", "mask").agg(F.count("*").alias("intervals"), F.sum("width").alias("bp")).join(total, "patient")
    share = lambda n: F.col("intervals") / F.greatest(F.col(n), F.lit(1))
    return out.select("patient", "category", "intervals", "bp", share("all_n").alias("share_all"), F.when(F.col("mask") > 0, share("cov_n")).otherwise(0.0).alias("share_covered"))


def category_matrix(rows: DataFrame) -> DataFrame:
    """One row per patient and a column per category (0 where a patient has none); bins, whose number has no bound, stay long (see ``bins``)."""
    return rows.groupBy("patient").pivot("category", list(LABELS)).count().fillna(0)


def bins(rows: DataFrame, size: int = 5000) -> DataFrame:
    at = (F.floor(F.col("start_pos") / size) * size).cast("long").alias("bin")
    share = lambda c, n: F.avg(c.cast("int")).alias(n)
    return rows.groupBy("patient", "chrom", at).agg(F.count("*").alias("n"), share(F.col("mask") > 0, "any"), share(F.col("mask") == 7, "all_three"), share(~F.col("mask").isin(0, 7), "discordant"), *(F.avg(f"cov_{x}").alias(f"mean_{x}") for x in ("dn", "dt", "rt")))


def summary(rows: DataFrame) -> DataFrame:
    """Means, exact medians, pairwise Jaccard and Pearson of each patient; null where they do not exist.

    Medians come from counted values (see ``exact_medians``), so that no task holds the values of a patient.
    """
    on = lambda n: F.col("mask").bitwiseAND(F.lit(n)) != 0

    def jaccard(a: int, b: int, name: str) -> Column:
        return F.try_divide(F.count_if(on(a) & on(b)), F.count_if(on(a) | on(b))).alias(name)

    def pearson(a: str, b: str, name: str) -> Column:
        x, y = F.col(a), F.col(b)
        return F.when((F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0), F.corr(x, y)).alias(name)

    c = ("cov_dn", "cov_dt", "cov_rt")
    return rows.groupBy("patient").agg(
        F.count("*").alias("n"), *(F.avg(x).alias(f"mean_{x}") for x in c),
        jaccard(1, 2, "jaccard_dn_dt"), jaccard(1, 4, "jaccard_dn_rt"), jaccard(2, 4, "jaccard_dt_rt"), pearson(c[0], c[1], "pearson_dn_dt"), pearson(c[0], c[2], "pearson_dn_rt"), pearson(c[1], c[2], "pearson_dt_rt"),
        *(F.count_if(F.col("mask") == i).alias(f"n_{name}") for i, name in enumerate(LABELS)),
    ).join(exact_medians(rows, "patient", c), "patient", "left")


def exact_medians(rows: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """``by`` and ``median_<column>`` of each column: the middle value, or the mean of the two middle ones; nulls do not count, and without values it is null.

    Values are counted first; of the counts, running sums tell where the middle lies. What a window spans is the different values of one column.
    Rows with a null ``by`` are a group of their own.
    """
    values = rows.select(by, F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in columns))).alias("v")).select(by, "v.*").where("x is not null")
    counts = values.groupBy(by, "c", "x").agg(F.count("*").alias("k"))
    w = W.partitionBy(by, "c")
    upto = counts.withColumns({"upto": F.sum("k").over(w.orderBy("x").rowsBetween(W.unboundedPreceding, 0)), "n": F.sum("k").over(w)})
    at = lambda place: F.min(F.when(F.col("upto") > F.floor(place / 2), F.col("x")))
    middle = upto.groupBy(by, "c").agg(((at(F.col("n") - 1) + at(F.col("n"))) / 2).alias("m"))
    return middle.groupBy(by).agg(*(F.max(F.when(F.col("c") == c, F.col("m"))).alias(f"median_{c}") for c in columns))


def cohort_bins(per_patient: DataFrame) -> DataFrame:
    return per_patient.groupBy("chrom", "bin").agg(F.count("*").alias("patients"), F.avg("any").alias("any"), F.avg("all_three").alias("all_three"), F.avg("discordant").alias("discordant"), *(F.avg(c).alias(c) for c in ("mean_dn", "mean_dt", "mean_rt")))


def worst_bins(per_patient: DataFrame, n: int = 50) -> DataFrame:
    """Report of the ``n`` bins that disagree most."""
    return per_patient.orderBy(F.desc("discordant"), "all_three", "patient", "chrom", "bin").limit(n)
