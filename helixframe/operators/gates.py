"""Gates that reject patients or files with a reason, and counts that are taken while the main plan runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import variant as v
from .records import input_validity, known_sites_only

#: Why a patient or a file is rejected.
MISSING_GENOTYPES, NO_KNOWN_SITES, NO_KNOWN_FIELD = "MISSING_TUMOR_GT", "NO_KNOWN_SITES", "NO_KNOWN_RNAEDIT_DB"


def missing_genotypes(composed: DataFrame) -> DataFrame:
    """Rejects: patients with a record whose ``tumour_gt`` is missing, and how many they have."""
    n = F.count_if(v.gt_missing(F.col("tumour_gt"))).alias("n")
    return composed.groupBy("patient").agg(n).where("n > 0").select("patient", F.lit(MISSING_GENOTYPES).alias("reason"), "n")


def known_site_rejects(records: DataFrame, pattern: str) -> DataFrame:
    """Rejects: patients none of whose records matches ``pattern`` by ``known_db``; the reason says whether any has the field at all. ``n`` counts their records."""
    hit = F.coalesce(F.col("known_db").rlike(pattern) & ~F.col("known_db").isin("", "."), F.lit(False))
    sums = records.groupBy("patient").agg(F.count_if(hit).alias("hits"), F.count("known_db").alias("given"), F.count("*").alias("n"))
    return sums.where("hits = 0").select("patient", F.when(F.col("given") == 0, NO_KNOWN_FIELD).otherwise(NO_KNOWN_SITES).alias("reason"), "n")


def file_rejects(lines: DataFrame) -> DataFrame:
    """Rejects: files without header or without records (``file``, ``reason``, ``n`` records); see ``records.input_validity``."""
    return input_validity(lines).where("status <> 'OK'").select("file", F.col("status").alias("reason"), F.col("records").alias("n"))


def passed(rows: DataFrame, rejects: DataFrame, on: str = "patient", strict: bool = True, observation: Observation | None = None) -> DataFrame:
    """``rows`` without those of rejected patients (or files); all of them if not ``strict``. Others are not held up.

    ``rejects`` has a column ``on`` and may have several reasons for one value; it is small beside ``rows`` and is what gets written as the reject table.
    ``observation``, if given, holds ``rows`` and ``rejected`` (numbers of rows) once the result has been used. A null value of ``on`` is never rejected.
    """
    marked = rows.join(rejects.select(F.col(on).alias("__on")).distinct(), F.col(on) == F.col("__on"), "left").withColumn("__rejected", F.col("__on").isNotNull()).drop("__on")
    if observation is not None:
        marked = marked.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if("__rejected").alias("rejected"))
    return (marked.where("not __rejected") if strict else marked).drop("__rejected")


def known_sites_gate(records: DataFrame, pattern: str, keep_all: bool = False, strict: bool = True, observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Records at known sites, and the rejects. With ``keep_all`` every record passes and nobody is rejected.

    Strict, a patient without any known site is rejected and has no records; else such patients are only reported.
    """
    rejects = known_site_rejects(records, pattern)
    if keep_all:
        return passed(records, rejects.limit(0), observation=observation), rejects.limit(0)
    return known_sites_only(passed(records, rejects, strict=strict, observation=observation), pattern), rejects


def funnel(rows: DataFrame, steps: dict[str, Column], by: str = "patient", more: dict[str, Column] | None = None) -> DataFrame:
    """``by``, ``stage``, ``metric`` and ``value`` of a chain of filters, from one scan of ``rows`` and one aggregate.

    A row is in a stage if it meets the conditions of that stage and all before it (null: not). The first stage, ``input``, has all rows. Metrics are ``records`` and
    the conditions ``more``, counted in each stage.
    """
    reached, inside = F.lit(True), {"input": F.lit(True)}
    for name, ok in steps.items():
        reached = reached & F.coalesce(ok, F.lit(False))
        inside[name] = reached
    counted = {"records": F.lit(True)} | {m: F.coalesce(c, F.lit(False)) for m, c in (more or {}).items()}
    cells = [(stage, metric, in_it & c) for stage, in_it in inside.items() for metric, c in counted.items()]
    sums = rows.groupBy(by).agg(*(F.count_if(c).alias(f"c{i}") for i, (_, _, c) in enumerate(cells)))
    long = F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.lit(m).alias("metric"), F.col(f"c{i}").alias("value")) for i, (s, m, _) in enumerate(cells))))
    return sums.select(by, long.alias("m")).select(by, "m.*")


class Stages:
    """Counts of several stages, each taken where its rows pass by in the plan of whatever uses them; nothing is scanned again.

    >>> stages = Stages()
    >>> out = stages.watch("kept", rows.where("ok"))
    >>> out.write.parquet(path)
    >>> stages.table(spark)  # stage, metric, value
    """

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def watch(self, stage: str, rows: DataFrame, **metrics: Column) -> DataFrame:
        """``rows`` as they are; their number (``records``) and the aggregates ``metrics`` are known once they have been used. A stage is watched once."""
        if stage in self.seen:
            raise ValueError(f"stage {stage} is watched already")
        self.seen[stage] = Observation()
        return rows.observe(self.seen[stage], F.count(F.lit(1)).alias("records"), *(c.cast("long").alias(m) for m, c in metrics.items()))

    def table(self, spark: SparkSession) -> DataFrame:
        """``stage``, ``metric``, ``value``; it waits for stages that nothing has used yet."""
        rows = [(stage, metric, value) for stage, o in self.seen.items() for metric, value in o.get.items()]
        return spark.createDataFrame(rows, "stage string, metric string, value bigint")
