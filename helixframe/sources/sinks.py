"""Writers and the tables behind them: per-patient and cohort tables, lists, metrics, record text, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import RECORD


def _tsv(writer, path: str) -> None:
    writer.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("nullValue", "NA").csv(path)


def write_per_patient(df: DataFrame, path: str, order: list[str], patient: str = "patient") -> None:
    """One folder of tab-separated files per patient, sorted by ``order`` over its files. A patient with many rows is spread over several tasks."""
    _tsv(df.repartitionByRange(patient, *order).sortWithinPartitions(patient, *order).write.partitionBy(patient), path)


def write_cohort(df: DataFrame, path: str, order: list[str]) -> None:
    """All patients as one sorted table."""
    _tsv(df.orderBy(*order).write, path)


def write_list(df: DataFrame, column: str, path: str) -> None:
    """The distinct values of a column, sorted; null is left out."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def write_split(df: DataFrame, path: str, reason: str = "reason") -> None:
    """Kept rows (null or PASS as ``reason``) under kept=true, the others under kept=false with their reason; one pass."""
    kept = F.coalesce(F.col(reason) == "PASS", F.lit(True))
    _tsv(df.withColumn("kept", kept).write.partitionBy("kept"), path)


def metrics(df: DataFrame, **values: Column) -> DataFrame:
    """``metric`` and ``value`` (text) of named aggregates, in one pass over ``df``."""
    one = df.agg(*(c.cast("string").alias(name) for name, c in values.items()))
    return one.unpivot([], list(values), "metric", "value")


def kept_rows(annotation: DataFrame, kept: DataFrame, key: str = "Uploaded_variation") -> DataFrame:
    """Annotation rows whose key is among the kept ones, with all their columns."""
    return annotation.join(kept.select(key), key, "left_semi").select(*annotation.columns)


def record_lines(records: DataFrame, header: DataFrame | None = None, new_header: list[str] | None = None) -> DataFrame:
    """``file`` and ``line``: records as text, sorted within each file, behind its header lines.

    ``records`` are those of ``read_records``. ``header`` has ``file``, ``line_no`` and ``line``;
    ``new_header`` are lines for every file that has them not yet; they stand before its #CHROM line.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in RECORD[:8]]
    calls = F.when(F.size("samples") > 0, F.concat(F.array(F.coalesce("format", F.lit("."))), F.transform("samples", lambda s: F.coalesce(s["value"], F.lit(".")))))
    line = F.concat_ws("\t", *fields, calls)
    key = lambda part, n, chrom, pos: F.struct(F.lit(part).alias("part"), n.cast("long").alias("n"), chrom.cast("string").alias("chrom"), pos.cast("long").alias("pos"))
    none = F.lit(None)
    out = records.select("file", key(3, F.lit(0), F.col("chrom"), F.col("pos")).alias("key"), line.alias("line"))
    if header is not None:
        part = F.when(F.col("line").startswith("#CHROM"), 2).otherwise(0)
        old = header.select("file", key(0, F.col("line_no"), none, none).withField("part", part).alias("key"), "line")
        out = out.unionByName(old)
        for i, text in enumerate(new_header or []):
            without = header.groupBy("file").agg(F.max((F.col("line") == text).cast("int")).alias("has")).where("has = 0")
            out = out.unionByName(without.select("file", key(1, F.lit(i), none, none).alias("key"), F.lit(text).alias("line")))
    return out.orderBy("file", "key", "line").select("file", "line")


def completeness(patients: DataFrame, stages: list[str], outputs: DataFrame) -> DataFrame:
    """``patient``, ``stage``, ``status`` (OK, EMPTY, MISSING) and ``input`` (status of the stage before; null for the first).

    ``outputs`` has ``patient``, ``stage`` and ``n`` (rows or bytes); of several the largest counts.
    """
    expected = patients.select("patient").distinct().select("patient", F.posexplode(F.lit(stages)).alias("place", "stage"))
    there = outputs.groupBy("patient", "stage").agg(F.max("n").alias("n"))
    status = F.when(F.col("n").isNull(), "MISSING").when(F.col("n") == 0, "EMPTY").otherwise("OK")
    marked = expected.join(there, ["patient", "stage"], "left").select("patient", F.struct("place", "stage", status.alias("status")).alias("s"))
    # a patient has as many rows as there are stages
    rows = marked.groupBy("patient").agg(F.sort_array(F.collect_list("s")).alias("all"))
    out = rows.select("patient", "all", F.explode("all").alias("s"))
    return out.select("patient", "s.stage", "s.status", F.get("all", F.col("s.place") - 1)["status"].alias("input"))
