"""Calls as bucketed tables, so that joins by position and windows by chromosome need no exchange."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: What tables are bucketed by; a window partitioned by these and a join that includes them fit the buckets.
KEY = ("patient", "chrom")


def write_calls(calls: DataFrame, table: str, buckets: int, order: tuple[str, ...] = ("pos",)) -> None:
    """``calls`` as the table ``table`` of ``buckets`` buckets by patient and chromosome, sorted within each by these and ``order``.

    Rows are brought to their bucket first, so each bucket is one file. Tables that are to be joined have the same number of
    buckets. A patient's chromosome is one bucket at most: more buckets than patients times chromosomes are of no use.
    """
    calls.repartition(buckets, *KEY).write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY, *order).saveAsTable(table)


@contextmanager
def by_bucket(spark: SparkSession) -> Iterator[None]:
    """Within, plans may join by position on buckets of fewer columns than the join has; sessions of before have their settings back afterwards.

    Plans must be run within, too.
    """
    key = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k) for k in key}
    for k, x in key.items():
        spark.conf.set(k, x)
    try:
        yield
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
