"""Where queries and their SQL are registered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .fixtures import table, with_tables

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, tables: str = "", sql: str | None = None):
    """Registers a query; ``sql`` follows the projections ``tables`` as further common table expressions."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the JVM does not compile methods beyond 8,000 bytes; Spark then takes the stage apart, in place of interpreting it
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
            return f(*(table(spark, sf_dir, t) for t in tables.split()))

        run.__name__ = name
        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = with_tables(sql, *tables.split())
        return f

    return add
