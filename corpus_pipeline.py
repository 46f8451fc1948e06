"""From raw documents to token ids: five stages over whole tables, each on what the one before has kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import leaks, lines, pieces, rules, simhash
from helixframe.llm.common import drop, passing, read_table, written

STAGES = [
    ("quality rules", rules.stage),
    ("line dedup", lines.stage),
    ("simhash near-dedup", simhash.stage),
    ("benchmark decontamination", leaks.stage),
    ("sentencepiece", pieces.stage),
]

#: SQL can neither hash shingles by XXH64 nor encode; tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents`` of ``sf_dir``.

    What a stage has written beside its result goes when the result is written, and that goes when the next stage's is; the
    last stage's rows read one table. Nulls, empty texts, repeated rows and empty tables are for the stages, which say what becomes of them.
    """
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with passing() as keep:
            kept = keep(written(stage(spark, docs, sf_dir)))
        drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
