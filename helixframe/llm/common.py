"""What the operators of this subpackage share: table access, shared-folder tables, connected components."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule: blank and the control characters 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
#: Most bytes of one Arrow batch that goes to a Python worker (a longer single text still goes whole).
BATCH_BYTES = 4 << 20

_open: ContextVar[list[DataFrame] | None] = ContextVar("open", default=None)
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``sf_dir``; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where the session has none, a temporary folder is set if driver and executors are one
    process (master local); on a cluster that is an error, as no folder is known to be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return root


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    The result has no lineage beyond those files, so a lost executor never
    repeats the work behind it, and a table that is used several times is made
    once. The shuffle files of the write go when it ends; the table stays until ``drop``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    if (tables := _open.get()) is not None:
        tables.append(out)
    return out


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are ``written`` within are deleted at its end, but for those given to the function that it yields."""
    tables: list[DataFrame] = []
    kept: list[DataFrame] = []
    outer = _open.get()
    mark = _open.set(tables)
    try:
        yield lambda df: kept.append(df) or df
    finally:
        _open.reset(mark)
        drop(*(x for x in tables if not any(x is k for k in kept)))
        if outer is not None:
            outer.extend(kept)


def drop(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` returned and that nothing will read again; other frames are left alone."""
    for df in tables:
        path = _paths.pop(df, None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on its session sends at most ``BATCH_BYTES`` at once to Python workers, so that their memory does not grow with a partition."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has a link.

    ``edges`` holds links in any direction, of one orderable column type. The
    result has one row per node that occurs in a link to another node: ``node``
    and ``component`` (the least node that it reaches, itself included).
    Nulls link nothing; self-links and repeated links change nothing; no links
    give an empty result.

    Each round hooks every root on its least neighbouring root and flattens the
    hooks by pointer jumping; then the links are rewritten between roots.
    Links within a tree vanish, so their number falls every round. The joins are
    plain equi-joins on single keys (a hub's rows can be split by adaptive
    execution) and minima are combined before they are shuffled; nothing is
    collected but whether links are left. The result is a written table (see ``drop``).
    """
    with passing() as keep:
        links = written(
            edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"))
            .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") < F.col("b")))
            .distinct()
        )
        labels = None
        while not links.isEmpty():
            # a hook for each root: itself or a smaller neighbour
            hooks = written(
                links.select(F.col("b").alias("node"), F.col("a").alias("parent"))
                .union(links.select(F.col("a").alias("node"), F.col("a").alias("parent")))
                .groupBy("node")
                .agg(F.min("parent").alias("parent"))
            )
            while True:
                up = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
                jumped = written(hooks.join(up, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") < F.col("parent")).alias("moved")))
                drop(hooks)
                hooks = jumped
                if hooks.where("moved").isEmpty():
                    break
            before = (labels, links)
            if labels is None:
                labels = written(hooks.select("node", F.col("parent").alias("component")))
            else:
                moved = hooks.select(F.col("node").alias("component"), "parent")
                labels = written(labels.join(moved, "component", "left").select("node", F.coalesce("parent", "component").alias("component")))
            of_a = hooks.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
            of_b = hooks.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
            links = written(
                links.join(of_a, "a")
                .join(of_b, "b")
                .where("pa <> pb")
                .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                .distinct()
            )
            drop(hooks, *(x for x in before if x is not None))
        if labels is None:
            labels = written(links.select(F.col("a").alias("node"), F.col("b").alias("component")))
        drop(links)
        return keep(labels)
