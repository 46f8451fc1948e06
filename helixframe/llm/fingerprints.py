"""Document fingerprints: sums of wide vectors hashed from paragraphs, modulo powers of two.

A fingerprint does not depend on the order of paragraphs; adding or taking away a paragraph adds or subtracts its vector.
A vector has two parts. ``SUMS`` lanes of 64 bits come from a paragraph's BLAKE2 digest, so that fingerprints are equal
only if the multisets of paragraphs are. ``LANES`` lanes of 16 bits count the paragraph's stretches of ``WIDTH`` characters, each
plus or minus one in the lane of its hash; products of two such parts estimate what the texts have in common, also where an
edit touches every paragraph.
"""

from __future__ import annotations

from base64 import b64encode
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read_table, small_batches

SUMS, LANES, WIDTH = 8, 512, 16
SIZE = SUMS * 8 + LANES * 2
#: Characters of a paragraph that are counted at once.
WINDOW = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the input touches every bit of the output."""
    for shift in (31, 29):
        h = (h ^ (h >> np.uint64(shift))) * _FACTOR
    return h ^ (h >> np.uint64(32))


def _stretches(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of all stretches of ``WIDTH`` characters that lie within one paragraph; a shorter paragraph is one stretch."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    n = len(code)
    size = np.minimum(ends - starts, WIDTH)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(ends - starts - size + 1)[:-1])), ends - starts - size + 1)
    at = np.arange(len(first)) + first
    rolled = _mixed(code)
    reach, power = 1, int(_FACTOR)
    while reach < min(WIDTH, n):  # hashes of twice the reach from two neighbours
        rolled[: n - reach] = rolled[: n - reach] * np.uint64(power) + rolled[reach:]
        reach, power = 2 * reach, power * power % 2**64
    out = rolled[at]
    for i in np.flatnonzero(size < WIDTH):
        out[np.searchsorted(at, starts[i])] = int.from_bytes(blake2b(text[starts[i] : ends[i]].encode(), digest_size=8).digest(), "little")
    return _mixed(out)


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Both parts of the fingerprint of a text, whose paragraphs are its lines with a character; a null text has none."""
    sums, lanes = np.zeros(SUMS, np.uint64), np.zeros(LANES, np.int64)
    paragraphs = [p for p in (text or "").split("\n") if p]
    for p in paragraphs:
        sums += np.frombuffer(blake2b(p.encode(), digest_size=SUMS * 8).digest(), "<u8")
    held: list[str] = []
    size = 0

    def count() -> None:
        ends = np.cumsum([len(p) for p in held])
        h = _stretches("".join(held), np.concatenate(([0], ends[:-1])), ends)
        np.add(lanes, np.bincount((h >> np.uint64(1)).astype(np.int64) % LANES, weights=1 - 2 * (h & np.uint64(1)).astype(np.float64), minlength=LANES).astype(np.int64), out=lanes)
        held.clear()

    for p in paragraphs:
        # a long paragraph goes in windows that overlap by all but one character of a stretch, so each stretch is counted once
        for i in range(0, max(1, len(p) - WIDTH + 1), WINDOW):
            held.append(p[i : i + WINDOW + WIDTH - 1])
            size += len(held[-1])
            if size >= WINDOW:
                count()
                size = 0
    if held:
        count()
    return sums, lanes & 0xFFFF


def packed(v: tuple[np.ndarray, np.ndarray]) -> bytes:
    return v[0].astype("<u8").tobytes() + v[1].astype("<u2").tobytes()


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(raw[: SUMS * 8], "<u8"), np.frombuffer(raw[SUMS * 8 :], "<u2").astype(np.int64)


def inserted(fingerprint: bytes, paragraphs: str) -> bytes:
    """The fingerprint after the lines of ``paragraphs`` were added, wherever they stand."""
    (a, b), (x, y) = unpacked(fingerprint), vector(paragraphs)
    return packed((a + x, (b + y) & 0xFFFF))


def deleted(fingerprint: bytes, paragraphs: str) -> bytes:
    """The fingerprint after the lines of ``paragraphs`` were taken away."""
    (a, b), (x, y) = unpacked(fingerprint), vector(paragraphs)
    return packed((a - x, (b - y) & 0xFFFF))


def likeness(x: bytes, y: bytes) -> float:
    """0 to 1: 1 for equal fingerprints, else the estimated share of the longer text's stretches that the other has too, and less than 1.

    Its standard error is about 1 / sqrt(LANES). Estimates hold while lanes stay within 16 bits, signed: a text that repeats one stretch
    more than 32,767 times may look less alike.
    """
    if x == y:
        return 1.0
    a, b = (((unpacked(r)[1] + 0x8000) & 0xFFFF) - 0x8000 for r in (x, y))
    most = max(int(a @ a), int(b @ b))
    return min(max(float(int(a @ b) / most), 0.0), 1.0 - 2.0**-20) if most else 0.0


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the binary column ``out``; null and empty texts have no paragraphs and the fingerprint of zeros. All rows and columns stay, one named ``out`` is replaced."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([packed(vector(t)) for t in texts])

    return small_batches(docs).withColumn(out, run(F.col(text)))


def with_next(docs: DataFrame, columns: list[str], order: str = "doc_id", tie: str = "text") -> DataFrame:
    """``docs`` with ``next_<column>`` of the row that follows in order of ``order`` (a number; nulls first, then by the hash of ``tie``); the first follows the last.

    Rows are split by quantiles of ``order``; the first row of each range goes to the one before as well, so each range is a task of its own
    and no window spans the table. Rows of one id share a range. ``docs`` is read three times and must hold the same rows each time.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    keyed = docs.withColumns({"__place": place, "__tie": F.xxhash64(tie)})
    splits = sorted(set(keyed.where(F.col(order).isNotNull()).approxQuantile("__place", [i / n for i in range(1, n)], 1 / (4 * n))))
    ranges = Bucketizer(splits=[float("-inf"), *(splits or [0.0]), float("inf")], inputCol="__place", outputCol="__range")
    rows = ranges.transform(keyed).withColumn("__range", F.col("__range").cast("int"))
    least = rows.groupBy("__range").agg(F.min("__place").alias("__place"))
    heads = rows.join(F.broadcast(least), ["__range", "__place"]).groupBy("__range").agg(F.min_by(F.struct(*columns), F.struct("__place", "__tie")).alias("__head"))
    # one small row a range: which range comes before each, the last before the first
    numbers = least.select("__range")
    before = numbers.withColumn("__before", F.coalesce(F.lag("__range").over(W.orderBy("__range")), F.max("__range").over(W.partitionBy())))
    heads = heads.join(before, "__range").select(F.col("__before").alias("__range"), "__head")
    w = W.partitionBy("__range").orderBy("__last", "__place", "__tie")
    both = rows.withColumn("__last", F.lit(0)).unionByName(heads.select("__range", F.lit(1).alias("__last"), *(F.col(f"__head.{c}").alias(c) for c in columns)), allowMissingColumns=True)
    return both.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns}).where("__last = 0").drop("__place", "__tie", "__range", "__last")


def edit(text: str, following: str) -> str:
    """``text`` with its last floor(length / 2) characters replaced by the first as many of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited(docs: DataFrame) -> DataFrame:
    """Each document against an edit of it and against the next document.

    ``docs`` has ``doc_id`` and ``text`` (null: empty); the edit replaces the last floor(n_chars / 2) characters by the first as many (or all) of
    the document with the next id, the first one's after the last; of equal ids those with the smaller text hash come first, and null ids before
    all. A single document follows itself. Other columns are dropped, repeated rows stay, an empty table gives an empty one.
    """
    rows = with_next(small_batches(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))), ["text"])

    @F.pandas_udf("struct<fingerprint:string,edited_fingerprint:string,near_edited:double,near_next:double,edited_sha256:string>")
    def compare(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, following in parts:
            texts, following, out = texts.tolist(), following.tolist(), []
            ahead = None
            for i, (text, after) in enumerate(zip(texts, following)):
                own = ahead if i and text == following[i - 1] else packed(vector(text))
                ahead = packed(vector(after))
                changed = edit(text, after)
                raw = packed(vector(changed))
                out.append((b64encode(own).decode(), b64encode(raw).decode(), likeness(own, raw), likeness(own, ahead), sha256(changed.encode()).hexdigest()))
            yield pd.DataFrame(out, columns=["fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_sha256"])

    out = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), compare("text", "next_text").alias("c"))
    return out.select("doc_id", "n_chars", "c.*")


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited(read_table(spark, sf_dir, "documents"))
