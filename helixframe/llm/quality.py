"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees grow on the driver from a bounded sample of labelled rows; what is
sent to the executors is a set of flat arrays (feature, threshold, children, value), and a
batch of documents walks down all of them as numpy arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, small_batches

#: Most labelled rows that a model is fitted on: those with the least hash of their doc_id.
SAMPLE_ROWS = 8000
FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_share", "longest_word", "symbol_share", "pipe_share", "digit_share", "upper_share", "letter_share", "mark_share", "bang_share",
    "stop_share", "log_lines", "line_words", "dup_line_share", "ended_line_share", "same_next_share", "short_word_share", "distinct_char_share", "at_share", "capital_words",
)
#: Short function words of several European languages.
STOP = frozenset("the of and to in a is it for on be with as by this that was are from or an de la le et les un en des que y el los der die das und zu den von ist mit für nicht im du est dans pour par sur au qui una con por para es se del".split())
_BREAKS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def statistics(text: str | None) -> list[float]:
    """The features of one whole text; an empty or null text gives zeros."""
    t = text or ""
    words = [w for w in t.translate(_BREAKS).split(" ") if w] if not t.isascii() else t.split()
    n, c = max(len(words), 1), max(len(t), 1)
    lines = [x for x in t.split("\n") if x.strip()]
    m = max(len(lines), 1)
    kinds = set(words)
    count = t.count
    lowered = t.lower()
    upper = sum(map(str.isupper, words)) if words else 0
    chars = sum(map(len, words))
    return [
        np.log1p(len(t)), np.log1p(len(words)), chars / n, len(kinds) / n, float(max(map(len, kinds), default=0)),
        sum(map(count, "#*$%&<>")) / c, count("|") / n, sum(map(count, "0123456789")) / c, upper / n, sum(map(str.isalpha, words)) / n,
        sum(map(count, ".,;:?")) / n, count("!") / n, sum(map(STOP.__contains__, lowered.split())) / n, np.log1p(len(lines)), len(words) / m,
        1 - len(set(lines)) / m, sum(x.rstrip()[-1] in ".!?:;\"')" for x in lines) / m, sum(map(str.__eq__, words, words[1:])) / n,
        sum(len(w) < 4 for w in words) / n, len(set(t)) / min(c, 200), count("@") / n, sum(w[0].isupper() for w in words) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """Flat trees: node arrays of all trees, the root of each, and a starting score."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                break
            down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(inner, down, at)
        return 1 / (1 + np.exp(-np.clip(self.start + self.value[at].sum(axis=1), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, bins: int = 48, least: int = 8, decay: float = 2.0) -> Trees:
    """Boosted trees for log loss. Without rows, or with one label only, the score is constant."""
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    p = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    start = float(np.log(p / (1 - p)))
    if len(np.unique(y)) > 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), start)
        width = bins + 1
        flat = code + np.arange(x.shape[1]) * width

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> int:
            here = len(nodes)
            nodes.append([-1, 0.0, 0, 0, float(-rate * g[rows].sum() / (h[rows].sum() + decay))])
            if level == depth or len(rows) < 2 * least:
                score[rows] += nodes[here][4]
                return here
            size = x.shape[1] * width
            at = flat[rows].ravel()
            rep = lambda v: np.bincount(at, np.repeat(v, x.shape[1]), size).reshape(-1, width).cumsum(axis=1)
            gs, hs, ns = rep(g[rows]), rep(h[rows]), rep(np.ones(len(rows)))
            G, H, N = gs[:, -1:], hs[:, -1:], ns[:, -1:]
            gain = gs**2 / (hs + decay) + (G - gs) ** 2 / (H - hs + decay) - G**2 / (H + decay)
            gain[(ns < least) | (N - ns < least)] = 0
            j, b = np.unravel_index(gain.argmax(), gain.shape)
            if gain[j, b] <= 1e-6 or b >= len(cuts[j]):
                score[rows] += nodes[here][4]
                return here
            low = code[rows, j] <= b
            left, right = grow(rows[low], g, h, level + 1), grow(rows[~low], g, h, level + 1)
            nodes[here][:4] = [j, float(cuts[j][b]), left, right]
            nodes[here][4] = 0.0
            return here

        for _ in range(trees):
            q = 1 / (1 + np.exp(-score))
            roots.append(grow(np.arange(len(y)), q - y, q * (1 - q), 0))
    table = np.array(nodes, dtype=float).reshape(-1, 5)
    return Trees(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4], np.array(roots, dtype=int), start)


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the features of ``text``, as an array column ``stats``."""

    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return small_batches(docs).select(*keep, stats(F.col(text)).alias("stats"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: int = 5, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """A model of ``label`` from at most ``sample_rows`` labelled rows whose crc32(doc_id as text) mod ``fold`` is not 0.

    Null ids and labels are left out; of several labels of one id the largest counts; of
    repeated documents one row each is used. The sample is bounded, so it may be sent
    to every executor to pick its documents, and its statistics to the driver.
    """
    mod = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % fold
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (mod("doc_id") != 0)).groupBy("doc_id").agg(F.max(label).alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    rows = with_statistics(picked, ["doc_id", "y"]).orderBy("doc_id").toPandas()
    x = np.array(rows["stats"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, rows["y"].to_numpy().astype(float))


def score(docs: DataFrame, model: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability ``out`` of label 1, from the whole text alone; null and empty texts get that of zeros."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(np.concatenate([model.score(x[i : i + 2048]) for i in range(0, len(x), 2048)]) if len(x) else [])

    return small_batches(docs).withColumn(out, run(F.col(text)))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
