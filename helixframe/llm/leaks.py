"""Benchmark decontamination: q-gram lemma filtering over diagonal bands, verified by banded alignment.

Each benchmark item gives patterns: windows of ``WINDOW`` characters, a quarter window
apart, the last flush with the end (the whole item, if shorter). A document leaks
an item if it holds one of the item's patterns with at most ``budget`` edits. Items of under
``EXACT`` characters have a budget of nothing: they must stand in the text as they are, between signs
that are no letters or digits, and one Aho-Corasick pass finds them. By the
q-gram lemma such a place shares at least m + 1 - q - q * budget q-grams with a pattern
of m characters, all on diagonals that differ by at most the budget; so they meet in one
of the overlapping bands of twice that width. Bands with so many q-grams on a pattern's
length are kept, and a dynamic program along the band decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, passing, read_table, small_batches, written

Q, WINDOW, SHARE, EXACT = 8, 100, 0.08, 30
#: Patterns are sent to the executors in blocks of about so many characters; every block meets all documents.
BLOCK_CHARS = 1_000_000
_PIECE = 60_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def normal(text: str | None) -> str:
    """Lower case, white space as single blanks."""
    return " ".join((text or "").lower().split())


def windows(text: str, window: int = WINDOW) -> list[str]:
    """Patterns of one normalized item; none if it is empty."""
    if len(text) <= window:
        return [text] if text else []
    starts = [*range(0, len(text) - window, window // 4), len(text) - window]
    return list(dict.fromkeys(text[s : s + window] for s in starts))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q characters in turn."""
    h = codes[: len(codes) - q + 1].copy()
    for i in range(1, q):
        h = h * np.uint64(1_000_003) + codes[i : len(codes) - q + 1 + i]
    return h * _MIX


class Patterns:
    """Index of a block of (item, pattern) pairs: sorted q-grams with the places that have them."""

    def __init__(self, patterns: list[tuple[int, str]], q: int = Q, share: float = SHARE, exact: int = EXACT) -> None:
        self.q = q
        self.short: dict[str, list[int]] = {}
        for i, p in patterns:
            if len(p) < exact:
                self.short.setdefault(p, []).append(i)
        self.auto = None
        if self.short:
            self.auto = ahocorasick.Automaton()
            for p in self.short:
                self.auto.add_word(p, p)
            self.auto.make_automaton()
        known = [(i, p) for i, p in patterns if len(p) >= exact]
        self.item = [i for i, _ in known]
        self.text = [p for _, p in known]
        self.codes = [_codes(p) for p in self.text]
        self.size = np.array([len(p) for p in self.text], dtype=np.int64)
        self.budget = (self.size * share).astype(np.int64)
        self.need = np.maximum(self.size + 1 - q - q * self.budget, 1)
        grams = [_grams(c, q) for c in self.codes]
        every = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        pattern = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.empty(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.pattern, self.place = pattern[order], place[order]
        self.gram, first, count = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.count = first, count
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self.gram >> np.uint64(64 - _BITS)] = True

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(pattern, least diagonal, first and last place) of the bands that the lemma cannot rule out."""
        if len(codes) < self.q or not len(self.gram):
            return []
        grams = _grams(codes, self.q)
        at = np.flatnonzero(self.seen[grams >> np.uint64(64 - _BITS)])
        if not len(at):
            return []
        k = np.searchsorted(self.gram, grams[at])
        k[k == len(self.gram)] = 0
        hit = self.gram[k] == grams[at]
        at, k = at[hit], k[hit]
        n = self.count[k]
        if not len(at) or n.sum() < self.need.min():
            return []
        pos = np.repeat(at, n)
        entry = np.repeat(self.first[k] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        pattern = self.pattern[entry]
        # patterns with too few shared q-grams in all are out before any sorting
        enough = np.bincount(pattern, minlength=len(self.size)) >= self.need
        keep = enough[pattern]
        if not keep.any():
            return []
        pos, pattern, entry = pos[keep], pattern[keep], entry[keep]
        diagonal = pos - self.place[entry] + self.size.max()
        step = np.maximum(self.budget[pattern], 1)
        band = diagonal // step
        pos, pattern, band = np.tile(pos, 2), np.tile(pattern, 2), np.concatenate((band, np.maximum(band - 1, 0)))
        order = np.lexsort((pos, band, pattern))
        pos, pattern, band = pos[order], pattern[order], band[order]
        last = np.minimum(np.arange(len(pos)) + self.need[pattern] - 1, len(pos) - 1)
        full = (np.arange(len(pos)) + self.need[pattern] - 1 < len(pos)) & (pattern[last] == pattern) & (band[last] == band) & (pos[last] - pos <= self.size[pattern] + self.budget[pattern])
        out: dict[tuple[int, int], list[int]] = {}
        for i in np.flatnonzero(full):
            key, end = (int(pattern[i]), int(band[i])), int(pos[last[i]])
            have = out.get(key)
            if have and pos[i] - have[-1] <= 2 * self.size[pattern[i]]:
                have[-1] = end
            else:
                out[key] = [*(have or []), int(pos[i]), end]
        return [(p, b * max(int(self.budget[p]), 1) - int(self.size.max()), v[j], v[j + 1]) for (p, b), v in out.items() for j in range(0, len(v), 2)]

    def align(self, codes: np.ndarray, asked: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """For each (pattern, least diagonal of a band): its least edits on the band and one budget to each side, and where it ends.

        Patterns of one length go through the dynamic program as one array.
        """
        out: list[tuple[int, int]] = [(0, 0)] * len(asked)
        by_size: dict[int, list[int]] = {}
        for k, (p, _) in enumerate(asked):
            by_size.setdefault(int(self.size[p]), []).append(k)
        big, n = 1 << 20, len(codes)
        for size, every in by_size.items():
            for at in range(0, len(every), 512):
                which = every[at : at + 512]
                pattern = np.stack([self.codes[asked[k][0]] for k in which])
                e = int(self.budget[asked[which[0]][0]])
                low = np.array([asked[k][1] - e for k in which])[:, None]
                # row i, column c: pattern[:i] ends at text place i + low + c
                cols = np.arange(4 * max(e, 1) + 1)
                place = low + cols
                row = np.where((place >= 0) & (place <= n), 0, big)
                for i in range(1, size + 1):
                    place = i + low + cols
                    there = (place >= 0) & (place <= n)
                    other = codes[np.clip(place - 1, 0, n - 1)] != pattern[:, i - 1 : i]
                    new = np.where(there & (place >= 1), row + other, big)
                    new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)  # a pattern character without partner
                    new = np.where(there, new, big)
                    row = np.minimum.accumulate(new - cols, axis=1) + cols  # text characters without partner
                best = row.argmin(axis=1)
                for j, k in enumerate(which):
                    out[k] = int(row[j, best[j]]), size + int(low[j, 0]) + int(best[j])
        return out

    def _whole(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, end) of the items of under ``EXACT`` characters that stand in the text."""
        if self.auto is not None:
            for last, p in self.auto.iter(text):
                start, end = last + 1 - len(p), last + 1
                if not (start and text[start - 1].isalnum() and p[0].isalnum()) and not (text[end : end + 1].isalnum() and p[-1].isalnum()):
                    yield from ((i, end) for i in self.short[p])

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item, edits, end) of each leaked item: fewest edits, then first end in the normalized text."""
        found: dict[int, tuple[int, int]] = {}
        for item, end in self._whole(text):
            found[item] = min(found.get(item, (0, end)), (0, end))
        if not len(self.size):
            return [(i, *v) for i, v in sorted(found.items())]
        codes = _codes(text)
        reach = int(self.size.max() + self.budget.max())
        for start in range(0, max(len(codes), 1), _PIECE):
            part = codes[max(0, start - reach) : start + _PIECE + reach]
            base = max(0, start - reach)
            asked = list(dict.fromkeys((p, diagonal) for p, diagonal, _, _ in self.candidates(part)))
            for (p, _), (edits, end) in zip(asked, self.align(part, asked)):
                if edits <= self.budget[p]:
                    item = self.item[p]
                    found[item] = min(found.get(item, (1 << 20, 0)), (edits, base + end))
        return [(i, *v) for i, v in sorted(found.items())]


def patterns_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item`` and ``pattern``, once each, of every item that is not null."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([windows(normal(t)) for t in texts])

    items = small_batches(benchmark).select(F.col(item_id).alias("item"), F.col(text).alias("t")).where("item is not null and t is not null")
    return items.select("item", F.explode(cut("t")).alias("pattern")).distinct()


def _blocks(patterns: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The patterns, a bounded block at a time."""
    total = patterns.agg(F.sum(F.length("pattern"))).first()[0] or 0
    n = max(1, -(-total // chars))
    for k in range(n):
        part = patterns.where(F.pmod(F.xxhash64("item", "pattern"), F.lit(n)) == k) if n > 1 else patterns
        yield [(r[0], r[1]) for r in part.toLocalIterator()]


_LEAKS = "array<struct<item_id:bigint,edits:int,end:bigint>>"


def _finder(index):
    @F.pandas_udf(_LEAKS)
    def run(texts: pd.Series, before: pd.Series) -> pd.Series:
        out = []
        for t, known in zip(texts, before):
            best = {x["item_id"]: (x["edits"], x["end"]) for x in known}
            for i, e, at in index.value.find(normal(t)):
                best[i] = min(best.get(i, (e, at)), (e, at))
            out.append([{"item_id": i, "edits": e, "end": at} for i, (e, at) in sorted(best.items())])
        return pd.Series(out)

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS, only_clean: bool = False) -> DataFrame:
    """``docs`` with ``leaks``: an array of (item_id, edits, end), one for each item that the text holds, by item_id.

    Texts are compared in lower case with white space as single blanks; ``end`` is a place in that
    form: of the copies with fewest edits the first one's. Null and empty texts hold nothing; null and empty items are
    held by nothing; texts of one item_id count as one item; repeated rows get
    equal results; whole texts are searched; a column named leaks is replaced; an empty table gives an empty one. The
    patterns reach the executors in blocks of at most about ``block_chars`` characters. With more than one block the rows are written
    after each, so that driver and executors hold one block at a time however large the benchmark; a benchmark
    of n blocks takes n passes. Documents are not shuffled. ``only_clean`` leaves out, after each block, the rows that hold an item.
    """
    with passing() as keep:
        patterns = written(patterns_of(benchmark, item_id, item_text))
        out = docs.withColumn("leaks", F.array().cast(_LEAKS))
        last = index = None
        for block in _blocks(patterns, block_chars):
            if index is not None:
                step = written(out)
                index.unpersist()
                if last is not None:
                    drop(last)
                out = last = step
            index = docs.sparkSession.sparkContext.broadcast(Patterns(block))
            out = small_batches(out).withColumn("leaks", _finder(index)(F.col(text), F.col("leaks")))
            if only_clean:
                out = out.where(F.size("leaks") == 0)
        if last is not None:
            keep(last)
        return out


def op3_leaks(spark, sf_dir: str) -> DataFrame:
    docs = find_leaks(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.edits", "leak.end")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; see ``find_leaks``. Null and empty texts stay; further columns are dropped."""
    return find_leaks(docs.select("doc_id", "text", "lang", "source", "n_chars"), read_table(spark, sf_dir, "benchmark"), only_clean=True).drop("leaks")
