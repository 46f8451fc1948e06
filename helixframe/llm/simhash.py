"""SimHash near-duplicate groups: multi-index hashing over 64-bit fingerprints.

Fingerprints differ in at most three bits if one of their two 32-bit halves
differs in at most one bit. Each fingerprint is listed under both halves; to find
partners it asks for every half within one bit, and complete distances
are checked. Halves that many fingerprints share go another exact way: their
members are parted by the four bytes of the other half, one of which partners share, and dealt
into blocks; every pair of blocks is compared by numpy in
a task of its own, which returns a spanning forest in place of all pairs.

The pipeline's stage also links texts by the similarity of their shingle sets, at
``SHARE`` or more and whatever their fingerprints: two such sets share a shingle
among the first fifth (and one) of each in any fixed order. The order puts
shingles last that a sample finds often; a poor sample costs time and no pair. Parity
sketches bound the difference of two sets from below: a short one first, then one that grows
with the set. Only what both leave is verified on the shingles themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, passing, read_table, small_batches, written

HALF = 32
#: A half with more fingerprints is compared in blocks.
BUSY = 48
BLOCK = 1500
#: Bytes of shingle sets in a block, if a block of ``BLOCK`` sets has more.
BLOCK_BYTES = 8 << 20
#: Similarity of shingle sets (numerator and denominator) from which the pipeline takes texts for near copies.
SHARE = (4, 5)
#: Longs of the short parity sketch; one text in so many is in the sample, and shingles of so many sampled texts go last.
SKETCH, SAMPLE, OFTEN = 8, 16, 4
#: More of them are not sent to the tasks, which costs time only.
MOST_OFTEN = 200_000


def _digests(text: str | None, width: int, seed: int = 42) -> bytes:
    """The XXH64 of all shingles of ``width`` words, or of all words if they are fewer."""
    # bytes: lower() and split() know just A-Z and the six white-space characters of the word rule
    words = (text or "").encode().lower().split()
    join, digest = b" ".join, xxhash.xxh64_digest
    if len(words) <= width:
        return digest(join(words), seed) if words else b""
    return b"".join([digest(join(g), seed) for g in zip(*(words[i:] for i in range(width)))])


def _shingles(raw: bytes) -> np.ndarray:
    """The different shingles of ``_digests``, sorted."""
    return np.unique(np.frombuffer(raw, dtype=">u8").astype(np.uint64))


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all shingles of ``width`` words; 0 without a word."""
    return _majority(_digests(text, width, seed))


def _majority(raw: bytes) -> int:
    n = len(raw) // 8
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = np.frombuffer(raw, dtype=np.uint8, count=min(n - at, 1 << 16) * 8, offset=at * 8)
        ones += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with the column ``fp`` (bigint: the 64 bits); a null text counts as empty."""

    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        out = np.array([fingerprint(t, width, seed) for t in texts], dtype=np.uint64)
        return pd.Series(out.view(np.int64))

    return small_batches(docs).withColumn("fp", fp(F.col(text)))


def _forest(left: np.ndarray, right: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges that connect what links of at most ``most`` bits between left and right connect."""
    n = np.zeros((len(left), len(right)), dtype=bool)
    for at in range(0, len(left), 256):
        n[at : at + 256] = np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= most
    new_l, new_r, edges = np.ones(len(left), bool), np.ones(len(right), bool), []
    for i in np.flatnonzero(n.any(axis=1)):
        if not new_l[i]:
            continue
        new_l[i], front = False, np.array([i])
        while len(front):
            hit = np.flatnonzero(n[front].any(axis=0) & new_r)
            new_r[hit] = False
            edges += [(int(left[i]), int(x)) for x in right[hit]]
            if not len(hit):
                break
            front = np.flatnonzero(n[:, hit].any(axis=1) & new_l)
            new_l[front] = False
            edges += [(int(left[i]), int(x)) for x in left[front]]
    return edges


def fingerprint_links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that join the same fingerprints as all pairs within ``most`` (at most 3) bits.

    ``fps`` holds distinct values in ``fp``. Halves with up to ``BUSY`` fingerprints
    give every pair; the others give spanning forests of their block pairs, with
    the same components.
    """
    if most > 3:
        raise ValueError("two halves with one differing bit each cover at most three bits")
    half = lambda: F.explode(F.array(F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned("fp", HALF).alias("v")), F.struct(F.lit(1).alias("seg"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("v"))))
    table = fps.select("fp", half().alias("h")).select("fp", "h.seg", F.col("h.v").alias("key"))
    keys = F.expr(f"concat(array(key), filter(transform(sequence(0, {HALF - 1}), i -> IF(getbit(key, i) = 1, key ^ shiftleft(1L, i), -1L)), x -> x >= 0))")
    asks = table.select("fp", "seg", (F.col("key")).alias("own"), F.explode(keys).alias("key"))
    busy = table.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUSY)
    busy = written(busy)
    rare = table.join(busy, ["seg", "key"], "left_anti").select("seg", "key", F.col("fp").alias("b"))
    cold = (
        asks.select("seg", "own", "key", F.col("fp").alias("a"))
        .join(rare, ["seg", "key"])
        .where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most) & ((F.col("own") != F.col("key")) | (F.col("a") < F.col("b"))))
        .select("a", "b")
    )
    if busy.isEmpty():
        return cold
    busy = busy.select("seg", "key")
    other = F.when(F.col("seg") == 0, F.col("fp")).otherwise(F.shiftrightunsigned("fp", HALF))
    byte = F.explode(F.array(*(F.struct(F.lit(i).alias("sub"), F.shiftrightunsigned(other, 8 * i).bitwiseAND(F.lit(255)).alias("val")) for i in range(4))))
    at = ["seg", "key", "sub", "val"]
    parted = lambda df: df.select("seg", "key", "fp", byte.alias("x")).select("seg", "key", "x.sub", "x.val", "fp")
    own, many = parted(table.join(busy, ["seg", "key"])), written(parted(asks.join(busy, ["seg", "key"])))
    blocks_of = lambda df, name: df.groupBy(*at).agg(F.ceil(F.count("*") / BLOCK).alias(name))
    size = written(blocks_of(own, "nb").join(blocks_of(many, "pb"), at))
    mix = lambda by: F.pmod(F.xxhash64("fp"), F.col(by))
    blocks = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = own.join(size, at).select(*at, "fp", F.lit(0).alias("side"), mix("nb").alias("i"), blocks("pb").alias("j"))
    right = many.join(size, at).select(*at, "fp", F.lit(1).alias("side"), mix("pb").alias("j"), blocks("nb").alias("i"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        fp = part["fp"].to_numpy().view(np.uint64)
        side = part["side"].to_numpy()
        edges = np.array(_forest(fp[side == 0], fp[side == 1], most), dtype=np.uint64).reshape(-1, 2).view(np.int64)
        edges = edges[edges[:, 0] != edges[:, 1]]
        return pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})

    hot = left.unionByName(right).groupBy(*at, "i", "j").applyInPandas(compare, "a bigint, b bigint")
    return cold.unionByName(hot)


def _often(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that many texts of a sample hold, sorted."""

    @F.pandas_udf("array<bigint>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([_shingles(_digests(t, width)).view(np.int64) for t in texts])

    some = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select(F.explode(shingles("text")).alias("s"))
    top = some.groupBy("s").count().where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "s").limit(MOST_OFTEN)
    return np.sort(np.array([r.s for r in top.collect()], dtype=np.int64).view(np.uint64))


def _among(s: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Which of ``s`` are in ``often``, which is sorted: a search each, as ``isin`` would sort ``often`` anew for every text."""
    if not len(often):
        return np.zeros(len(s), bool)
    return often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s


def with_shingles(docs: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id``, ``fp``, the hash ``tk`` of the text, and of its shingle set the hash ``key``, size ``n``, parity sketches ``sketch`` (short) and ``wide`` (at least a bit for each shingle), and first shingles ``first``."""
    often = _often(small_batches(docs), width)

    @F.pandas_udf("fp bigint, key bigint, n int, sketch array<bigint>, wide array<bigint>, first array<bigint>")
    def facts(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            raw = _digests(t, width)
            s = _shingles(raw)
            n = len(s)
            size = max(SKETCH * 64, 1 << (n - 1).bit_length() if n else 0)
            wide = np.packbits((np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).view(np.int64)
            late = _among(s, often)
            ordered = np.concatenate([s[~late], s[late]])
            first = ordered[: n + (-n * SHARE[0]) // SHARE[1] + 1]
            key = np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))
            rows.append((np.uint64(_majority(raw)).view(np.int64), key.view(np.int64), n, _folded(wide, SKETCH), wide, first.view(np.int64)))
        return pd.DataFrame(rows, columns=["fp", "key", "n", "sketch", "wide", "first"])

    return docs.select("doc_id", F.xxhash64("text").alias("tk"), facts("text").alias("f")).select("doc_id", "tk", "f.*")


def _folded(wide: np.ndarray, size: int) -> np.ndarray:
    """The parity sketch of ``size`` longs, from one of a power of two times as many."""
    return np.bitwise_xor.reduce(wide.reshape(-1, size), axis=0)


def _near(a: np.ndarray, b: np.ndarray, n: int) -> bool:
    """Whether wide sketches leave two sets of ``n`` shingles in all a similarity of ``SHARE``."""
    size = min(len(a), len(b))
    apart = int(np.bitwise_count((_folded(a, size) ^ _folded(b, size)).view(np.uint64)).sum(dtype=np.int64))
    return apart * sum(SHARE) <= (SHARE[1] - SHARE[0]) * n


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have the similarity of ``SHARE``: common / (all - common)."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * SHARE[1] >= SHARE[0] * (len(a) + len(b) - common)


class _Wide:
    """Shingle sets by size, with their wide sketches.

    Sets of similarity ``SHARE`` are alike in size, so a set is compared only with those
    about its size, on sketches that are folded by half at most and so tell them apart.
    """

    def __init__(self, wides: list[np.ndarray], sizes: np.ndarray) -> None:
        self.wides, self.sizes, self.by = wides, sizes, {}
        longs = np.array([len(w) for w in wides], dtype=np.int64)
        for size in map(int, np.unique(longs)):
            own = np.flatnonzero(longs == size)
            own = own[np.argsort(sizes[own], kind="stable")]
            rows = np.stack([wides[i] for i in own]).view(np.uint64)
            half = rows[:, : size // 2] ^ rows[:, size // 2 :] if size > SKETCH else None
            self.by[size] = own, sizes[own], rows, half

    def near(self, i: int) -> np.ndarray:
        """Places of the sets, itself included, that sizes and sketches leave a similarity of ``SHARE`` with the set at ``i``."""
        n, mine, found = int(self.sizes[i]), self.wides[i].view(np.uint64), [np.empty(0, np.int64)]
        for size in (len(mine) // 2, len(mine), len(mine) * 2):
            if size not in self.by:
                continue
            own, ns, rows, half = self.by[size]
            at, end = np.searchsorted(ns, (-(-n * SHARE[0] // SHARE[1]), n * SHARE[1] // SHARE[0] + 1))
            a, b = (mine, half) if size > len(mine) else (_folded(mine, size), rows)
            apart = np.bitwise_count(b[at:end] ^ a).sum(axis=1, dtype=np.int64)
            found.append(own[at:end][apart * sum(SHARE) <= (SHARE[1] - SHARE[0]) * (ns[at:end] + n)])
        return np.concatenate(found)


def _set_forest(sets: list[np.ndarray], wides: list[np.ndarray], left: np.ndarray) -> list[tuple[int, int]]:
    """Edges (places) that connect what similar sets across ``left`` and the others connect; each set asks those not yet reached, once."""
    wide = _Wide(wides, np.array([len(s) for s in sets], dtype=np.int64))
    new, edges = np.ones(len(sets), bool), []
    for start in np.flatnonzero(left):
        if not new[start]:
            continue
        new[start], front = False, [int(start)]
        while front:
            i = front.pop()
            others = wide.near(i)
            others = others[new[others] & (left[others] != left[i])]
            hit = [int(j) for j in others if _alike(sets[i], sets[j])]
            new[hit] = False
            front += hit
            edges += [(i, j) for j in hit]
    return edges


def shingle_links(docs: DataFrame, marked: DataFrame, width: int = 5) -> DataFrame:
    """Links ``a``, ``b`` between fingerprints that join what all pairs of texts of similar shingle sets join.

    ``marked`` is ``with_shingles(docs)``. A shingle that up to ``BUSY`` sets put first gives pairs;
    the others give spanning forests of their block pairs.
    """
    num, den = SHARE
    some = marked.where("n > 0")
    same = some.groupBy("key").agg(F.min("fp").alias("b"), F.min("tk").alias("tk"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"), F.first("first").alias("first"))
    same = written(same)
    copies = some.select("key", F.col("fp").alias("a")).join(same.select("key", "b"), "key").where("a <> b").select("a", "b")
    firsts = same.select("key", "n", F.explode("first").alias("s"))
    counts = written(firsts.groupBy("s").agg(F.count("*").alias("c"), F.sum("n").alias("longs")).where("c > 1"))
    shared = written(firsts.drop("n").join(counts, "s").join(same.select("key", "n", "sketch"), "key"))
    deal = F.ceil(F.greatest(F.col("c") / BLOCK, F.col("longs") * 8 / BLOCK_BYTES)).alias("nb")

    @F.pandas_udf("binary")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([_shingles(_digests(t, width)).tobytes() for t in texts])

    def sets_of(keys: DataFrame) -> DataFrame:
        wanted = same.join(keys.distinct(), "key", "left_semi").select("key", "tk", F.col("b").alias("fp"))
        texts = docs.select("text", F.xxhash64("text").alias("tk")).join(wanted, "tk").dropDuplicates(["key"])
        return written(texts.select("key", "fp", shingles("text").alias("set")))

    rare = shared.where(F.col("c") <= BUSY).drop("c", "longs")
    one, two = (rare.select("s", *(F.col(c).alias(c + side) for c in ("key", "n", "sketch"))) for side in ("1", "2"))
    apart = sum((F.bit_count(F.col("sketch1")[k].bitwiseXOR(F.col("sketch2")[k])) for k in range(SKETCH)), F.lit(0))
    near = (F.least("n1", "n2") * den >= F.greatest("n1", "n2") * num) & (apart * (den + num) <= (F.col("n1") + F.col("n2")) * (den - num))
    pairs = written(one.join(two, "s").where((F.col("key1") < F.col("key2")) & near).select("key1", "key2").distinct())

    @F.pandas_udf("boolean")
    def near_by_wide(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_near(x, y, m) for x, y, m in zip(a, b, n)], dtype=bool)

    wide1, wide2 = (same.select(F.col("key").alias("key" + k), F.col("n").alias("n" + k), F.col("wide").alias("wide" + k)) for k in ("1", "2"))
    pairs = written(pairs.join(wide1, "key1").join(wide2, "key2").where(near_by_wide("wide1", "wide2", F.col("n1") + F.col("n2"))).select("key1", "key2"))
    sets = sets_of(pairs.select(F.col("key1").alias("key")).union(pairs.select(F.col("key2").alias("key"))))

    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([_alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(left, right)], dtype=bool)

    left, right = (sets.select(F.col("key").alias("key" + k), F.col("fp").alias(name), F.col("set").alias("set" + k)) for k, name in (("1", "a"), ("2", "b")))
    links = copies.unionByName(pairs.join(left, "key1").join(right, "key2").where(alike("set1", "set2")).select("a", "b"))
    if counts.where(F.col("c") > BUSY).isEmpty():
        return links
    many = shared.where(F.col("c") > BUSY).select("s", "key", "n", deal)
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1))

    def dealt(rows: DataFrame, *more: str) -> DataFrame:
        rows = rows.withColumn("own", F.pmod(F.xxhash64("key"), F.col("nb"))).withColumn("other", blocks)
        return rows.select("s", "key", *more, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("left"), (F.col("own") == F.col("other")).alias("both"))

    def partnered(part: pd.DataFrame) -> pd.DataFrame:
        """Sets for which the wide sketches leave a partner across the two blocks."""
        both, left, key = part["both"].all(), part["left"].to_numpy(), part["key"].to_numpy()
        wide = _Wide(part["wide"].to_list(), part["n"].to_numpy(dtype=np.int64))
        found: set[int] = set()
        for k in np.flatnonzero(left):
            hit = wide.near(k)
            hit = hit[(key[hit] != key[k]) & (both | ~left[hit])]
            if len(hit):
                found.add(int(key[k]))
                found.update(key[hit].tolist())
        return pd.DataFrame({"s": part["s"].iloc[0], "key": np.array(sorted(found), dtype=np.int64)})

    wides = many.join(same.select("key", "wide"), "key")
    some = written(dealt(wides, "n", "wide").groupBy("s", "i", "j").applyInPandas(partnered, "s bigint, key bigint").distinct())
    few = many.join(some, ["s", "key"], "left_semi")
    few = few.join(sets_of(some.select("key")), "key").join(same.select("key", "wide"), "key")
    dealt_sets = dealt(few, "fp", "wide", "set")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        if part["both"].any():  # a block against itself stands on both sides
            part = pd.concat([part.assign(left=True), part.assign(left=False)])
        sets = [np.frombuffer(x, np.uint64) for x in part["set"]]
        fp = part["fp"].to_numpy()
        edges = np.array(_set_forest(sets, part["wide"].to_list(), part["left"].to_numpy()), dtype=np.int64).reshape(-1, 2)
        found = pd.DataFrame({"a": fp[edges[:, 0]], "b": fp[edges[:, 1]]})
        return found[found["a"] != found["b"]]

    return links.unionByName(dealt_sets.groupBy("s", "i", "j").applyInPandas(compare, "a bigint, b bigint"))


def fingerprint_classes(marked: DataFrame, most: int = 3, more: DataFrame | None = None) -> DataFrame:
    """``fp``, ``root`` (the least fingerprint that links reach) and ``component_id`` (the least doc_id) of each fingerprint in ``marked``; ``more`` are further links."""
    with passing() as keep:
        fps = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
        links = fingerprint_links(fps.select("fp"), most)
        labels = connected_components(links if more is None else links.unionByName(more))
        named = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        return keep(written(named.select("fp", "root").join(least, "root").select("fp", "root", "component_id")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 3, width: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the least doc_id that links reach.

    Only ``doc_id`` and ``text`` are read, so further columns of any name do no
    harm. Null texts and texts without a word have fingerprint zero, which links
    like any other. Repeated rows stay and share their component. Among null
    doc_ids a component takes the least that is not null; if it has none the
    component is null. Texts of any length are read whole. An empty table gives an empty result.
    """
    marked = written(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", width).select("doc_id", "fp"))
    return marked.join(fingerprint_classes(marked, most).drop("root"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, most: int = 3, width: int = 5) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) with one document of each group of near duplicates: that of the least doc_id.

    Near are fingerprints within ``most`` bits and texts whose shingle sets have a similarity of
    ``SHARE`` or more. Five-word shingles by default. A null doc_id comes after all others; of different
    texts of one doc_id in a group the one of the least hash stays, of repeated rows one. Null and empty texts and those
    without a word are one group. The columns stay as they are; an empty table gives an empty one.
    """
    with passing() as keep:
        marked = written(with_shingles(docs, width))
        classes = fingerprint_classes(marked, most, shingle_links(docs, marked, width))
        rows = marked.select("doc_id", "tk", "fp").groupBy("doc_id", "tk", "fp").count()
        rows = written(rows.join(classes.select("fp", "root"), "fp").select("doc_id", "tk", "root", "count"))
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tk")
        winner = rows.groupBy("root").agg(F.min(order).alias("w"))
        lost = rows.join(winner, "root").where(~(F.col("doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("tk") == F.col("w.tk"))))
        lost = keep(written(lost.select(F.col("doc_id").alias("__id"), F.col("tk").alias("__tk"))))
        again = keep(written(rows.where("count > 1").select(F.col("doc_id").alias("__id"), F.col("tk").alias("__tk"))))
    names = docs.columns
    own = docs.select(F.struct(*names).alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__tk"))
    same = lambda a, b: (a["__tk"] == b["__tk"]) & a["__id"].eqNullSafe(b["__id"])
    kept = own.join(lost, same(own, lost), "left_anti")
    if not again.isEmpty():
        once = own.join(again, same(own, again), "left_semi").join(lost, same(own, lost), "left_anti").dropDuplicates(["__id", "__tk"])
        kept = kept.join(again, same(kept, again), "left_anti").unionByName(once)
    return kept.select("__row.*")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group stays; see ``one_of_each`` for nulls, ties and repeated rows. Further columns are dropped."""
    return one_of_each(docs.select("doc_id", "text", "lang", "source", "n_chars"))
