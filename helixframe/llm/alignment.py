"""Alignment of two tokenizers' tokens by byte offsets, with corpus-wide counts of linked ids.

Byte ranges of a text form fragments: an open prefix (tokens before the first offset where tokens of both
tokenizers end), closed groups, and an open suffix. Fragments compose associatively, so the fragments of a very
long document are reduced as a tree over Spark tasks; a text of one range is a single fragment.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, passing, read_table, small_batches, written

#: Bytes of one range of a long text.
CHUNK = 1 << 16
#: Fragments that one task of the tree composes.
FAN = 8
#: Linked id pairs of documents that one block row holds at least before the next begins.
BLOCK = 2_000_000
#: A blank between characters that are none: no token of either tokenizer spans the place before it.
APART = re.compile(r"(?<=\S) (?=\S)")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Tokens(NamedTuple):
    """Ids of both tokenizers and the byte offsets at which their tokens end, ascending."""

    a: np.ndarray
    ea: np.ndarray
    b: np.ndarray
    eb: np.ndarray

    def slice(self, ia: slice, ib: slice) -> Tokens:
        return Tokens(self.a[ia], self.ea[ia], self.b[ib], self.eb[ib])

    def then(self, more: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, more)))


NONE = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


class Fragment(NamedTuple):
    """One element of the monoid. ``cut``: tokens of both end together somewhere; else all tokens are in ``pre``.

    ``counts`` (n_a, n_b, n_groups, n_links), ``text`` (groups, each followed by ``;``), ``pairs`` and ``times`` speak of
    the closed groups. ``same``: the tokens of both read as the text itself.
    """

    same: bool
    cut: bool
    counts: np.ndarray
    text: str
    pairs: np.ndarray
    times: np.ndarray
    pre: Tokens
    suf: Tokens


EMPTY = (np.zeros(4, np.int64), "", np.zeros(0, np.int64), np.zeros(0, np.int64))
#: Neutral element: no tokens.
UNIT = Fragment(True, False, *EMPTY, NONE, NONE)
#: The start of a document, where both tokenizers have an end.
START = Fragment(True, True, *EMPTY, NONE, NONE)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {**{chr(x): x for x in plain}, **{chr(256 + i): x for i, x in enumerate(rest)}}


class Both:
    """The two tokenizers: ``a`` byte-level merges from a JSON file, ``b`` a merge-type piece model."""

    def __init__(self, a_path: str, b_path: str, pattern: str) -> None:
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, byte = spec["model"]["vocab"], _byte_of()
        special = {x["content"] for x in spec.get("added_tokens", []) if x.get("special")}
        ranks = {bytes(map(byte.__getitem__, k)): i for k, i in vocab.items() if k not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [vocab[x + y] for x, y in merges]
        if order != sorted(order):
            raise ValueError("merges are not in order of ids")
        self.first = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.bytes_a = [b""] * (1 + max(ranks.values()))
        for k, i in ranks.items():
            self.bytes_a[i] = k
        self.bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        if any(re.search("[^▁]▁", p) for p in names) or not sp.encode_as_pieces("x")[0].startswith("▁"):
            raise ValueError("a piece has a blank after another character, or the model adds no blank")
        # what each id is written as, by tokenizer and by whether its group ends with it
        self.base_b = 2 * len(self.bytes_a)
        self.shown = [f"{i}{s}" for i in range(len(self.bytes_a)) for s in ",|"] + [f"{i}{s}" for i in range(n) for s in ",;"]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of blank + text of each text by both, and whether both read as these bytes."""
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            a = self.first.encode_ordinary(" " + text)
            raw = b" " + text.encode()
            same = b"".join(map(self.bytes_b.__getitem__, b)) == raw and b"".join(map(self.bytes_a.__getitem__, a)) == raw
            yield np.array(a, np.int64), np.array(b, np.int64), same

    def groups(self, t: Tokens, common: np.ndarray) -> list[str]:
        """The tokens as they are written, group by group; both sides of ``t`` begin and end together."""
        ga, gb = np.searchsorted(common, t.ea), np.searchsorted(common, t.eb)
        out = np.empty(len(t.a) + len(t.b), np.int64)
        out[np.arange(len(t.a)) + np.searchsorted(gb, ga, "left")] = 2 * t.a + (t.ea == common[ga])
        out[np.arange(len(t.b)) + np.searchsorted(ga, gb, "right")] = self.base_b + 2 * t.b + (t.eb == common[gb])
        return list(map(self.shown.__getitem__, out.tolist()))

    def measure(self, t: Tokens, closed_left: bool = False) -> Fragment:
        """The fragment of the tokens of one range; ``closed_left``: both sides begin at one offset."""
        common = np.intersect1d(t.ea, t.eb, assume_unique=True)
        if not len(common):
            return Fragment(True, False, *EMPTY, t, NONE)
        fa, fb = (0, 0) if closed_left else (int(np.searchsorted(e, common[0], "right")) for e in (t.ea, t.eb))
        la, lb = (int(np.searchsorted(e, common[-1], "right")) for e in (t.ea, t.eb))
        inner = t.slice(slice(fa, la), slice(fb, lb))
        inside = common if closed_left else common[1:]
        at, pair = links(inner)
        pairs, times = np.unique(pair, return_counts=True)
        counts = np.array([la - fa, lb - fb, len(inside), len(at)], np.int64)
        text = "".join(self.groups(inner, inside)) if len(inside) else ""
        return Fragment(True, True, counts, text, pairs, times, t.slice(slice(0, fa), slice(0, fb)), t.slice(slice(la, None), slice(lb, None)))

    def compose(self, x: Fragment, y: Fragment) -> Fragment:
        """``x`` followed by ``y``; associative, with ``UNIT`` neutral. Open ends that meet are measured again, closed groups only add up."""
        if not (x.same and y.same):
            return Fragment(False, False, *EMPTY, NONE, NONE)
        middle = (x.suf if x.cut else x.pre).then(y.pre)
        m = self.measure(middle, closed_left=x.cut)
        parts = [p for p in (x, m, y) if p.cut]
        if not parts:
            return m
        pairs, times = _added([(p.pairs, p.times) for p in parts])
        pre = parts[0].pre
        suf = y.suf if y.cut else m.suf if m.cut else middle
        return Fragment(True, True, sum(p.counts for p in parts), "".join(p.text for p in parts), pairs, times, pre, suf)


def links(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """End offset and id pair (A id times 2^32, plus B id) of every two tokens whose bytes overlap; they share just one stretch between ends."""
    ends = np.union1d(t.ea, t.eb)
    return ends, (t.a[np.searchsorted(t.ea, ends)] << 32) | t.b[np.searchsorted(t.eb, ends)]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return pairs, np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(pairs)).astype(np.int64)


@lru_cache(2)
def both(a_path: str, b_path: str, pattern: str) -> Both:
    """The tokenizers, read once per Python worker."""
    return Both(a_path, b_path, pattern)


BLOCKS = (
    "block string, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
    "sizes array<int>, entries binary, times binary, pairs array<bigint>, held array<int>"
)


class _Block:
    """Documents and their distinct pairs, until there are enough for a row."""

    def __init__(self) -> None:
        self.docs: list[tuple] = []
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.entries = 0

    def add(self, docs: list[tuple], sizes: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        """``docs`` (doc_id, the counts, digest); each has ``sizes`` of the ``pairs``."""
        self.docs += docs
        self.sizes.append(sizes)
        self.pairs.append(pairs)
        self.times.append(times)
        self.entries += len(pairs) + len(docs)

    def row(self) -> pd.DataFrame:
        pairs, at, held = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        pack = lambda x: zlib.compress(x.astype("<i4").tobytes(), 1)
        cells = [uuid.uuid4().hex, *map(list, zip(*self.docs)), np.concatenate(self.sizes).astype(np.int32), pack(np.diff(at, prepend=0)), pack(np.concatenate(self.times)), pairs, held.astype(np.int32)]
        self.__init__()
        return pd.DataFrame({f.split(" ")[0]: [c] for f, c in zip(BLOCKS.split(", "), cells)})


def _digest(text: str) -> str:
    return hashlib.sha256(text[:-1].encode()).hexdigest()


def _batch(t: Both, ids: list, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """What a block takes of a batch of whole texts, all measured at once: the end of each text is an end of both tokenizers."""
    some = [i for i, x in enumerate(texts) if x]
    encoded = list(t.encode([texts[i] for i in some]))
    some = [i for i, e in zip(some, encoded) if e[2]]
    encoded = [e for e in encoded if e[2]]
    docs = [(i, 0, 0, 0, 0, "") for i in ids]
    sizes = np.zeros(len(texts), np.int64)
    if not some:
        return docs, sizes, EMPTY[2], EMPTY[3]
    a, b = (np.concatenate([e[k] for e in encoded]) for k in (0, 1))
    na, nb = (np.array([len(e[k]) for e in encoded]) for k in (0, 1))
    all_of = Tokens(a, np.cumsum(t.size_a[a]), b, np.cumsum(t.size_b[b]))
    ends = all_of.ea[np.cumsum(na) - 1]
    common = np.intersect1d(all_of.ea, all_of.eb, assume_unique=True)
    at, pair = links(all_of)
    owner = np.searchsorted(ends, at)
    n_groups = np.bincount(np.searchsorted(ends, common), minlength=len(some))
    n_links = np.bincount(owner, minlength=len(some))
    pairs, place = np.unique(pair, return_inverse=True)
    each, times = np.unique(owner * len(pairs) + place, return_counts=True)
    sizes[some] = np.bincount(each // len(pairs), minlength=len(some))
    shown, start = t.groups(all_of, common), 0
    for k, i in enumerate(some):
        stop = start + int(na[k] + nb[k])
        docs[i] = (ids[i], int(na[k]), int(nb[k]), int(n_groups[k]), int(n_links[k]), _digest("".join(shown[start:stop])))
        start = stop
    return docs, sizes, pairs[each % len(pairs)], times


def _edges(text: str, raw: int, chunk: int) -> list[tuple[int, int, int]]:
    """Byte ranges of blank + text of about ``chunk`` bytes: (edge, safe place before it, safe place after it), in bytes.

    An edge without a safe place (see ``APART``) within a quarter of a range on both sides is left out, so a stretch without
    blanks stays in one range.
    """
    out, char, byte = [], 0, 1  # the blank in front
    reach = chunk // 4
    for edge in range(chunk, raw, chunk):
        # the character that holds the edge: at most ``edge - byte`` characters further
        step = text[char : char + edge - byte].encode()[: edge - byte].decode(errors="ignore")
        char, byte = char + len(step), byte + len(step.encode())
        before = [m.start() for m in APART.finditer(text, max(0, char - reach), min(len(text), char + 1))]
        after = APART.search(text, char, min(len(text), char + reach))
        if before and after and before[-1] > 0:
            low, high = before[-1], after.start()
            out.append((byte, byte - len(text[low:char].encode()), byte + len(text[char:high].encode())))
    return out


def _windows(ids: list, rows: list, texts: list[str], chunk: int) -> Iterator[tuple]:
    """Row, document, number, offset of the window, byte range, and window of each range of long texts; the blank in front of a window is left out."""
    for row, doc, text in zip(rows, ids, texts):
        raw = b" " + text.encode()
        edges = [(0, 0, 0), *_edges(text, len(raw), chunk), (len(raw), len(raw), len(raw))]
        for no, ((low, before, _), (high, _, after)) in enumerate(zip(edges, edges[1:])):
            yield row, doc, no, before, low, high, raw[before + 1 : after].decode()


FRAGMENTS = "row bigint, doc_id bigint, no bigint, same boolean, cut boolean, counts array<bigint>, text string, " + ", ".join(f"{c} binary" for c in ("pairs", "times", *(f"{s}_{x}" for s in ("pre", "suf") for x in Tokens._fields)))


def _flat(f: Fragment) -> list:
    return [f.same, f.cut, f.counts, f.text, f.pairs.tobytes(), f.times.tobytes(), *(x.tobytes() for x in (*f.pre, *f.suf))]


def _unflat(cells) -> Fragment:
    same, cut, counts, text, *raw = cells
    pairs, times, *tokens = (np.frombuffer(x, np.int64) for x in raw)
    return Fragment(bool(same), bool(cut), np.asarray(counts, np.int64), text, pairs, times, Tokens(*tokens[:4]), Tokens(*tokens[4:]))


def fragments(docs: DataFrame, a_path: str, b_path: str, pattern: str, chunk: int) -> DataFrame:
    """One row per byte range of the texts of ``docs`` (row, doc_id, text): its fragment, of the tokens that begin in the range."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for w in _windows(x["doc_id"].astype(object).where(x["doc_id"].notna(), None).tolist(), x["row"].tolist(), x["text"].tolist(), chunk):
                yield pd.DataFrame([w], columns=["row", "doc_id", "no", "base", "low", "high", "text"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = both(a_path, b_path, pattern)
        for x in batches:
            for r in x.itertuples(index=False):
                a, b, same = next(t.encode([r.text]))
                ea, eb = r.base + np.cumsum(t.size_a[a]), r.base + np.cumsum(t.size_b[b])
                ours_a, ours_b = ((e - s[i] >= r.low) & (e - s[i] < r.high) for e, s, i in ((ea, t.size_a, a), (eb, t.size_b, b)))
                f = t.measure(Tokens(a[ours_a], ea[ours_a], b[ours_b], eb[ours_b])) if same else UNIT._replace(same=False)
                yield pd.DataFrame([[r.row, None if pd.isna(r.doc_id) else r.doc_id, r.no, *_flat(f)]], columns=[c.split(" ")[0] for c in FRAGMENTS.split(", ")])

    windows = small_batches(docs).mapInPandas(split, "row bigint, doc_id bigint, no bigint, base bigint, low bigint, high bigint, text string")
    return windows.repartition("row", "no").mapInPandas(measure, FRAGMENTS)


def reduced(rows: DataFrame, a_path: str, b_path: str, pattern: str, fan: int = FAN) -> DataFrame:
    """One row per document from its fragments, composed as a tree: each level joins ``fan`` neighbours and is a written table."""
    names = [c.split(" ")[0] for c in FRAGMENTS.split(", ")]

    def join(x: pd.DataFrame) -> pd.DataFrame:
        t = both(a_path, b_path, pattern)
        x = x.sort_values("no")
        f = reduce(t.compose, (_unflat(r) for r in x[names[3:]].itertuples(index=False)))
        return pd.DataFrame([[x["row"].iloc[0], None if pd.isna(x["doc_id"].iloc[0]) else x["doc_id"].iloc[0], int(x["no"].iloc[0]) // fan, *_flat(f)]], columns=names)

    while (rows.agg(F.max("no")).first()[0] or 0) > 0:
        level = written(rows.groupBy("row", F.floor(F.col("no") / fan).alias("up")).applyInPandas(lambda _, x: join(x), FRAGMENTS))
        drop(rows)
        rows = level
    return rows


def blocks(docs: DataFrame, a_path: str, b_path: str, pattern: str, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """The documents aligned, in rows of several each: their counts and digests, their distinct linked pairs, and in how many of them each pair is."""

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, held = both(a_path, b_path, pattern), _Block()
        for x in batches:
            ids = x["doc_id"].astype(object).where(x["doc_id"].notna(), None).tolist()
            for i in range(0, len(x), 512):
                held.add(*_batch(t, ids[i : i + 512], x["text"].iloc[i : i + 512].tolist()))
                if held.entries >= block:
                    yield held.row()
        if held.docs:
            yield held.row()

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, held = both(a_path, b_path, pattern), _Block()
        for x in batches:
            for r in x.itertuples(index=False):
                f = t.compose(START, _unflat(r[3:]))
                doc = None if pd.isna(r.doc_id) else int(r.doc_id)
                if f.same and not (len(f.suf.a) or len(f.suf.b)):
                    held.add([(doc, *map(int, f.counts), _digest(f.text))], np.array([len(f.pairs)]), f.pairs, f.times)
                else:
                    held.add([(doc, 0, 0, 0, 0, "")], np.zeros(1, np.int64), EMPTY[2], EMPTY[3])
                if held.entries >= block:
                    yield held.row()
        if held.docs:
            yield held.row()

    docs = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    is_long = F.octet_length("text") > chunk
    with passing() as keep:
        parts = written(fragments(docs.where(is_long).withColumn("row", F.monotonically_increasing_id()), a_path, b_path, pattern, chunk))
        parts = reduced(parts, a_path, b_path, pattern)
        return keep(written(docs.where(~is_long).mapInPandas(short, BLOCKS).unionByName(parts.mapInPandas(finished, BLOCKS))))


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): tokens, groups and links of both tokenizers, and how common its links are.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256`` as ``Fragment`` has them; ``count_sum`` adds up, over the links, in how many
    documents their id pair is linked, and ``n_best`` counts the links whose pair is in as many documents as the commonest pair
    of its A id (ties included). Null and empty texts, and those that either tokenizer does not give back as they are, have zeros and
    an empty digest. Repeated rows count as documents of their own; null ids stay null; other columns are dropped; an empty table
    gives an empty one.

    Pairs are counted within blocks of documents first, so what is shuffled is a row per block and pair, however common the pair.
    """
    with passing() as keep:
        table = keep(blocks(docs, a_path, b_path, pattern, chunk, block))
        each = table.select("block", F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("block", F.col("p.pairs").alias("pair"), F.col("p.held").alias("n"))
        counts = keep(written(each.groupBy("pair").agg(F.sum("n").alias("n"))))
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    rated = counts.withColumn("a", F.shiftright("pair", 32)).join(most, "a").select("pair", (2 * F.col("n") + (F.col("n") == F.col("most")).cast("long")).alias("code"))
    back = each.select("block", "pair").join(rated, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pair", "code"))).alias("c"))
    back = back.select("block", F.col("c.code").alias("codes"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for r in x.itertuples(index=False):
                sizes = np.asarray(r.sizes, np.int64)
                entries, times = (np.frombuffer(zlib.decompress(c), "<i4").astype(np.int64) for c in (r.entries, r.times))
                code = (np.asarray(r.codes, np.int64) if r.codes is not None else EMPTY[2])[np.cumsum(entries)]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                best, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                np.add.at(best, owner, (code & 1) * times)
                np.add.at(total, owner, (code >> 1) * times)
                yield pd.DataFrame({"doc_id": pd.array(r.doc_id, "Int64"), **{c: getattr(r, c) for c in COUNTS}, "n_best": best, "count_sum": total, "groups_sha256": r.groups_sha256})

    rows = table.select("block", "doc_id", *COUNTS, "groups_sha256", "sizes", "entries", "times").join(back, "block", "left").drop("block")
    return rows.mapInPandas(score, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return align(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN)
