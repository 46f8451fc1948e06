"""SentencePiece encoding and decoding of merge-type (BPE) models, exactly as the library does.

The encoder does not run merges over a text. It takes the longest vocabulary
match at a position (all matches come from one Aho-Corasick pass), accepts it
if it is compatible with the piece before, and steps back over a bitfield of
positions that are known to fail. Two pieces are compatible if merging their
joint characters again gives just these two; a chain of pieces whose neighbours
are all compatible is the one result of the merges.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, small_batches

SPACE = "▁"
#: Encoded words that a worker remembers; beyond that it starts anew.
MEMORY = 150_000
#: Longer stretches without a blank have their matches listed in windows of so many characters.
WINDOW = 1 << 15


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class Matches:
    """Ends of the matches that start at each place of a long text, ascending; two windows are held at a time."""

    def __init__(self, auto: ahocorasick.Automaton, text: str, reach: int, window: int) -> None:
        self.auto, self.text, self.reach, self.window = auto, text, reach, window
        self.held: dict[int, list[list[int]]] = {}

    def __getitem__(self, at: int) -> list[int]:
        low = at - at % self.window
        rows = self.held.get(low)
        if rows is None:
            if len(self.held) > 1:
                self.held.pop(min(self.held, key=lambda x: -abs(x - low)))
            high = min(low + self.window, len(self.text))
            rows = self.held[low] = [[] for _ in range(high - low)]
            for end, size in self.auto.iter(self.text, low, min(len(self.text), high + self.reach)):
                if end - size + 1 < high:
                    rows[end - size + 1 - low].append(end + 1)
        return rows[at - low]


class Pieces:
    """A merge-type model with identity normalizer, read from its file."""

    def __init__(self, path: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            top = list(_fields(f.read()))
        trainer = dict(_fields(next(v for k, v in top if k == 2)))
        rules = dict(_fields(next(v for k, v in top if k == 3)))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a merge-type model")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only the identity normalizer that escapes blanks and keeps all of them is supported")
        self.prefix = bool(rules.get(3, 1))
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.rank = {p: (-sp.get_score(i), i) for i, (p, s) in enumerate(zip(names, special)) if not s}
        self.ids = {p: i for p, (_, i) in self.rank.items()}
        self.chars = {p for p in self.ids if len(p) == 1}
        if {c for p in self.ids for c in p} - self.chars:
            raise ValueError("a character of a longer piece is no piece itself")
        self.byte = {int(p[1:-1], 16): i for i, p in enumerate(names) if sp.is_byte(i)}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.is_byte = [sp.is_byte(i) for i in range(n)]
        # what each id stands for, blanks in place of their mark
        self.surface = [b"" if sp.is_control(i) else bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else sp.decode([i]).encode() if sp.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.packed = [np.uint32(i).astype("<u4").tobytes() for i in range(n)]
        self.auto = ahocorasick.Automaton()
        for p in self.ids:
            self.auto.add_word(p, len(p))
        self.auto.make_automaton()
        self.reach = max(map(len, self.ids))
        self.packed_of = {p: self.packed[i] for p, i in self.ids.items()}
        self.meets: dict[str, int] = {}
        self.wholes: dict[str, bool] = {}
        # No piece has a blank after another character: then no merge crosses such a place, and words can be encoded one by one.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        apart = "" if "\n" in self.chars else "\n"
        self.words = re.compile(f" +[^ {apart}]*|[^ {apart}]+" + (f"|{apart}+" if apart else ""))
        self.known: dict[str, bytes] = {}

    def remerge(self, text: str) -> list[str]:
        """The merges themselves, over a few characters: best score first, then leftmost."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _meet(self, both: str) -> int:
        """Where two compatible pieces that read ``both`` meet: their joint merges leave just these; 0 if they leave anything else."""
        parts = self.remerge(both)
        if len(self.meets) >= MEMORY:
            self.meets.clear()
        got = self.meets[both] = len(parts[0]) if len(parts) == 2 else 0
        return got

    def _whole(self, piece: str) -> bool:
        got = self.wholes.get(piece)
        if got is None:
            got = self.wholes[piece] = len(self.remerge(piece)) == 1
        return got

    def backtrack(self, text: str) -> list[str]:
        """Pieces of ``text``, all of whose characters are pieces themselves."""
        n = len(text)
        longer: list[list[int]] = [[] for _ in text]
        for end, size in self.auto.iter(text):
            longer[end - size + 1].append(end + 1)  # ends ascend
        failed = bytearray(n + 1)
        chain: list[str] = []
        ends: list[list[int]] = []  # of each piece in the chain: its shorter rivals
        meets, at, rivals, before = self.meets, 0, longer[0], ""
        while at < n:
            while rivals:
                end = rivals.pop()
                if failed[end]:
                    continue
                piece = text[at:end]
                if before:
                    both = before + piece
                    meet = meets.get(both)
                    if (self._meet(both) if meet is None else meet) != len(before):
                        continue
                elif not self._whole(piece):
                    continue
                chain.append(piece)
                ends.append(rivals)
                at, before = end, piece
                rivals = longer[at].copy() if at < n else ()
                break
            else:
                # no piece fits here: this position fails, and the piece before gives way to a shorter one
                if not chain:
                    raise ValueError(f"no segmentation of {text[:40]!r}")
                failed[at] = 1
                at -= len(chain.pop())
                rivals, before = ends.pop(), chain[-1] if chain else ""
        return chain

    def backtrack_long(self, text: str, window: int = WINDOW) -> bytes:
        """Packed ids of a long ``text``, as ``backtrack`` finds them, in a few bytes per character.

        Of the chain only the ends are kept; a piece's shorter rivals are looked up again when it gives way.
        """
        n, ends, failed = len(text), array("Q"), bytearray(len(text) + 1)
        matches = Matches(self.auto, text, self.reach, window)
        at, before, rivals = 0, "", matches[0].copy()
        while at < n:
            while rivals:
                end = rivals.pop()
                piece = text[at:end]
                if failed[end] or not ((self.meets.get(before + piece) or self._meet(before + piece)) == len(before) if before else self._whole(piece)):
                    continue
                ends.append(end)
                at, before = end, piece
                rivals = matches[at].copy() if at < n else []
                break
            else:
                if not ends:
                    raise ValueError(f"no segmentation of {text[:40]!r}")
                failed[at] = 1
                end = ends.pop()
                at = ends[-1] if ends else 0
                before = text[ends[-2] if len(ends) > 1 else 0 : at]
                rivals = [x for x in matches[at] if x < end]
        packed, out, start = self.packed_of, bytearray(), 0
        for end in ends:
            out += packed[text[start:end]]
            start = end
        return bytes(out)

    def _pieces(self, text: str) -> bytes:
        return self.backtrack_long(text) if len(text) > WINDOW else b"".join([self.packed_of[p] for p in self.backtrack(text)])

    def _pack(self, text: str) -> bytes:
        """Packed ids of a normalized stretch; characters that are no pieces never merge and fall back to bytes."""
        ids = self.packed_of
        if self.chars.issuperset(text):
            got = ids.get(text)
            return got if got is not None and self._whole(text) else self._pieces(text)
        out, at = [], 0
        for m in self.unknown(text):
            if at < m[0]:
                out.append(self._pieces(text[at : m[0]]))
            out += [self.packed[self.byte[b]] for b in m[1].encode()] if self.byte else [self.packed[self.unk]]
            at = m[0] + len(m[1])
        if at < len(text):
            out.append(self._pieces(text[at:]))
        return b"".join(out)

    def unknown(self, text: str) -> Iterator[tuple[int, str]]:
        return ((i, c) for i, c in enumerate(text) if c not in self.chars)

    def encode_packed(self, text: str | None, add_bos: bool = True, add_eos: bool = True) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        if text:
            text = text.replace(SPACE, " ")
            if self.prefix:
                text = " " + text
            for word in self.words.findall(text) if self.by_word else [text]:
                got = known.get(word)
                if got is None:
                    if len(known) >= MEMORY:
                        known.clear()
                    got = self._pack(word.replace(" ", SPACE))
                    if len(word) <= 64:
                        known[word] = got
                out.append(got)
        middle = b"".join(out)
        return (self.packed[self.bos] if add_bos else b"") + middle + (self.packed[self.eos] if add_eos else b"")

    def decode_packed(self, ids: bytes) -> str:
        """The text of packed ids: control ids vanish, the first blank mark goes if the model adds one."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        surface = self.surface
        if not self.control.isdisjoint(numbers[1:-1]):
            return self._decode_slowly(numbers)
        raw = b"".join([surface[i] for i in numbers])
        if self.prefix and raw[:1] == b" ":
            first = next(i for i in numbers if surface[i])
            if not self.is_byte[first] and first != self.unk:
                raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_slowly(numbers)

    def _decode_slowly(self, numbers: list[int]) -> str:
        """One id at a time: control ids part runs of byte ids, and each byte that belongs to no character becomes U+FFFD."""
        out, run, strip = [], bytearray(), self.prefix
        for i in [*numbers, None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + size].decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
                strip = False
            run.clear()
            if i is not None and (piece := self.surface[i].decode()):
                if strip and piece[0] == " " and i != self.unk:
                    piece = piece[1:]
                strip = False
                out.append(piece)
        return "".join(out)


@lru_cache(4)
def pieces(path: str) -> Pieces:
    """The model at ``path``, read once per Python worker."""
    return Pieces(path)


def encode(docs: DataFrame, model: str, text: str = "text", out: str = "ids_le", add_bos: bool = True, add_eos: bool = True) -> DataFrame:
    """``docs`` with the binary column ``out``: the ids as little-endian unsigned 32-bit integers.

    A null text counts as empty (only the begin and end ids). Texts of any length
    are encoded whole, in time that grows with their length. All columns and rows
    stay; a column named like ``out`` is replaced. ``model`` is a path that
    every executor has.
    """

    @F.pandas_udf("binary")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        p = pieces(model)
        for batch in texts:
            yield pd.Series([p.encode_packed(t, add_bos, add_eos) for t in batch])

    return small_batches(docs).withColumn(out, run(F.col(text)))


def decode(docs: DataFrame, model: str, ids: str = "ids_le", out: str = "decoded") -> DataFrame:
    """``docs`` with the string column ``out``: the text that the packed ids stand for.

    Null ids give an empty text; all rows and columns stay; a column named like ``out`` is replaced.
    """

    @F.pandas_udf("string")
    def run(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        p = pieces(model)
        for batch in packed:
            yield pd.Series([p.decode_packed(x or b"") for x in batch])

    return small_batches(docs).withColumn(out, run(F.col(ids)))


def encode_and_decode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids_le", decoded: str = "decoded", add_bos: bool = True, add_eos: bool = True) -> DataFrame:
    """``decode(encode(docs))`` in one Python worker per task, which holds one model and one batch of texts."""

    @F.pandas_udf("struct<ids:binary,decoded:string>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = pieces(model)
        for batch in texts:
            packed = [p.encode_packed(t, add_bos, add_eos) for t in batch]
            yield pd.DataFrame({"ids": packed, "decoded": [p.decode_packed(x) for x in packed]})

    out = small_batches(docs).withColumn("__both", run(F.col(text)))
    return out.withColumns({ids: F.col("__both.ids"), decoded: F.col("__both.decoded")}).drop("__both")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    model = default_model()
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode_and_decode(docs, model)
    return both.select("doc_id", (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the ids of each document, and whether decoding them gives back its text.

    Null texts count as empty (begin and end ids only); every row stays, repeated ones too;
    further columns are dropped; an empty table gives an empty one.
    """
    model = default_model()
    both = encode_and_decode(docs.select("doc_id", "lang", "source", "text"), model)
    n = (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens")
    return both.select("doc_id", "lang", "source", n, "ids_le", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
