"""Personal data: fixed patterns, plus a linear-chain conditional random field over word shapes.

The field is trained by gradient ascent on the likelihood of a small labelled
table and decoded by Viterbi in numpy batches. Its chains are the runs of tokens that
can be part of such data: those with a digit or an ``@``, and those of joining marks alone
between them. Any other token ends a chain, in training as in decoding.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, small_batches

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Texts that go through the field together; a worker holds the features of so many.
TOGETHER = 256

# --- fixed patterns ---------------------------------------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a number that fails at its first digit fails at every later one: start at first digits only, so that long digit runs cost linear time
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    """Whether ASCII digits, leading zeros or not, are at most 255."""
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of what the fixed patterns find, by kind and then start."""
    out: list[tuple[str, int, int]] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        else:
            free = at + 1  # a local part holds no @
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(_octet(x) for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def touches(spans: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a (start, end) overlaps any of ``spans``, in logarithmic time."""
    known = sorted(spans)
    starts, reach = [s for s, _ in known], list(accumulate((e for _, e in known), max))

    def hit(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and reach[before - 1] > start

    return hit


# --- the field --------------------------------------------------------------------------------------------
#: The labelled table: texts with personal data marked as [kind value], and look-alikes left plain.
LABELLED = (
    "Write to [email jo.doe@mail.example.org] before Friday.",
    "contact: [email a_b+c@host-1.example.net], or call [phone +1 (202) 555-0143].",
    "mail [email info@example.com] and [email sales99@shop.example.co]",
    "His address is <[email k.l@uni.example.edu]>.",
    "Call me at [phone +44 20 7946 0958] tomorrow.",
    "Phone [phone +49 (30) 901820-17] or fax [phone +49 (30) 901820-18].",
    "Tel. [phone +33 1 99 00 12 34], room 12.",
    "dial [phone +1-212-555-0187] now",
    "Dial [phone +34 911 23 45 67] between 9 and 17.",
    "call [phone (212) 555-0143] or [phone 212-555-0143] today",
    "Office: [phone (030) 901-8201].",
    "Ring [phone 361 555 8283] or [phone 020 7946 0958] after ten.",
    "Her number is [phone 555 867 5309] at work",
    "Reach us: [phone 0161 496 0018], weekdays.",
    "Mobile [phone 212 - 555 - 0143] only.",
    "The server [ip 10.0.12.7] answered in 35 ms.",
    "Denied 3 times from [ip 192.168.44.201].",
    "hosts [ip 172.16.0.9] and [ip 8.8.4.4] are up",
    "Ping [ip 203.0.113.77] failed.",
    "Card [card 4111111111111111] expires 09/27.",
    "paid with [card 4111 1111 1111 1111] on 3 May",
    "Charge [card 5500-0000-0000-0004], please.",
    "number [card 378282246310005] was declined",
    "Order 4111111111111112 was shipped in 2019.",
    "serial 1234567890123456 of batch 77",
    "Version 2.4.1 of 12 March 2021 fixes 17 bugs.",
    "version 1.2.3.400 came after 1.2.3.399",
    "Build 999.300.1.2 is old.",
    "In 1998 they sold 12,500 of 40,000 units.",
    "See section 3.2.1 and table 4.",
    "GPL version 3, CC BY-NC 4.0, Apache 2.0.",
    "price 19.99 for 3 at 10:45",
    "token = 9f86d081884c7d659a2feaa0c55ad015 end",
    "Follow @someone and @other2 today.",
    "twelve @ 5 each, 60 in total",
    "a@b is no address, nor is x@y",
    "The ratio was 3.14159 + 2.71828.",
    "Rooms 101 102 103 104 are free.",
    "Pages 12 17 203 were torn.",
    "Lots 4500 3200 1100 sold in 1987.",
    "scores 21 17 11 9",
    "year 1999 2000 2001",
    "The summers of 1995 1996 1997 1998 were dry.",
    "From 2001-02-03 to 2004-05-06, 1000 days.",
    "Add +5 and -3 to get +2.",
    "id 550e8400 e29b 41d4 a716 446655440000",
    "ISBN 978 3 16 148410 0 is a book",
)
_MARK = re.compile(r"\[(email|ip|card|phone) ([^\]]+)\]")
_TOKEN = re.compile(r"\S+")
_LIVE = re.compile(r"[0-9@]")
_JOINS = re.compile(r"[-+().]+")
_TRIM = ".,;:!?\"'<>[]{}|*&%$#"
_SHAPE = re.compile(r"(a+)|(A+)|(0+)")
_CLASS = str.maketrans({**{c: "0" for c in "0123456789"}, **{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})


def shape(token: str) -> str:
    """Word shape: letters as a or A, digits as 0; runs are cut to one sign."""
    return _SHAPE.sub(lambda m: m[0][0], token.translate(_CLASS))


def _features(tokens: list[str], i: int) -> list[str]:
    core = tokens[i].strip(_TRIM)
    digits = re.sub(r"[^0-9]", "", core)
    out = ["bias", f"s:{shape(core)}", f"n:{min(len(digits), 24)}"]
    if "@" in core:
        out.append("mail" if _DOMAIN.search(core) and core[0] != "@" else "at")
    parts = core.split(".")
    if len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts):
        out.append("quad" if all(map(_octet, parts)) else "wide")
    if 13 <= len(digits) <= 19 and len(digits) + core.count("-") == len(core):
        out.append("luhn" if luhn(digits) else "no-luhn")
    if core[:1] == "+":
        out.append("plus")
    for name, j in (("p", i - 1), ("q", i - 2), ("f", i + 1)):
        out.append(f"{name}:{shape(tokens[j].strip(_TRIM)) if 0 <= j < len(tokens) else '-'}")
    return out


def _runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """The chains of a text, as (start, end) pairs of their tokens: from a token with a digit or @ to the last such one that only joining marks part."""
    run: list[tuple[int, int]] = []
    marks: list[tuple[int, int]] = []
    for m in _TOKEN.finditer(text):
        if _LIVE.search(m[0]):
            run += [*marks, m.span()]
            marks = []
        elif run and len(marks) < len(run) and _JOINS.fullmatch(m[0]):
            marks.append(m.span())
        else:
            if run:
                yield run
            run, marks = [], []
    if run:
        yield run


class Field:
    """Linear-chain conditional random field with indicator features."""

    def __init__(self, table: tuple[str, ...] = LABELLED, rounds: int = 80, rate: float = 0.4, decay: float = 1e-3) -> None:
        data = []
        for row in table:
            text, spans, at = "", [], 0
            for m in _MARK.finditer(row):
                text += row[at : m.start()]
                spans.append((m[1], len(text), len(text) + len(m[2])))
                text += m[2]
                at = m.end()
            text += row[at:]
            for run in _runs(text):
                tags = []
                for s, e in run:
                    hit = next(((k, a) for k, a, b in spans if s < b and a < e), None)
                    tags.append(0 if hit is None else TAGS.index(("B-" if s <= hit[1] else "I-") + hit[0]))
                data.append(([_features([text[s:e] for s, e in run], i) for i in range(len(run))], tags))
        self.index = {f: i for i, f in enumerate(sorted({f for xs, _ in data for x in xs for f in x}))}
        n = len(TAGS)
        self.emit, self.move = np.zeros((len(self.index), n)), np.zeros((n, n))
        self.rules = np.zeros((n, n))  # I follows B or I of its own kind only
        self.first = np.zeros(n)
        for j, t in enumerate(TAGS):
            if t[0] == "I":
                self.first[j] = -1e9
                for i, u in enumerate(TAGS):
                    if u[2:] != t[2:]:
                        self.rules[i, j] = -1e9
        coded = [([[self.index[f] for f in x] for x in xs], ys) for xs, ys in data]
        g_e, g_m = np.full_like(self.emit, 1e-6), np.full_like(self.move, 1e-6)
        for _ in range(rounds):
            d_e, d_m = -decay * self.emit, -decay * self.move
            for xs, ys in coded:
                self._gradient(xs, ys, d_e, d_m)
            g_e += d_e**2
            g_m += d_m**2
            self.emit += rate * d_e / np.sqrt(g_e)
            self.move += rate * d_m / np.sqrt(g_m)

    def _gradient(self, xs: list[list[int]], ys: list[int], d_e: np.ndarray, d_m: np.ndarray) -> None:
        score = np.array([self.emit[x].sum(axis=0) for x in xs])
        score[0] += self.first
        move, n = self.move + self.rules, len(xs)
        fore, back = np.empty_like(score), np.zeros_like(score)
        fore[0] = score[0]
        for t in range(1, n):
            fore[t] = score[t] + np.logaddexp.reduce(fore[t - 1][:, None] + move, axis=0)
        for t in range(n - 2, -1, -1):
            back[t] = np.logaddexp.reduce(move + score[t + 1] + back[t + 1], axis=1)
        z = np.logaddexp.reduce(fore[-1])
        for t, x in enumerate(xs):
            p = -np.exp(fore[t] + back[t] - z)
            p[ys[t]] += 1
            for f in x:
                d_e[f] += p
        for t in range(1, n):
            d_m -= np.exp(fore[t - 1][:, None] + move + score[t] + back[t] - z)
            d_m[ys[t - 1], ys[t]] += 1

    def decode(self, runs: list[list[list[str]]]) -> list[np.ndarray]:
        """Best tags of every run of feature lists; runs of one length go through Viterbi as one array."""
        out: list[np.ndarray] = [np.empty(0, int)] * len(runs)
        move = self.move + self.rules
        by_length: dict[int, list[int]] = {}
        for i, r in enumerate(runs):
            by_length.setdefault(len(r), []).append(i)
        index, emit = self.index, self.emit
        for n, which in by_length.items():
            for at in range(0, len(which), max(1, 20000 // n)):
                part = which[at : at + max(1, 20000 // n)]
                score = np.array([[emit[[index[f] for f in x if f in index]].sum(axis=0) for x in runs[i]] for i in part])
                best, came = score[:, 0] + self.first, []
                for t in range(1, n):
                    ways = best[:, :, None] + move
                    came.append(ways.argmax(axis=1))
                    best = ways.max(axis=1) + score[:, t]
                tags = np.empty((len(part), n), int)
                tags[:, -1] = best.argmax(axis=1)
                for t in range(n - 1, 0, -1):
                    tags[:, t - 1] = np.take_along_axis(came[t - 1], tags[:, t][:, None], axis=1)[:, 0]
                for i, row in zip(part, tags):
                    out[i] = row
        return out


def plausible(kind: str, value: str) -> bool:
    """What a span of the field must satisfy: the patterns' own checks on digits."""
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        return re.fullmatch(r"[0-9]+(\.[0-9]+){3}", value) is not None and all(map(_octet, value.split(".")))
    return "@" in value[1:-1]


def find(texts: Iterable[str | None], field: Field) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """For each text the spans of the fixed patterns, and the further ones of the field that overlap none of them. Null counts as empty."""
    every = [t or "" for t in texts]
    return [x for at in range(0, len(every), TOGETHER) for x in _find(every[at : at + TOGETHER], field)]


def _find(texts: list[str], field: Field) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    base, runs, where = [], [], []
    for n, text in enumerate(texts):
        live = bool(text) and _LIVE.search(text) is not None
        spans = base_spans(text) if live else []
        base.append(spans)
        taken = touches((s, e) for _, s, e in spans)
        for run in _runs(text) if live else ():
            # what the patterns have found needs no second opinion, but stays as context of its neighbours
            if all(taken(s, e) for s, e in run):
                continue
            tokens = [text[s:e] for s, e in run]
            runs.append([_features(tokens, i) for i in range(len(tokens))])
            where.append((n, run, taken))
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (n, run, taken), tags in zip(where, field.decode(runs)):
        i = 0
        while i < len(run):
            if tags[i] == 0:
                i += 1
                continue
            j = i + 1
            while j < len(run) and TAGS[tags[j]][0] == "I":
                j += 1
            text, s, e = texts[n], run[i][0], run[j - 1][1]
            while s < e and text[s] in _TRIM:
                s += 1
            while e > s and text[e - 1] in _TRIM:
                e -= 1
            if s < e and plausible(TAGS[tags[i]][2:], text[s:e]) and not taken(s, e):
                added[n].append((TAGS[tags[i]][2:], s, e))
            i = j
    return list(zip(base, added))


def personal_data(docs: DataFrame, text: str = "text", labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (kind, start, end) in code points, ends exclusive.

    ``base`` has what the fixed patterns find, ordered by kind and start;
    ``added`` what the field finds besides, none of it overlapping ``base``.
    Null and empty texts give empty arrays; texts of any length are searched
    whole; repeated rows get equal results; columns of these two names are replaced.
    ``labelled`` is the small table that trains the field, on the driver, once.
    """
    field = Field(labelled)
    kind = "base array<struct<kind:string,start:bigint,end:bigint>>, added array<struct<kind:string,start:bigint,end:bigint>>"

    @F.pandas_udf(f"struct<{kind.replace('base ', 'base:').replace('added ', 'added:')}>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = find(texts, field)
        rows = [[[{"kind": k, "start": s, "end": e} for k, s, e in sorted(x, key=lambda y: (KINDS.index(y[0]), y[1]))] for x in both] for both in found]
        return pd.DataFrame({"base": [r[0] for r in rows], "added": [r[1] for r in rows]})

    out = small_batches(docs).withColumn("__found", run(F.col(text)))
    return out.withColumns({"base": F.col("__found.base"), "added": F.col("__found.added")}).drop("__found")


def redact(docs: DataFrame, text: str = "text", labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in angle brackets; overlapping spans become one.

    A null text stays null; the other columns are neither read nor changed, whatever their names; repeated rows get equal results.
    """
    field = Field(labelled)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t, (base, added) in zip(texts, find(texts, field)):
            parts, at = [], 0
            for k, s, e in sorted([*base, *added], key=lambda x: (x[1], -x[2])):
                if s >= at:
                    parts += [t[at:s], f"<{k}>"]
                at = max(at, e)
            out.append(t if t is None else "".join(parts) + t[at:])
        return pd.Series(out)

    return small_batches(docs).withColumn(text, run(F.col(text)))


def spans_text(column) -> Column:
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8_pii(spark, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base", "added")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    order = F.transform(F.concat("base", "added"), lambda x: F.struct(F.array_position(F.lit(list(KINDS)), x["kind"]).alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return found.select("doc_id", *map(count, KINDS), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.sort_array(order)).alias("spans"))
