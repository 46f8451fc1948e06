"""Secrets: fixed patterns, plus character Markov models of random strings and of ordinary identifiers.

A token that the patterns leave is a secret if the model of random strings
explains it better than the model of identifiers by a margin per character
and in all (a log-likelihood ratio). Both models are trained from labelled samples.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, small_batches
from .pii import spans_text, touches

KINDS = ("assign", "access", "hex", "random")
_KEY = r"(password|passwd|secret|token|api_?key)"
# ASCII alone is folded: no long s or Kelvin sign stands for s or k
_ASSIGN = re.compile(_KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 or more
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_MARKS = re.compile(r"[:=]")
_LETTER, _DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")

#: Ordinary identifiers, the second labelled sample: program names, paths, words in several languages, dates, versions.
ORDINARY = (
    "configuration", "initialization_vector", "get_user_by_id", "HttpRequestHandler", "application_settings", "internationalization", "responsibilities",
    "org/apache/commons/lang", "src/main/java/com/example", "usr/local/share/applications", "DocumentBuilderFactory", "max_number_of_retries", "default_timeout_seconds",
    "characteristically", "straightforwardness", "thunderstorms", "weather-forecasting", "state-of-the-art", "mother-in-law", "well-understood-and-tested", "2021-03-14T09-26",
    "Geschwindigkeitsbegrenzung", "Versicherungsgesellschaft", "Rechtsanwaltskanzlei", "Donaudampfschifffahrt", "Freundschaftsbeziehungen", "Verantwortungsbereich", "Aufmerksamkeit",
    "extraordinairement", "gouvernementale", "developpement", "administrativement", "particulierement", "responsabilite", "electroencefalografista", "desafortunadamente",
    "constitucionalidad", "otorrinolaringologo", "interdisciplinario", "reconocimiento", "AbstractSingletonProxyFactoryBean", "thread_pool_executor", "connection_string_builder",
    "test_should_return_none_when_empty", "README_first", "index-2020-12-31", "version-2_10_4", "chapter-12-section-3", "http_status_code_404", "utf8_general_ci", "ISO-8859-1",
    "windows-server-2019", "IMG_20190704_101500", "0000000000000000", "1111222233334444", "1234567890123456", "----------------", "================", "________________",
    "the-quick-brown-fox-jumps-over-the-lazy-dog", "anticipation", "understanding", "nevertheless", "notwithstanding", "counterproductive", "misunderstanding", "heterogeneous",
    "orthographically", "thoroughbred", "withstanding", "strengthening", "lengthwise", "bewitching", "hitherto", "otherworldliness", "thenceforth", "whitewashing",
    "4532015112830366", "20240131235959", "5555-5555-5555-5555", "and/or/either/neither", "height/width/depth", "Monday/Tuesday/Wednesday", "North-Rhine-Westphalia",
)


def random_sample(n: int = 240) -> list[str]:
    """Random strings, the first labelled sample: digests in the alphabets that keys are written in."""
    import base64

    out = []
    for i in range(n):
        d = hashlib.sha512(str(i).encode()).digest()
        out.append((d.hex()[:40], base64.b64encode(d).decode()[:40], base64.urlsafe_b64encode(d).decode()[:32], base64.b32encode(d).decode()[:32])[i % 4])
    return out


_SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_AT = np.full(128, 0)
_AT[[ord(c) for c in _SIGNS]] = np.arange(len(_SIGNS))


class Markov:
    """Log-likelihood ratio of first-order chains; letter frequencies back up what a small sample has not seen."""

    def __init__(self, random: list[str], ordinary: list[str]) -> None:
        self.ratio = self._chain(random, 20.0) - self._chain(ordinary, 4.0)

    @staticmethod
    def _chain(sample: list[str], trust: float) -> np.ndarray:
        n = len(_SIGNS)
        pairs, single = np.zeros((n, n)), np.full(n, 0.5)
        for s in sample:
            code = _AT[np.frombuffer(s.encode("ascii"), np.uint8)]
            np.add.at(pairs, (code[:-1], code[1:]), 1)
            np.add.at(single, code, 1)
        single /= single.sum()
        return np.log((pairs + trust * single) / (pairs.sum(axis=1, keepdims=True) + trust))

    def score(self, token: str) -> tuple[float, float]:
        """Ratio in all, and per step."""
        code = _AT[np.frombuffer(token.encode("ascii"), np.uint8)]
        total = float(self.ratio[code[:-1], code[1:]].sum())
        return total, total / (len(code) - 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of what the fixed patterns find, by start and then kind."""
    out = []
    if _MARKS.search(text):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def added_spans(text: str, base: list[tuple[str, int, int]], model: Markov, margin: float = 0.9, least: float = 15.0, letters_margin: float = 1.0) -> list[tuple[str, int, int]]:
    """Further tokens of 16 or more signs that look random and overlap no span of ``base``.

    Tokens of letters and marks alone need ``letters_margin``; in capitals alone they are scored in lower case, as
    the samples hold ordinary words in lower case. Tokens without a letter are numbers, not keys.
    """
    out, taken = [], touches((a, b) for _, a, b in base)
    for m in _WORD.finditer(text):
        token, (s, e) = m[0], m.span()
        if _LETTER.search(token) is None or taken(s, e):
            continue
        mixed = _DIGIT.search(token) is not None
        total, mean = model.score(token.lower() if not mixed and token.isupper() else token)
        if mean >= (margin if mixed else letters_margin) and total >= least:
            out.append(("random", s, e))
    return out


def secrets(docs: DataFrame, text: str = "text", random: list[str] | None = None, ordinary: list[str] | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (kind, start, end) in code points, ends exclusive.

    ``base`` has what the fixed patterns find, ordered by start and kind;
    ``added`` the tokens that the Markov models take for random strings besides, none
    overlapping ``base``. Null and empty texts give empty arrays; texts of any
    length are searched whole; repeated rows get equal results; columns of these two
    names are replaced. ``random`` and ``ordinary`` are the labelled samples, small and
    known to the driver (defaults: digests in common alphabets; ``ORDINARY``).
    """
    model = Markov(random or random_sample(), ordinary or list(ORDINARY))
    one = "array<struct<kind:string,start:bigint,end:bigint>>"

    @F.pandas_udf(f"struct<base:{one},added:{one}>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base = base_spans(t or "")
            rows.append([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in (base, added_spans(t or "", base, model))])
        return pd.DataFrame({"base": [r[0] for r in rows], "added": [r[1] for r in rows]})

    out = small_batches(docs).withColumn("__found", run(F.col(text)))
    return out.withColumns({"base": F.col("__found.base"), "added": F.col("__found.added")}).drop("__found")


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    found = secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base", "added")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    order = F.transform(F.concat("base", "added"), lambda x: F.struct(x["start"].alias("start"), F.array_position(F.lit(list(KINDS)), x["kind"]).alias("k"), x["end"].alias("end"), x["kind"].alias("kind")))
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.sort_array(order)).alias("spans"))
