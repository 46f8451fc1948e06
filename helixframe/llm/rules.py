"""Quality rules, line first: bad lines go, then documents that lost too much go. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_or_empty

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

#: Lines that pages carry and prose does not: site chrome, in the languages of the corpus.
BOILERPLATE = (
    "javascript", "cookie", "lorem ipsum", "privacy policy", "terms of use", "terms of service", "sign in", "log in", "subscribe", "click here", "read more", "share this",
    "datenschutz", "impressum", "politique de confidentialit", "mentions légales", "política de privacidad", "aviso legal",
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the array holds twice or more; ``words`` must be a plain column or variable."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _let(placed, cover)).otherwise(0)

    def cover(s: Column) -> Column:
        # equal windows are neighbours now; in order of place, each covers min(3, distance to the last) further words
        again = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(F.sort_array(F.transform(again, lambda x: x["i"])), start, step)["n"]

    return F.when(F.size(words) >= 3, _let(hashes, covered)).otherwise(0).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def base_counts(text: str = "text") -> dict[str, Column]:
    """The plain counts of a whole text; null counts as empty."""
    t = text_or_empty(text)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    long = lambda c, name: c.cast("long").alias(name)
    of_words = lambda w: F.struct(long(F.size(w), "n_words"), long(F.length(F.array_join(w, "")), "word_chars"), repeated_words(w).alias("n_repeat_words"))
    return {
        "__w": _let(words_of(t), of_words),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def bad_line(line: Column) -> Column:
    """Whether a line with a word fails: navigation, symbols, shouting, babble, boilerplate, or long without any punctuation."""
    count = lambda p, name: F.regexp_count(line, F.lit(p)).alias(name)
    counts = F.struct(
        count(rf"{WORD}+", "n"),
        count(r"[#*$%&<>]{2,}", "symbols"),
        count(r"(?: [|»›•>] |^[|»›•] | [|»›•]$)", "navigation"),
        count(r"!!", "shouts"),
        count(r"\p{Lu}", "upper"),
        count(r"\p{L}", "letters"),
        F.size(F.array_distinct(words_of(line))).alias("distinct"),
    )
    return _let(
        counts,
        lambda c: (c["navigation"] >= F.greatest(F.lit(1), F.ceil(c["n"] / 6).cast("int")))
        | (c["symbols"] * 4 > c["n"])
        | (c["shouts"] * 4 > c["n"])
        | ((c["letters"] > 20) & (c["upper"] * 2 > c["letters"]))
        | ((c["n"] >= 12) & (c["distinct"] * 4 < c["n"]))
        | ((c["n"] <= 12) & F.lower(line).rlike("|".join(BOILERPLATE)))
        | ((c["n"] >= 30) & ~line.rlike(r"[.!?:;,…。！？]")),
    )


def clean_lines(docs: DataFrame, text: str = "text", keep_share: float = 0.5) -> DataFrame:
    """``docs`` with ``cleaned`` (the text without failed lines) and ``enough`` (bool).

    Lines end at \\n. Lines without a word stay where they are. ``enough`` says that the kept
    lines hold at least ``keep_share`` of the text's characters outside white
    space; a text without words has not enough. A null text counts as empty. Rows, repeated
    ones too, are judged one by one; columns of these two names are replaced.
    """
    kept = F.filter(F.split(text_or_empty(text), "\n"), lambda x: ~x.rlike(WORD) | ~bad_line(x))
    out = docs.withColumn("cleaned", F.array_join(kept, "\n"))
    full = lambda c: F.length(F.regexp_replace(c, BLANK, ""))
    sizes = F.struct(full(text_or_empty(text)).alias("all"), full(F.col("cleaned")).alias("kept"))
    return out.withColumn("enough", _let(sizes, lambda n: (n["all"] > 0) & (n["kept"] >= n["all"] * keep_share)))


def quality_rules(docs: DataFrame, text: str = "text", keep_share: float = 0.5) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``cleaned`` and ``kept``; see ``clean_lines``.

    ``base_failed``: fewer than 50 words, or over half of the words repeated.
    """
    counted = docs.withColumns(base_counts(text))
    counted = counted.withColumns({c: F.col(f"__w.{c}") for c in ("n_words", "word_chars", "n_repeat_words")}).drop("__w")
    out = clean_lines(counted, text, keep_share)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("enough")).drop("enough")


def op5_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, failed lines go from the others."""
    out = quality_rules(docs.select("doc_id", "text", "lang", "source", "n_chars")).where("kept")
    return out.select("doc_id", F.col("cleaned").alias("text"), "lang", "source", F.length("cleaned").cast("long").alias("n_chars"))


def _sql() -> str:
    chrome = "|".join(BOILERPLATE)
    nav = "[|»›•>]"
    edge = "[|»›•]"
    count = lambda p: f"len(regexp_extract_all(line, '{p}'))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (SELECT row, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS s, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3),
again AS (SELECT row, i FROM win WINDOW x AS (PARTITION BY row, s) QUALIFY count(*) OVER x > 1),
rep AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY row),
lines AS (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d),
full_lines AS (SELECT row, line, {count("[^\\x20\\x09-\\x0D]+")} AS n, len(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS dist,
  {count("[#*$%&<>]{2,}")} AS sy, {count(f"(?: {nav} |^{edge} | {edge}$)")} AS nav, {count("!!")} AS sh, {count("\\p{Lu}")} AS up, {count("\\p{L}")} AS le
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (SELECT row, line, nav >= greatest(1, ceil(n / 6)) OR sy * 4 > n OR sh * 4 > n OR (le > 20 AND up * 2 > le) OR (n >= 12 AND dist * 4 < n)
  OR (n <= 12 AND regexp_matches(lower(line), '{chrome}')) OR (n >= 30 AND NOT regexp_matches(line, '[.!?:;,\x{{2026}}\x{{3002}}\x{{ff01}}\x{{ff1f}}]')) AS bad,
  length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS size FROM full_lines),
per AS (SELECT row, count(*) - count(DISTINCT line) AS dup, sum(size) AS size, coalesce(sum(size) FILTER (WHERE NOT bad), 0) AS good FROM judged GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  len(words) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(words) AS base_failed,
  NOT (len(words) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(words)) AND good >= size * 0.5 AS kept
FROM w LEFT JOIN rep USING (row) LEFT JOIN per USING (row)
"""


OP5_SQL = _sql()
