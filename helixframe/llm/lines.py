"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Equal lines, of any length, are found by their hashes. Two lines of at least ``MIN_WORDS``
words within one edited word (inserted, dropped or replaced) share a
variant: the line itself, or the line without one word. Every line that could
have a partner emits a hashed key for each of its variants; equal keys meet in
an aggregate, which keeps the earliest line of a key in place of pairs; the edit
distance to that line is then verified on the words, for every key.

Lines without a partner are found before that: of two such lines, the shorter's
first or last half of words also begins or ends the other. Half keys that only one
line has cost a few hashes per line, and spare the neighbourhoods of nearly all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop, passing, read_table, written
from .rules import WORD, _let

#: Shorter lines go only if they equal an earlier one: one word in five is a similarity of 0.8.
MIN_WORDS = 5


def _plain(text: Column) -> Column:
    """The text with the blank as its only white space within lines."""
    return F.regexp_replace(text, r"[\x09\x0B-\x0D]", " ")


def _words(line: Column) -> Column:
    """Words of a line of ``_plain`` text."""
    return F.array_remove(F.split(line, " "), "")


def _half_keys(w: Column) -> Column:
    """Hashes of the first and last floor(n/2) and floor((n-1)/2) words."""
    n = F.size(w)
    sizes = (F.shiftright(n, 1), F.shiftright(n - 1, 1))
    first = [F.xxhash64(F.lit(0), k, F.slice(w, F.lit(1), k)) for k in sizes]
    last = [F.xxhash64(F.lit(1), k, F.slice(w, n - k + 1, k)) for k in sizes]
    return F.array_distinct(F.array(*first, *last))


def _within_one(a: str, b: str) -> Column:
    """Whether two word arrays are at most one edited word apart."""

    def same(x: Column, y: Column) -> Column:
        at = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), False)
        return F.when(at > 0, at - 1).otherwise(F.size(x))

    p, s = same(F.col(a), F.col(b)), same(F.reverse(a), F.reverse(b))
    return F.greatest(F.size(a), F.size(b)) - p - s <= 1


def first_lines(keyed: DataFrame, min_words: int) -> DataFrame:
    """Every different line with a word: two hashes, its first place, and its half keys if it has ``min_words`` words."""
    lines = keyed.select("doc_id", "dk", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("line_no", "line"))
    words = lines.where(F.col("line").rlike("[^ ]")).select("doc_id", "dk", "line_no", _words(F.col("line")).alias("w"))
    halves = F.when(F.size("w") >= min_words, _half_keys(F.col("w"))).alias("halves")
    hashed = words.select("doc_id", "dk", "line_no", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"), halves)
    first = F.min(F.struct(F.struct("doc_id", "dk", "line_no").alias("place"), "halves")).alias("m")
    return hashed.groupBy("h1", "h2").agg(first).select("h1", "h2", "m.place.*", "m.halves")


def suspects(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines that share a half key with another: ``id`` (any), hashes, place and ``words``."""
    me = ["h1", "h2"]
    halves = lines.where("halves is not null").select(*me, F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    some = halves.join(shared, "half", "left_semi").select(*me).distinct()
    asked = lines.join(some, me, "left_semi").groupBy("dk", F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("line_no", *me)).alias("ask"))
    docs = keyed.join(asked, "dk").where(F.col("doc_id").eqNullSafe(F.col("of")))
    found = _let(F.split(_plain(F.col("text")), "\n"), lambda t: F.transform("ask", lambda a: F.struct(a["h1"].alias("h1"), a["h2"].alias("h2"), a["line_no"].alias("line_no"), F.get(t, a["line_no"]).alias("line"))))
    texts = docs.select("doc_id", "dk", F.explode(found).alias("t")).select("doc_id", "dk", "t.*")
    texts = texts.dropDuplicates(me)  # repeated rows of the table ask for the same lines
    return texts.select(F.monotonically_increasing_id().alias("id"), *me, "doc_id", "dk", "line_no", _words(F.col("line")).alias("words"))


def variants(texts: DataFrame) -> DataFrame:
    """``v``, ``slot``, ``id``: the hash of each line without the word at ``slot``, and of the whole line (slot -1)."""
    words = texts.select("id", F.size("words").alias("n"), F.posexplode("words").alias("j", "w"))
    words = words.select("id", "n", "j", F.xxhash64("w", "j").alias("a"), F.xxhash64("w", F.col("j") - 1).alias("b"))
    # the hash of a line is the xor of its words with their places; without word j, later words move up by one
    mine = W.partitionBy("id")
    upto = mine.orderBy("j").rowsBetween(W.unboundedPreceding, W.currentRow)
    words = words.select("n", "j", "id", "a", F.bit_xor("a").over(upto).alias("to_a"), F.bit_xor("b").over(upto).alias("to_b"), F.bit_xor("b").over(mine).alias("all_b"))
    without = F.xxhash64(F.col("n") - 1, F.col("to_a").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("all_b")).bitwiseXOR(F.col("to_b")))
    cut = F.struct(without.alias("v"), F.col("j").alias("slot"))
    whole = F.struct(F.xxhash64("n", "to_a").alias("v"), F.lit(-1).alias("slot"))
    both = F.when(F.col("j") == F.col("n") - 1, F.array(cut, whole)).otherwise(F.array(cut))
    return words.select("id", F.explode(both).alias("k")).select("k.v", "k.slot", "id")


def near_lines(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """``h1``, ``h2`` of the lines that have an earlier line within one edited word."""
    texts = written(suspects(keyed, lines))
    every = written(variants(texts))
    shared = every.groupBy("v").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("v")
    order = F.struct("doc_id", "dk", "line_no", "id").alias("order")
    met = written(every.join(shared, "v", "left_semi").join(texts.select("id", order), "id"))
    drop(every)
    slots = met.groupBy("v", "slot").agg(F.min("order").alias("least"))
    keys = slots.groupBy("v").agg(F.min(F.when(F.col("slot") >= 0, F.col("least"))).alias("cut"), F.min(F.when(F.col("slot") < 0, F.col("least"))).alias("whole"))
    # without word j: those that lack a word at the same place, or the whole line that reads so; as a whole: those that read so without a word
    best = F.when(F.col("slot") >= 0, F.least("least", "whole")).otherwise(F.col("cut"))
    pairs = met.join(slots, ["v", "slot"]).join(keys, "v").where(best < F.col("order")).select("id", best["id"].alias("other")).distinct()
    own = texts.select("id", "h1", "h2", F.col("words").alias("wa"))
    other = texts.select(F.col("id").alias("other"), F.col("words").alias("wb"))
    near = written(pairs.join(own, "id").join(other, "other").where(_within_one("wa", "wb")).select("h1", "h2").distinct())
    drop(texts, met)
    return near


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated and nearly repeated lines taken out of ``text``, and ``n_lines``, ``n_removed``.

    Lines end at \\n and are compared word by word. Of equal lines the earliest stays, by
    doc_id (null first), a hash of row and text, and line number; a line of at least
    ``min_words`` (at least 2) words within one edited word of an earlier such line, kept or not, goes.
    Lines without a word stay. A null text stays null with zero lines;
    an empty text is one line. Rows that repeat doc_id and text share their lines: each
    keeps what the first keeps. Other columns stay; columns of the two new names are replaced.
    An empty table gives an empty one. Lines may be of any length and number.
    """
    rows = docs.withColumn("__dk", F.xxhash64(F.lit(7), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text)))
    keyed = rows.select(F.col(doc_id).alias("doc_id"), F.col("__dk").alias("dk"), F.col(text).alias("text")).where("text is not null")
    with passing() as hold:
        lines = written(first_lines(keyed, min_words))
        near = near_lines(keyed, lines)
        keep = lines.join(near, ["h1", "h2"], "left_anti").groupBy(F.col("dk").alias("__dk"), F.col("doc_id").alias("__of")).agg(F.collect_list("line_no").alias("__keep"))
        keep = hold(written(keep))
    out = rows.join(keep, (rows["__dk"] == keep["__dk"]) & rows[doc_id].eqNullSafe(keep["__of"]), "left").drop(keep["__dk"])

    def cut(lines: Column) -> Column:
        every = F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1))
        other = F.array_except(every, F.coalesce("__keep", F.array().cast("array<int>")))
        gone = F.filter(other, lambda i: F.get(lines, i).rlike(WORD))
        return _let(gone, lambda g: F.struct(F.size(lines).cast("long").alias("n_lines"), F.size(g).cast("long").alias("n_removed"), F.when(F.size(g) > 0, F.array_join(F.transform(F.array_except(every, g), lambda i: F.get(lines, i)), "\n")).alias("text")))

    out = out.withColumn("__cut", _let(F.split(F.col(text), "\n"), cut))
    zero = F.lit(0).cast("long")
    return out.withColumns({text: F.coalesce("__cut.text", F.col(text)), "n_lines": F.coalesce("__cut.n_lines", zero), "n_removed": F.coalesce("__cut.n_removed", zero)}).drop("__dk", "__of", "__keep", "__cut")


def op2_lines(spark, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated lines go (see ``line_dedup``), and with them documents whose every word they held.

    Null and empty texts, and texts without a word, stay as they are; of repeated rows each keeps
    the same lines, so all stay. Further columns are dropped; an empty table gives an empty one.
    """
    out = line_dedup(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    empty = (F.col("n_removed") > 0) & ~F.col("text").rlike(WORD)
    return out.where(~empty).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


OP2_SQL = r"""
WITH occ AS (SELECT doc_id, no, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM
  (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS no FROM documents WHERE text IS NOT NULL)),
cls AS (SELECT array_to_string(w, ' ') AS s, any_value(w) AS w, min((doc_id, no)) AS o FROM occ WHERE len(w) > 0 GROUP BY 1),
cut AS (SELECT s, o, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:len(w)]), ' ') AS v FROM (SELECT s, o, w, unnest(range(1, len(w) + 1)) AS i FROM cls WHERE len(w) >= 5)),
near AS (SELECT a.s FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND b.o < a.o
  UNION SELECT a.s FROM cut a JOIN cls b ON a.v = b.s AND len(b.w) >= 5 AND b.o < a.o
  UNION SELECT a.s FROM cls a JOIN cut b ON b.v = a.s AND len(a.w) >= 5 AND b.o < a.o),
judged AS (SELECT occ.doc_id, occ.no, occ.line, len(occ.w) > 0 AND ((occ.doc_id, occ.no) <> cls.o OR near.s IS NOT NULL) AS gone
  FROM occ LEFT JOIN cls ON cls.s = array_to_string(occ.w, ' ') LEFT JOIN near ON near.s = cls.s)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS text
FROM judged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
