"""Spelling variants: words one edit apart, found by a bit-sliced position index, and the commoner form of each."""

from __future__ import annotations

from collections import defaultdict
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, passing, read_table, written

LETTERS = "A-Za-zÀ-ÿ"
#: Words of one index and words that one task holds against it, about.
INDEXED, ASKED = 4096, 16384


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, slip: int = 199) -> DataFrame:
    """``word`` and ``n``, its occurrences: maximal runs of letters in ``text``, only A-Z lower-cased, of at least ``min_length`` characters.

    A run loses the character at h % length if ``slip`` divides h, the crc32 of ``<doc_id>:<run>`` (null id: empty). Null and
    empty texts have no words; repeated rows count again; words with fewer than ``min_count`` occurrences are left out.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{min_length},}})"), 1)).alias("run"))
    runs = runs.withColumn("run", F.translate("run", ascii_uppercase, ascii_lowercase))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))).withColumn("at", (F.col("h") % F.char_length("run")).cast("int"))
    cut = F.concat(F.substr("run", F.lit(1), F.col("at")), F.substr("run", F.col("at") + 2))
    words = runs.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


class PositionIndex:
    """For each position and letter the set of words that have it there, as one long integer with a bit for each word."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.at: defaultdict[tuple[int, str], int] = defaultdict(int)
        self.length: defaultdict[int, int] = defaultdict(int)
        for j, w in enumerate(words):
            bit = 1 << j
            self.length[len(w)] |= bit
            for at in enumerate(w):
                self.at[at] |= bit

    def near(self, q: str) -> list[str]:
        """Words that differ from ``q`` by exactly one inserted, deleted or replaced character.

        ``exact`` has the words that agree so far. Of those with one error, ``same`` go on at the same position, ``longer`` one position
        ahead (they have a further character), and ``shorter`` one position behind.
        """
        at, length = self.at.get, self.length.get
        exact = (1 << len(self.words)) - 1
        same = longer = shorter = 0
        for i, c in enumerate(q):
            here = at((i, c), 0)
            left = exact & here
            same = same & here | exact ^ left
            longer = (longer | exact) & at((i + 1, c), 0)
            shorter = shorter & at((i - 1, c), 0) | exact
            exact = left
            if not (exact or same or longer or shorter):
                return []
        n, out = len(q), []
        found = same & length(n, 0) | (longer | exact) & length(n + 1, 0) | shorter & length(n - 1, 0)
        while found:
            low = found & -found
            out.append(self.words[low.bit_length() - 1])
            found ^= low
        return out


def near_words(words: DataFrame, indexed: int = INDEXED, asked: int = ASKED) -> DataFrame:
    """Each ordered pair ``word``, ``near`` one edit apart, once, with ``near_n``; ``words`` (``word``, ``n``) are different and have two characters or more.

    One edit leaves the first or the last half of a word as it is, so an index is shared by words whose halves fall into one
    bucket, and a word asks the buckets of its own halves at the three lengths it may meet. Buckets have about ``indexed`` words;
    those with more are split into several indexes, and their askers into several tasks, so a half that many words share
    is never one task.
    """
    total = words.count()
    n_buckets = max(1, -(-total // indexed))

    def bucket(length, half, kind: int):
        return (F.pmod(F.xxhash64(length, half), F.lit(n_buckets)) * 2 + kind).cast("long")

    size = F.char_length("word")

    def halves(length):
        first = F.floor(length / 2).cast("int")
        return bucket(length, F.substr("word", F.lit(1), first), 0), bucket(length, F.substr("word", size - (length - first) + 1), 1)

    index = words.select("word", "n", F.explode(F.array(*halves(size))).alias("bucket"))
    askers = words.select("word", F.explode(F.array_distinct(F.array(*(b for d in (-1, 0, 1) for b in halves(size + d))))).alias("bucket"))
    parts = lambda rows, most, name: rows.groupBy("bucket").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    sizes = written(parts(index, indexed, "indexes").join(parts(askers, asked, "tasks"), "bucket"))
    number = lambda seed, n: F.pmod(F.xxhash64("word", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = index.join(sizes, "bucket").select("bucket", "word", "n", number(1, "indexes").alias("part"), every("tasks").alias("task"))
    askers = askers.join(sizes, "bucket").select("bucket", F.col("word").alias("asker"), number(2, "tasks").alias("task"), every("indexes").alias("part"))

    def look_up(key: tuple, held: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        by_first = key[0] % 2 == 0
        index, n, out = PositionIndex(held["word"].tolist()), dict(zip(held["word"], held["n"])), []
        for q in ask["asker"]:
            for w in index.near(q):
                # pairs with equal first halves are told where those meet, all others where the last halves meet
                half = len(w) // 2
                if q.startswith(w[:half]) == by_first and (by_first or q.endswith(w[half:])):
                    out.append((q, w, n[w]))
        return pd.DataFrame(out, columns=["word", "near", "near_n"])

    keys = ("bucket", "part", "task")
    return index.groupBy(*keys).cogroup(askers.groupBy("bucket", "part", "task")).applyInPandas(look_up, "word string, near string, near_n bigint")


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, slip: int = 199, ratio: int = 5, indexed: int = INDEXED, asked: int = ASKED) -> DataFrame:
    """One row per word of ``vocabulary``: ``n``, ``n_near`` (words one edit apart), ``form``, ``form_n`` and ``root``.

    ``form`` is the commonest near word (ties: the first in code-point order) if it is at least ``ratio`` times as common as the word, else
    null; ``root`` is the end of the chain of forms, the word itself without a form. No documents, or none with words, give no rows;
    columns other than ``doc_id`` and ``text`` are not read.
    """
    with passing() as keep:
        words = written(vocabulary(docs, min_length, min_count, slip))
        near = near_words(words, indexed, asked).groupBy("word").agg(F.count("*").alias("n_near"), F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near")).alias("top"))
        formed = words.join(near, "word", "left").withColumn("top", F.when(F.col("top.near_n") >= ratio * F.col("n"), F.col("top")))
        table = keep(written(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("top.near").alias("form"), F.col("top.near_n").alias("form_n"))))
        # forms are commoner by a factor, so chains are short and have no cycle: each round doubles what a step spans
        steps = written(table.where("form is not null").select("word", F.col("form").alias("root")))
        while True:
            ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
            jumped = written(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
            drop(steps)
            steps = jumped
            if steps.where("moved").isEmpty():
                break
        roots = keep(steps)
    return table.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)),
runs AS (
  SELECT doc_id, translate(run, '{ascii_uppercase}', '{ascii_lowercase}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}]{{6,}}')) AS run FROM documents) GROUP BY 1, 2),
coded AS (
  SELECT run, n, list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(ord(c) - 64 AS BIGINT)] END))) AS b FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM coded, crc),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS (SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS gap FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.gap = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.gap = b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.r = 1),
chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r ON f.word = r.word
"""
