"""Chat formatting: reply trees, their best root-to-leaf paths, one formatted conversation for each.

Paths are enumerated by self-joins that double in reach: after round k every node
knows its ancestor 2^k steps up, its depth, and the score of the way. So the
number of rounds is the logarithm of the longest path, and only node names and
numbers move; texts join once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read_table, written

START, SAYS, END = "### ", ": ", " </turn>\n"


def escape(text: Column) -> Column:
    r"""Control strings inside a text, made harmless: \ -> \b, ### -> \h, </turn> -> \e. Undone by ``unescape``."""
    for plain, code in (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    for plain, code in ((":", "\\c"), ("###", "\\h"), ("</turn>", "\\e"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def best_paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """Root-to-leaf paths: ``tree``, ``path`` (name of the leaf), ``node``, ``depth`` of every node on a chosen path.

    ``nodes`` has ``tree``, ``node`` (unique), ``parent`` (null at a root) and ``score``
    (null: 0). Paths of a tree rank by the sum of their scores, then by length and by
    the leaf's name; the best ``per_tree`` of each tree are returned. A parent that does
    not exist makes its child a root; nodes on a cycle reach no root and are left out.
    """
    known = written(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")))
    there = known.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    first = known.join(there, "parent", "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).alias("length"), "score")
    steps = [written(first)]
    over = steps[0].where("up is null")  # those whose way to the root is complete
    # step k: up is the ancestor 2^k steps above, if there is one; length and score cover the way up to it, without it.
    # Only what still climbs goes on to the next step.
    while not (climbing := steps[-1].where("up is not null")).isEmpty():
        high = over.unionByName(climbing).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("length").alias("l2"), F.col("score").alias("s2"))
        steps.append(written(climbing.join(high, "up").select("tree", "node", F.col("up2").alias("up"), (F.col("length") + F.col("l2")).alias("length"), (F.col("score") + F.col("s2")).alias("score"))))
        done = steps[-1].where("up is null")
        if done.isEmpty():
            break  # a tree ends at every depth up to its last: what climbs without end goes round a cycle
        over = over.unionByName(done)
    full = over
    parents = first.where("up is not null").select(F.col("up").alias("node"))
    leaves = full.join(parents, "node", "left_anti")
    rank = W.partitionBy("tree").orderBy(F.desc("score"), F.desc("length"), F.asc("node"))
    chosen = leaves.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= per_tree)
    reached = written(chosen.select(F.col("node").alias("path"), "node", F.col("length").alias("depth")))
    # from the leaf upwards: whoever is reached reaches the ancestor 2^k steps above, from large k to small
    for k in range(len(steps) - 2, -1, -1):
        hop = steps[k].where("up is not null").select("node", "up")
        more = reached.join(hop, "node").select("path", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        reached = written(reached.unionByName(more))
    return reached.join(known.select("tree", "node"), "node").select("tree", "path", "node", "depth")


def format_paths(messages: DataFrame, per_tree: int = 1, trained: str = "assistant") -> DataFrame:
    """One conversation per chosen path: ``tree``, ``path``, ``formatted``, ``loss_spans``.

    ``messages`` has ``tree``, ``node``, ``parent``, ``score``, ``role`` and ``text``.
    ``loss_spans`` are the (start, end) code points, ends exclusive, of the escaped texts
    whose role is ``trained``. Null roles and texts count as empty.
    """
    on = best_paths(messages, per_tree)
    lines = messages.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit(SAYS))
    body = escape(F.col("text"))
    turns = on.join(lines, "node").select("tree", "path", "depth", (F.col("role") == trained).alias("trained"), head.alias("head"), body.alias("body"))
    turns = turns.withColumns({"size": (F.length("head") + F.length("body") + len(END)).cast("long")})
    upto = W.partitionBy("tree", "path").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    turns = turns.withColumn("stop", F.sum("size").over(upto) - len(END))
    piece = F.struct("depth", F.concat("head", "body", F.lit(END)).alias("piece"), "trained", (F.col("stop") - F.length("body")).alias("start"), F.col("stop").alias("end"))
    rows = turns.groupBy("tree", "path").agg(F.sort_array(F.collect_list(piece)).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["trained"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return rows.select("tree", "path", F.array_join(F.col("t.piece"), "").alias("formatted"), spans.alias("loss_spans"))


def threads(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees: each row answers the one before it, by turn, then role and text.

    Rows with a null conv_id form one conversation of their own; null turns come first.
    Rows that are equal in all four columns stay, each a turn. Further columns are dropped.
    """
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(order))
    name = lambda n: F.struct("conv_id", n.alias("n"))
    return rows.select(F.col("conv_id").alias("tree"), name(F.col("n")).alias("node"), F.when(F.col("n") > 1, name(F.col("n") - 1)).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def op6_chat(spark, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"))
    out = format_paths(threads(table.unionByName(extra)))
    # read back from the formatted text alone
    parts = F.transform(F.filter(F.split("formatted", END), lambda x: x != ""), lambda x: F.substring(x, len(START) + 1, F.length(x)))
    turn = F.transform(parts, lambda x: F.struct(unescape(F.substring_index(x, SAYS, 1)).alias("role"), unescape(F.substring(x, F.locate(SAYS, x) + len(SAYS), F.length(x))).alias("text")))
    said = F.array_join(F.transform(F.col("turns"), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    out = out.withColumns({"turns": turn, "loss": loss})
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') AS body,
             replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS who FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + length(who) + 15) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
