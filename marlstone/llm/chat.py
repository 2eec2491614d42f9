"""Reply trees to training conversations.

Branches are found by pointer doubling: iterative self-joins give each message
its 2^k-th ancestor, and a second round of joins spreads each leaf over all its
ancestors, so a branch of n messages takes about log2(n) rounds and no task
holds a whole tree. Branches are ranked by score and each chosen one becomes
one conversation. Built from DataFrame functions only.

Template: an assistant turn is ``<s>text</s>``, any other ``[INST]role<newline>text[/INST]``.
Inside roles and texts ``\\``, ``[`` and ``<`` become ``\\e``, ``\\l`` and ``\\g``
(a newline in a role ``\\n``), so that no text can hold a mark, and back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import saved

TURNS = r"\[INST\][^\n\[]*\n[^\[]*\[/INST\]|<s>[^<]*</s>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("["), F.lit("\\l")), F.lit("<"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\g"), F.lit("<")), F.lit("\\l"), F.lit("[")), F.lit("\\e"), F.lit("\\"))


def branches(messages: DataFrame, top: int | None = None) -> DataFrame:
    """(tree, leaf, back, id, rank, branch_score): a row for each message of each chosen root-to-leaf path; back counts from the leaf.

    messages: (tree, id, parent, score). A message whose parent is null, itself
    or not in the tree is a root; repeated ids count once (the smallest row);
    null scores are 0; a cycle has no leaf, and so no path. Null trees and ids
    are ignored here. Branches rank by the sum of scores, then the leaf's id.
    top: branches kept per tree, all by default.
    """
    nodes = messages.where("tree is not null and id is not null").groupBy("tree", "id").agg(F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")).select("tree", "id", "m.parent", "m.score")
    nodes = saved(nodes)
    parents = nodes.select("tree", F.col("id").alias("parent")).join(nodes.where("parent <> id").select("tree", "parent", F.col("id").alias("child")), ["tree", "parent"])
    step = saved(parents.select("tree", F.col("child").alias("id"), F.col("parent").alias("up")))
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    jumps = [step]
    for _ in range(1, (most - 1).bit_length()):
        last = jumps[-1]
        jumps.append(saved(last.join(last.select("tree", F.col("id").alias("up"), F.col("up").alias("far")), ["tree", "up"]).select("tree", "id", F.col("far").alias("up"))))
    leaves = nodes.join(step.select("tree", F.col("up").alias("id")).distinct(), ["tree", "id"], "left_anti")
    path = leaves.select("tree", F.col("id").alias("leaf"), F.lit(0).alias("back"), "id")
    for k in range(len(jumps) - 1, -1, -1):
        path = saved(path.union(path.join(jumps[k], ["tree", "id"]).select("tree", "leaf", (F.col("back") + (1 << k)).alias("back"), F.col("up").alias("id"))))
    scored = path.join(nodes.select("tree", "id", "score"), ["tree", "id"]).groupBy("tree", "leaf").agg(F.sum("score").alias("branch_score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return path.join(ranked, ["tree", "leaf"]).select("tree", "leaf", "back", "id", "rank", "branch_score")


def format_trees(messages: DataFrame, top: int | None = None) -> DataFrame:
    """One row per chosen branch: tree, leaf, rank, branch_score, formatted, loss_spans (code points, end exclusive).

    messages: (tree, id, parent, score, role, text); null roles and texts are
    empty. Rows are treated as in branches(); other columns are ignored. Loss
    falls on the assistant texts, escaped as they stand in the output.
    """
    words = messages.where("tree is not null and id is not null").groupBy("tree", "id").agg(F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m")).select("tree", "id", "m.role", "m.text")
    said = escaped(F.col("text"))
    head = F.when(F.col("role") == "assistant", F.lit("<s>")).otherwise(F.concat(F.lit("[INST]"), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n")))
    tail = F.when(F.col("role") == "assistant", F.lit("</s>")).otherwise(F.lit("[/INST]"))
    shown = words.select("tree", "id", F.concat(head, said, tail).alias("shown"), F.when(F.col("role") == "assistant", F.length(said)).alias("loss"))
    turns = branches(messages, top).join(shown, ["tree", "id"])
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("shown").cast("long")).over(before), F.lit(0).cast("long")) + 3)
    span = F.when(F.col("loss").isNotNull(), F.struct(F.col("at").alias("start"), (F.col("at") + F.col("loss")).alias("end")))
    found = turns.groupBy("tree", "leaf").agg(F.first("rank").alias("rank"), F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("at"), "shown"))).alias("turns"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return found.select("tree", "leaf", "rank", "branch_score", F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"), "loss_spans")


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""
    role = lambda t: F.replace(F.substring_index(F.substring(t, 7, 1 << 30), "\n", 1), F.lit("\\n"), F.lit("\n"))

    def turn(t: Column) -> Column:
        other = t.startswith("[INST]")
        head = F.when(other, F.locate("\n", t)).otherwise(F.lit(3))
        tail = F.when(other, F.lit(7)).otherwise(F.lit(4))
        body = F.substring(t, head + 1, F.length(t) - head - tail)
        return F.struct(F.when(other, unescaped(role(t))).otherwise(F.lit("assistant")).alias("role"), unescaped(body).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURNS), F.lit(0)), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
