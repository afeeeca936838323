"""Chat formatting with DataFrame operations only: reply trees to paths, paths to formatted conversations and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import saved

#: Fixed values of the template. Texts never hold a "<" once escaped, so no mark can be forged in one.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
#: What is escaped and how, in order; read back in the other order.
ESCAPES = (("%", "%25"), ("<", "%3C"))
ROLE_ESCAPES = (*ESCAPES, ("|", "%7C"), ("\n", "%0A"))
LOSS_ROLE = "assistant"


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def chains(conversations: DataFrame) -> DataFrame:
    """Messages (tree, conv_id, node, parent, role, text, score) of rows by turn: each row replies to the one before.

    Rows of one turn are taken in the order of role and text; a null turn comes first; rows without conv_id are one
    conversation of their own. Null roles and texts are empty.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("tree", "conv_id", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, depth, path_score): every root-to-leaf path of every reply tree, depth counted up from the leaf.

    Self-joins double the step: after k of them every message knows its ancestor 2^k above and every leaf its 2^k
    nearest ancestors, so a chain of n messages takes log2(n) rounds and no path is carried as a growing array.
    A parent that isn't in the tree makes a root. Where replies go round in a circle, its least message is taken for a
    root, so every message is on some path. `node` must occur once in its tree (see `one_each`). path_score is the
    mean score of the path, null scores being 0.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    real = messages.select("tree", F.col("node").alias("up"))
    links = nodes.filter("parent IS NOT NULL").join(real, (nodes.tree == real.tree) & (nodes.parent == real.up), "left_semi").select("tree", "node", F.col("parent").alias("up"))
    links = saved(links.withColumn("low", F.col("up")), "replies")
    parents = links.select("tree", F.col("up").alias("node")).distinct()
    leaves = nodes.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("depth"))
    reached, step, jump = saved(leaves, "leaves"), 1, links
    most = None
    while not jump.isEmpty():
        if step >= 32 and most is None:
            most = nodes.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if most is not None and step > most:  # no chain is longer than its tree: these ones go round
            heads = saved(jump.filter("low = node").select("tree", "node", F.lit(True).alias("head")), "circles")
            cut = messages.join(heads, ["tree", "node"], "left").withColumn("parent", F.when(F.col("head").isNull(), F.col("parent")))
            return paths(cut.drop("head"))
        above = jump.select("tree", "node", "up")
        further = reached.join(above, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("depth") + step).alias("depth"))
        reached = saved(reached.union(further), "paths")
        twice = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top"), F.col("low").alias("low_above"))
        jump = jump.join(twice, ["tree", "up"]).select("tree", "node", F.col("top").alias("up"), F.least("low", "low_above").alias("low"))
        jump = saved(jump, "jumps")
        step *= 2
    scored = reached.join(nodes.select("tree", "node", "score"), ["tree", "node"])
    mean = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("path_score"))
    return reached.join(mean, ["tree", "leaf"])


def one_each(messages: DataFrame) -> DataFrame:
    """One message for each node of a tree: of several, the least by parent (a root first), role, text and score. Other columns go."""
    return messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score", "conv_id")).alias("m")).select("tree", "node", "m.*")


def best_paths(messages: DataFrame, per_tree: int | None = None) -> DataFrame:
    """The paths with their `rank` in the tree by path_score, ties to the smaller leaf; only the first `per_tree` if given."""
    found = paths(messages)
    order = Window.partitionBy("tree").orderBy(F.col("path_score").desc(), "leaf")
    ranks = found.select("tree", "leaf", "path_score").distinct().withColumn("rank", F.row_number().over(order))
    if per_tree is not None:
        ranks = ranks.filter(F.col("rank") <= per_tree)
    return found.drop("path_score").join(ranks, ["tree", "leaf"])


def format_paths(messages: DataFrame, per_tree: int | None = None) -> DataFrame:
    """(tree, conv_id, leaf, rank, segments, formatted): one formatted conversation for each chosen path.

    `segments` are the pieces of `formatted` in order, as (text, loss): marks and every role's text, escaped; loss is
    true for the texts of the assistant alone. Repeated nodes count once (see `one_each`); other columns are left out.
    """
    messages = one_each(messages)
    chosen = best_paths(messages, per_tree)
    turns = chosen.join(messages.select("tree", "node", "conv_id", "role", "text"), ["tree", "node"])
    turn = F.struct((-F.col("depth")).alias("at"), F.col("role"), F.col("text"))
    grouped = turns.groupBy("tree", "leaf", "rank").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(t["role"], ROLE_ESCAPES), F.lit(CLOSE))
        no = F.lit(False)
        return F.array(
            F.struct(head.alias("text"), no.alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == LOSS_ROLE).alias("loss")),
            F.struct(F.lit(END).alias("text"), no.alias("loss")),
        )

    out = grouped.select("tree", "conv_id", "leaf", "rank", F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, unescaped."""
    parts = F.split(formatted, r"<\|end\|>\n", -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, CLOSE, 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1)), ROLE_ESCAPES).alias("role"),
            unescape(F.substr(p, F.length(head) + len(CLOSE) + 1)).alias("text"),
        )

    return F.transform(turns, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation says, read back from it: turns, and the text under the loss mask."""
    read = formatted.withColumn("_turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    read = read.withColumn("_loss", loss)
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
