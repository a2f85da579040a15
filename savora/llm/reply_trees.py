"""Chat formatting: reply trees become conversations, one per chosen root-to-leaf path.

Messages are rows ``(tree, node, parent, role, text, score)``.  Self-joins of the parent
links by doubling (the 1st, 2nd, 4th ... ancestor, with the sum of scores on the way) reach the root of every leaf in a
number of joins that grows with the logarithm of the depth; branches of a tree are ranked by the mean
score of their messages. Only the chosen paths are written out, each formatted as one text with a loss mask.

Defined cases: a null text, role or score counts as empty or 0; a parent that is not in the
tree makes its child a root; a leaf whose ancestors form a cycle has no root and no path; a null
tree id is a tree of its own; repeated rows of a turn follow each other; texts of any length are formatted whole; other columns
are not read; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from savora.llm.common import let, stored

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Text in which ``<|`` cannot occur: backslashes are doubled, ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: a single backslash occurs only where it was put in."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def linear_messages(turns: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages of turn-by-turn conversations: each turn replies to the one before it.

    Equal turn numbers are ordered by role, then text.  ``tree_key`` is never null.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("null"))
    order = Window.partitionBy("tree_key").orderBy(F.col(turn), F.col("role"), F.col("text"))
    return (turns.select(key.alias("tree_key"), F.col(tree).alias("tree"), F.col(turn).alias(turn),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .select("tree_key", "tree", F.row_number().over(order).cast("long").alias("node"), "role", "text")
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0)))


def jump_tables(messages: DataFrame) -> list[DataFrame]:
    """Stored ``(tree_key, node, up, total)``: table k leads to the ancestor 2**k steps up; ``total`` sums the scores from the message to below that ancestor.

    ``messages`` must be stored.  Each table is the one before it joined with itself; the last one is empty unless parents form a cycle.
    """
    scored = messages.select("tree_key", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    known = messages.select("tree_key", F.col("node").alias("parent"))
    jumps = [stored(scored.filter(F.col("parent").isNotNull()).join(known, ["tree_key", "parent"])
                    .select("tree_key", "node", F.col("parent").alias("up"), "total"), "jump")]
    largest = messages.groupBy("tree_key").count().agg(F.max("count")).first()[0] or 0
    while 2 ** (len(jumps) - 1) < largest:
        last = jumps[-1]
        further = last.select("tree_key", F.col("node").alias("up"), F.col("up").alias("further"), F.col("total").alias("more"))
        jumps.append(stored(last.join(further, ["tree_key", "up"])
                            .select("tree_key", "node", F.col("further").alias("up"), (F.col("total") + F.col("more")).alias("total")), "jump"))
    return jumps


def best_leaves(messages: DataFrame, jumps: list[DataFrame], branches: int) -> DataFrame:
    """Stored ``(tree_key, leaf, rank)`` of the ``branches`` paths with the highest mean score; ties go to the smaller leaf.

    A leaf climbs to its root in one step per table, so only leaves are ranked and no path is written out.
    """
    scores = messages.select("tree_key", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    leaves = scores.select("tree_key", "node").join(
        jumps[0].select("tree_key", F.col("up").alias("node")), ["tree_key", "node"], "left_anti")
    # as many steps up as the tree has messages: the ancestors form a cycle
    at = leaves.join(jumps[-1].select("tree_key", "node"), ["tree_key", "node"], "left_anti").select(
        "tree_key", F.col("node").alias("leaf"), "node", F.lit(0.0).alias("sum"), F.lit(1).cast("long").alias("length"))
    for power in reversed(range(len(jumps) - 1)):
        climbed = F.col("up").isNotNull()
        at = at.join(jumps[power], ["tree_key", "node"], "left").select(
            "tree_key", "leaf", F.coalesce("up", "node").alias("node"), (F.col("sum") + F.coalesce("total", F.lit(0.0))).alias("sum"),
            F.when(climbed, F.col("length") + 2 ** power).otherwise(F.col("length")).alias("length"))
    mean = (F.col("sum") + F.col("score")) / F.col("length")
    rank = F.row_number().over(Window.partitionBy("tree_key").orderBy(F.col("mean").desc(), "leaf"))
    ranked = at.join(scores, ["tree_key", "node"]).withColumn("mean", mean).withColumn("rank", rank)
    return stored(ranked.filter(F.col("rank") <= branches).select("tree_key", "leaf", "rank"), "leaves")


def path_nodes(jumps: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """Rows ``(tree_key, leaf, rank, node, distance)``: every message from the given leaves to their roots; only ids are shuffled."""
    paths = leaves.withColumns({"node": F.col("leaf"), "distance": F.lit(0).cast("long")})
    for power in reversed(range(len(jumps) - 1)):
        higher = (paths.join(jumps[power], ["tree_key", "node"])
                  .select("tree_key", "leaf", "rank", F.col("up").alias("node"), (F.col("distance") + 2 ** power).alias("distance")))
        paths = stored(paths.unionByName(higher.select(paths.columns)), "paths")
    return paths


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best paths of each tree: ``(tree, rank, turns)``, root first.

    ``turns`` is an array of ``(role, text)``.  Ties between branches go to the smaller leaf.
    """
    jumps = jump_tables(messages)
    members = path_nodes(jumps, best_leaves(messages, jumps, branches)).join(messages, ["tree_key", "node"])
    turn = F.struct((-F.col("distance")).alias("at"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = members.groupBy("tree_key", "leaf", "rank").agg(F.first("tree").alias("tree"), F.array_sort(F.collect_list(turn)).alias("turns"))
    return gathered.select("tree", "rank", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"))


def formatted(paths: DataFrame) -> DataFrame:
    """Add ``formatted`` and ``loss_mask``, the spans ``(start, length)`` of trained text in code points."""
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == TRAINED_ROLE).alias("trained")))

    def spans(parts: Column) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

        def step(acc: Column, p: Column) -> Column:
            start = acc["at"] + F.length(p["head"])
            size = F.length(p["body"]).cast("long")
            span = F.struct(start.alias("start"), size.alias("length"))
            return F.struct((start + size + len(END)).alias("at"),
                            F.when(p["trained"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))
        return F.aggregate(parts, state, step, lambda acc: acc["spans"])

    return (paths.withColumn("_parts", pieces)
            .withColumn("formatted", F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
            .withColumn("loss_mask", spans(F.col("_parts"))).drop("_parts", "turns"))


def read_turns(text: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation."""
    def turn(segment: Column) -> Column:
        body = F.substring(segment, len(START) + 1, 1 << 30)
        return let(F.instr(body, "\n"), lambda cut: F.struct(
            unescape_role(F.substr(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substr(body, cut + 1)).alias("text")))
    segments = F.split(text, r"<\|im_end\|>\n")
    return let(segments, lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), turn))


def trained_text(text: Column, mask: Column) -> Column:
    """What the loss mask covers, unescaped and joined."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substr(text, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
