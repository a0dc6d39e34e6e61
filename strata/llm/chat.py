"""Reply trees to conversations, with DataFrame functions only.

A tree's nodes name their parent.  Self-joins of pointer doubling list, for
every leaf, all its ancestors: with jumps of 1, 2, 4, ... turns a tree of depth
d takes log2(d) joins.  The joins carry keys and scores alone; texts come in
once, when the chosen paths are formatted.

Template: a turn the model learns is ``<s>role\\ntext</s>``, any other
``[INST]role\\ntext[/INST]``.  Inside roles and texts every control string gets
a backslash after its first character (``<\\s>``, ``[\\INST]``), also when it
has some already, so that escaping can be undone and no text can end its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Store, pick

_TURN = r"(?s)(<s>|\[INST\])(.*?)(</s>|\[/INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1"), r"\[(\\*/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"<\\(\\*/?s>)", r"<$1"), r"\[\\(\\*/?INST\])", r"[$1")


def _escape_role(role: Column) -> Column:
    """Roles hold no line break, which ends them in the template."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def root_to_leaf(nodes: DataFrame, store: Store) -> DataFrame:
    """(tree, leaf, node, up) for every leaf and each node on its path, ``up`` turns above it.

    ``nodes``: tree, node, parent (null or unknown: a root).  Iterative: each
    round doubles the length of all paths by one self-join on the jumps, and
    the jumps by another; it ends when no path can grow.  A node on a cycle of
    replies, or its own parent, counts as a root: jumps longer than the largest
    tree lead onto cycles only, whose nodes then lose their parents."""
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    known = nodes.select("tree", F.col("node").alias("parent"))
    jump = store.put(nodes.join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("to")), "jumps")
    leaves = nodes.select("tree", "node").join(jump.select("tree", F.col("to").alias("node")), ["tree", "node"], "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up"))
    step = 1
    while not jump.isEmpty():
        above = paths.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        paths = store.put(paths.union(above), "paths")
        again = jump.select("tree", F.col("to").alias("node"), F.col("node").alias("from")).join(jump, ["tree", "node"])
        jump = store.put(again.select("tree", F.col("from").alias("node"), "to"), "jumps")
        step *= 2
        if step > largest and not jump.isEmpty():
            circular = jump.select("tree", F.col("to").alias("node")).distinct().withColumn("circular", F.lit(True))
            cut = nodes.join(circular, ["tree", "node"], "left")
            return root_to_leaf(store.put(cut.select("tree", "node", F.when(F.col("circular").isNull(), F.col("parent")).alias("parent")), "cut"), store)
    return paths


def format_trees(messages: DataFrame, top: int | None = None, trained: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, leaf, rank, formatted and the loss spans.

    ``messages``: tree, node (unique in its tree), parent, role, text, score.  A
    path's score is the sum of its nodes' (null: 0); paths rank by falling
    score, then by leaf; ``top`` paths a tree are kept (None: all).  Null roles
    and texts count as empty.  Spans are code-point offsets and lengths of the
    ``trained`` role's texts in ``formatted``.  Empty input gives no rows; a
    null tree is a tree like others; a row with a null node belongs to no path;
    nodes on cycles of replies are roots."""
    store = Store(messages.sparkSession, "chat")
    # inside a struct nulls equal each other, so a null tree joins like any
    rows = messages.where("node is not null").withColumn("tree", F.struct("tree"))
    light = store.put(rows.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    paths = root_to_leaf(light, store).join(light.select("tree", "node", "score"), ["tree", "node"])
    scored = paths.groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    chosen = paths.join(ranked.select("tree", "leaf", "rank"), ["tree", "leaf"]).select("tree", "leaf", "rank", "node", "up")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    learnt = role == trained
    turn = F.struct(
        (-F.col("up")).alias("at"),
        F.concat(F.when(learnt, "<s>").otherwise("[INST]"), _escape_role(role), F.lit("\n")).alias("head"),
        escape(text).alias("body"),
        F.when(learnt, "</s>").otherwise("[/INST]").alias("tail"),
        learnt.alias("learnt"),
    )
    turns = chosen.join(rows.select("tree", "node", "role", "text"), ["tree", "node"])
    out = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    sizes = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + F.length(t["tail"]))
    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(sizes, zero, lambda a, n: F.struct((a["end"] + n).alias("end"), F.concat(a["starts"], F.array(a["end"])).alias("starts")))["starts"]
    spans = F.transform(F.arrays_zip("turns", starts.alias("start")), lambda z: F.struct((z["start"] + F.length(z["turns"]["head"])).alias("start"), F.length(z["turns"]["body"]).alias("length"), z["turns"]["learnt"].alias("learnt")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], t["tail"])), "")
    spans = F.transform(F.filter(spans, lambda s: s["learnt"]), lambda s: F.struct(s["start"], s["length"]))
    return out.select("tree.tree", "leaf", "rank", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    return F.transform(bodies, lambda b: F.struct(_unescape_role(F.substring_index(b, "\n", 1)).alias("role"), unescape(F.substring(b, F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b))).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def conversation_chains(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` rows as trees of one branch: each row answers the one before it (order: turn, role, text, nulls first).

    A null conv_id is a conversation of its own; repeated rows are turns each;
    other columns are ignored; an empty table gives no rows."""
    rows = pick(conversations, tree="conv_id", turn="turn", role="role", text="text")
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.select("tree", F.row_number().over(order).cast("long").alias("node"), "role", "text", F.lit(0.0).alias("score")).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
