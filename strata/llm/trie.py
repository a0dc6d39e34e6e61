"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct opening of rebuilt conversations, named by its least
member and its depth.  Openings are compared by 128 bits: the exclusive or,
over an opening's turns, of two 64-bit hashes of place and turn.  Rows are put
in order by range, so that a conversation of any length is cut over many
tasks, and running values of a part are set off by those of the parts before.

Roll-up: every node starts in one component, the trie.  A component's centroid
is its deepest node that still holds half of the component's mass (the turns
of all conversations at or below a node, which need no roll-up themselves).
The nodes that hold half are just those from the centroid up to the top.  Taking
the centroid out leaves its children's components and the rest above, each of
at most half the mass, so log2(all turns) rounds end it, however deep or wide
the trie is.  A centroid's total, of its part of the component, is added to
every node from it to the component's top; each pair of a node and one below
it meets exactly once that way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Store, pick

FAMILY, MOST_HEAD = 100, 6
CHUNK = 1 << 16  # conversation ids in one piece of text to hash

_NODE = ["conv_id", "depth"]


def _slice_of(mid: Column) -> Column:
    return F.shiftright(mid, 33)


def _offsets(stored: DataFrame, total: Column, running) -> DataFrame:
    """Of each conversation in each part: the first row, and the running value of the parts before."""
    parts = stored.groupBy("conv_id", _slice_of(F.col("mid")).alias("slice")).agg(F.min("mid").alias("first"), *total)
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("conv_id", "slice", "first", *[F.coalesce(f.over(before), F.lit(0)).alias(name) for name, f in running.items()])


def numbered_turns(conversations: DataFrame, store: Store) -> DataFrame:
    """conv_id, i (from 1, by turn with nulls first, role, text), two hashes of the turn and its text's code points."""
    filled = lambda c: F.coalesce(c, F.lit(""))
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", filled("role").alias("role"), filled("text").alias("text"))
    order = "conv_id", F.asc_nulls_first("turn"), "role", "text"
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    word = lambda at: F.conv(F.substring(content, at, 15), 16, 10).cast("long")
    light = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", word(1).alias("a"), word(16).alias("b"), F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("mid"))
    stored = store.put(light, "turns")
    base = _offsets(stored, [F.count("*").alias("n")], {"base": F.sum("n")})
    at = stored.withColumn("slice", _slice_of(F.col("mid"))).join(base, ["conv_id", "slice"])
    return at.select("conv_id", (F.col("base") + F.col("mid") - F.col("first") + 1).alias("i"), "a", "b", "chars")


def rebuilt_turns(conversations: DataFrame, store: Store) -> DataFrame:
    """conv_id, depth, two hashes of place and turn, chars and the rebuilt length; each conversation has a row of depth 0 besides its turns.

    Conversation c takes the first h turns of conversation c - c % 100, then
    its own after its first h, where h is crc32 of c's digits modulo 6."""
    turns = store.put(numbered_turns(conversations, store), "numbered")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD).alias("h")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", h, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"))
    heads = own.select(F.col("conv_id").alias("head"), F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = own.join(heads, "head", "left").select("conv_id", "head", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    convs = store.put(convs, "conversations")
    kept = turns.join(convs, "conv_id").where("i > h").select("conv_id", (F.col("taken") + F.col("i") - F.col("h")).alias("depth"), "a", "b", "chars", "length")
    # a head's five first turns go to at most 199 conversations
    openings = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("i") < MOST_HEAD)).withColumnRenamed("conv_id", "head")
    lent = openings.join(convs, "head").where("i <= taken").select("conv_id", F.col("i").alias("depth"), "a", "b", "chars", "length")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("chars"), "length")
    rows = kept.unionByName(lent).select("conv_id", "depth", F.xxhash64("depth", "a", "b").alias("a"), F.xxhash64("b", "depth", "a", F.lit(1)).alias("b"), "chars", "length")
    return rows.unionByName(roots)


def openings(turns: DataFrame, store: Store) -> DataFrame:
    """conv_id, depth, (a, b) of the whole opening, chars, length."""
    ranged = turns.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth").withColumn("mid", F.monotonically_increasing_id())
    stored = store.put(ranged.mapInArrow(_running, ranged.schema), "ranged")
    # within a part the last row of a conversation has the whole of it
    last = [F.max_by(c, "mid").alias(c) for c in "ab"]
    base = _offsets(stored, last, {"base_a": F.bit_xor("a"), "base_b": F.bit_xor("b")})
    at = stored.withColumn("slice", _slice_of(F.col("mid"))).join(base, ["conv_id", "slice"])
    return at.select("conv_id", "depth", *[F.col(c).bitwiseXOR(F.col(f"base_{c}")).alias(c) for c in "ab"], "chars", "length")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces a and b by their running exclusive or in each conversation, from batch to batch."""
    conv, carried = None, {"a": 0, "b": 0}
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch["conv_id"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        lengths = np.diff(np.append(starts, len(ids)))
        for c in "ab":
            run = np.bitwise_xor.accumulate(batch[c].to_numpy())
            base = np.concatenate(([0], run))[starts]
            if ids[0] == conv:
                base[0] ^= carried[c]
            run = run ^ np.repeat(base, lengths)
            carried[c] = int(run[-1])
            batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(run))
        conv = ids[-1]
        yield batch


def prefix_nodes(conversations: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """The nodes (conv_id, depth, parent, n_convs, chars, mass), and every conversation's nodes (member, depth, conv_id, ended)."""
    opened = store.put(openings(rebuilt_turns(conversations, store), store), "openings")
    key = ["depth", "a", "b"]
    nodes = opened.groupBy(*key).agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.sum(F.col("length") - F.col("depth") + 1).alias("mass"))
    nodes = store.put(nodes, "named")
    paths = opened.join(nodes.select(*key, "node"), key).select(F.col("conv_id").alias("member"), "depth", F.col("node").alias("conv_id"), (F.col("depth") == F.col("length")).alias("ended"))
    paths = store.put(paths, "paths")
    up = paths.where("conv_id = member or not ended").select(F.col("member").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent"))
    named = nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "chars", "mass")
    return store.put(named.join(up, _NODE, "left"), "nodes"), paths


def roll_up(nodes: DataFrame, paths: DataFrame, values: list[str], store: Store) -> DataFrame:
    """conv_id, depth and, of each of ``values``, the sum over the node's subtree.

    ``nodes``: conv_id, depth, mass and the values; ``paths``: member, depth,
    conv_id, as from ``prefix_nodes``.  See the module's text."""
    # from this depth on a node's conversation is its own least member, so its path needs no looking up
    alone = nodes.groupBy("conv_id").agg(F.min("depth").alias("alone"))
    own = paths.join(alone.withColumnRenamed("conv_id", "member"), "member").where("depth < alone")
    above = own.select("member", "depth", F.col("conv_id").alias("here"), "alone")
    following = own.select("member", (F.col("depth") - 1).alias("depth"), F.col("conv_id").alias("next"))
    above = above.join(following, ["member", "depth"], "left").select(F.col("member").alias("conv_id"), F.col("depth").alias("c_depth"), "here", F.coalesce("next", "conv_id").alias("next"))
    above = store.put(above, "above")
    top = ["top", "top_depth"]
    left = nodes.select(*_NODE, "mass", *values)
    root = left.where("depth = 0").first()
    left = left.select("*", F.lit(root and root.conv_id).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"))
    rounds = []
    while not left.isEmpty():
        whole = left.where("conv_id = top and depth = top_depth").select(*top, F.col("mass").alias("whole"))
        half = left.join(whole, top).where("2 * mass >= whole")
        centre = half.groupBy(*top, "whole").agg(F.min(F.struct("mass", "depth", "conv_id")).alias("c"))
        centre = store.put(centre.select(*top, "whole", F.col("c.conv_id").alias("centre"), F.col("c.depth").alias("c_depth"), F.col("c.mass").alias("c_mass")), "centres")
        met = left.join(centre, top).join(above, ["conv_id", "c_depth"], "left")
        is_centre = (F.col("conv_id") == F.col("centre")) & (F.col("depth") == F.col("c_depth"))
        below = (F.col("depth") > F.col("c_depth")) & (F.coalesce("here", "conv_id") == F.col("centre"))
        on_path = 2 * F.col("mass") >= F.col("whole")
        met = met.select(
            *_NODE, *values, F.lit(len(rounds)).alias("round"), "centre", "c_depth", is_centre.alias("is_centre"), below.alias("below"), on_path.alias("on_path"),
            (F.col("mass") - F.when(on_path, F.col("c_mass")).otherwise(0)).alias("mass"),
            F.when(below, F.coalesce("next", "conv_id")).otherwise(F.col("top")).alias("top"),
            F.when(below, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        )
        rounds.append(store.put(met, "round"))
        left = rounds[-1].where("not is_centre").select(*_NODE, "mass", *values, *top)
    part = ["round", "centre", "c_depth"]
    if not rounds:
        return nodes.select(*_NODE, *values)
    met = rounds[0].sparkSession.read.schema(rounds[0].schema).parquet(*[f for r in rounds for f in _folders(r)])
    totals = met.where("below or is_centre").groupBy(*part).agg(*[F.sum(v).alias(v) for v in values])
    return met.where("on_path").select(*_NODE, *part).join(totals, part).groupBy(*_NODE).agg(*[F.sum(v).alias(v) for v in values])


def _folders(df: DataFrame) -> list[str]:
    return sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})


def ended_hashes(paths: DataFrame) -> DataFrame:
    """conv_id, depth and the SHA-256 of the ids that end there, ascending, joined by commas.

    Ids are sorted by range, so a node where very many end is written out by
    many tasks, in pieces of ``CHUNK`` ids; one task then hashes the pieces."""
    rows = paths.where("ended").select(*_NODE, "member").repartitionByRange(*_NODE, "member").sortWithinPartitions(*_NODE, "member")
    pieces = rows.mapInArrow(_join_ids, "conv_id long, depth long, first long, ids string")
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_hash_pieces, "conv_id long, depth long, ends_sha256 string")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, depth, member = (batch[c].to_numpy() for c in (*_NODE, "member"))
        cut = np.flatnonzero((conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) + 1
        edge = [0, *cut.tolist(), len(conv)] if len(conv) else []
        at = [(a, min(a + CHUNK, hi)) for lo, hi in zip(edge, edge[1:]) for a in range(lo, hi, CHUNK)]
        digits = member.astype(str).tolist()
        cols = [conv[[a for a, _ in at]], depth[[a for a, _ in at]], member[[a for a, _ in at]], [",".join(digits[a:b]) for a, b in at]] if at else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[*_NODE, "first", "ids"])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        out = []
        for conv, depth, ids in zip(*(batch[c].to_pylist() for c in (*_NODE, "ids"))):
            if (conv, depth) == node:
                digest.update(b",")
            else:
                out += [(*node, digest.hexdigest())] if node else []
                node, digest = (conv, depth), hashlib.sha256()
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)
    if node:
        yield pa.RecordBatch.from_pylist([{"conv_id": node[0], "depth": node[1], "ends_sha256": digest.hexdigest()}], schema)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns count by turn (nulls first), then role, then text; null roles and
    texts are empty; rows that repeat a turn are turns of their own.  Rows with
    a null conv_id are no conversation's and stay out.  Other columns are
    ignored; an empty table gives no rows, not even the root."""
    store = Store(conversations.sparkSession, "trie")
    nodes, paths = prefix_nodes(conversations, store)
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    full = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    full = store.put(full.select("*", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "weighed")
    rolled = roll_up(full, paths, ["n_leaves", "saved_tokens"], store)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = full.drop("n_leaves", "saved_tokens").join(rolled, _NODE).join(ended_hashes(paths), _NODE, "left")
    return out.select(*_NODE, F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
