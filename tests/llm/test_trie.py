"""The prefix trie against a dictionary of tuples, on awkward, random, deep and wide conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from strata.llm import catalog, common, trie

SF = "/root/testdata/sf0.001"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    members, ends, below = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        built = tuple(own.get(head, [])[:h] + own[c][h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
            below[built[:d]].update(built[:e] for e in range(d, len(built) + 1))
        ends[built].append(c)
    children = defaultdict(int)
    for x in members:
        if x:
            children[x[:-1]] += 1
    out = {}
    for x, m in members.items():
        saved = sum((len(members[y]) - 1) * len(y[-1][1].decode()) for y in below[x] if y)
        digest = hashlib.sha256(",".join(map(str, ends[x])).encode()).hexdigest()
        out[m[0], len(x)] = (members[x[:-1]][0] if x else None, len(m), children[x], sum(not children[y] for y in below[x]), saved, digest)
    return out


def check(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie.prefix_trie(frame).collect()
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in got} == brute(rows)
    assert len(got) == len({(r.conv_id, r.depth) for r in got})


def test_all_kinds_at_once(spark):
    """Random ones that share openings, a deep one, copies that part at their ends, thousands of copies, and awkward rows; pieces of few ids."""
    rng = random.Random(1)
    rows = [(c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "日本"])) for c in range(-150, 450) for t in range(rng.randrange(1, 9)) if c % 7]
    rows += [(1005, t, "user", f"t{t}") for t in range(150)]
    rows += [(2000 + c, t, "user", f"s{t}" if t < 12 else f"{c}{t}") for c in range(40) for t in range(14)]
    rows += [(10_000 + c, t, "user", f"{t}") for c in range(2000) for t in range(2)]
    rows += [(None, 1, "user", "x"), (7, None, None, None), (7, None, None, None), (2**62, 1, "u", "é"), (-300, 2, "", ""), (9100, 1, "u", "x" * 2_000_000), (9107, 1, "u", "y")]
    chunk, trie.CHUNK = trie.CHUNK, 64
    try:
        check(spark, rows)
    finally:
        trie.CHUNK = chunk


def test_extra_columns_and_empty(spark):
    frame = spark.createDataFrame([(1, 1, "user", "a", "q")], "conv_id long, turn long, role string, text string, TEXT string")
    assert trie.prefix_trie(frame).count() == len(brute([(1, 1, "user", "a")]))
    assert trie.prefix_trie(frame.where("1 = 0")).count() == 0


def test_roll_up_sums_any_value(spark):
    """Subtree sizes by the roll-up alone; rounds stay logarithmic on a path."""
    store = common.Store(spark, "test")
    rows = spark.range(100).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    nodes, paths = trie.prefix_nodes(rows, store)
    found = trie.roll_up(nodes.withColumn("one", F.lit(1).cast("long")), paths, ["one"], store)
    assert {(r.depth, r.one) for r in found.collect()} == {(d, 101 - d) for d in range(101)}


def test_query(spark):
    rows = [tuple(r) for r in common.table(SF, "conversations", spark).select("conv_id", "turn", "role", "text").collect()]
    got = catalog.QUERIES["op13_trie"](spark, SF).collect()
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in got} == brute(rows)
