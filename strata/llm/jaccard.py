"""Near-duplicate join on n-gram sets by universe partition and the pigeonhole principle, verified exactly.

Sets fall into size bands.  For each band the universe of shingles is cut into
segments by a hash, and a budget of differences that no linked pair of that
band can exceed is set against them: every segment is allotted one unit (its
part of the set is indexed) or two (so are all subsets with one shingle less),
and a pair whose differences are fewer than the units must agree on an indexed
part of some segment.  The allotment is the cheapest by an estimate of rows
and chance agreements.

The units beyond a set's own most differences are its to give up: empty parts
are never indexed, and of the others each set gives up those that the most sets
share, down to what it can afford.  A linked pair still meets: the one that
stops at the rarer parts has an agreed part among those it keeps, and the other
keeps all parts as rare as that.  So a set whose shared parts are all
affordable has no partner, and passages that very many documents hold cost
nothing.

Buckets are not expanded into pairs.  Round by round each set is compared with
one other of its buckets that is not yet in its component, most shared buckets
first; once most of a round's comparisons fail, all that is left is compared.

Before sets are compared, their parity sketches are: each shingle flips one of
512 bits, so two sketches differ in no more bits than the sets do in shingles,
and a pair whose sketches differ in more than a linked pair's sets can is none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import hashing
from strata.llm.common import Store, forget_words, map_batches, pick

PERCENT = 80
SHINGLE = 5
GROWTH = 1.6  # a band's largest size over its smallest
MOST = 100_000  # sets of a bucket held at once; larger ones all count as this large
BLOCK = 32_768  # bits of one of Spark's bitmaps
WORDS = 8  # 64-bit words of a sketch
_SKETCH = [f"w{i}" for i in range(WORDS)]
_KNOWN = ["size", *_SKETCH]

_U = np.uint64
_ENTRY = "sig long, node long, room int, doc long, size int"


def band_edges(size: int, percent: int = PERCENT, growth: float = GROWTH) -> tuple[int, int, int]:
    """Band number, smallest and largest size of the band that holds ``size``."""
    k, low = 0, 1
    while True:
        high = max(low, int(low * growth))
        if size <= high:
            return k, low, high
        k, low = k + 1, high + 1


@lru_cache(maxsize=None)
def allot(low: int, high: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """Segments, how many of them get two units, and the most differences, for pairs whose smaller set is in the band.

    |x ^ y| = (|x| + |y|)(1 - J) / (1 + J), largest for the band's largest set
    and a partner as much larger as the similarity allows."""
    most = high * 100 // percent
    differ = (high + most) * (100 - percent) // (100 + percent)
    if not differ:
        return 1, 0, 0
    spare = 1 + differ // 12  # units to give up on common and empty parts
    mean, best = (low + high) / 2, None
    for double in range(0, (differ + spare) // 2 + 2):
        m = differ + 1 + spare - double
        if m < max(1, double):
            break
        part = mean / m
        rows = m + double * part
        chance = m * 2.0 ** -min(60.0, 4 * part) + double * part * 2.0 ** -min(60.0, 4 * max(0.0, part - 1))
        cost = rows + 8 * chance
        if best is None or cost < best[0]:
            best = cost, m, double
    return best[1], best[2], differ


def entries(shingles: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, int]]:
    """(signatures, room) of a set, in its own band's segments and, where a smaller partner can be in the band below, in those.

    ``room`` is how many units may be given up; the lowest bits of a signature
    tell the parity of the segments' band (2), which differs between the two,
    and whether its segment has two units (1)."""
    size = len(shingles)
    band, low, high = band_edges(size, percent)
    at = [(0, band, low, high)]
    if low > 1 and ceil(size * percent / 100) < low:
        below = band_edges(low - 1, percent)
        at.append((1, *below))
    for instance, k, lo, hi in at:
        m, double, _ = allot(lo, hi, percent)
        segment = (hashing.mix(shingles, 11) % _U(m)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        token, segment = hashing.mix(shingles[order], 13), segment[order]
        start = np.flatnonzero(np.diff(segment, prepend=-1))
        n = np.diff(start, append=size)
        used = segment[start]
        total = np.add.reduceat(token, start)
        salt = hashing.mix(np.array([k], _U), 17)
        named = hashing.mix((used + 1).astype(_U) * salt, 19)
        two = used < double
        out = [_tag(hashing.mix(total, 23) ^ named, k, two)]
        lost = (m - len(used)) + (double - int(two.sum()))  # empty parts: all their units
        if two.any():
            group = np.repeat(np.arange(len(start)), n)
            pick_ = two[group] & (n[group] > 1)  # less one of a single shingle is empty
            left = total[group[pick_]] - token[pick_]
            out.append(_tag(hashing.mix(left, 23) ^ named[group[pick_]], k, np.ones(int(pick_.sum()), bool)))
            lost += int((two & (n == 1)).sum())
        largest = size * 100 // percent if not instance else low - 1  # of the partners
        room = m + double - (size + largest) * (100 - percent) // (100 + percent) - 1 - lost
        if room < 0:  # too many empty parts: index these too, for sets in the same case
            empty = np.setdiff1d(np.arange(m), used)
            bare = np.concatenate([empty, used[two & (n == 1)]])
            out.append(_tag(hashing.mix((bare + 1).astype(_U) * salt, 29), k, bare < double))
        yield np.unique(np.concatenate(out)), room


def _tag(sig: np.ndarray, band: int, two: np.ndarray) -> np.ndarray:
    return (sig << _U(2)) | _U(2 * (band & 1)) | two.astype(_U)


def set_id(shingles: np.ndarray) -> int:
    """Names a set by its content: equal sets are one node."""
    whole = hashing.mix(np.add.reduce(hashing.mix(shingles, 31), keepdims=True) + _U(len(shingles)), 37)
    return int(whole.view(np.int64)[0])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles dealt to each bit."""
    odd = np.bincount((hashing.mix(shingles, 41) % _U(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _may_link(x: Callable[[str], Column], y: Callable[[str], Column], percent: int) -> Column:
    """False for pairs that cannot link, by their sizes and sketches."""
    sizes = 100 * F.least(x("size"), y("size")) >= percent * F.greatest(x("size"), y("size"))
    apart = sum((F.bit_count(x(w).bitwiseXOR(y(w))) for w in _SKETCH[1:]), F.bit_count(x(_SKETCH[0]).bitwiseXOR(y(_SKETCH[0]))))
    return sizes & (apart * (100 + percent) <= (x("size") + y("size")) * (100 - percent))


def _index(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Signature rows (sig, node, room) and, with a null sig, one row per document (doc, node, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        seen: set[int] = set()  # of this task: a copy need not be indexed again

        def batch(sig, node, room, docs_):
            d = np.array(docs_, dtype=object).reshape(-1, 3)
            sig, node, room = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sig, node, room))
            k, m = len(sig), len(docs_)
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(sig.astype(np.int64)), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.array(node.astype(np.int64)), pa.array(d[:, 1].tolist(), pa.int64())]),
                    pa.concat_arrays([pa.array(room.astype(np.int32)), pa.nulls(m, pa.int32())]),
                    pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(d[:, 0].tolist(), pa.int64())]),
                    pa.concat_arrays([pa.nulls(k, pa.int32()), pa.array(d[:, 2].tolist(), pa.int32())]),
                ],
                names=[x.split()[0] for x in _ENTRY.split(", ")],
            )

        for b in batches:
            sig, node, room, docs_, held = [], [], [], [], 0
            for doc, text in zip(b["doc"].to_pylist(), b["text"]):
                s = hashing.shingles(text.as_py(), size)
                name = set_id(s) if len(s) else None
                docs_.append((doc, name, len(s)))
                if name is None or name in seen or doc is None:
                    continue
                if len(seen) < 200_000:
                    seen.add(name)
                for sigs, spare in entries(s, percent):
                    sig.append(sigs.view(np.int64)), node.append(np.full(len(sigs), name)), room.append(np.full(len(sigs), spare))
                    held += len(sigs)
                if held > 500_000:
                    yield batch(sig, node, room, docs_)
                    sig, node, room, docs_, held = [], [], [], [], 0
            if docs_:
                yield batch(sig, node, room, docs_)

    return docs.mapInArrow(run, _ENTRY)


def _shared(entry: DataFrame, parts: int | None) -> DataFrame:
    """Of the sorted signatures, those of at least two nodes: (sig, node, room, n), ``n`` the bucket's size; rows of documents pass through.

    Streams, holding one bucket at a time and of that ``MOST`` rows at most."""
    dealt = F.coalesce("sig", F.xxhash64("doc", "node"))
    args = ([parts] if parts else []) + [dealt]
    ordered = entry.repartition(*args).sortWithinPartitions("sig", "node")

    def rows(s, n, r, size):
        k = len(s)
        return pa.RecordBatch.from_arrays([pa.array(s), pa.array(n), pa.array(r), pa.array(size, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32())], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)  # the last bucket so far
        huge = None  # a bucket that has sent rows already
        for b in batches:
            docs_ = b.filter(b["sig"].is_null())
            if docs_.num_rows:
                k = docs_.num_rows
                yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), docs_["node"], pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), docs_["doc"], docs_["size"]], names=_NAMES)
            b = b.filter(b["sig"].is_valid())
            if not b.num_rows:
                continue
            s, n, r = (np.append(h, b[c].to_numpy()) for h, c in zip(held, ("sig", "node", "room")))
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1])
            s, n, r = s[new], n[new], r[new]
            if huge is not None:
                more = s == huge
                if more.any():
                    yield rows(s[more], n[more], r[more], np.full(int(more.sum()), MOST))
                    s, n, r = s[~more], n[~more], r[~more]
                if not len(s):
                    held = s, n, r
                    continue
                huge = None
            start = np.flatnonzero(np.diff(s, prepend=s[0] - 1))
            size = np.repeat(np.diff(start, append=len(s)), np.diff(start, append=len(s)))
            done = (np.arange(len(s)) < start[-1]) & (size > 1)
            if done.any():
                yield rows(s[done], n[done], r[done], size[done])
            held = s[start[-1] :], n[start[-1] :], r[start[-1] :]
            if len(held[0]) >= MOST:
                yield rows(*held, np.full(len(held[0]), MOST))
                huge, held = held[0][0], tuple(x[:0] for x in held)
        if len(held[0]) > 1:
            yield rows(*held, np.full(len(held[0]), len(held[0])))

    return ordered.mapInArrow(run, _SHARED)


_SHARED = "sig long, node long, room int, n int, doc long, size int"
_NAMES = [x.split()[0] for x in _SHARED.split(", ")]


def _affordable(rows: DataFrame, store: Store) -> DataFrame:
    """Bucket rows (sig, node) without those that their set can give up, the most shared first."""
    own = Window.partitionBy("node", F.col("sig").bitwiseAND(2)).orderBy(F.desc("n")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    given = F.sum(1 + F.col("sig").bitwiseAND(1)).over(own)
    return store.put(rows.withColumn("given", given).where("given > room").select("sig", "node"), "kept")


def _marked(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents of ``chosen`` and about one in 16 of the others.

    ``chosen`` marks a bit for each of its ids, in a map of 16 bits an id, so
    that the texts of most others are not shuffled to find out."""
    bits = BLOCK * max(1, ceil(16 * chosen.count() / BLOCK))
    bit = F.pmod(F.xxhash64("doc"), F.lit(bits)) + 1
    at, block = F.bitmap_bit_position(bit), F.bitmap_bucket_number(bit)
    marks = chosen.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(at).alias("marks"))
    near = docs.withColumns({"block": block, "at": at}).join(F.broadcast(marks), "block")
    byte = F.expr("cast(conv(hex(substring(marks, cast(at div 8 as int) + 1, 1)), 16, 10) as int)")
    return near.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(at % 8 as int))")) != 0).select(*docs.columns)


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame, store: Store, size: int) -> DataFrame:
    """(node, set, size, sketch words) of the given nodes: sorted shingle hashes, read off one document of each."""
    chosen = members.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc").alias("doc"))
    chosen = store.put(chosen, "chosen")

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for node, text in zip(b["node"].to_pylist(), b["text"]):
            s = hashing.shingles(text.as_py(), size)
            if len(s) and set_id(s) == node:  # not another row of that id
                found.append((node, s.tobytes(), len(s), sketch(s)))
        if found:
            node, sets, count, bits = zip(*found)
            words = [pa.array(w) for w in np.array(bits).T]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(sets, pa.binary()), pa.array(count, pa.int64()), *words], names=["node", "set", "size", *_SKETCH])

    read = _marked(docs, chosen).join(chosen, "doc").select("node", "text")
    out = store.put(map_batches(read, run, ", ".join(["node long, set binary, size long", *(f"{w} long" for w in _SKETCH)])), "sets")
    store.release()
    store.drop(chosen)
    return out


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v, a, b, linked) of pairs of nodes a, b with roots u, v, by their whole sets."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        linked = []
        for x, y in zip(b["x"], b["y"]):
            p, q = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
            same = len(np.intersect1d(p, q, assume_unique=True))
            linked.append(100 * same >= percent * (len(p) + len(q) - same))
        return pa.RecordBatch.from_arrays([b["u"], b["v"], b["a"], b["b"], pa.array(linked)], names=["u", "v", "a", "b", "linked"])

    return map_batches(both.select("u", "v", "a", "b", "x", "y"), run, "u long, v long, a long, b long, linked boolean")


def components(edges: DataFrame, store: Store) -> DataFrame:
    """(node, root) for every node of an edge, ``root`` the least node it is connected with.

    Alternates two steps until nothing changes: each node hangs its larger
    neighbours, then its smaller ones, under the least of them."""
    edges = store.put(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = _digest(edges)
    while True:
        after = store.put(_star_step(edges), "edges")
        store.drop(edges)
        edges, now = after, _digest(after)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _star_step(edges: DataFrame) -> DataFrame:
    """Both steps once, on edges with ``u > v``: the same components in flatter trees."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    below = large.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return large.join(below, "u").select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u <> v").distinct()


def _labels(edges: DataFrame) -> DataFrame:
    """(node, root): a lesser node of the same component, two hops down.  Equal roots are connected; the converse need not hold yet."""
    down = edges.groupBy("u").agg(F.min("v").alias("v"))
    next_ = down.select(F.col("u").alias("v"), F.col("v").alias("w"))
    return down.join(next_, "v", "left").select(F.col("u").alias("node"), F.coalesce("w", "v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the least doc_id reachable by links.

    Two documents link when ``100 * |x & y| >= percent * |x | y|`` for their
    sets of ``size``-word shingles (A-Z lower-cased).  A text with fewer words
    has one shingle, its whole sequence; null and empty texts have none and
    link with nothing.  Equal sets are compared once.  Rows that repeat an id
    count as one document if any of them links; a null id keeps a null component and takes no
    part; an empty table gives no rows; other columns are ignored."""
    store = Store(docs.sparkSession, "jaccard")
    docs = pick(docs, doc="doc_id", text="text").withColumn("doc", F.col("doc").cast("long"))
    entry = _shared(_index(docs, percent, size), None)
    kinds = store.put(entry.withColumn("kind", F.when(F.col("sig").isNull(), "doc").otherwise("entry")), "index", ["kind"])
    store.release()
    rows = kinds.where("kind = 'entry'").select("sig", "node", "room", "n")
    members = kinds.where("kind = 'doc'").select("doc", "node", "size")
    buckets = _affordable(rows, store)
    root = _link(docs, buckets, members.where("doc is not null and node is not null"), store, percent, size)
    named = members.join(root, "node", "left").withColumn("class", F.when(F.col("doc").isNotNull(), F.coalesce("root", "node")))
    least = named.where("class is not null").groupBy("class").agg(F.min("doc").alias("least"))
    out = named.join(least, "class", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), F.coalesce("least", "doc").alias("component_id"))


def _open_buckets(buckets: DataFrame, store: Store) -> DataFrame:
    """Bucket rows (sig, node, times, hub); of buckets with the same members one stands for all (``times``).

    ``hub`` is how many bucket neighbours a node has in all."""
    kinds = buckets.groupBy("sig").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("n > 1")
    chosen = kinds.groupBy("n", "x", "y").agg(F.min("sig").alias("sig"), F.count("*").alias("times"))
    rows = buckets.join(chosen.select("sig", "n", "times"), "sig")
    return store.put(rows.withColumn("hub", F.sum(F.col("times") * F.col("n")).over(Window.partitionBy("node"))).drop("n"), "open")


def _led_pairs(labelled: DataFrame, sketches: DataFrame, tried: DataFrame, step: int, percent: int, store: Store) -> DataFrame:
    """(u, v, a, b): each node with the lead it shares most buckets with, of those of other components that it may link with and was not compared with."""
    draw = F.struct(F.lit(0) if step % 2 else -F.col("hub"), F.xxhash64("node", F.lit(step)))
    spread = labelled.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min_by(F.struct("node", "root"), draw).alias("lead")).where("r0 < r1")
    # written, so that a hot bucket's rows are a shuffled side of their own in the join, which Spark splits
    spread = store.put(spread.select("sig", "lead"), "spread")
    met = labelled.join(spread, "sig").where("root <> lead.root")
    near = met.groupBy("node", "root", "lead").agg(F.sum("times").alias("n"))
    near = near.select("node", "n", F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"), F.greatest("root", "lead.root").alias("u"), F.least("root", "lead.root").alias("v"))
    near = near.join(tried, ["a", "b"], "left_anti")
    for n in "ab":
        near = near.join(sketches.select(F.col("node").alias(n), *(F.col(c).alias(c + n) for c in _KNOWN)), n)
    near = near.where(_may_link(lambda c: F.col(c + "a"), lambda c: F.col(c + "b"), percent))
    return near.groupBy("node").agg(F.max_by(F.struct("u", "v", "a", "b"), F.struct("n", F.xxhash64("a", "b"))).alias("p")).select("p.u", "p.v", "p.a", "p.b").distinct()


def _rest_pairs(labelled: DataFrame, sketches: DataFrame, tried: DataFrame, percent: int, store: Store) -> DataFrame:
    """(u, v, a, b): all pairs of a bucket that lie in two components, may link and were not compared."""
    spread = labelled.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("sig")
    open_ = store.put(labelled.select("sig", "node", "root").join(store.put(spread, "spread"), "sig").join(sketches, "node"), "rest")
    x, y = (open_.select("sig", F.col("node").alias(n), F.col("root").alias("r" + n), *(F.col(c).alias(c + n) for c in _KNOWN)) for n in "ab")
    pairs = x.join(y, "sig").where("a < b and ra <> rb").where(_may_link(lambda c: F.col(c + "a"), lambda c: F.col(c + "b"), percent))
    return pairs.select(F.greatest("ra", "rb").alias("u"), F.least("ra", "rb").alias("v"), "a", "b").distinct().join(tried, ["a", "b"], "left_anti")


def _link(docs: DataFrame, buckets: DataFrame, members: DataFrame, store: Store, percent: int, size: int) -> DataFrame:
    """(node, root): components of the links among bucket neighbours, and of nodes that share a document id.

    In a round each bucket has a lead, in turn the node with the most
    neighbours (the original among its near copies) and any; nodes of other
    components are compared with the leads they share most buckets with.  Once
    most of a round's comparisons fail, components are made whole and all pairs
    of a bucket that lie in two of them, and may link, are compared."""
    sets = _texts(docs, buckets.select("node").distinct(), members, store, size)
    sketches = sets.select("node", *_KNOWN).dropDuplicates(["node"])
    buckets = _open_buckets(buckets, store)
    twice = members.groupBy("doc").agg(F.min("node").alias("b"), F.max("node").alias("c")).where("b < c")
    links = store.put(members.join(twice, "doc").select(F.col("node").alias("a"), "b").where("a <> b").distinct(), "links")
    root = components(links, store)
    forest = root.select(F.col("node").alias("u"), F.col("root").alias("v"))
    tried = docs.sparkSession.createDataFrame([], "a long, b long")
    last, step = False, 0
    while True:
        labelled = buckets.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        found = _rest_pairs(labelled, sketches, tried, percent, store) if last else _led_pairs(labelled, sketches, tried, step, percent, store)
        pairs = store.put(found, "pairs")
        checked = store.put(_verify(pairs, sets, percent).distinct(), "checked")
        store.drop(pairs)
        count = checked.agg(F.count("*").alias("n"), F.count_if("linked").alias("linked")).first()
        if count.linked:
            # links of roots; labels need not be whole before the end, so one step a round is enough
            forest = store.put(_star_step(forest.union(checked.where("linked").select("u", "v"))), "forest")
        if last:
            break
        last, step = 2 * count.linked <= count.n, step + 1
        tried = store.put(tried.union(checked.select("a", "b")), "tried")
        store.drop(checked)
        if last:
            root = components(forest.select(F.col("u").alias("a"), F.col("v").alias("b")), store)
        elif count.linked:
            root = store.put(_labels(forest), "root")
        store.release()
    return components(forest.select(F.col("u").alias("a"), F.col("v").alias("b")), store)
