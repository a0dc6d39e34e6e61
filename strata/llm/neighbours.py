"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and every vector is filed in its leaf.
A query walks the tree through a priority queue of nodes, nearest first, and
so lists the leaves in the order in which they are worth a visit.  How many
leaves a query visits is calibrated: a sample of queries is compared with an
exact search in blocks, and visits widen until the wanted recall is reached.

Vectors that are equal are searched once: of equal candidates only those with
the smallest ids can be among the nearest, and equal queries share an answer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Store, map_batches, pick

SAMPLE = 20_000  # rows the tree is fitted on
CALIBRATION = 200  # queries of the exact comparison
LEAF = 4096  # candidates a leaf should hold: each leaf visited gives k + 1 rows, so few large ones
BLOCK = 4096  # candidates a task's block holds at most, about
RECALL = 0.97


class Tree:
    """Nodes as arrays: centre, children range; leaves are numbered."""

    def __init__(self, data: np.ndarray, leaves: int, branch: int = 8, seed: int = 7):
        self.centre, self.children, self.leaf, self.leaves = [data.mean(0)], [()], [None], 0
        rng = np.random.default_rng(seed)
        queue = [(-len(data), 0, data)]
        open_leaves = 1
        while queue and open_leaves < leaves:
            _, node, rows = heapq.heappop(queue)
            if len(rows) < 2 * branch:
                continue
            label, centres = _kmeans(rows, branch, rng)
            if len(centres) < 2:
                continue
            kids = []
            for i, c in enumerate(centres):
                kids.append(len(self.centre))
                self.centre.append(c), self.children.append(()), self.leaf.append(None)
                part = rows[label == i]
                heapq.heappush(queue, (-len(part), kids[-1], part))
            self.children[node] = tuple(kids)
            open_leaves += len(kids) - 1
        for node, kids in enumerate(self.children):
            if not kids:
                self.leaf[node] = self.leaves
                self.leaves += 1
        self.centre = np.array(self.centre)

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at every level."""
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            kids = self.children[node]
            if not kids:
                out[at] = self.leaf[node]
            elif len(at):
                c = self.centre[list(kids)]
                best = np.argmin((c * c).sum(1) - 2 * rows[at] @ c.T, axis=1)
                todo += [(k, at[best == i]) for i, k in enumerate(kids)]
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        distance = ((self.centre - query) ** 2).sum(1)
        heap, found = [(0.0, 0)], []
        while heap and len(found) < most:
            _, node = heapq.heappop(heap)
            if self.leaf[node] is not None:
                found.append(self.leaf[node])
            for k in self.children[node]:
                heapq.heappush(heap, (float(distance[k]), k))
        return found


def _kmeans(rows: np.ndarray, k: int, rng, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    label = np.zeros(len(rows), int)
    for _ in range(rounds):
        label = np.argmin((centres * centres).sum(1) - 2 * rows @ centres.T, axis=1)
        used = np.unique(label)
        centres = np.array([rows[label == i].mean(0) for i in used])
    label = np.argmin((centres * centres).sum(1) - 2 * rows @ centres.T, axis=1)
    used, label = np.unique(label, return_inverse=True)
    return label, centres[used]


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows.reshape(len(column), -1) if len(column) else rows.reshape(0, 0)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, v`` of the vectors that take part: not null, no null or non-finite component, not all zero, of the commonest length (of several the least)."""
    df = pick(vectors, id=id_column, v=vector_column).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v")).where("id is not null")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    df = df.where(good)
    length = df.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return df.where(F.size("v") == (length.n if length else 0))


def _augmented(rows: np.ndarray, longest: float) -> np.ndarray:
    """One more component makes all vectors equally long, so that the nearest by distance has the largest inner product."""
    return np.hstack([rows, np.sqrt(np.maximum(0, longest**2 - (rows * rows).sum(1)))[:, None]])


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", recall: float = RECALL, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score (inner product in double precision) of each query's ``k`` nearest found.

    Queries are the rows whose id ``every`` divides; all other rows are their
    candidates (all of them, if fewer than ``k``), equal scores in order of id.  Vectors that are null,
    zero, or hold null or non-finite components, and those of another length
    than most, take no part; nor do null ids.  Repeated rows of an id and vector count once.  An
    empty table gives no rows; other columns are ignored.  ``leaf`` is how many
    candidates a leaf should hold, ``block`` how many candidates or queries of a
    leaf a task takes at most, about.  A query visits more leaves than
    calibrated where those hold too few candidates to fill its list."""
    spark = vectors.sparkSession
    store = Store(spark, "nearest")
    rows = usable(vectors, id_column, vector_column).distinct().withColumn("same", F.xxhash64("v"))
    rows = store.put(rows, "rows")
    # of equal vectors the k + 1 smallest ids suffice as candidates; one row stands for all of them
    order = Window.partitionBy("same", "v").orderBy("id")
    first = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).select("same", "v", "id")
    units = store.put(first.groupBy("same", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("unit", F.col("ids")[0]), "units")
    n = units.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    longest = units.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    sample = units.select("unit", "v").orderBy(F.xxhash64("unit")).limit(SAMPLE).toArrow()
    fitted = _augmented(_matrix(sample["v"].combine_chunks()), longest)
    tree = Tree(fitted, max(1, min(-(-n // leaf), SAMPLE // 16)))
    tree_at = spark.sparkContext.broadcast(tree)  # at most SAMPLE / 8 centres

    def leafed(b: pa.RecordBatch) -> pa.RecordBatch:
        at = tree_at.value.file(_augmented(_matrix(b["v"]), longest))
        return pa.RecordBatch.from_arrays([b["unit"], b["v"], pa.array(at, pa.int32())], names=["unit", "v", "leaf"])

    filed = store.put(map_batches(units.select("unit", "v"), leafed, "unit long, v array<double>, leaf int"), "filed")
    is_query = rows.where(F.pmod("id", F.lit(every)) == 0).select("id", "same", "v")
    asked = store.put(is_query.select("same", "v").distinct().join(units.select("same", "v", "unit"), ["same", "v"]).select("unit", "v"), "asked")
    visits = _calibrate(asked, filed, tree, longest, k, recall)
    held = np.zeros(tree.leaves, np.int64)  # one row a leaf
    for r in filed.groupBy("leaf").count().collect():
        held[r["leaf"]] = r["count"]

    def leaves_of(query: np.ndarray) -> list[int]:
        found = tree_at.value.visit(query, visits)
        if held[found].sum() <= k:  # k + 1 hold k besides the query's own
            found = tree_at.value.visit(query, tree_at.value.leaves)
            found = found[: max(visits, int(np.searchsorted(np.cumsum(held[found]), k + 1)) + 1)]
        return found

    def walk(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queries = _augmented(_matrix(b["v"]), longest)
        queries[:, -1] = 0.0  # distance then orders as the inner product does
        lists = [*map(leaves_of, queries)]
        times = np.array([len(x) for x in lists])
        at = np.repeat(np.arange(len(lists)), times)
        yield pa.RecordBatch.from_arrays([b["unit"].take(pa.array(at)), b["v"].take(pa.array(at)), pa.array(np.concatenate(lists), pa.int32())], names=["unit", "v", "leaf"])

    walked = map_batches(asked, walk, "unit long, v array<double>, leaf int")
    # a leaf's candidates and its queries are cut into blocks, and each block of the ones meets each of the others; the table of blocks is bounded by the tree
    walked = store.put(walked, "walked")
    cut = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    blocks = F.broadcast(cut(filed, "blocks").join(cut(walked, "parts"), "leaf"))
    own = lambda n: F.pmod(F.xxhash64("unit"), F.col(n)).cast("int")
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    candidates = filed.join(blocks, "leaf").select("leaf", own("blocks").alias("block"), every_one("parts").alias("part"), "unit", "v")
    walked = walked.join(blocks, "leaf").select("leaf", every_one("blocks").alias("block"), own("parts").alias("part"), "unit", "v")

    def match(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "unit": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        c, cu = _matrix(right["v"].combine_chunks()), right["unit"].to_numpy()
        qs, us, ss = [], [], []
        for at in range(0, left.num_rows, 256):
            part = left.slice(at, 256)
            score = _matrix(part["v"].combine_chunks()) @ c.T
            least = -np.partition(-score, k, axis=1)[:, k : k + 1] if score.shape[1] > k + 1 else -np.inf
            q, u = np.nonzero(score >= least)  # the k + 1 best and what equals the last of them
            qs.append(part["unit"].to_numpy()[q]), us.append(cu[u]), ss.append(score[q, u])
        return pa.table({"query": np.concatenate(qs), "unit": np.concatenate(us), "score": np.concatenate(ss)})

    found = walked.groupBy("leaf", "block", "part").cogroup(candidates.groupBy("leaf", "block", "part")).applyInArrow(match, "query long, unit long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "unit")
    found = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).select("query", "unit", "score")
    # k + 1 units hold at least k rows besides the query itself
    answer = found.join(units.select("unit", "ids"), "unit").select("query", "score", F.explode("ids").alias("vec_id"))
    again = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answer = answer.withColumn("at", F.row_number().over(again)).where(F.col("at") <= k + 1)
    lists = answer.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("list"))
    queries = is_query.join(units.select("same", "v", F.col("unit").alias("query")), ["same", "v"]).select("id", "query")
    out = queries.join(lists, "query").select(F.col("id").alias("query_id"), F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("id")), 1, k).alias("list"))
    out = out.select("query_id", F.posexplode("list").alias("pos", "x"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _top(score: np.ndarray, k: int) -> np.ndarray:
    if score.shape[1] <= k:
        return np.broadcast_to(np.arange(score.shape[1]), score.shape)
    return np.argpartition(-score, k - 1, axis=1)[:, :k]


def _calibrate(asked: DataFrame, filed: DataFrame, tree: Tree, longest: float, k: int, recall: float) -> int:
    """Leaves to visit so that the sampled queries find ``recall`` of their true nearest, from an exact search in blocks."""
    sample = asked.orderBy(F.xxhash64("unit")).limit(CALIBRATION).toArrow()
    if not sample.num_rows:
        return 1
    ids, queries = sample["unit"].to_numpy(), _matrix(sample["v"].combine_chunks())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = queries @ _matrix(b["v"]).T
            score[ids[:, None] == b["unit"].to_numpy()[None, :]] = -np.inf
            top = _top(score, k)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(ids)), top.shape[1])), pa.array(b["leaf"].to_numpy()[top].ravel()), pa.array(np.take_along_axis(score, top, 1).ravel())], names=["q", "leaf", "score"])

    exact = filed.mapInArrow(scan, "q long, leaf int, score double").where("score > double('-Infinity')")
    best = Window.partitionBy("q").orderBy(F.desc("score"))
    truth = exact.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).select("q", "leaf").toPandas()
    order = _augmented(queries, longest)
    order[:, -1] = 0.0
    place = np.array([np.argsort(tree.visit(q, tree.leaves)) for q in order])
    needed = np.sort(place[truth["q"].to_numpy(), truth["leaf"].to_numpy()]) if len(truth) else np.zeros(1, int)
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1
