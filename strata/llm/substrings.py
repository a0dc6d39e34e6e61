"""Removal of passages that repeat across documents, by level-wise doubling.

Level one looks at windows of half the length, and at few of them: in every
full window the half-length window with the least hash is its anchor, so equal
full windows have equal anchors, and neighbouring full windows mostly share
one.  Anchors found in one document only cannot lie in a repeated passage;
what hangs on the others is extended to the full length.  Neighbouring full
windows under one anchor form a run with a hash of its own: an anchor whose
runs are all equal is settled by that, and only the windows of the rest are
compared one by one.  No table but that of the anchors grows with all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import hashing
from strata.llm.common import Store, forget_words, map_batches

SIZE = 50
_RUN = "a long, r long, doc long, tag int, start int, n int"


def anchored_runs(h: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Of a text's word hashes: anchor hash, run hash, first window and number of windows of each run."""
    half = -(-size // 2)
    g = hashing.windows(h, half)
    width = size - half + 1
    if len(g) < width:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    view = np.lib.stride_tricks.sliding_window_view(g, width)
    at = view.argmin(axis=1) + np.arange(len(view))
    first = np.flatnonzero(np.diff(at, prepend=-1))
    n = np.diff(first, append=len(at))
    content = hashing._run_hash(h, first, first + n - 1 + size, 1)
    return g[at[first]], hashing.mix(content + (at[first] - first).astype(np.uint64), 3), first, n


def _runs(docs: DataFrame, size: int) -> DataFrame:
    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        forget_words()
        parts, held = [], 0

        def batch():
            cols = [np.concatenate(c) for c in zip(*parts)]
            cols = [c.view(np.int64) if c.dtype == np.uint64 else c for c in cols]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in _RUN.split(", ")])

        for doc, tag, text in zip(b["doc"].to_pylist(), b["tag"].to_pylist(), b["text"]):
            h, _, _ = hashing.words(text.as_py())
            a, r, first, n = anchored_runs(h, size)
            if len(a):
                parts.append((a, r, np.full(len(a), doc), np.full(len(a), tag, np.int32), first.astype(np.int32), n.astype(np.int32)))
                held += len(a)
            if held > 500_000:
                yield batch()
                parts, held = [], 0
        if parts:
            yield batch()

    return map_batches(docs.where("doc is not null and text is not null").select("doc", "tag", "text"), run, _RUN)


def _windows(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``w, doc, tag, start``: the hash of each wanted full window."""
    lists = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n")).alias("runs"))  # bounded by the one text

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for doc, tag, text, runs in zip(b["doc"].to_pylist(), b["tag"].to_pylist(), b["text"], b["runs"].to_pylist()):
            h, _, _ = hashing.words(text.as_py())
            w = hashing.windows(h, size, 1).view(np.int64)
            at = np.concatenate([np.arange(x["start"], x["start"] + x["n"]) for x in runs])
            yield pa.RecordBatch.from_arrays([pa.array(w[at]), pa.array(np.full(len(at), doc)), pa.array(np.full(len(at), tag, np.int32)), pa.array(at.astype(np.int32))], names=["w", "doc", "tag", "start"])

    return map_batches(docs.select("doc", "tag", "text").join(lists, ["doc", "tag"]), run, "w long, doc long, tag int, start int")


def repeated(docs: DataFrame, store: Store, size: int = SIZE) -> DataFrame:
    """``doc, tag, start, n``: runs of ``n`` full windows from word ``start`` on whose words also start in a document of a smaller id.

    ``docs``: doc, tag (tells rows of one id apart) and text."""
    runs = store.put(_runs(docs, size), "runs")
    # level one: anchors in at least two documents, and whether all their runs are equal
    level = runs.groupBy("a").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.min("r").alias("r0"), F.max("r").alias("r1")).where("least < most")
    level = store.put(level.select("a", "least", (F.col("r0") == F.col("r1")).alias("same")), "level")
    # in a document that is the first with the anchor nothing can be removed under it, but others are compared with its windows
    hits = store.put(runs.join(level, "a").where("not same or doc > least").select("doc", "tag", "start", "n", "same"), "hits")
    store.drop(runs), store.drop(level), store.release()
    # level two: the windows of full length
    windows = store.put(_windows(docs, hits.where("not same"), size), "windows")
    store.release()
    # written, so that a hot window's rows are a shuffled side of their own in the join, which Spark splits
    first = store.put(windows.groupBy("w").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most"), "first")
    later = windows.join(first, "w").where("doc > least").select("doc", "tag", "start", F.lit(1).alias("n"))
    out = store.put(hits.where("same").select("doc", "tag", "start", "n").union(later), "repeated")
    store.drop(windows), store.drop(hits), store.drop(first), store.release()
    return out


def strip_repeats(docs: DataFrame, size: int = SIZE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with repeated passages taken out of their text, and ``n_words`` (before) and ``n_removed`` after their own columns.

    Goes every word covered by a window of ``size`` words whose sequence also
    starts in a document of a smaller id; windows are judged on the input.
    What is left of a shortened text is joined by single spaces; other texts stay
    as they are.  Null texts count as empty and become empty; a null id has no
    order, so its text stays and removes nothing; rows that repeat an id do not
    shorten each other; an empty table gives no rows; all columns are kept."""
    names = docs.columns
    store = Store(docs.sparkSession, "substrings")
    i, t = names.index(id_column), names.index(text_column)
    flat = docs.toDF(*[f"c{k}" for k in range(len(names))])
    keyed = flat.withColumn("doc", F.col(f"c{i}").cast("long")).withColumn("tag", F.hash(f"c{t}"))
    found = repeated(keyed.select("doc", "tag", F.col(f"c{t}").alias("text")), store, size)
    lists = found.distinct().groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = keyed.join(lists, ["doc", "tag"], "left").drop("doc", "tag")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields) + ", n_words long, n_removed long"

    def strip(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, n_words, n_removed = [], [], []
        for text, runs in zip(b[t], b["runs"]):
            text, runs = text.as_py() or "", runs.as_py()
            raw = text.encode(errors="surrogatepass")
            start, end = hashing.spans(np.frombuffer(raw, np.uint8))
            n_words.append(len(start))
            if runs:
                cover = np.zeros(len(start) + 1, np.int64)
                s = np.array([x["start"] for x in runs])
                np.add.at(cover, s, 1)
                np.add.at(cover, s + np.array([x["n"] for x in runs]) - 1 + size, -1)
                keep = np.cumsum(cover[:-1]) == 0
                edge = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])).astype(np.int8)))
                text = b" ".join(raw[start[a] : end[z - 1]] for a, z in zip(edge[::2], edge[1::2])).decode(errors="surrogatepass")
                n_removed.append(int((~keep).sum()))
            else:
                n_removed.append(0)
            texts.append(text)
        own = [pa.array(texts, pa.string()) if k == t else b[k] for k in range(len(names))]
        yield pa.RecordBatch.from_arrays([*own, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=[*(f"c{k}" for k in range(len(names))), "n_words", "n_removed"])

    return map_batches(joined, strip, schema).toDF(*names, "n_words", "n_removed")
