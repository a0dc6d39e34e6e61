"""Helpers shared by the operators: column picking, shared tables, word caches."""

from __future__ import annotations

import gc
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator, Sequence
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

#: Any white space the engines' splitters know beyond the six ASCII ones.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Select columns by exact name and position.

    Works on frames whose other columns repeat a name or differ from it only
    in case; the first exact match counts.  ``renamed`` maps new to old names."""
    at = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(at))])
    wanted = {n: n for n in names} | renamed
    return flat.select(*[F.col(f"_{at.index(old)}").alias(new) for new, old in wanted.items()])


def table(sf_dir: str, name: str, spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Store:
    """Intermediate tables in the shared checkpoint folder.

    Writing one cuts the lineage: a lost executor costs a reread, not a rerun.
    ``drop`` deletes a table that nothing reads any more; ``release`` lets
    Spark delete the shuffle files of the jobs that are done."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/strata-llm/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n}-{name}"

    def put(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Columns are stored by position if names clash but for case."""
        path, names = self.path(name), df.columns
        if len({n.lower() for n in names}) < len(names):
            df = df.toDF(*[f"_{i}" for i in range(len(names))])
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).toDF(*names)

    def drop(self, df: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/strata-llm/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(run, schema)


_CACHES: weakref.WeakSet = weakref.WeakSet()


def forgotten_too(cache) -> None:
    """``cache.clear()`` is part of ``forget_words`` from now on."""
    _CACHES.add(cache)


def forget_words() -> None:
    """Empties this worker's word caches: tasks that use none need the memory for themselves."""
    for cache in _CACHES:
        cache.clear()


class WordCache:
    """Encodings of distinct words, kept between the batches of a Python worker.

    ``encode`` turns a list of new words into a list of little-endian id
    strings.  Words met since the last turnover are in ``known``, those met
    only before it in ``old``; when ``known`` holds half of ``limit`` bytes it
    becomes ``old``, so words met often stay.  Words of more than ``longest``
    characters are not kept.  This bounds memory and changes no result."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 100_000_000, longest: int = 256):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.clear()
        forgotten_too(self)

    def clear(self) -> None:
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def __call__(self, words: list[str]) -> list[bytes]:
        """Of distinct words."""
        out = [*map(self.known.get, words)]
        new = [i for i, x in enumerate(out) if x is None]
        if new:
            found = self._find([words[i] for i in new])
            for i, x in zip(new, found):
                out[i] = x
        return out

    def _find(self, words: list[str]) -> list[bytes]:
        found = [*map(self.old.get, words)]
        fresh = [w for w, x in zip(words, found) if x is None]
        made = iter(self.encode(fresh)) if fresh else iter(())
        found = [next(made) if x is None else x for x in found]
        keep = {w: x for w, x in zip(words, found) if len(w) <= self.longest}
        size = sum(map(getsizeof, keep)) + sum(map(getsizeof, keep.values())) + 100 * len(keep)
        if self.held + size > self.limit // 2:
            self.old, self.known, self.held = self.known, {}, 0
        if size <= self.limit // 2:
            self.known.update(keep)
            self.held += size
        return found

    def joined(self, words: list[str]) -> bytes:
        """The encodings of one text's words in a row."""
        out = [*map(self.known.get, words)]
        if None in out:
            new = [*{w for w, x in zip(words, out) if x is None}]
            found = dict(zip(new, self(new)))
            out = [found[w] if x is None else x for w, x in zip(words, out)]
        return b"".join(out)

    def rows(self, words: pa.ListArray) -> list[bytes]:
        """Of each row, the encodings of its words in a row."""
        coded = words.flatten().dictionary_encode()
        flat = pa.array(self(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        at = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1 + flat.offset)[flat.offset :]
        start = words.offsets.to_numpy() - words.offsets[0].as_py()
        raw = flat.buffers()[2]
        raw = memoryview(raw) if raw is not None else memoryview(b"")
        edge = at[start].tolist()
        return [bytes(raw[a:b]) for a, b in zip(edge, edge[1:])]


def slices(texts: Sequence[str | None], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about ``most`` characters each (one longer text stands alone)."""
    size = np.cumsum([len(t or "") for t in texts])
    at = 0
    while at < len(texts):
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + most, side="right")))
        yield at, to
        at = to
