"""Packing token sequences by shortest-pack-first over the length histogram.

Documents are tokenised once and cut into pieces of at most one sequence.  The
packing itself only sees how many pieces there are of each length: lengths are
placed longest first, a count at a time, always into the packs with the most
room, and a pack is known only by its pattern and how many packs share it.  So
the driver's part is bounded by the sequence length, whatever the corpus.
Each pattern then claims a range of ranks of every length in it, and pieces
find their place by their rank among pieces of their length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Store, forgotten_too, map_batches, pick, slices

VOCABULARY = "word_bpe_49k.json"
SEQUENCE = 2048
END = 1  # the id put after each document
SALTS = 64

# Fixed value: the normaliser and the cutting rule that the plain words' short cut below follows.
_RULES = json.dumps(
    [
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    ],
    sort_keys=True,
)
_LETTER = "a-zß-öø-ÿ"
#: Words whose normal form and pieces are plain: printable ASCII and the Latin-1 letters.  All others go through the tokenizer's own normaliser.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
_PIECE = rf"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+)"
#: Bytes of words and ids kept between slices, and characters of the longest word kept.
KEPT, LONGEST = 16_000_000, 256


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """The word vocabulary's ids, word by word.

    No token spans white space, so a text's ids are its words' ids in a row.
    Plain words skip the normaliser, which takes most of the library's time:
    they are cut here and only merged there, each distinct piece once.  Words
    stay in Arrow arrays, as most of the distinct ones are met once.  ``known``
    holds words met before and ``ids`` theirs; when they are ``KEPT`` bytes,
    only those of the slice at hand stay, so words met often do."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if json.dumps([spec["normalizer"], spec["pre_tokenizer"]], sort_keys=True) != _RULES or spec["model"].get("end_of_word_suffix") != "</w>":
            raise ValueError("only vocabularies that lower-case, cut words and mark their ends as this one does")
        self.merger = Tokenizer(self.whole.model)
        self.merger.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        size = self.whole.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.ends = np.array([(self.whole.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.clear()
        forgotten_too(self)

    def clear(self) -> None:
        self.known, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _merge(self, pieces: pa.Array) -> pa.Array:
        """Of distinct pieces, each a word's whole run of letters or signs."""
        raw, edges, at = [], [np.zeros(1, np.int64)], 0
        for low in range(0, len(pieces), 50_000):
            part = pieces.slice(low, 50_000).to_pylist()
            ids = np.array(self.merger.encode_batch_fast([part], is_pretokenized=True, add_special_tokens=False)[0].ids, self.dtype)
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != len(part):
                raise ValueError("a piece without exactly one last token")
            raw.append(ids.tobytes())
            edges.append(at + stop * self.dtype.itemsize)
            at += len(raw[-1])
        return _binary(np.concatenate(edges), pa.py_buffer(b"".join(raw)))

    def _encode(self, words: pa.Array) -> pa.Array:
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), pc.match_substring(words, "<|"))
        cut = pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), _PIECE, r"\1 ")
        pieces = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(cut))
        coded = pieces.flatten().dictionary_encode()
        each = self._merge(coded.dictionary).take(coded.indices)
        of_plain = _binary(_edges(each)[_starts(pieces)], each.buffers()[2])
        rest = self.whole.encode_batch_fast(words.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)
        of_rest = pa.array([np.array(e.ids, self.dtype).tobytes() for e in rest], pa.large_binary())
        plain = plain.to_numpy(zero_copy_only=False)
        return pa.concat_arrays([of_plain, of_rest]).take(pa.array(np.where(plain, np.cumsum(plain), len(of_plain) + np.cumsum(~plain)) - 1))

    def _look_up(self, words: pa.Array) -> pa.Array:
        """Of distinct words."""
        at = pc.index_in(words, value_set=self.known)
        fresh = words.filter(at.is_null())
        ids = pa.concat_arrays([self.ids, self._encode(fresh)])
        new = at.is_null().to_numpy(zero_copy_only=False)
        found = ids.take(pa.array(np.where(new, len(self.known) + np.cumsum(new) - 1, at.fill_null(0).to_numpy())))
        if ids.nbytes + self.known.nbytes + fresh.nbytes <= KEPT:
            self.known, self.ids = pa.concat_arrays([self.known, fresh]), ids
        else:
            short = pc.less_equal(pc.utf8_length(words), LONGEST)
            self.known, self.ids = words.filter(short), found.filter(short)
            if self.known.nbytes + self.ids.nbytes > KEPT:
                self.clear()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = words.flatten().dictionary_encode()
        flat = self._look_up(coded.dictionary).take(coded.indices)
        edge, raw = _edges(flat)[_starts(words)].tolist(), memoryview(flat.buffers()[2] or b"")
        return [bytes(raw[a:b]) for a, b in zip(edge, edge[1:])]


def _starts(lists: pa.ListArray) -> np.ndarray:
    """Where each list starts among ``lists.flatten()``, and where the last ends."""
    return lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _edges(flat: pa.Array) -> np.ndarray:
    """Where the values of a large binary array that starts at its buffer's begin start and end."""
    return np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1) if len(flat) else np.zeros(1, np.int64)


def _binary(edges: np.ndarray, raw: pa.Buffer | None) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(edges, np.int64)), raw or pa.py_buffer(b"")])


_LOADED: dict[str, WordTokenizer] = {}


def _load(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, end: int | None = END) -> DataFrame:
    """doc_id, start, length, ids and doc_tokens of consecutive pieces of at most ``size`` ids; ``ids`` holds 16-bit ids (32-bit for a vocabulary beyond 65,536)."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokenizer, texts = _load(vocabulary), [t or "" for t in b["text"].to_pylist()]
        step, docs_ = tokenizer.dtype.itemsize, b["doc_id"].to_pylist()
        last = b"" if end is None else np.array([end], tokenizer.dtype).tobytes()
        for low, high in slices(texts):
            rows = []
            for doc, raw in zip(docs_[low:high], tokenizer.encode(texts[low:high])):
                raw += last
                n = len(raw) // step
                rows += [(doc, at, min(size, n - at), raw[at * step : (at + size) * step], n) for at in range(0, n, size)]
            if rows:
                cols = zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], names=["doc_id", "start", "length", "ids", "doc_tokens"])

    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(rows, run, "doc_id long, start long, length int, ids binary, doc_tokens long")


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns as (number of packs, ((length, times), ...)).

    Lengths go longest first; a length's pieces go to the packs with the most
    room that hold them, a whole group of like packs at a time, and open new
    packs where none has room."""
    room: dict[int, list[tuple[int, tuple]]] = {}
    spaces: list[int] = []  # sorted

    def add(space: int, count: int, pattern: tuple) -> None:
        if space not in room:
            room[space] = []
            spaces.insert(int(np.searchsorted(spaces, space)), space)
        room[space].append((count, pattern))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not spaces or spaces[-1] < length:
                add(size - length, left, ((length, 1),))
                break
            space = spaces[-1]
            count, pattern = room[space].pop()
            if not room[space]:
                del room[space], spaces[-1]
            used = min(count, left)
            if used < count:
                add(space, count - used, pattern)
            grown = (*pattern[:-1], (length, pattern[-1][1] + 1)) if pattern[-1][0] == length else (*pattern, (length, 1))
            add(space - length, used, grown)
            left -= used
    return [x for space in sorted(room) for x in room[space]]


def _slots(patterns: list, size: int) -> dict[str, np.ndarray]:
    """For each length in each pattern: the ranks it claims, and where they go."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, times, sequence, offset))
            used[length] = rank + count * times
            offset += length * times
        sequence += count
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "times", "sequence", "offset"), table.T.copy()))


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE, end: int | None = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; repeated rows and null ids are
    documents of their own; an empty table gives no rows; other columns are
    ignored.  The tokenised pieces are written once; ranks are counted over
    (length, salt) groups, so no length, however common, meets in one task."""
    spark = docs.sparkSession
    store = Store(spark, "pack")
    pieces = token_pieces(docs, vocabulary or vocabulary_path(), size, end).withColumn("piece", F.monotonically_increasing_id())
    path = store.path("pieces")
    pieces.write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(pieces.schema).parquet(path)
    store.release()
    light = pieces.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(SALTS)).cast("int").alias("salt"))
    # at most size * SALTS rows
    counts = light.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = store.put(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(pack_histogram(histogram, size), size)
    order = Window.partitionBy("length", "salt").orderBy("piece")
    ranked = light.withColumn("at", F.row_number().over(order)).join(F.broadcast(counts.select("length", "salt", "base")), ["length", "salt"])
    ranked = ranked.select("piece", "length", (F.col("base") + F.col("at") - 1).alias("rank"))

    def assign(b: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = b["length"].to_numpy().astype(np.int64), b["rank"].to_numpy()
        low = np.searchsorted(slots["length"], length, side="left")
        high = np.searchsorted(slots["length"], length, side="right")
        while ((high - low) > 1).any():  # the last slot of that length that starts at or before the rank
            mid = (low + high) // 2
            up = (slots["rank"][np.minimum(mid, len(slots["rank"]) - 1)] <= rank) & (high - low > 1)
            low, high = np.where(up, mid, low), np.where(up | (high - low <= 1), high, mid)
        within, times = rank - slots["rank"][low], slots["times"][low]
        sequence = slots["sequence"][low] + within // times
        offset = slots["offset"][low] + within % times * length
        return pa.RecordBatch.from_arrays([b["piece"], pa.array(sequence), pa.array(offset)], names=["piece", "sequence_id", "offset"])

    places = map_batches(ranked, assign, "piece long, sequence_id long, offset long")

    def widen(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype("<u4").tobytes() for x, n in zip(b["ids"].to_pylist(), b["length"].to_pylist())]
        return b.set_column(b.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

    joined = pieces.join(places, "piece").select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens", "sequence_id", "offset")
    return map_batches(joined, widen, joined.schema)
