"""Byte-level BPE encoding and decoding, with a queue of merge ranks over a linked list of symbols.

A text is cut at the vocabulary's added tokens, then into words by the byte
level rule.  A word starts as one symbol a byte, in a doubly linked list; a
heap holds (rank, place) of every pair that has a merge.  The least entry is
popped; it is stale, and skipped, if its place was merged away or now starts
another pair.  Otherwise the right symbol is joined to the left one, unlinked,
and the two new pairs are pushed.  A word of n bytes takes O(n log n) steps,
so one very long word does no harm.

Decoding joins the vocabulary's strings of a document's ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from strata.llm.common import WordCache, map_batches, pick, slices

VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the word rule of byte-level vocabularies.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same rule over ASCII texts, in classes that need no Unicode tables.
_ASCII_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\x09-\x0D\x20A-Za-z0-9]+|[\x09-\x0D\x20]+(?![^\x09-\x0D\x20])|[\x09-\x0D\x20]+"

_PLACE = 32  # bits of a place in a heap entry
_PLACES = (1 << _PLACE) - 1
_CUT = regex.compile(WORD_RULE).findall
_CUT_ASCII = re.compile(_ASCII_RULE).findall


def byte_strings() -> list[str]:
    """The character that stands for each byte in a vocabulary file: printable Latin-1 ones themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


class Vocabulary:
    """Ranks, strings and added tokens of a vocabulary file; refuses files whose rules it doesn't follow."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
        unused = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in unused) or spec["normalizer"]:
            raise ValueError("only byte-level BPE vocabularies without a normaliser")
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or (spec["decoder"] or {}).get("type") != "ByteLevel":
            raise ValueError("only the byte-level word rule without an added space")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that look at their neighbours are not supported")
        vocab = model["vocab"]
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        chars = byte_strings()
        self.raw_id = [i.to_bytes(4, "little") for i in range(self.size)]
        self.start = [vocab[c] for c in chars]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank_of = {vocab[a] * self.size + vocab[b]: rank for rank, (a, b) in enumerate(pairs)}.get
        self.made = [vocab[a + b] for a, b in pairs]
        back = {c: b for b, c in enumerate(chars)}
        self.first = {(back[a], back[b]): rank for rank, (a, b) in enumerate(pairs) if len(a) == len(b) == 1}
        strings = [b""] * self.size
        for piece, i in vocab.items():
            strings[i] = bytes(back[c] for c in piece)
        for t in added:
            strings[t["id"]] = bytes(back[c] for c in t["content"]) if all(c in back for c in t["content"]) else t["content"].encode()
        self.strings = pa.array(strings, pa.large_binary())
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(longest_first) + ")").split if added else None
        self.library_cut = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.same, self.differs = set(map(chr, range(128))), set()
        self.cache = WordCache(self.encode_words)

    def _agreed(self, text: str) -> bool:
        """Whether the rule here and the library's, which may know another Unicode version, class all characters alike."""
        for c in set(text) - self.same:
            if c not in self.differs:
                probe = f"a{c}1{c}!{c}b"
                alike = [probe[a:b] for _, (a, b) in self.library_cut(probe)] == _CUT(probe)
                (self.same if alike else self.differs).add(c)
            if c in self.differs:
                return False
        return True

    def cut(self, text: str) -> list[str]:
        """The words of a text without added tokens."""
        if text.isascii():
            return _CUT_ASCII(text)
        if self._agreed(text):
            return _CUT(text)
        return [text[a:b] for _, (a, b) in self.library_cut(text)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        ids, size, rank_of, made = [self.start[b] for b in word], self.size, self.rank_of, self.made
        n = len(ids)
        right, left = [*range(1, n + 1)], [*range(-1, n - 1)]
        rank = [*map(self.first.get, zip(word, word[1:])), None]  # of the pair that starts at each place now
        heap = [r << _PLACE | at for at, r in enumerate(rank) if r is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            at, top = entry & _PLACES, entry >> _PLACE
            if rank[at] != top:
                continue  # merged away, or another pair now
            joined = ids[at] = made[top]
            gone = right[at]
            after = right[at] = right[gone]
            ids[gone] = rank[gone] = None
            found = None
            if after < n:
                left[after] = at
                if (found := rank_of(joined * size + ids[after])) is not None:
                    heappush(heap, found << _PLACE | at)
            rank[at] = found
            before = left[at]
            if before >= 0:
                found = rank[before] = rank_of(ids[before] * size + joined)
                if found is not None:
                    heappush(heap, found << _PLACE | before)
        return [i for i in ids if i is not None]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """32-bit ids of each word or added token."""
        return [self.added.get(w) or b"".join([self.raw_id[i] for i in self.merge(w.encode())]) for w in words]

    def encode(self, text: str) -> bytes:
        """32-bit ids of one text."""
        if self.at_added and any(a in text for a in self.added):
            return self.cache.joined([w for part in self.at_added(text) if part for w in ([part] if part in self.added else self.cut(part))])
        return self.cache.joined(self.cut(text))

    def decode(self, ids: pa.Array, ends: np.ndarray) -> list[str]:
        """Text of each run of ids up to ``ends``; bytes that are no UTF-8 become U+FFFD."""
        joined = pc.take(self.strings, ids)
        at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1)
        raw = memoryview(joined.buffers()[2] or b"")
        edge = at[np.concatenate(([0], ends))].tolist()
        return [str(raw[a:b], errors="replace") for a, b in zip(edge, edge[1:])]


_LOADED: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    """One vocabulary and word cache a worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (little-endian 32-bit) of every whole text.

    Null and empty texts have no ids; added tokens inside a text get their own
    id, as the library's default is; repeated rows and null doc_ids are encoded
    each; an empty table gives no rows; other columns are ignored.  A batch is
    worked off in slices of bounded size, a longer text alone."""
    path = vocabulary or vocabulary_path()

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, texts = load(path), [t or "" for t in b["text"].to_pylist()]
        for low, high in slices(texts):
            ids = pa.array([*map(at.encode, texts[low:high])], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(low, high - low).cast(pa.int64()), ids], names=["doc_id", "ids"])

    return map_batches(pick(docs, "doc_id", "text"), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text.

    Null and empty ``ids`` give an empty text; ids outside the vocabulary are
    an error; other columns are ignored; repeated rows are decoded each and an
    empty table gives no rows."""
    path = vocabulary or vocabulary_path()

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, ids = load(path), [x or b"" for x in b["ids"].to_pylist()]
        for low, high in slices(ids):
            part = ids[low:high]
            flat = pa.array(np.frombuffer(b"".join(part), "<u4"))
            texts = at.decode(flat, np.cumsum([len(x) // 4 for x in part], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(low, high - low).cast(pa.int64()), pa.array(part, pa.binary()), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return map_batches(pick(encoded, "doc_id", "ids"), run, "doc_id long, ids binary, text string")
