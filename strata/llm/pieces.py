"""Encoding and decoding with a SentencePiece vocabulary, by a forward pass shared over common prefixes.

Texts are cut before each run of the space mark, where no piece can reach
across; the distinct marked words of a batch are sorted, which lays them out
as a trie in depth-first order, and each word's forward pass starts where it
leaves the previous word.

For a unigram vocabulary the forward state of a prefix is its best score and
last piece (Viterbi).  A merge vocabulary has no such scores, but its result
has the same shape: the encoding of a prefix is the encoding of a shorter
prefix and one last piece, namely the only piece that ends there and may stand
after the shorter prefix's last one.  Two pieces may stand side by side if
merging their joined characters gives just these two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import WordCache, map_batches, pick, slices

MARK = "▁"
_NORMAL, _UNKNOWN, _BYTE, _MERGES = 1, 2, 6, 2


class Vocabulary:
    """Pieces, scores and byte fallback of a model file; ``encode_words`` does the shared forward pass."""

    def __init__(self, path: str, pair_limit: int = 400_000):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if len(model.pieces) > 65_535:
            raise ValueError("only vocabularies of at most 65,535 pieces are supported: pairs of pieces are keyed by 16 bits each")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only vocabularies without text normalisation are supported")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.merges = model.trainer_spec.model_type == _MERGES
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.raw = [bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE else p.piece.replace(MARK, " ").encode() if p.type == _NORMAL else b"" for p in model.pieces]
        self.longest = max(map(len, self.id))
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece reaches across the start of a word")
        alone = "" if any("\n" in p for p in self.id) else "\n"
        self.cut = re.compile(rf"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (r"|\n" if alone else "")).findall
        self.id_bytes = {i: i.to_bytes(2, "little") for i in self.id.values()}
        self.text = {i: p for p, i in self.id.items()}
        ends: dict[str, set[int]] = {}
        for p in self.id:
            ends.setdefault(p[-3:], set()).add(len(p))
        self.ends = {k: sorted(v, reverse=True) for k, v in ends.items()}  # last three characters -> lengths of pieces, longest first
        self.pairs, self.pair_limit = {}, pair_limit
        self.cache = WordCache(self.encode_words)

    def _merge(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until no two make a piece."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            joined = [score(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            top = max(joined)
            if top == -np.inf:
                break
            at = joined.index(top)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' characters gives just these two; a left of -1 is a word's start or an unknown character, where nothing merges."""
        key = left * 65536 + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > self.pair_limit:
                self.pairs.clear()
            pair = [self.text[right]] if left < 0 else [self.text[left], self.text[right]]
            found = self.pairs[key] = self._merge("".join(pair)) == pair
        return found

    def _fallback(self, char: str) -> bytes:
        ids = [self.byte_id.get(b, self.unknown) for b in char.encode()] if self.byte_id else [self.unknown]
        return np.array(ids, "<u2").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """16-bit ids of each word; sorted, so that a prefix shared with the word before is not passed again."""
        found, before = {}, ""
        last, size, best = [-1], [0], [0.0]  # of each prefix: its last piece (-1: an unknown character), that piece's length, its score
        step = self._merge_step if self.merges else self._score_step
        for word in sorted(set(words)):
            common, most = 0, min(len(word), len(before))
            while common < most and word[common] == before[common]:
                common += 1
            del last[common + 1 :], size[common + 1 :], best[common + 1 :]
            for end in range(common + 1, len(word) + 1):
                step(word, end, last, size, best)
            found[word] = self._walk_back(word, last, size)
            before = word
        return [found[w] for w in words]

    def _walk_back(self, word: str, last: list[int], size: list[int]) -> bytes:
        """The ids of the whole word, from its end."""
        parts, end = [], len(word)
        while end:
            parts.append(self._fallback(word[end - 1]) if last[end] < 0 else self.id_bytes[last[end]])
            end -= size[end]
        return b"".join(reversed(parts))

    def _merge_step(self, word: str, end: int, last: list[int], size: list[int], best: list[float]) -> None:
        """The piece that ends at ``end`` and may follow the shorter prefix's last one: there is just one."""
        pairs, known = self.pairs, self.id
        for n in (*self.ends.get(word[max(0, end - 3) : end], ()), 2, 1) if end > 2 else (2, 1)[2 - end :]:
            if n <= end and (piece := known.get(word[end - n : end])) is not None:
                fits = pairs.get(last[end - n] * 65536 + piece)
                if fits or fits is None and self._may_follow(last[end - n], piece):
                    last.append(piece)
                    size.append(n)
                    return
        last.append(-1)
        size.append(1)

    def _score_step(self, word: str, end: int, last: list[int], size: list[int], best: list[float]) -> None:
        """Viterbi: the piece with the best score in all."""
        top = best[end - 1] - 1e6, -1, 1
        for n in range(min(self.longest, end), 0, -1):
            p = word[end - n : end]
            if p in self.score and best[end - n] + self.score[p] > top[0]:
                top = best[end - n] + self.score[p], self.id[p], n
        best.append(top[0])
        last.append(top[1])
        size.append(top[2])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; new words of all texts share one sorted pass."""
        cut = [self.cut((self.prefix + t).replace(" ", MARK)) if t else [] for t in texts]
        return [np.frombuffer(x, "<u2") for x in self.cache.rows(pa.array(cut, pa.list_(pa.string())))]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.raw[i] for i in ids.tolist()]).decode(errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_LOADED: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    """One vocabulary and word cache a worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ``ids`` (little-endian 32-bit piece ids) of every whole text.

    Null texts give null ids and empty ones none; repeated rows are encoded
    each; an empty table gives no rows; other columns are ignored.  A batch is
    worked off in slices of bounded size, a longer text alone."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary, texts = load(model), b["text"].to_pylist()
        for low, high in slices(texts):
            part = texts[low:high]
            ids = [None if t is None else x.astype("<u4").tobytes() for t, x in zip(part, vocabulary.encode(part))]
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(low, high - low).cast(pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return map_batches(pick(docs, "doc_id", "text"), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and the decoded text.

    Null ids give a null text, empty ones an empty text; repeated rows and null
    doc_ids are decoded each; other columns are ignored; an empty table gives no rows."""

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary, ids = load(model), b["ids"].to_pylist()
        for low in range(0, len(ids), 1000):
            part = ids[low : low + 1000]
            texts = [None if i is None else vocabulary.decode(np.frombuffer(i, "<u4")) for i in part]
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(low, len(part)), pa.array(part, pa.binary()), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return map_batches(pick(encoded, "doc_id", "ids"), run, "doc_id long, ids binary, text string")
