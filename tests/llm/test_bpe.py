"""BPE encoding and decoding against the library, on awkward and random texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import bpe, catalog, common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.vocabulary_path())


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def awkward():
    rng = random.Random(5)
    pools = [range(32, 127), range(0xA0, 0x250), range(0x2000, 0x2100), range(0x3040, 0x3100), range(0x1F300, 0x1F650), [9, 10, 13, 32, 0x1C, 0x1F, 0x85, 0xA0, 0x3000], [0x558, 0x208F, 0xA7CE, 0x10940]]
    mixed = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(1, 80))) for _ in range(400)]
    return mixed + ["", " ", "\n\n a\n", "it's I'LL 'tis we'd  they've", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftex", "é" * 999, "ab" * 7000, " " * 4000 + "x", "á̀", "\x00\x7f"]


def test_ids_are_the_librarys(vocabulary, library):
    texts = awkward()
    want = [raw(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [vocabulary.encode(t) for t in texts] == want
    assert [vocabulary.encode(t) for t in texts] == want  # from the word cache


def test_long_word_is_merged_once_a_pair(vocabulary, library):
    word = "".join(random.Random(1).choice("abcdeTH") for _ in range(60_000))
    assert vocabulary.encode(word) == raw(library.encode(word, add_special_tokens=False).ids)


def test_small_cache_changes_nothing(vocabulary):
    texts = awkward()
    want = [vocabulary.encode(t) for t in texts]
    small = bpe.Vocabulary(bpe.vocabulary_path())
    small.cache.limit = 2000
    assert [small.encode(t) for t in texts] == want
    assert small.cache.held <= 2000


def test_any_ids_decode_as_the_library_does(vocabulary, library):
    rng = random.Random(2)
    runs = [[rng.randrange(vocabulary.size) for _ in range(n)] for n in (0, 1, 7, 50) for _ in range(50)] + [[50256, 50256]]
    flat = pa.array(np.array([i for r in runs for i in r], "<u4"))
    got = vocabulary.decode(flat, np.cumsum([len(r) for r in runs]))
    assert got == [library.decode(r, skip_special_tokens=False) for r in runs]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.vocabulary_path("word_bpe_49k.json"))


def test_documents(docs, empty, library):
    rows = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    given = [(r.i, r.t or "") for r in common.pick(docs, i="doc_id", t="text").collect()]
    want = [(i, raw(library.encode(t, add_special_tokens=False).ids), t) for i, t in given]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, bytes(r.ids), r.text) for r in rows), key=key) == sorted(want, key=key)
    assert bpe.encode_documents(empty).count() == 0 and bpe.decode_documents(bpe.encode_documents(empty)).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert {(r.doc_id, r.text) for r in bpe.decode_documents(rows).collect()} == {(1, ""), (2, "")}


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in common.table(SF, "documents", spark).select("doc_id", "text").collect()}
    rows = catalog.QUERIES["op11_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
