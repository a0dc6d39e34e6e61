"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re

from test_operators import brute_components

import corpus_pipeline
from strata.llm import common, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(SF, "documents", spark)
    store = common.Store(spark, "test")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(store.put(stage(spark, kept[-1], SF), name))
    rows = [{r.doc_id: r.text for r in k.select("doc_id", "text").collect()} for k in kept[:-1]]
    assert all(k.columns == docs.columns for k in kept[:-1])
    clean = {r.doc_id for r in quality.judge_quality(docs).where("kept").collect()}
    assert rows[1] == {i: t for i, t in rows[0].items() if i in clean}
    first = {i for i, _, root in brute_components(list(rows[1].items())) if i == root}
    assert rows[2] == {i: t for i, t in rows[1].items() if i in first}
    words = {i: WORD.findall(t or "") for i, t in rows[2].items()}
    seen = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            seen.setdefault(tuple(words[i][k : k + 50]), i)
    assert rows[3].keys() == words.keys()
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - 49) if seen[tuple(w[k : k + 50])] < i for j in range(50)}
        assert WORD.findall(rows[3][i] or "") == [x for k, x in enumerate(w) if k not in gone]
    pieces = kept[-1].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in pieces} == rows[3].keys()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)


def run_stages(spark, docs):
    store = common.Store(spark, "test")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(store.put(stage(spark, kept[-1], ""), name))
    return kept


def test_awkward_tables(spark, docs, empty):
    """Names that clash but for case, null and repeated ids, null and empty texts, no n_chars; an empty table."""
    kept = run_stages(spark, docs)
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [common.pick(k, i="doc_id", t="text").collect() for k in kept[:-1]]
    given = {(r.i, r.t) for r in rows[0]}
    assert {(r.i, r.t) for r in rows[1]} <= given and {(r.i, r.t) for r in rows[2]} <= {(r.i, r.t) for r in rows[1]}
    assert all(len(WORD.findall(r.t or "")) >= 10 for r in rows[1])
    roots = {i: root for i, _, root in brute_components([(r.i, r.t) for r in rows[1]])}
    assert sorted(str(r.i) for r in rows[2]) == sorted(str(r.i) for r in rows[1] if r.i is None or roots[r.i] == r.i)
    assert len(rows[3]) == len(rows[2])
    assert {r.doc_id for r in kept[-1].collect()} == {r.i for r in rows[3]}
    assert all(k.count() == 0 for k in run_stages(spark, empty))


def test_n_chars_follows_the_text(spark):
    base = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, base, 7), (2, "own start " + base + " and own end", 9)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert (out[1].n_chars, out[2].text, out[2].n_chars) == (7, "own start and own end", 21)
