"""Each operator on awkward rows, empty tables and against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import chat, common, jaccard, neighbours, packing, pieces, quality, sharding, substrings, url_rules, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(docs):
    return [(r.i, r.t) for r in common.pick(docs, i="doc_id", t="text").collect()]


def test_packing(docs, empty):
    rows = packing.pack(docs).collect()
    assert packing.pack(empty).count() == 0
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary_path())
    want = Counter((i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in texts(docs))
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert len(r.ids) == 4 * r.length and r.length <= 2048
    for i, parts in by_doc.items():
        ids = Counter(x for p in parts for x in np.frombuffer(p.ids, "<u4").tolist())
        assert ids == sum((Counter(k) for (d, k), n in want.items() for _ in range(n) if d == i), Counter())
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= 2048


def test_histogram_packing_is_tight():
    rng = np.random.default_rng(3)
    counts = Counter(int(x) for x in rng.integers(1, 2049, 5000))
    patterns = packing.pack_histogram(counts, 2048)
    placed = Counter()
    for n, pattern in patterns:
        assert sum(length * times for length, times in pattern) <= 2048
        for length, times in pattern:
            placed[length] += n * times
    assert placed == counts
    assert sum(k * v for k, v in counts.items()) > 0.97 * 2048 * sum(n for n, _ in patterns)


def brute_components(rows, percent=80):
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return Counter((i, len(s), find(i) if i is not None else None) for i, s in sets)


def test_jaccard_awkward(docs, empty):
    got = Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect())
    assert got == brute_components(texts(docs))
    assert jaccard.near_duplicates(empty).count() == 0


def test_jaccard_signatures_meet_for_every_linked_pair():
    """Whatever two linked sets give up of what they can afford, they keep a signature in common."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        keep = x[: n - int(rng.integers(0, max(1, n // 6) + 1))]
        y = np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 8) + 1)), dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        same = len(np.intersect1d(x, y))
        if not len(y) or 100 * same < 80 * (len(x) + len(y) - same):
            continue
        a, b = [*jaccard.entries(x)], [*jaccard.entries(y)]
        shared = np.intersect1d(np.concatenate([s for s, _ in a]), np.concatenate([s for s, _ in b]))
        assert len(shared)


def test_jaccard_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(6)
    for n in (1, 5, 60, 900, 5000):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 2**63, n // 10, dtype=np.uint64)]))
        bits = sum(int(w & (2**64 - 1)).bit_count() for w in (jaccard.sketch(x) ^ jaccard.sketch(y)).tolist())
        assert bits <= len(np.setxor1d(x, y))


def test_substrings(docs, empty):
    rows = texts(docs)
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 49):
            if i is not None:
                key = tuple(w[k : k + 50])
                first[key] = min(i, first.get(key, i))
    want = Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - 49) if i is not None and first[tuple(w[k : k + 50])] < i for j in range(50)}
        want[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    out = substrings.strip_repeats(docs)
    at = out.toDF(*[f"c{k}" for k in range(len(out.columns))])
    got = Counter((r[0], r[5], r[6], " ".join(WORD.findall(r[1]))) for r in at.collect())
    assert got == want
    assert substrings.strip_repeats(empty).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 8)).astype(np.float32)
    v[50:90] = v[50]
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(900, None), (920, [0.0] * 8), (940, [float("nan")] * 8), (960, [1.0, None] + [0.0] * 6), (980, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    s = v.astype(float) @ v.astype(float).T
    hit = 0
    assert set(got) == set(range(0, 400, 20))
    for q, found in got.items():
        assert len(found) == 20 and q not in dict(found)
        assert all(abs(x - s[q, i]) < 1e-9 for i, x in found)
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-s[q, 50 if 50 <= i < 90 else i], i))[:20]
        hit += len(set(order) & {i for i, _ in found})
    assert hit >= 0.9 * 20 * len(got)
    assert neighbours.nearest(df.where("1 = 0")).count() == 0


def test_warc(spark, tmp_path):
    big = "é<p>" * 900 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/", big), (2, "http://b/\r\n", big), (2, "http://b/\r\n", big), (3, None, None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (None, "u", big), (7, "u", "x" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload).decode() if r.payload is not None else None) for r in warc.archive_round_trip(df).collect())
    want = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = h == big and i != 2
        want[i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None, None if revisit else h or ""] += 1
    assert got == want
    assert warc.archive_round_trip(df.where("1 = 0")).count() == 0
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_url_rules(spark):
    urls = [None, "", "nothing", "http://NET", "http://net/", "https://a.b.Example.NET/en/x?y#z", "http://example.net/en", "http://xexample.com/de/", "http://example.com/de/1", "http://w.org/fr/", "http://w.org/f", "http://w.net?/en/", "://org/fr/a"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(None, "http://net/")], "page_id long, url string")
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, rules).collect()}
    want = set()
    for k, u in [*enumerate(urls), (None, "http://net/")]:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.lower()
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        want.add((k, host, path, best[1], best[2]))
    assert got == want
    assert url_rules.judge_urls(df, rules.where("1 = 0")).where("verdict <> 'allow'").count() == 0
    assert url_rules.judge_urls(df.where("1 = 0"), rules).count() == 0


def test_pieces(docs, empty):
    import sentencepiece

    model = quality.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    got = Counter((r.doc_id, None if r.ids is None else bytes(r.ids), r.text) for r in pieces.decode_documents(pieces.encode_documents(docs, model), model).collect())
    assert got == Counter((i, None if t is None else np.array(sp.encode(t), "<u4").tobytes(), t) for i, t in texts(docs))
    assert pieces.encode_documents(empty, model).count() == 0
    v = pieces.Vocabulary(model)
    for t in ["  a  b ", "\n\n a\n", "aaaaaaaaaaaaaaaaa", "<s> </s> <0x41>", "a\tb 😀", "éé̂", "x" * 100 + " " * 37 + "y"]:
        assert v.encode([t])[0].tolist() == sp.encode(t)


def test_pieces_of_long_words_take_linear_memory():
    import random
    import tracemalloc

    import sentencepiece

    model = quality.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    draw = random.Random(4)
    base = "".join(draw.choices("ABCDEFabcdefghijklmnopqrstuvwxyz0123456789+/", k=20_000))
    words = [base, base[:15_000] + "end", "".join(draw.choices("日本語漢字仮名", k=20_000)), "😀" * 5_000]
    v = pieces.Vocabulary(model)
    tracemalloc.start()
    got = v.encode(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50_000_000
    assert [x.tolist() for x in got] == [sp.encode(w) for w in words]
    assert not any(len(w) > 256 for w in v.cache.known)


def test_quality(docs, empty):
    rows = {(r.doc_id, r.n_words): r for r in quality.judge_quality(docs).collect()}
    assert rows[4, 0].base_failed and not rows[4, 0].kept and not rows[1, 120].base_failed
    text = "a b c d e f\na b c d e f\n\n  \n# |"
    w = WORD.findall(text)
    five = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    cover = {k + j for k in range(len(w) - 4) if five[tuple(w[k : k + 5])] > 1 for j in range(5)}
    assert quality.base_counts(text) == (len(w), sum(map(len, w)), 2, 1, len(cover), True)
    assert quality.judge_quality(empty).count() == 0
    kept = quality.keep_clean(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality.judge_quality(docs).collect())


def test_quality_limits_decide():
    """Documents of sf0.1: short texts full of symbols go, short prose with numbers or a license line stays."""
    clean = [
        ("fr", "Pas. Éauxaux etèmenteuxeau aile.\nDe, ré retreeau.\nAll rights reserved."),
        ("de", "Ie, des. Heitbe ötz.\nLicensed under the Apache License, Version 2.0."),
        ("en", "Was orer.\nThis work is licensed under the GNU General Public License, version 3."),
        ("fr", "Èqueelle. Aiment ourepa èê queçé oitreoi aiçre.\n1219538112535716 Éaielletre.\nEn laleenéelle la des et. Enmentai. Réleou eauoué.\nLes."),
    ]
    junk = [
        ("en", "Thingor%%% that*** of.&&& Onerea$$$ erored$$$ thoring%%% tionnd.%%%\nThe and attion to thanedble the, anea. Eriner thanea."),
        ("en", "Threston&&& orer*** atnd*** ththsh$$$ is%%% thha*** andrelythha.%%%\nThe and attion to thanedble the, anea. Eriner thanea."),
        ("en", "For&&& thstrend&&& ouedst$$$ eres*** than.\nThndating.$$$\nThe and attion to thanedble the, anea. Eriner thanea."),
    ]
    kept = [x[quality._KEPT] for x in quality._judge([t for _, t in clean + junk], [x for x, _ in clean + junk], quality.model_path(), quality.BANDS)]
    assert kept == [True] * len(clean) + [False] * len(junk)
    en = quality.BANDS["en"]
    assert en.keeps(1000, 2.2, 0.0, 0.06, 6.7 / np.log2(1000))
    assert not en.keeps(1000, 2.2, 0.0, 0.06, 6.0 / np.log2(1000))  # entropy alone
    assert not en.keeps(1000, 1.8, 0.0, 0.06, 6.7 / np.log2(1000)) and not en.keeps(1000, 2.7, 0.0, 0.06, 6.7 / np.log2(1000))  # characters alone


def test_sharding(docs, empty):
    rows = sharding.shard(docs, shards=3, bundles_per_shard=4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts(docs))
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= {0, 1, 2}
    assert sharding.shard(empty).count() == 0


def test_shards_are_even(spark):
    rng = np.random.default_rng(2)
    items = np.column_stack([rng.lognormal(5, 1, 3000), rng.lognormal(3, 1, 3000), np.ones(3000)])
    at = sharding.place(items, 24)
    for d in range(3):
        total = np.bincount(at, items[:, d], 24)
        assert total.max() - total.min() < 0.05 * total.mean()


def test_chat_tree_paths(spark):
    nodes = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a </s>", 1.0), ("t", 3, 1, "assistant", r"b [\INST]", 5.0), ("t", 4, 3, "us%er\n", None, None), (None, 9, None, "user", "lost", 0.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    rows = chat.format_trees(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).orderBy("rank", "leaf").collect()
    assert [(r.tree, r.leaf, r.loss) for r in rows] == [("t", 4, r"b [\INST]"), (None, 9, ""), ("t", 2, "a </s>")]
    assert [tuple(t) for t in rows[0].turns] == [("user", "q"), ("assistant", r"b [\INST]"), ("us%er\n", "")]
    assert chat.format_trees(df, top=1).count() == 2 and chat.format_trees(df.where("1 = 0")).count() == 0


def test_neighbours_over_many_leaves_and_blocks(spark):
    """Ties, copies and far groups; leaves too small to fill a list; queries and candidates in several blocks."""
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=(1200, 6)) + rng.normal(size=6) * 6 for _ in range(3)] + [rng.normal(size=(5, 6)) * 0.01 + 40])
    v[100:160] = v[100]
    v = np.round(v, 1)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, leaf=30, block=64).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    s, hit = v @ v.T, 0
    assert set(got) == set(range(0, len(v), 20))
    for q, found in got.items():
        assert len(found) == 20 and len(dict(found)) == 20 and q not in dict(found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and all(abs(x - s[q, i]) < 1e-9 for i, x in found)
        least = sorted((x for i, x in enumerate(s[q]) if i != q), reverse=True)[19]
        hit += sum(x >= least - 1e-9 for _, x in found)
    assert hit >= 0.9 * 20 * len(got)


def test_url_hosts_with_commas(spark):
    df = spark.createDataFrame([(1, "http://org,a/fr/x"), (2, "http://net,foo/x"), (3, "http://a,b.net/"), (4, "http://,/"), (5, "http://.net/")], "page_id long, url string")
    rules = spark.createDataFrame([*url_rules.RULES, ("block", "a/b", "/")], "verdict string, host string, path string")
    assert {(r.page_id, r.rule) for r in url_rules.judge_urls(df, rules).collect()} == {(1, None), (2, None), (3, "net/"), (4, None), (5, "net/")}


def test_equal_texts_share_a_shard(spark):
    """Groups of up to a whole shard stay together; heavier ones are cut, so that shards stay even."""
    rows = [(k, f"doc {k} " + "x" * (k % 90)) for k in range(3000)] + [(10_000 + k, "y" * 9_000) for k in range(2)] + [(20_000 + k, "z" * 100) for k in range(2000)]
    placed = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8, bundles_per_shard=64).collect()
    assert len({r.shard for r in placed if 10_000 <= r.doc_id < 20_000}) == 1
    total = np.zeros(8)
    for r in placed:
        total[r.shard] += r.size
    assert len({r.shard for r in placed if r.doc_id >= 20_000}) > 1 and total.max() - total.min() < 0.05 * total.mean()


def test_chat_null_trees_and_cycles(spark):
    rows = [(None, 1, "user", "q", "other"), (None, 2, "assistant", "a", "other"), (5, 1, "user", "x", "other")]
    chains = chat.conversation_chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, TEXT string"))
    got = {r.tree: len(r.turns) for r in chat.format_trees(chains).select("tree", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: 2, 5: 1}
    nodes = [("c", 1, 3), ("c", 2, 1), ("c", 3, 2), ("c", 4, 2), ("c", 5, 4), ("s", 1, 1), ("s", 2, 1), ("o", 1, None), ("o", 2, 1)]
    df = spark.createDataFrame([(*n, "user", f"n{n[1]}", 1.0) for n in nodes], "tree string, node long, parent long, role string, text string, score double")
    paths = {(r.tree, tuple(t.text for t in r.turns)) for r in chat.format_trees(df).select("tree", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert paths == {("c", ("n1",)), ("c", ("n3",)), ("c", ("n2", "n4", "n5")), ("s", ("n1", "n2")), ("o", ("n1", "n2"))}


def test_chat_branches_against_brute_force(spark):
    rng = np.random.default_rng(4)
    nodes, want = [], []
    for tree in range(12):
        parent = [None] + [int(rng.integers(0, k)) for k in range(1, 30)]
        score = [float(x) for x in rng.integers(0, 4, 30)]
        nodes += [(tree, k, p, "assistant" if k % 2 else "user", f"{tree}:{k}", score[k]) for k, p in enumerate(parent)]
        paths = []
        for leaf in sorted(set(range(30)) - set(parent)):
            path = [leaf]
            while parent[path[0]] is not None:
                path.insert(0, parent[path[0]])
            paths.append((-sum(score[k] for k in path), leaf, [f"{tree}:{k}" for k in path]))
        want += [(tree, leaf, at + 1, path) for at, (_, leaf, path) in enumerate(sorted(paths)[:4])]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    rows = chat.format_trees(df, top=4).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert sorted((r.tree, r.leaf, r["rank"], [t.text for t in r.turns]) for r in rows) == sorted(want)


def test_quality_base_counts_against_brute_force(spark):
    """All base columns and the contract's column order, on every document of sf0.001."""
    rows = common.table("/root/testdata/sf0.001", "documents", spark)
    judged = quality.judge_quality(rows)
    assert judged.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    text = {r.doc_id: r.text or "" for r in rows.select("doc_id", "text").collect()}
    for r in judged.collect():
        t = text[r.doc_id]
        w = WORD.findall(t)
        seen, repeated = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        five = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {k + j for k in range(len(w) - 4) if five[tuple(w[k : k + 5])] > 1 for j in range(5)}
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        assert tuple(r)[1:7] == (len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), repeated, len(cover), failed)
        assert not (failed and r.kept)


def test_packing_keeps_ids_in_order(spark):
    """Every piece's ids lie where its start says; the digest columns of the query follow."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary_path())
    rows = common.table("/root/testdata/sf0.001", "documents", spark)
    want = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 1] for r in rows.select("doc_id", "text").collect()}
    seen = Counter()
    for r in packing.pack(rows).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == want[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(want[r.doc_id])
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in want.items()}


def test_other_packing_vocabularies_are_refused(spark):
    with pytest.raises(ValueError):
        packing.WordTokenizer(packing.vocabulary_path("byte_bpe_50k.json"))


def test_packing_encodes_distinct_words_by_the_slice():
    """Ids are the library's, whatever is kept; words met once cost no Python call each."""
    import sys

    import pyarrow as pa
    import pyarrow.compute as pc

    tok = packing.WordTokenizer(packing.vocabulary_path())

    def want(text):
        words = pc.ascii_split_whitespace(pa.array([text]))[0].as_py()
        return b"".join(np.array(e.ids, tok.dtype).tobytes() for e in tok.whole.encode_batch_fast(words, add_special_tokens=False))

    odd = ["", "  ", "Don't I'LL'S 's '' x2.5--y", "ÀÉ×÷ÿß ﬁ İ <|endoftext|> a<|b", "\x1c 你好 Łódź naïve", "w" * 3000 + "," * 3000]
    for _ in range(2):
        assert tok.encode(odd) == [want(t) for t in odd]
    letters = np.random.default_rng(3).integers(97, 123, (20_000, 9)).astype(np.uint8)
    many = " ".join(bytes(w).decode() + ",;"[i % 2] for i, w in enumerate(letters))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = tok.encode([many])
    finally:
        sys.setprofile(None)
    assert got == [want(many)] and calls < 5_000


def test_jaccard_shuffles_few_texts_it_does_not_need(spark):
    """All chosen documents pass the map of bits, and about one in 16 of the others."""
    from pyspark.sql import functions as F

    ids = spark.range(-10_000, 30_000).select(F.col("id").alias("doc"), F.lit("t").alias("text"))
    docs = ids.union(spark.createDataFrame([(None, "n"), (0, "again")], "doc long, text string"))
    for step in (7, 1):
        chosen = spark.range(-10_000, 30_000, step).select(F.col("id").alias("doc"))
        near = jaccard._marked(docs, chosen)
        found, n = near.count(), chosen.count()
        assert near.columns == docs.columns and near.join(chosen, "doc").count() == n + (1 if step == 1 or 10_000 % 7 == 0 else 0)
        assert found <= n + 2 + 0.1 * (40_000 - n)  # the repeated and the null id may pass too
    assert jaccard._marked(docs, chosen.limit(0)).count() == 0
