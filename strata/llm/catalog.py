"""The subpackage's queries (opN_<name> and the pipeline) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, chat, common, jaccard, neighbours, packing, pieces, quality, repair, sharding, substrings, trie, url_rules, warc


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(common.table(sf_dir, "documents", spark))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(common.table(sf_dir, "documents", spark))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(common.table(sf_dir, "embeddings", spark), every=20, k=20)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(common.table(sf_dir, "pages", spark))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    return url_rules.judge_urls(common.table(sf_dir, "pages", spark), rules)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.model_path("piece_bpe_32k.model")
    documents = common.table(sf_dir, "documents", spark)
    decoded = pieces.decode_documents(pieces.encode_documents(documents, model), model)
    return decoded.select(
        "doc_id",
        F.octet_length("ids").cast("long").alias("ids_bytes"),
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(common.table(sf_dir, "documents", spark))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(common.table(sf_dir, "documents", spark), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = substrings.strip_repeats(common.pick(common.table(sf_dir, "documents", spark), "doc_id", "text"))
    kept = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = common.pick(common.table(sf_dir, "conversations", spark), "conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_trees(chat.conversation_chains(rows))
    turns = chat.read_turns(F.col("formatted"))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(F.col("tree").alias("conv_id"), "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode_documents(bpe.encode_documents(common.table(sf_dir, "documents", spark)))
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(common.table(sf_dir, "conversations", spark)))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(common.table(sf_dir, "conversations", spark))


QUERIES = {f.__name__: f for f in (op1_packing, op2_jaccard, op3_neighbours, op4_warc, op5_url_rules, op6_pieces, op7_quality, op8_sharding, op9_substrings, op10_chat, op11_bpe, op12_repair, op13_trie)}

_URL_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), ranked AS (
  SELECT s.page_id, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.host || r.path) AS at
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT s.page_id, s.host, s.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM split s LEFT JOIN ranked r ON r.page_id = s.page_id AND r.at = 1
"""

_WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), o AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS owner FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to FROM o
"""

_CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') AS body,
    regexp_replace(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') AS head FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(head) + 1 + length(body) + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_SUBSTRING_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM w WHERE len(words) >= 50
), k AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos : pos + 49], ' ')) AS key FROM s
), f AS (
  SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY key) AS first FROM k) WHERE doc_id > first
), gone AS (
  SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(pos, pos + 50)) AS i FROM f) GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
    CASE WHEN gone IS NULL THEN words ELSE [words[i] for i in range(1, len(words) + 1) if NOT list_contains(gone, i)] END AS left_over
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(left_over, ' '), '')) AS kept_sha256 FROM kept
"""

_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""

_REPAIR_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), crc AS (
  SELECT key, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(key) + 1),
      lambda i: [ascii(substr(key, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295) % 20 AS fate
  FROM (SELECT DISTINCT key FROM src)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM src JOIN crc USING (key)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i, left(role, 1) AS initial
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged)
), r AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM numbered
), ids AS (
  SELECT DISTINCT conv_id FROM src
), counts AS (
  SELECT ids.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM ids LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id GROUP BY ids.conv_id
), inserts(before, k, mid, added) AS (
  VALUES ('', 0, '', []::VARCHAR[]), ('', 1, 'u', ['user:']), ('', 2, 'a', ['user:', 'assistant:']),
    ('s', 0, 's', []), ('s', 1, 'u', ['user:']), ('s', 2, 'a', ['user:', 'assistant:']),
    ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:']),
    ('a', 0, 'a', []), ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:'])
), edits(mid, edit, needs, after, named, cost) AS (
  SELECT mid, 'D', NULL::VARCHAR, mid, NULL::VARCHAR, 4 FROM (VALUES (''), ('s'), ('u'), ('a')) v(mid)
  UNION ALL VALUES ('', 'K', 's', 's', NULL, 0), ('', 'K', 'u', 'u', NULL, 0), ('s', 'K', 'u', 'u', NULL, 0), ('a', 'K', 'u', 'u', NULL, 0), ('u', 'K', 'a', 'a', NULL, 0),
    ('', 'R', NULL, 'u', 'user', 3), ('s', 'R', NULL, 'u', 'user', 3), ('a', 'R', NULL, 'u', 'user', 3), ('u', 'R', NULL, 'a', 'assistant', 3)
), moves AS (
  SELECT before, after, repeat('I', k) || edit AS letters, edit, needs, named, added, 3 * k + cost AS cost FROM inserts JOIN edits USING (mid)
), dp(conv_id, i, state, best) AS (
  SELECT conv_id, 0::BIGINT, '', {'cost': 0::BIGINT, 'audit': '', 'put': []::VARCHAR[]} FROM ids
  UNION ALL
  SELECT dp.conv_id, dp.i + 1, m.after, min({'cost': dp.best.cost + m.cost + CASE WHEN m.edit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END,
    'audit': dp.best.audit || m.letters,
    'put': list_concat(dp.best.put, list_concat(m.added, CASE WHEN m.edit = 'D' THEN []::VARCHAR[] ELSE [coalesce(m.named, r.role) || ':' || r.text] END))})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1
  JOIN moves m ON m.before = dp.state AND (m.needs IS NULL OR m.needs = r.initial) AND (m.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY dp.conv_id, dp.i, m.after
), ended AS (
  SELECT dp.conv_id, min({'cost': best.cost + 3 * x.k, 'audit': best.audit || repeat('I', x.k), 'put': list_concat(best.put, x.added)}) AS best
  FROM dp JOIN counts c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n = dp.i
  JOIN inserts x ON x.before = dp.state AND x.mid IN ('', 'a')
  GROUP BY dp.conv_id
)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit, sha256(array_to_string(best.put, chr(10))) AS repaired_sha256
FROM counts c JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_TRIE_SQL = r"""
WITH src AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS head, xor(list_reduce(list_concat([4294967295::BIGINT],
      flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295) % 6 AS h
  FROM src GROUP BY conv_id
), convs AS (
  SELECT a.conv_id, a.head, a.h, least(a.h, coalesce(b.n, 0)) AS taken, least(a.h, coalesce(b.n, 0)) + greatest(a.n - a.h, 0) AS size
  FROM own a LEFT JOIN own b ON b.conv_id = a.head
), built AS (
  SELECT c.conv_id, c.size, s.i AS depth, role, text FROM convs c JOIN src s ON s.conv_id = c.head AND s.i <= c.taken
  UNION ALL SELECT c.conv_id, c.size, c.taken + s.i - c.h, role, text FROM convs c JOIN src s ON s.conv_id = c.conv_id AND s.i > c.h
), opened AS (
  SELECT conv_id, size, 0::BIGINT AS depth, '' AS opening, 0::BIGINT AS chars FROM convs
  UNION ALL SELECT conv_id, size, depth, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth)), length(text)
  FROM built
), nodes AS (
  SELECT depth, opening, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM opened GROUP BY depth, opening
), named AS (
  SELECT o.conv_id AS member, o.depth, n.conv_id FROM opened o JOIN nodes n USING (depth, opening)
), parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN named p ON p.member = n.conv_id AND p.depth = n.depth - 1
), counted AS (
  SELECT p.*, coalesce(c.n, 0) AS n_children FROM parents p
  LEFT JOIN (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM parents WHERE depth > 0 GROUP BY ALL) c USING (conv_id, depth)
), below AS (
  SELECT DISTINCT x.conv_id, x.depth, y.conv_id AS below_id, y.depth AS below_depth FROM named x JOIN named y ON x.member = y.member AND y.depth >= x.depth
), summed AS (
  SELECT b.conv_id, b.depth, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.chars)::BIGINT AS saved_tokens
  FROM below b JOIN counted c ON c.conv_id = b.below_id AND c.depth = b.below_depth GROUP BY b.conv_id, b.depth
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM counted JOIN summed USING (conv_id, depth)
"""

ORACLE = {"op2_jaccard": _JACCARD_SQL, "op9_substrings": _SUBSTRING_SQL, "op4_warc": _WARC_SQL, "op5_url_rules": _URL_SQL, "op10_chat": _CHAT_SQL, "op12_repair": _REPAIR_SQL, "op13_trie": _TRIE_SQL}
