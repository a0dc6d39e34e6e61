"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups (equal texts) are the items.  The many small ones are first hashed into
a fixed number of bundles per shard, so what is placed one by one is bounded by
a parameter: bundles, and the groups that alone outweigh one.  A group heavier
than a whole shard is cut into pieces, since no placement of the whole could
balance.  Items go heaviest first to the shard where the dot
product of their vector with the shard's residual capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, Store, pick


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows: vectors), heaviest first, to the highest dot product with the residual capacity.

    Capacity is each dimension's even share; once a shard is beyond its share
    in the heaviest sense it takes no more while another has room."""
    total = items.sum(axis=0)
    share = np.where(total > 0, total, 1) / shards
    unit = items / share
    left = np.ones((shards, items.shape[1]))
    where = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -unit.max(axis=1))):
        fits = (left >= unit[i] - 1e-12).all(axis=1)
        score = left @ unit[i] if fits.any() else left.min(axis=1)
        where[i] = int(np.argmax(np.where(fits, score, -np.inf) if fits.any() else score))
        left[where[i]] -= unit[i]
    return where


def shard(docs: DataFrame, shards: int = 24, bundles_per_shard: int = 256, split_above: float = 1.0) -> DataFrame:
    """One row per document: doc_id, size, tokens, text_crc32, group, shard and slot (gapless from 0 in each shard).

    ``size`` is the UTF-8 length plus 8; tokens are words.  Equal texts share a
    shard unless they alone fill more than ``split_above`` shards.  Null texts
    count as empty (size 8) and form one group with empty ones; repeated rows
    and null ids are rows like any other; an empty table gives no rows; other
    columns are ignored."""
    store = Store(docs.sparkSession, "shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    light = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"),
    )
    light = store.put(light, "rows")
    total = light.agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")).first()
    if not total.r:
        return light.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    most = [max(1, x or 0) / (shards * bundles_per_shard) for x in total]
    groups = light.groupBy("group").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r"))
    # at most shards * bundles_per_shard groups a dimension can exceed its bundle's even part
    weight = F.greatest(*[F.col(c) / m for c, m in zip("btr", most)])
    heavy = groups.where(weight > 1).select("group", F.when(weight > split_above * bundles_per_shard, F.ceil(weight)).otherwise(F.lit(1)).alias("pieces"))
    rows = light.join(F.broadcast(heavy), "group", "left")
    row = F.xxhash64("doc_id", "group")
    bundle = F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("group"), F.lit(shards * bundles_per_shard)).cast("string")).otherwise(F.concat_ws("/", F.hex("group"), F.pmod(row, F.col("pieces")).cast("string")))
    rows = store.put(rows.select("doc_id", "size", "tokens", "text_crc32", "group", bundle.alias("bundle")), "bundled")
    # bounded: shards * bundles_per_shard bundles, three times as many heavy groups, and the pieces they are cut into
    items = rows.groupBy("bundle").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")).orderBy("bundle").collect()
    at = place(np.array([[x.b, x.t, x.r] for x in items], float), shards)
    base, placed = [0] * shards, []
    for x, s in zip(items, at.tolist()):
        placed.append((x.bundle, s, base[s]))
        base[s] += x.r
    placed = docs.sparkSession.createDataFrame(placed, "bundle string, shard int, first long")
    order = Window.partitionBy("bundle").orderBy("doc_id", "text_crc32")
    return rows.withColumn("at", F.row_number().over(order)).join(F.broadcast(placed), "bundle").select("doc_id", "size", "tokens", "text_crc32", "group", "shard", (F.col("first") + F.col("at") - 1).alias("slot"))
