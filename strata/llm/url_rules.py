"""URL block and allow rules as a sort-merge range join.

A host's labels in reverse order make a key under which a domain and all its
subdomains form one interval: ``net/`` opens the interval that holds
``net/example/`` and everything below.  Urls and rules are dealt to parts by
ranges of that key, sorted together, and swept once: a stack holds the rules
whose intervals are open, nested from the widest to the narrowest.

Ranges come from the data (a range partitioning of all keys gives one bound
per part), with a hash of the row as a second key, so that a host with a third
of all urls is cut over many parts; a rule goes to every part that its
interval meets.  Nothing is broadcast but the bounds, one per part.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pick

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(c):
    return F.translate(c, _UPPER, _UPPER.lower())


def url_parts(urls: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Id, host and path.  Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end.  Without ``://`` or url both are empty."""
    df = pick(urls, id=id_column, url=url_column)
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.select("id", _lower(host).alias("host"), path.alias("path"))


def _key(host):
    """``www.example.net`` -> ``net/example/www/``; no host holds a slash."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/"))


def judge_urls(urls: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow", parts: int | None = None) -> DataFrame:
    """One row per url: id, host, path, the winning rule (or null) and its verdict (else ``default``).

    ``rules`` has verdict, host and path.  A rule fits its host and all
    subdomains when the url's path starts with the rule's; of several the
    longest rule text wins, then the longer host, then the smaller text.  A
    rule with a null part is no rule, nor is one with a slash in its host.  Null urls and urls without ``://`` get
    an empty host and path and the default; repeated rows are judged each; an
    empty rule table gives the default throughout; other columns are ignored.
    """
    spark = urls.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = url_parts(urls, id_column, url_column).select("*", _key(F.col("host")).alias("key"), F.xxhash64("id", "host", "path").alias("salt"))
    bounds = _bounds(keyed, n)

    def part_of(key: str, salt: int) -> int:
        return bisect_right(bounds, (key, salt))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [part_of(k, s) for k, s in zip(b["key"].to_pylist(), b["salt"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), b["key"], pa.array([1] * len(at), pa.int32()), b["id"].cast(pa.int64()), b["host"], b["path"], pa.nulls(len(at), pa.string())], schema=_EVENT)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                # every key below the rule's host starts with the rule's key
                low, high = bisect_left(bounds, (row["key"],)), bisect_right(bounds, (row["key"] + "\U0010ffff",))
                at = [*range(low, high + 1)]
                m = len(at)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([row["key"]] * m), pa.array([0] * m, pa.int32()), pa.nulls(m, pa.int64()), pa.array([row["host"]] * m), pa.array([row["path"]] * m), pa.array([row["verdict"]] * m)], schema=_EVENT)

    rule_rows = pick(rules, "verdict", "host", "path").dropna().where(~F.contains("host", F.lit("/"))).distinct()
    rule_rows = rule_rows.select("verdict", _lower(F.col("host")).alias("host"), "path").withColumn("key", _key(F.col("host")))
    schema = "part int, key string, kind int, id long, host string, path string, verdict string"
    events = keyed.mapInArrow(deal, schema).unionByName(rule_rows.mapInArrow(spread, schema))
    swept = events.repartition(n, "part").sortWithinPartitions("part", "key", "kind").mapInArrow(_sweeper(default), "id long, host string, path string, rule string, verdict string")
    return swept.withColumnRenamed("id", id_column)


_EVENT = pa.schema([("part", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), ("id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())])


def _bounds(keyed: DataFrame, n: int) -> list[tuple[str, int]]:
    """The least (key, salt) of each range partition but the first: at most ``n`` small rows."""
    ranged = keyed.select("key", "salt").repartitionByRange(n, "key", "salt")
    least = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("key", "salt")).alias("low")).collect()
    return sorted((r.low.key, r.low.salt) for r in least)[1:]


def _sweeper(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # stack: (key, {path length: {path: (rank, rule, verdict)}}), outermost first
        for b in batches:
            ids, hosts, paths, rules, verdicts = [], [], [], [], []
            for p, key, kind, i, host, path, verdict in zip(*(b[c].to_pylist() for c in _EVENT.names)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not kind:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}))
                    own = stack[-1][1].setdefault(len(path), {})
                    text = host + path
                    found = ((-len(text), -len(host), text, verdict), text, verdict)
                    own[path] = min(found, own.get(path, found))
                    continue
                best = min((fit for _, by_length in stack for length, by_path in by_length.items() if (fit := by_path.get(path[:length]))), default=None)
                ids.append(i), hosts.append(host), paths.append(path)
                rules.append(best[1] if best else None), verdicts.append(best[2] if best else default)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["id", "host", "path", "rule", "verdict"])

    return sweep
