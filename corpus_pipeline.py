"""The corpus pipeline: quality rules, near-duplicate removal, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared checkpoint folder and reads it
back, so a lost executor costs at most the stage it was in.  All stages but
the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard, packing, quality, substrings
from strata.llm.common import Store, table

#: The tokeniser and the iterated components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, null and repeated ids are judged row by row."""
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id; rows that repeat an id stand or fall together, null ids stay."""
    found = jaccard.near_duplicates(docs)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    names = docs.columns  # by position, as names may clash but for case
    flat = docs.toDF(*[f"_{i}" for i in range(len(names))])
    return flat.join(gone, flat[f"_{names.index('doc_id')}"] == gone["doc_id"], "left_anti").toDF(*names)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars``, where there is one, follows the text.

    Null texts become empty; null ids keep their text and shorten none."""
    names, kinds = docs.columns, docs.schema.fields
    stripped = substrings.strip_repeats(docs)
    flat = stripped.toDF(*[f"_{i}" for i in range(len(names))], "n_words", "n_removed")
    out = [F.col(f"_{i}") for i in range(len(names))]
    if "n_chars" in names:
        at = names.index("n_chars")
        out[at] = F.when(F.col("n_removed") > 0, F.length(out[names.index("text")]).cast(kinds[at].dataType)).otherwise(out[at])
    return flat.select(*out).toDF(*names)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes; see ``packing.pack``.  Null and empty texts are their end id alone; null and repeated ids are documents each."""
    packed = packing.pack(docs)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packed_sequences", packed_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    store = Store(spark, "pipeline")
    docs = table(sf_dir, "documents", spark)
    for name, stage in STAGES[:-1]:
        docs = store.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
