"""The corpus pipeline: documents in, packed sequences of tokens out.

Each stage is a function of the session, the rows that the stage before kept, and the
directory of the tables.  Its result is written as Parquet and read again as the next
stage's input, so a lost executor repeats one stage at most.

1. Quality rules drop documents that fail the base rules or diverge from their language.
2. Toxicity drops documents that score at the threshold or above.
3. Near duplicates: of each group the document with the smallest id stays.
4. Substring removal cuts out byte strings that an earlier document has.
5. Packing returns a row for each piece of a document, with its token ids and its place in a
   sequence.

All stages but the last return the columns of ``documents``.  Rows without a document
id are judged like others; the near-duplicate stage keeps them.  SQL can express none of
the stages but the third and fourth, so ``ORACLE_SQL`` is None.  The tests hold the run against
its own stages one by one; only single operators are held against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credmill.llm import minhash, packing, quality, suffixes, toxicity
from credmill.sources.scratch import shared_dir

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
