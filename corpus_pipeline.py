"""The corpus pipeline: language, quality, near duplicates, packing.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm import langid, minhash, packing, rules
from flowtable.llm.common import materialize, ship_code, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter (``und``).

    The machines learn from the labelled documents of the input; without labels no document has a
    language, so that nothing is dropped but texts without a letter.
    """
    ship_code(spark)
    model = langid.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.identify(docs, model).where(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rule or that the learned decision list rejects."""
    verdicts = rules.quality_verdicts(docs, table(spark, sf_dir, "labels"))
    # a generator, not a filter: a filter would be pushed below the statistics and compute them again
    kept = F.when(F.col("kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return verdicts.select("row", F.explode(kept)).select("row.*")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: that with the smallest id, a row without an id last.

    Rows are told apart by a number of their own, so rows that share an id are copies only if their texts
    are.  Texts without a word are copies of nothing; of those that share an id one stays.
    """
    ship_code(spark)
    rows = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
                       .withColumn("n", F.monotonically_increasing_id()), "rows")
    found = minhash.near_duplicates(rows.select(F.col("n").alias("doc_id"), F.col("row.text").alias("text"))).select(
        F.col("doc_id").alias("n"), "component_id", (F.col("n_shingles") == 0).alias("blank"))
    ids = rows.select("n", F.col("row.doc_id").cast("long").alias("id"), F.xxhash64("row.text").alias("text"))
    group = [F.when(F.col("blank"), F.coalesce("id", "n")).otherwise(F.col("component_id")).alias("group"),
             "blank", (F.col("blank") & F.col("id").isNull()).alias("alone")]
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "text", "n")).alias("first")
    kept = found.join(ids, "n").groupBy(*group).agg(first).select(F.col("first.n").alias("n"))
    return rows.join(kept, "n", "left_semi").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    ship_code(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_duplicates", remove_near_duplicates),
    ("packing", pack_sequences),
]

#: SQL can express neither the machines nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
