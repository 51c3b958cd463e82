"""A corpus pipeline over ``documents``: filter, drop near copies, cut repeats, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again for the next one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import bpe, jaccard, mixing, rules, substring
from tallyloom.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; thresholds come from the stage's own input."""
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id.

    Of rows that share that doc_id the one with the smallest text stays. Rows without doc_id are in
    no group and all stay.
    """
    first = (
        jaccard.near_duplicates(docs).where("doc_id = component_id")
        .select(F.col("doc_id").alias("first_id")).distinct()
    )
    columns = [f"`{c}`" for c in docs.columns]
    order = Window.partitionBy("doc_id").orderBy("text", *[c for c in columns if c not in ("`doc_id`", "`text`")])
    kept = docs.join(first, F.col("doc_id") == F.col("first_id"), "left_semi")
    kept = kept.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")
    return kept.unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that an earlier document has.

    Every document stays, with its kept words joined by blanks and n_chars counted anew; a text
    from which nothing is cut stays as it is, and a null text stays null.
    """
    cut = substring.cut_repeats(docs, keep=[c for c in docs.columns if c != "text"])
    changed = F.col("n_removed") > 0
    return cut.select(
        *[
            F.when(changed, F.col("kept_text")).otherwise(F.col("text")).alias("text") if c == "text"
            else F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("kept.n_chars")).alias("n_chars")
            if c == "n_chars"
            else F.col(f"kept.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh the root of their size, in shuffled order."""
    return mixing.replicate(docs).select(*[f"`{c}`" for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and ids, little-endian unsigned 32-bit integers.

    The ids are decoded again; a text that does not come back byte for byte stops the job.
    """
    ranks = bpe.default_ranks()
    both = bpe.decode(bpe.encode(docs, ranks), ranks, decoded="__decoded")
    back = F.col("__decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    lost = F.raise_error(F.concat(F.lit("ids do not decode to the text of doc_id "), name))
    return both.withColumn("ids", F.when(back, F.col("ids")).otherwise(lost.cast("binary"))).drop("__decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: The near-duplicate and encoding stages are beyond SQL; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
