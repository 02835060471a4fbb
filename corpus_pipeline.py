"""A corpus from raw documents to packed sequences: quality, near duplicates, repeated strings, leaks, packing.

Each stage takes (spark, docs, sf_dir) and gives the DataFrame that is written as Parquet and read again for the next.
All but the last return the columns of documents. Null texts are empty, an empty table gives empty stages, other columns
pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brume.llm import decontamination, jaccard_join, packing, quality_rules, suffix_dedup
from brume.llm.common import fresh, written
from brume.ship import shipped


#: Bytes of a string whose later copies go: less than passages of 50 words have, more than phrases that texts share by chance.
REPEAT_BYTES = 200


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the least doc_id."""
    return jaccard_join.keep_firsts(docs)


@shipped
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of strings of REPEAT_BYTES; a text of which only white space is left goes.

    Where a cut splits a character, what is left of it goes too. n_chars follows the text.
    """

    kept, removed, spans = (fresh(docs, n) for n in ("_kept", "_removed", "_spans"))
    left = suffix_dedup.dedup(docs, least=REPEAT_BYTES, keep_first=True, as_text=True, added=(kept, removed, spans))
    cut = F.col(removed) > 0
    left = left.where(~cut | F.col(kept).rlike(r"[^ \t\n\r\f\x0B]")).withColumn("text", F.when(cut, F.col(kept)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(cut, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


@shipped
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@shipped
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.digest(packing.pack(docs))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_strings), ("benchmark decontamination", decontaminated), ("packing", packed)]

#: Suffix arrays, MinHash classes, tokenizers and packing have no SQL form; each stage is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
