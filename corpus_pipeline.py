"""From raw documents to packed training sequences: language, quality, near duplicates, packing.

Each stage gets what its predecessor kept, as Parquet, and all but the last return the columns of ``documents`` with
whole, unchanged texts. Rows with a null doc_id go through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import language_id, line_quality, near_dups, packing
from tidewright.llm.common import discard, with_found, written
from tidewright.llm.queries import tokenizer_path


#: The columns that stages read. Others are carried under names that no operator uses, whatever they are called.
READ = ("doc_id", "text", "lang", "source")


def _apart(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[c if c in READ else f"_x{i}" for i, c in enumerate(docs.columns)])


def _back(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(_apart(docs).columns).toDF(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near enough to a centroid of some language; the label stays, a null one is filled in."""
    model = language_id.train(docs, F.lit(True))
    told = language_id.identify(_apart(docs), model).where(~F.col("lang_rejected"))
    return _back(told.withColumn("lang", F.coalesce("lang", "lang_pred")), docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't mostly boilerplate lines of their host."""
    return _back(line_quality.quality_rules(_apart(docs)).where("kept"), docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones: shingles of five words, similarity 0.8.

    Rows with equal id and text are one document; texts are shuffled for them alone, or where many documents go.
    """
    found = near_dups.near_duplicates(docs, width=5, threshold=0.8).where("doc_id IS NOT NULL")
    told = found.groupBy("doc_id").agg(F.bool_or("kept").alias("_kept"), F.count("*").alias("_rows")).where("NOT _kept OR _rows > 1")
    told = written(told, "told")
    marked = with_found(_apart(docs), told, ["doc_id"])
    once = marked.where("_rows IS NULL")
    if told.where("_kept").isEmpty():
        return _back(once, docs)
    return _back(once.unionByName(marked.where("_kept").dropDuplicates(["doc_id", "text"])), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("near_dedup", without_near_duplicates),
    ("packing", packed),
]

#: SQL can't express the first stage; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        discard(*before)  # what the stage has read
        before = [docs]
    return docs
