"""The corpus pipeline: from raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's docs. All but the
last keep the columns of documents. ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import line_dedup, packing, repetition, simhash, toxicity
from quillspark.llm.common import cut, table, unused

#: Documents at this score or above are toxic. Tokens of a sequence, and the id that ends a document.
TOXIC = 0.5
CAPACITY = 2048
END_ID = 0
#: Documents are near-duplicates from this similarity of their shingles of WIDTH words on.
SIMILARITY = 0.8
WIDTH = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the lexicon, trained on the folder's labels, scores as toxic. Null texts are not toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    name = unused(docs, "score")
    return toxicity.with_score(docs, model, name=name).filter(F.col(name) < TOXIC).drop(name)


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or repeat themselves; null and very short texts fail."""
    name = unused(docs, "kept")
    return repetition.with_repetition(docs, prefix=name.removesuffix("kept"), fields=("kept",)).filter(F.col(name)).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines out that are alike to an earlier one of the corpus; documents stay, n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that of smallest doc_id. Rows that repeat an id with other
    texts are judged each; of rows that repeat both one stays. Rows without an id come last."""
    found = simhash.near_copies(docs, SIMILARITY, WIDTH).filter("first").select(F.col("doc_id").alias("i"), F.col("th").alias("t"))
    counted = cut(found.groupBy("i", "t").agg(F.count("*").alias("n")), "near-kept")
    row, own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("own")
    kept = docs.select(row, own).join(counted, F.col("row.doc_id").eqNullSafe(F.col("i")) & (F.col("own") == F.col("t"))).select("row", "i", "t", "n")
    if not counted.filter("n > 1").isEmpty():
        kept = kept.filter("n = 1").unionByName(kept.filter("n > 1").dropDuplicates(["i", "t"]))
    return kept.select([F.col("row").getField(c).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_repetitive),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("best-fit packing", pack),
]

#: A trained lexicon, MinHash, SimHash and a packing search are beyond SQL; tests hold run() against brute-force versions of its stages, one after the other.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
