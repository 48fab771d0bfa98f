"""A corpus pipeline: quality rules, language ID, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns of
``documents``; where a stage changes a text, ``n_chars`` follows. Null and empty texts are rejected by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import language_id, near_dedup, packing, quality, repeats
from tidewright.llm.sieve import Sieve
from tidewright.llm.workspace import Workspace

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.2
"""A text whose best language scores less is in none of the languages learned."""
PASSAGE_WORDS = 51
"""The least passage that counts as a repeat. Bytes count too, as some scripts put no spaces between words."""
PACK_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail are removed; documents that fail are rejected."""
    return _with_text(quality.clean(docs.select(*COLUMNS)), F.col("text"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language are rejected. It learns from the rows that op5 learns from, of this stage's input."""
    learned = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = language_id.train(docs, learned)
    judged = language_id.predict(docs.select(*COLUMNS, F.col("text").alias("read")), model, list(COLUMNS), "read")
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the least id, null ids last. Rows are told apart by a key
    of their own, as ids may repeat or be null."""
    work = Workspace(spark, "pipeline-rows")
    keyed = work.save(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = near_dedup.near_duplicates(keyed, Workspace(spark, "pipeline-near-dedup"), "row").select("row", "component_id").join(keyed.select("row", "doc_id"), "row")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("least")
    first = found.groupBy("component_id").agg(least).select("least.row")
    gone = work.save(found.select("row").join(first, "row", "left_anti"), "gone")
    # The rows that go are few, so of the others most stay where they are.
    sieve = Sieve(gone, ["row"], work, "gone-bits")
    return sieve.misses(keyed).select(*COLUMNS).unionByName(sieve.hits(keyed).join(gone, "row", "left_anti").select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte in a passage of ``PASSAGE_WORDS`` words or 400 bytes that is somewhere else too is removed. A document may be
    left empty; it stays a row."""
    left = repeats.without_repeats(docs.select(*COLUMNS), Workspace(spark, "pipeline-repeats"), words=PASSAGE_WORDS)
    return _with_text(left, F.col("text"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    work = Workspace(spark, "pipeline-packing")
    return packing.pack(work.save(packing.token_pieces(docs, PACK_VOCABULARY), "pieces"), work)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", best_fit_packing),
]
#: SQL cannot express the model, the tokenizer and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = work.save(docs, f"stage-{k}")
    return docs
