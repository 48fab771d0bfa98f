"""The operators' queries over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import byte_bpe, chat_format, language_id, lexical_search, licenses, media, near_dedup, packing, quality, relative_lz, repeats, token_counts, vector_codes
from tidewright.llm.workspace import Workspace

PATTERN = public_tokenizers.PATTERN
COUNT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PACK_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TAIL_BYTES = 32
"""Of the end of a payload, for ``tail_crc32``."""
PASSAGE_WORDS = 51
"""The least passage counted in ``n_passage_bytes``: over 50 words."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat_format.format_turns(chat_format.canonical_turns(rows, ["role", "text"]), "conv_id", ["turn"])
    read = out.withColumns({"turns": chat_format.parse_formatted(F.col("formatted")), "loss": chat_format.trained_text(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = media.store_media(table(spark, sf_dir, "documents"), Workspace(spark, "media"))
    read = media.read_features(media.read_headers(index), TAIL_BYTES)
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.col("length").alias("media_bytes"), "media_sha256", "feature", "width", "height")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "packing")
    pieces = work.save(packing.token_pieces(table(spark, sf_dir, "documents"), PACK_VOCABULARY), "pieces")
    return packing.pack(pieces, work)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), COUNT_VOCABULARY)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~held_out())
    return language_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "near-dedup"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), Workspace(spark, "repeats"), words=PASSAGE_WORDS)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), Workspace(spark, "vector-codes"))
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relative_lz.find_copied(table(spark, sf_dir, "documents"), Workspace(spark, "relative-lz"))
    return found.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "lexical-search")
    index = lexical_search.build_index(table(spark, sf_dir, "documents"), work)
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), work)


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_media, op3_packing, op4_token_counts, op5_language_id, op6_byte_bpe, op7_quality, op8_licenses, op9_near_dedup, op10_repeats, op11_vector_codes, op12_relative_lz, op13_lexical_search)}
