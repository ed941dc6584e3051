"""The queries of the training-data operators and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from basketwise.llm import bpe, decontaminate, langid, neardup, ngram_join, packing, preference, sharding, spelling, substring, suffix, trie, warc
from basketwise.llm.oracles import ORACLES
from basketwise.llm.workers import ready
from basketwise.session import materialise
from basketwise.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(ready(spark), f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = langid.fit(docs.where(~held), vocabulary)
    found = langid.predict(docs.select("doc_id", "text"), model, vocabulary)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = preference.format_preferences(_table(spark, sf_dir, "conversations"))
    runs = lambda c: F.array_join(F.transform(c, lambda m: F.concat_ws(":", m["n"].cast("string"), m["trained"].cast("string"))), ",")
    return records.withColumns({"chosen_mask": runs("chosen_mask"), "rejected_mask": runs("rejected_mask")})


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs, 8, keep=["doc_id"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(_table(spark, sf_dir, "documents"), drop_every=199)
    return spelling.variants(counts.where((F.length("word") >= 6) & (F.col("n") >= 5)), ratio=5)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialise(trie.numbered_turns(_table(spark, sf_dir, "conversations")), "trie-turns")
    turns = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return trie.prefix_trie(*trie.graft(own, F.col("conv_id") - F.col("conv_id") % 20, turns.cast("int"), 3))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_ngram_join": op2_ngram_join,
    "op3_decontaminate": op3_decontaminate,
    "op4_langid": op4_langid,
    "op5_near_vectors": op5_near_vectors,
    "op6_suffix": op6_suffix,
    "op7_substring": op7_substring,
    "op8_bpe": op8_bpe,
    "op9_preferences": op9_preferences,
    "op10_sharding": op10_sharding,
    "op11_spelling": op11_spelling,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_packing": op13_packing,
    "pipeline": corpus_pipeline.run,
}
__all__ = ["ORACLES", "QUERIES"]
