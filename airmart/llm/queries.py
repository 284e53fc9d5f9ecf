"""One query per operator over its whole table, with the parameters meant for use."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from airmart.llm import chat, collocations, decontaminate, jaccard, merkle, neighbours, oracle, passages, pieces, pseudonyms, token_files, tokens, toxicity, warc
from airmart.session import materialize

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
WORDS, END_ID = "word_bpe_49k.json", 2
TOXIC = 0.5
KEY = "test tables only"  # a real key comes from the caller


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and whether they decode to the text."""
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose five-word shingles are similar by 0.8 or more."""
    return jaccard.similar_classes(table(spark, sf_dir, "documents")).drop("n_links")


def trained_on_labels(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model | None:
    """A toxicity model from labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return toxicity.train(*toxicity.labelled_sample(docs, labels))


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity.score("text", trained_on_labels(spark, docs, sf_dir)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat, each with a passage it repeats and the class of its document."""
    return passages.passage_classes(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 60 % of a benchmark item or more, in whatever order."""
    found = decontaminate.tilings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_covered", "n_words", F.size("tiles").cast("long").alias("n_tiles"), F.round("coverage", 6).alias("coverage"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its repair and its piece of the rendered conversation; pieces go by part and seq."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def with_pseudonyms(docs: DataFrame, text_col: str) -> DataFrame:
    """Documents with pseudonyms by a key that is read from a file while the query runs."""
    spark = docs.sparkSession
    key, = jaccard.unused(docs.columns, "key")
    keyed = docs.withColumn(key, pseudonyms.stored_key(spark, pseudonyms.store_key(spark, KEY)))
    return keyed.withColumn(text_col, pseudonyms.pseudonymise(text_col, F.col(key))).drop(key)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal values replaced, and whether any was."""
    docs = with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("new")), "new")
    return docs.select("doc_id", F.coalesce(F.col("new") != F.col("text"), F.lit(False)).alias("changed"), F.col("new").alias("text"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archive read back gives it."""
    index = warc.write_archive(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archive(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found for every hundredth vector, among all others."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", tokens.byte_length("text").alias("n_bytes"), tokens.count_tokens("text", public_tokenizers.path(MODEL)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and digest as the files of token ids give them."""
    shards = token_files.write_shards(table(spark, sf_dir, "documents"), token_files.shard_folder(spark), public_tokenizers.path(WORDS), END_ID)
    return token_files.read_documents(shards)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in a manifest by source, and the root that its text, in part tampered with, folds to."""
    docs = table(spark, sf_dir, "documents")
    digest = lambda text: merkle.row_digest([*map(F.col, ("doc_id", "source", "lang", "n_chars")), text])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(chosen, digest(F.translate("text", "\n", "")))
    leaves = materialize(docs.select(F.col("source").alias("series"), F.col("doc_id").alias("id"), digest(F.col("text")).alias("digest"), tampered.alias("replacement")), "leaves")
    found = merkle.fold(merkle.build(leaves), leaves.where("replacement is not null"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.hex("leaf")).alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_jaccard, op3_toxicity, op4_passages, op5_decontamination, op6_chat, op7_pseudonyms, op8_warc, op9_neighbours, op10_token_counts, op11_collocations, op12_token_files, op13_merkle)}


def all_oracles() -> dict[str, str]:
    return oracle.all_oracles()
