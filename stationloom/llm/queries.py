"""The registered queries of this package: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.llm import (
    addressable, alignment, ann, html, minhash, mixing, packing, personal, prefix_trie, quality, secrets, sql, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Appended to the ids of every document.
END_ID = 2

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {
    "op1_quality_rules": sql.OP1, "op4_minhash": sql.OP4, "op5_mixing": sql.OP5, "op11_personal_data": sql.OP11,
    "op13_prefix_trie": sql.OP13,
}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


@query
def op1_quality_rules(spark, sf):
    """Base counts and the verdict of the cross-document line rule on every document."""
    return quality.quality_rules(table(spark, sf, "documents", "doc_id", "text", "source"))


@query
def op2_addressable_codes(spark, sf):
    """All documents as files of directly addressable codes, read back from them."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    files = addressable.write_codes(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=END_ID)
    return addressable.documents_in_files(spark, files)


@query
def op3_harmonic_packing(spark, sf):
    """The pieces of all documents and their places in sequences of 4096 ids."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=END_ID)


@query
def op4_minhash(spark, sf):
    """Component and verdict of every document among its near duplicates."""
    return minhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"))


@query
def op5_mixing(spark, sf):
    """The words a capped mixture of all sources takes of every document."""
    out = mixing.mix(table(spark, sf, "documents", "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_toxicity(spark, sf):
    """A toxicity score for every document, learnt from the labels of the training part."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels", "doc_id", "toxic")))


@query
def op7_nearest_neighbours(spark, sf):
    """The ten nearest vectors of every hundredth one."""
    return ann.nearest(table(spark, sf, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@query
def op8_secret_scan(spark, sf):
    """Counts and spans of the secrets in every document."""
    return secrets.digest(secrets.scan(table(spark, sf, "documents", "doc_id", "text")))


@query
def op9_warc(spark, sf):
    """Every page as a WARC record, read back from the archives by byte ranges."""
    archives = warc.write_archives(table(spark, sf, "pages", "page_id", "url", "html"))
    records = warc.read_archives(spark, archives)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_html_extraction(spark, sf):
    """The main text of every page, by the container path its host's pages agree on."""
    out = html.extract(table(spark, sf, "pages", "page_id", "url", "html"))
    return out.select("*", F.length("text").cast("long").alias("n_chars"))


@query
def op11_personal_data(spark, sf):
    """Spans of personal data in every document, with identifiers found through the phrases before known ones."""
    return personal.digest(personal.personal_data(table(spark, sf, "documents", "doc_id", "text")))


@query
def op12_token_alignment(spark, sf):
    """How the tokens of two tokenizers align in every document, each distinct text worked on once."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_prefix_trie(spark, sf):
    """The nodes of the trie of conversation prefixes."""
    return prefix_trie.conversation_trie(table(spark, sf, "conversations", "conv_id", "turn", "role", "text"))
