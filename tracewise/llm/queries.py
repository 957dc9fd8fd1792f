"""Registered queries of the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.llm import oracles
from tracewise.llm.common import table

QUERIES = {}
ORACLES = {"op4_chat_format": oracles.CHAT, "op6_sentence_dedup": oracles.SENTENCES, "op7_near_dedup": oracles.NEAR,
           "op8_url_filter": oracles.URLS, "op11_prefix_trie": oracles.TRIE, "op12_spelling_variants": oracles.SPELLING,
           "op13_line_dedup": oracles.LINES}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The public 50k byte-level vocabulary; ``TRACEWISE_TOKENIZER`` overrides the path."""
    if p := os.environ.get("TRACEWISE_TOKENIZER"):
        return p
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every text and of its edited text."""
    from tracewise.llm import winnow
    rows = winnow.edited_fingerprints(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       winnow.fingerprint_key("own_").alias("fingerprint"),
                       winnow.fingerprint_key("edited_").alias("edited_fingerprint"),
                       winnow.likeness("own_", "edited_").alias("near_edited"),
                       winnow.likeness("own_", "next_").alias("near_next"),
                       F.size("own_hashes").cast("long").alias("n_kept"))


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text decoded from them, as digests."""
    from tracewise.llm import bpe
    from tracewise.llm.common import text_rows
    vocab = bpe.Vocabulary(tokenizer_path())
    rows = bpe.encode(text_rows(table(spark, sf_dir, "documents")).select("doc_id", "text"), vocab)
    return bpe.digests(bpe.decode(rows.select("doc_id", "ids"), vocab))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document statistics, base rules and the boosted trees' verdict."""
    from tracewise.llm import quality_rules as q
    docs = table(spark, sf_dir, "documents")
    model = q.fit_rules(docs, table(spark, sf_dir, "labels"))
    return q.with_verdict(docs.select("doc_id", "text"), model).select("doc_id", *q.BASE, "base_failed", "kept")


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes control strings, formatted;
    every column is read back from the formatted output and its mask."""
    from tracewise.llm import chat
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", quoted), (-7, 1, "assistant", quoted)], rows.schema)
    out = chat.read_back(chat.format_conversations(rows.unionByName(extra), tokenizer_path()))
    return out.select("conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("loss_text").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    from tracewise.llm import packing
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op6_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the sentences that repeat an earlier span."""
    from tracewise.llm import sentence_dedup
    rows = sentence_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_removed", "text")


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components on 4-word shingles at 80 percent."""
    from tracewise.llm import lsh_forest
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


URL_RULES = ["allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by rules and redirect equivalence."""
    from tracewise.llm import url_filter
    rows = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"),
                            [url_filter.parse_rule(r) for r in URL_RULES])
    return rows.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: base spans, and all spans."""
    from tracewise.llm import pii
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pii.with_spans(docs, pii.fit_selector(docs))
    counts = [F.size(F.filter("base_spans", _of_kind(i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(pii.KINDS)]
    return rows.select("doc_id", *counts, F.sha2(pii.span_text("base_spans").cast("binary"), 256).alias("base_sha256"),
                       pii.span_text("spans").alias("spans"))


def _of_kind(i: int):
    return lambda s: s["kind"] == i


@query
def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality probability of every whole text."""
    from tracewise.llm import byte_cnn
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = byte_cnn.fit_quality(docs, table(spark, sf_dir, "labels"))
    return byte_cnn.with_score(docs, model).select(
        "doc_id", byte_cnn.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each rebuilt with the
    start of the first one of its hundred."""
    from tracewise.llm import prefix_trie as trie
    keyed = trie.conversation_keys(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    rebuilt = trie.with_shared_starts(keyed, 5, 100, lambda c: F.crc32(c.cast("string").cast("binary")) % 6)
    return trie.prefix_trie(rebuilt)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, and the frequent form each leads to; one word in
    97 is damaged on purpose."""
    from tracewise.llm import spelling
    return spelling.spelling_variants(spelling.word_counts(
        table(spark, sf_dir, "documents").select("doc_id", "text"), one_in=97))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines that ten or more documents hold."""
    from tracewise.llm import line_dedup
    rows = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
