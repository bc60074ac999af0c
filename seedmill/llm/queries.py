"""Registered queries of this subpackage, one per operator, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, filter_audit, html_wrapper, line_dedup, ngram_join, nn_descent, packing, secret_scan, shuffle_shards, template_decontam,
               toxicity, url_filter, vector_codes)
from .common import rows, table, text_or_empty

CHAT_SAMPLE = "\\### Assistant: </turn> ok"  # fixed value of the contract: conversation -7
SHARDS, SHARD_SEED = 40, 2026
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path() -> str:
    """The vocabulary file of the packing query; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids at most."""
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted; every column is read back from the formatted text."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = rows(spark, [(-7, 0, "user", CHAT_SAMPLE), (-7, 1, "assistant", CHAT_SAMPLE)], "conv_id long, turn long, role string, text string")
    messages = given.unionByName(extra).select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts"))
    out = chat_format.format_chats(messages)
    turns, loss = chat_format.parse_formatted(F.col("formatted")), chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))
    back = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, verbatim or with its slots filled anew."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = template_decontam.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.where("consistent or literal").select("doc_id", "item_id", "matched", "windows", "at", "slots")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every whole text; labels of held-out rows are never read into the fit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page through its host's wrapper."""
    out = html_wrapper.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every vector whose id is divisible by 100."""
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the contract; without a rule, canonical addresses that several rows carry are blocked."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = rows(spark, URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(pages, rules, url_filter.repeated_urls(pages))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, Jaccard 0.85 or more, components of all documents."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=85)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the numbers of the lines that an earlier line matches."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = line_dedup.removed_lines(docs)
    lines = docs.select("doc_id", F.coalesce("doc_id", F.lit(line_dedup.LAST)).alias("doc"), F.xxhash64("text").alias("th"),
                        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    found = F.coalesce("removed", F.array().cast("array<int>"))
    return lines.join(gone, ["doc", "th"], "left").select("doc_id", "n_lines", F.size(found).cast("long").alias("n_removed"),
                                                          F.array_join(found.cast("array<string>"), ",").alias("removed"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of the contract and the further rules' spans of every whole text."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in secret_scan.BASE],
                        F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each of their 120 orders, per language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "lang", "ABCDE")


def op12_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shuffled into 40 shards of row counts at most one apart."""
    out = shuffle_shards.shuffle_shards(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    return out.select("doc_id", shuffle_shards.record_size("text").alias("size"),
                      F.crc32(text_or_empty("text").cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all usable embeddings, 16 parts of 64 entries, after two rounds."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = vector_codes.codebooks_digest(books) if books is not None else ""
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_chat_format": op2_chat_format,
    "op3_template_decontam": op3_template_decontam,
    "op4_toxicity": op4_toxicity,
    "op5_html_wrapper": op5_html_wrapper,
    "op6_nn_descent": op6_nn_descent,
    "op7_url_filter": op7_url_filter,
    "op8_ngram_join": op8_ngram_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_shuffle_shards": op12_shuffle_shards,
    "op13_vector_codes": op13_vector_codes,
}
