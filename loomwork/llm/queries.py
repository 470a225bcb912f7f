"""The registered queries of this subpackage: each takes a session and a folder of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import bpe, chat, chunked_bpe, decontamination, lm_scoring, near_dedup, neighbours, pii, prefix_trie, quality, token_alignment, token_files, url_filters
from loomwork.staging import staged, staging_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the URL filter.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(*map(F.lit, rule)) for rule in URL_RULES])))
    judged = url_filters.judged(table(spark, sf_dir, "pages"), rules.toDF("host", "path", "verdict"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target corpus is what is labelled good and not toxic."""
    target = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), target)


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.scored(table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir))
    return scored.select("doc_id", *quality.SCORES, (F.col("quality") >= quality.KEEP).alias("kept"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.PATTERNS]
    return pii.personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans")
    )


def round_trip(documents: DataFrame) -> DataFrame:
    """``doc_id, ids, decoded`` with the byte-level tokenizer."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_and_decode(documents, tokenizer)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", n_ids("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with end id 1 in packed files, read back."""
    files = token_files.write(
        table(spark, sf_dir, "documents"), staging_path(spark), public_tokenizers.path("word_bpe_49k.json"), 49_408, 1
    )
    return token_files.read(files).select("doc_id", "start", n_ids("ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and number -1, whose turns look like the template's own marks."""
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    conversations = staged(chat.formatted(chat.linear_threads(turns)))
    said = chat.read_back(conversations).groupBy("tree").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"), "loss_text"))).alias("turns"),
    )
    loss = F.array_join("turns.loss_text", "")
    lengths = conversations.select("tree", F.length("conversation").cast("long").alias("formatted_chars"))
    return said.join(lengths, "tree").select(
        F.col("tree").try_cast("long").alias("conv_id"), "n_turns", F.sha2(F.array_join("turns.said", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return neighbours.nearest(vectors, "vec_id % 20 = 0", 20)


def alignment_summary(documents: DataFrame, a: str, b: str, common_pairs: int = token_alignment.COMMON_PAIRS) -> DataFrame:
    """One row for each document: numbers of tokens, groups and links, sums over its links, and a digest of its groups."""
    found = token_alignment.aligned(documents, a, b)
    counts = staged(token_alignment.pair_counts(found, a, b))
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = token_alignment.groups(found).select("row", "doc_id", *numbers, digest.alias("groups_sha256"))
    parts = token_alignment.scored(found, counts, a, b, common_pairs)
    summed = rows.unionByName(parts, allowMissingColumns=True).groupBy("row").agg(
        *(F.max(c).alias(c) for c in ("doc_id", *numbers)), *(F.sum(c).alias(c) for c in ("n_best", "count_sum")),
        F.max("groups_sha256").alias("groups_sha256"),
    )
    return summed.drop("row")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment_summary(table(spark, sf_dir, "documents"), a, b)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_summary(table(spark, sf_dir, "conversations"))


def trie_summary(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, with a digest of those that end at each."""
    nodes, ends = prefix_trie.trie(*prefix_trie.rebuilt(conversations))
    digests = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    return nodes.join(prefix_trie.ends_digest(ends), ["depth", "node"], "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n_seqs").alias("n_convs"), "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), digests.alias("ends_sha256"),
    )


def op13_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return chunked_bpe.encode_and_decode(table(spark, sf_dir, "documents"), ranks, pattern).select(
        "doc_id", n_ids("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def n_ids(column: str) -> Column:
    """Number of 32-bit ids in a binary column."""
    return (F.octet_length(column) / 4).cast("long")


def queries() -> dict[str, Query]:
    registered = (
        op1_url_filter, op2_cross_entropy, op3_quality, op4_decontamination, op5_near_dedup, op6_pii, op7_bpe, op8_chat,
        op9_neighbours, op10_token_files, op11_token_alignment, op12_prefix_trie,
        op13_chunked_bpe,
    )
    return {query.__name__: query for query in registered}
