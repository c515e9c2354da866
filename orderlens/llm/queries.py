"""The registered queries of the text operators. Each takes (spark, folder of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe_counts,
    chat,
    decontam,
    line_dedup,
    mixing,
    ngram_join,
    prefix_trie,
    quality,
    repair,
    sharding,
    substring,
    toxicity,
    url_lists,
)
from orderlens.llm.common import text_crc32, word_count
from orderlens.scratch import stage
from orderlens.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
TOKENIZER = "piece_bpe_32k.model"
MAX_TOKENS = 4096
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def op1_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    records = stage(
        docs.select(
            "doc_id",
            sharding.record_size(F.col("text")).alias("size"),
            text_crc32(F.col("text")).alias("text_crc32"),
            F.xxhash64("text").alias("text_hash"),
        ),
        "shard-records",
    )
    placed = sharding.shard(
        records, SHARDS, F.col("text_hash"), F.xxhash64("doc_id"), F.col("size")
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_multi_order_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return ngram_join.similar_groups(docs, stage).select("doc_id", "n_shingles", "component_id")


def op3_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    rendered = chat.render(read_table(spark, folder, "conversations"))
    shown = F.transform("spans", lambda span: F.concat_ws("-", span["start"], span["end"]))
    return rendered.select(
        "conv_id", "speaker", "part", "n_turns", "text", F.array_join(shown, ",").alias("spans")
    )


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as captures; the fetch day is spread over two years by page id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("page_id") * 37) % 730).cast("int"))
    return read_table(spark, folder, "pages").select("page_id", "url", day.alias("fetched_on"))


def _list_day(pattern, start: int, spread: int):
    number = F.conv(F.substring(F.md5(pattern), start, 4), 16, 10).cast("int") % spread
    return F.date_add(F.lit("2024-01-01").cast("date"), number)


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated lists over the hosts and the registered domains that occur in the captures.

    ``watch`` blocks every host at some day and drops it later; ``partners`` allows or blocks every
    two-label domain from some day on.
    """
    hosts = pages.select(url_lists.host(F.col("url")).alias("pattern")).filter("pattern is not null")
    hosts = hosts.distinct()
    domains = hosts.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct()
    digit = F.substring(F.md5("pattern"), 9, 1)
    watch = [
        hosts.select(
            F.lit("watch").alias("list_name"),
            "pattern",
            _list_day(F.col("pattern"), start, 700).alias("listed_on"),
            F.lit(action).alias("action"),
        )
        for start, action in ((1, "block"), (5, "drop"))
    ]
    partners = domains.select(
        F.lit("partners").alias("list_name"),
        "pattern",
        _list_day(F.col("pattern"), 1, 400).alias("listed_on"),
        F.when(digit < "8", F.lit("allow")).otherwise(F.lit("block")).alias("action"),
    )
    return watch[0].unionByName(watch[1]).unionByName(partners)


def op4_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, folder, "documents"), stage)


def op5_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    ).drop("row_key")


def op6_super_kmer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return substring.remove_repeats(docs, stage, with_text=False).drop("kept_text")


def op7_temporal_list_join(spark: SparkSession, folder: str) -> DataFrame:
    pages = captures(spark, folder)
    return url_lists.judge_captures(pages, list_entries(pages)).select(
        "page_id", "host", "fetched_on", "verdict", "pattern", "list_name"
    )


def toxicity_categories() -> dict:
    """The chain over the given labels; the last two are the toxicity categories proper."""
    toxic = F.col("toxic") == 1
    return {
        "low_quality": F.col("quality") == 0,
        "toxic_low_quality": toxic & (F.col("quality") == 0),
        "toxic": toxic,
    }


REJECT_ON = ("toxic",)


def op8_classifier_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    chain = toxicity.fit_chain(
        docs, read_table(spark, folder, "labels"), toxicity_categories(), stage
    )
    scored = toxicity.score(docs, chain)
    shown = [
        F.round(F.get("probabilities", F.lit(at)), 6).alias(f"p_{name}")
        for at, name in enumerate(toxicity_categories())
    ]
    toxic = F.array_contains("reported", F.lit(REJECT_ON[0])).alias("toxic")
    return scored.select("doc_id", *shown, toxic)


def op9_mixing_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    sized = stage(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "mix-words"
    )
    return mixing.mix(sized, F.col("words")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def op10_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read_table(spark, folder, "documents"), stage).drop(
        "char_distance", "word_distance", "frequent_distance"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults planted by a hash of their conversation and number."""
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    kind = F.crc32(name.cast("binary")) % 20
    role = F.coalesce("role", blank)
    text = F.coalesce("text", blank)
    return (
        conversations.withColumn("_kind", kind)
        .filter("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, F.lit("user")).otherwise(role).alias("role"),
            F.when(F.col("_kind") == 1, F.lit(""))
            .when(F.col("_kind") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.array_repeat(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias(
                "_copy"
            ),
        )
        .drop("_copy")
    )


def op11_cyk_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = damaged(conversations)
    summary = stage(repair.summaries(turns, conversations, stage), "repair-summaries")
    hashed = repair.digests(repair.repaired_turns(turns, summary))
    joined = summary.join(hashed, summary["conv_id"].eqNullSafe(hashed["of_conv"]), "left")
    return joined.select(
        *summary.columns, F.coalesce("digest", F.lit(EMPTY_SHA256)).alias("repaired_sha256")
    )


def rebuilt(keys: DataFrame) -> DataFrame:
    """Up to three first turns come from the conversation whose id is the multiple of 20 below."""
    heads = keys.filter("conv_id % 20 = 0").select(
        F.col("conv_id").alias("base"), F.slice("keys", 1, 3).alias("head")
    )
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    joined = keys.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("base"), "left")
    begun = F.when(F.col("head").isNull(), F.slice("keys", 1, 0)).otherwise(
        F.slice("head", F.lit(1), kept.cast("int"))
    )
    own = F.slice("keys", kept.cast("int") + 1, F.size("keys"))
    return joined.select("conv_id", F.concat(begun, own).alias("keys"))


def op12_parentheses_trie(spark: SparkSession, folder: str) -> DataFrame:
    keys = stage(
        prefix_trie.conversation_keys(read_table(spark, folder, "conversations")), "trie-keys"
    )
    return prefix_trie.trie_nodes(rebuilt(keys), stage)


def op13_heap_bpe_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return bpe_counts.token_counts(docs, public_tokenizers.path(TOKENIZER), MAX_TOKENS)


def queries() -> dict[str, Query]:
    return {
        "op1_sampled_splitters": op1_sampled_splitters,
        "op2_multi_order_jaccard": op2_multi_order_jaccard,
        "op3_perspective_rotation": op3_perspective_rotation,
        "op4_line_chunks": op4_line_chunks,
        "op5_template_decontamination": op5_template_decontamination,
        "op6_super_kmer_dedup": op6_super_kmer_dedup,
        "op7_temporal_list_join": op7_temporal_list_join,
        "op8_classifier_chain": op8_classifier_chain,
        "op9_mixing_tree": op9_mixing_tree,
        "op10_distribution_divergence": op10_distribution_divergence,
        "op11_cyk_repair": op11_cyk_repair,
        "op12_parentheses_trie": op12_parentheses_trie,
        "op13_heap_bpe_counts": op13_heap_bpe_counts,
    }
