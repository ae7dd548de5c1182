"""The registered queries of the corpus operators, each with its check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, checks, collocations, crf, cross_entropy, derivatives, line_rules, mixing, pivots, prefix_trie, redirects, sharding, surrogates, winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_line_first_cleaning", checks.LINE_RULES)
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_rules.measured(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", F.sha2("clean_text", 256).alias("clean_sha256"),
        *[F.col("line_faults")[r].cast("long").alias(f"n_{r}") for r in line_rules.RULES],
    )


@query("op4_pivot_distances")
def op4(spark, sf_dir):
    return pivots.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_winnowing", checks.WINNOWING)
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = winnowing.shared_spans(docs, table(spark, sf_dir, "benchmark"))
    n_hit = winnowing.hit_words(F.col("found"))
    return found.select("doc_id", "found", n_hit.alias("n_hit")).select(
        "doc_id", F.col("found.n_words").alias("n_words"), "n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op10_splitting_tree", checks.MIXING)
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix = F.col("mix")
    in_shards = F.size(F.filter(mix["copies"], lambda c: c["shard"] >= 0)).cast("long")
    return mixing.mixed(docs).select("doc_id", "mix").select(
        "doc_id", mix["size"].alias("size"), mix["source_size"].alias("source_size"), mix["target"].alias("target"),
        (mix["size"] * in_shards).alias("taken"),
    )


@query("op1_extendible_hashing", checks.SHARDING)
def op1(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.col("shard.name").alias("shard"), "shard.depth", "shard.n_bytes", "shard.shard_bytes")


@query("op2_redirect_equivalence", checks.URL_RULES)
def op2(spark, sf_dir):
    return redirects.judged(table(spark, sf_dir, "pages")).select("page_id", "judgement.*")


@query("op3_warc_derivatives", checks.DERIVATIVES)
def op3(spark, sf_dir):
    return derivatives.derivatives(derivatives.responses(table(spark, sf_dir, "pages")))


@query("op9_surrogates")
def op9(spark, sf_dir):
    return surrogates.replaced(table(spark, sf_dir, "documents"), surrogates.query_key(spark)).select("doc_id", "text", "n_entities")


@query("op5_crf_language")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = crf.fitted(docs.filter(~held_out), "doc_id", "text", "lang")
    return crf.predicted(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


@query("op7_cross_entropy_difference")
def op7(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return cross_entropy.scored(table(spark, sf_dir, "documents"), good)


@query("op11_weighted_automata", checks.COLLOCATIONS)
def op11(spark, sf_dir):
    return collocations.phrases(table(spark, sf_dir, "documents"))


@query("op12_rank_queue_bpe")
def op12(spark, sf_dir):
    import public_tokenizers

    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text"), vocab).alias("own"))
    ids = F.col("own.ids")
    return docs.select("doc_id", bpe.n_tokens(ids).alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("own.decoded", 256).alias("decoded_sha256"))


@query("op13_prefix_trie")
def op13(spark, sf_dir):
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns(table(spark, sf_dir, "conversations"))))
