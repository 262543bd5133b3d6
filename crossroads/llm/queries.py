"""The registered queries of the operators; each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossroads.llm import chat, decontamination, lm_scoring, packing, pii, prefix_trie, quality, simhash, spelling, substring_dedup, suffix_dedup, token_counts, token_output
from crossroads.llm.frames import stored, table
from crossroads.llm.oracle import ORACLE  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op5_personal_data(spark, sf_dir):
    return span_digests(pii.table(table(spark, sf_dir)))


def _of(kind: str):
    return lambda s: s["kind"] == kind


def span_digests(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS[:pii.BASE_KINDS]))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(F.filter("spans", _of(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS[:pii.BASE_KINDS]],
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


@_query
def op7_token_counts(spark, sf_dir):
    return token_counts.counts(table(spark, sf_dir), vocabulary_file("byte_bpe_50k.json"))


@_query
def op8_benchmark_hits(spark, sf_dir):
    return hit_digests(decontamination.hits(table(spark, sf_dir), table(spark, sf_dir, "benchmark")))


def hit_digests(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


@_query
def op9_quality_rules(spark, sf_dir):
    return quality.measures(table(spark, sf_dir))


@_query
def op6_substring_dedup(spark, sf_dir):
    found = substring_dedup.deduplicated(table(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op4_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir))


@_query
def op3_suffix_array_dedup(spark, sf_dir):
    found = suffix_dedup.measured(table(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_later", "n_later_spans")


@_query
def op10_token_output(spark, sf_dir):
    docs = table(spark, sf_dir)
    store = token_output.write(docs, vocabulary_file("word_bpe_49k.json"))
    return token_output.read(docs, store, token_output.crc32, "ids_crc32 long")


@_query
def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.scores(table(spark, sf_dir), least=1)


@_query
def op1_best_fit_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir))


@_query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.word_counts(table(spark, sf_dir), change=spelling.typos))


@_query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@_query
def op11_chat_formatting(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.read_back(stored(chat.formatted(rows.unionByName(fixed)), "chat"))
