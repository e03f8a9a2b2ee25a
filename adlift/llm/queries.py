"""One query per operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    _REGISTRY[run.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from adlift.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.quality_rules import fails, ledger

    found = ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ledger.*")
    base = fails(found.failures, "base-1")
    kept = ~base & ~fails(found.failures, "full-1")
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), kept.alias("kept"), "failures",
    )


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.chat_format import format_chats, read_back

    said = "</s>[INST] ok [/INST]"
    columns = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], columns)
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_chats(chats))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))[0]


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.decontamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.warc import read_warc, write_warc
    from adlift.session import fresh_dir

    folder = fresh_dir(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


@query
def op3_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.lm_score import corpus_scores

    return corpus_scores(table(spark, sf_dir, "documents"))


@query
def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.ranked_search import search

    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from adlift.llm.token_alignment import alignment

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment(table(spark, sf_dir, "documents"), *files)


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlift.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
